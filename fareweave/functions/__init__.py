"""Column-level helpers (scalar functions) — every one returns a ``Column``."""
