"""Vectors as fixed-width binary rows for numpy, and which of them take part."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(vec: str) -> Column:
    """True for a non-empty vector without null or non-finite components (false for a null vector)."""
    ok = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce((F.size(vec) > 0) & ok, F.lit(False))
