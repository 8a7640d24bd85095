"""Registry binding SURVEY §2 keys to a Spark query and its DuckDB oracle.

A query is ``fn(spark, sf_dir) -> DataFrame``; the oracle is DuckDB SQL over
the driver tables, with the fixture views it needs prefixed as CTEs. Keys
without an oracle (model fits, stateful streams, file round trips) are
checked by pytest against brute force instead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.fixtures import with_views

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
_RAW: dict[str, tuple[str, tuple[str, ...]]] = {}


def register(key: str, oracle: str | None = None, views: tuple[str, ...] = ()):
    """Decorator: register ``fn`` under ``key`` with an optional oracle SQL."""

    def deco(fn: Query) -> Query:
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key!r}")
        QUERIES[key] = fn
        if oracle is not None:
            _RAW[key] = (oracle, views)
        return fn

    return deco


def load_all() -> None:
    """Import every plan module so that its queries register."""
    from . import (calendar_plans, itinerary_plans, market_plans,  # noqa: F401
                   model_plans, source_plans, stream_plans, track_plans)
    # views are resolved only now: a plan module may use views another defines
    for key, (sql, views) in _RAW.items():
        ORACLES[key] = with_views(sql, *views)
