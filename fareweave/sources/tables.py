"""Driver tables: one Parquet file per table under an ``sf_dir``.

Reads never infer anything but the Parquet footer schema, and every caller
selects only the columns it needs, so Catalyst prunes the scan
(``ReadSchema`` in ``explain``) and pushes filters into it.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Read one driver table, optionally projected to ``columns``."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df
