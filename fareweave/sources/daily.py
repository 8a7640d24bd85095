"""Daily collected files: one folder a day, appended to, collected once a day unless forced.

Which days are there is read from the folder names, so guarding a run opens no file.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..streaming.snapshots import append_daily


def landed_days(spark: SparkSession, path: str, day_col: str = "collected_date") -> list[date]:
    """The days that have a folder with files."""
    root = spark._jvm.org.apache.hadoop.fs.Path(os.path.join(path, f"{day_col}=*", "*"))
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    names = {re.search(rf"{day_col}=([^/]+)/", f.getPath().toString())[1] for f in fs.globStatus(root) or []
             if not f.getPath().getName().startswith(("_", "."))}
    return sorted(date.fromisoformat(n) for n in names if n[:1].isdigit())


def collect_once(df: DataFrame, path: str, force: Iterable[date] = (), day_col: str = "collected_date") -> list[date]:
    """Append the rows of those days that are not landed yet, or are in ``force``, in one job; the days appended.

    A forced day is appended to, as its earlier rows stay. Rows without a day are not collected."""
    spark = df.sparkSession
    have = set(landed_days(spark, path, day_col)) - set(force)
    offered = df.filter(F.col(day_col).isNotNull())
    days = [r[0] for r in offered.select(day_col).distinct().collect()]  # one row a day
    todo = sorted(d for d in days if d not in have)
    if todo:
        append_daily(offered.filter(F.col(day_col).isin(todo)), path, day_col)
    return todo


def days_to_collect(spark: SparkSession, path: str, first: date, last: date, day_col: str = "collected_date") -> DataFrame:
    """``day``: the days of a schedule that are not landed."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(first), F.lit(last))).alias("day"))
    have = landed_days(spark, path, day_col)
    return days.filter(~F.col("day").isin(have)) if have else days
