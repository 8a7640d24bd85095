"""Exact, seeded, stratified sampling.

Per stratum keep the ``k = round_half_even(fraction · n)`` rows with the
smallest ``md5(key | seed)``. A window over a whole stratum would sort a
stratum (possibly a third of all rows) in one task, so instead:

1. every row gets a 20-bit hash prefix bucket; counting rows per
   (stratum, bucket) is a small map-side-combined aggregation;
2. a running count over that small table finds, per stratum, the bucket in
   which the k-th row lies and how many rows of it are still needed;
3. rows of earlier buckets are kept outright; only rows of that one
   boundary bucket (≈ n / 2^20 of the stratum) are ranked by a window.

The sample is nested in the fraction (a larger fraction keeps a superset)
and independent of partitioning, so it is reproducible across clusters.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PREFIX_HEX = 5  # 20 bits → ≤ 1,048,576 buckets per stratum


def sample_hash(key: str, seed: int):
    return F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed))))


def exact_sample(df: DataFrame, strata: Sequence[str], key: str, fraction: float,
                 seed: int = 42) -> DataFrame:
    if not 0 <= fraction <= 1:
        raise ValueError("fraction must be in [0, 1]")
    strata = list(strata)
    h = df.withColumn("_h", sample_hash(key, seed)).withColumn(
        "_b", F.conv(F.substring("_h", 1, PREFIX_HEX), 16, 10).cast("int"))
    counts = h.groupBy(*strata, "_b").agg(F.count(F.lit(1)).alias("_n"))
    ws = Window.partitionBy(*strata)
    wc = ws.orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    cum = counts.select(*strata, "_b", "_n",
                        F.sum("_n").over(wc).alias("_cum"),
                        F.bround(F.lit(fraction) * F.sum("_n").over(ws), 0).cast("long").alias("_k"))
    # boundary bucket per stratum: first bucket whose running count reaches k
    cut = (cum.filter((F.col("_cum") >= F.col("_k")) & (F.col("_k") > 0))
           .groupBy(*strata)
           .agg(F.min_by(F.struct("_b", (F.col("_k") - F.col("_cum") + F.col("_n")).alias("need")),
                         F.col("_b")).alias("c"))
           .select(*strata, F.col("c._b").alias("_cut"), F.col("c.need").alias("_need")))
    # one row per stratum; AQE broadcasts it when its runtime size is small
    j = h.join(cut, strata)
    below = j.filter(F.col("_b") < F.col("_cut"))
    edge = j.filter(F.col("_b") == F.col("_cut"))
    rank = F.row_number().over(Window.partitionBy(*strata).orderBy("_h", key))
    edge = edge.withColumn("_r", rank).filter(F.col("_r") <= F.col("_need")).drop("_r")
    cols = df.columns
    return below.select(*cols).unionByName(edge.select(*cols))


# --- stored samples -----------------------------------------------------------

RANK, POPULATION = "_sample_rank", "_stratum_rows"


def ranked_sample(df: DataFrame, strata: Sequence[str], key: str, fraction: float, seed: int = 42) -> DataFrame:
    """The rows of ``exact_sample`` with their rank in the stratum's hash order and the stratum's size, so that any
    smaller fraction is a filter on the two.

    Rows are hashed once: running counts over the hash-prefix buckets give each bucket its first rank, and only rows
    of one bucket (≈ n / 2^20 of a stratum) are put in order together.
    """
    if not 0 <= fraction <= 1:
        raise ValueError("fraction must be in [0, 1]")
    strata = list(strata)
    h = df.withColumn("_h", sample_hash(key, seed)).withColumn(
        "_b", F.conv(F.substring("_h", 1, PREFIX_HEX), 16, 10).cast("int"))
    counts = h.groupBy(*strata, "_b").agg(F.count(F.lit(1)).alias("_n"))
    ws = Window.partitionBy(*strata)
    first = F.coalesce(F.sum("_n").over(ws.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select(*strata, "_b", first.alias("_first"), F.sum("_n").over(ws).alias(POPULATION))
    wanted = F.bround(F.lit(fraction) * F.col(POPULATION), 0).cast("long")
    starts = starts.filter(F.col("_first") < wanted)
    j = h.join(starts, [*strata, "_b"])
    within = F.row_number().over(Window.partitionBy(*strata, "_b").orderBy("_h", key))
    ranked = j.withColumn(RANK, F.col("_first") + within).filter(F.col(RANK) <= wanted)
    return ranked.select(*df.columns, RANK, POPULATION)


def store_sample(df: DataFrame, path: str, strata: Sequence[str], key: str, fraction: float, seed: int = 42) -> None:
    """Write a ranked sample, one folder per stratum, its rows in hash order."""
    (ranked_sample(df, strata, key, fraction, seed).repartition(*strata, F.floor(F.col(RANK) / 1_000_000))
     .sortWithinPartitions(*strata, RANK).write.mode("overwrite").partitionBy(*strata).parquet(path))


def load_sample(spark, path: str, columns: Sequence[str] | None = None, fraction: float | None = None) -> DataFrame:
    """A stored sample, or the part of it that a smaller ``fraction`` of the population keeps; reads only ``columns``
    (and, for a fraction, the two rank columns)."""
    stored = spark.read.parquet(path)
    if fraction is not None:
        stored = stored.filter(F.col(RANK) <= F.bround(F.lit(fraction) * F.col(POPULATION), 0).cast("long"))
    return stored.select(*(columns or [c for c in stored.columns if c not in (RANK, POPULATION)]))
