"""Global running sums over an ordered key without an un-partitioned window.

``Window.orderBy(x)`` with no ``partitionBy`` moves every row into one task.
Instead the rows (already collapsed to one per distinct key) are cut into
``buckets`` contiguous key ranges at approximate quantiles; each range gets
its running sum in its own window partition, and a tiny per-range totals
table (one row per range, a proven size bound) supplies the offset of every
range. The result is exact: only the cut points are approximate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _bucket_bounds(df: DataFrame, key: str, buckets: int) -> list:
    if buckets <= 1:
        return []
    qs = [i / buckets for i in range(1, buckets)]
    row = df.agg(F.percentile_approx(key, qs, 1000).alias("b")).first()
    bounds = row["b"] if row and row["b"] is not None else []
    return sorted(set(bounds))


def ordered_cumsum(df: DataFrame, key: str, sum_cols: Sequence[str],
                   buckets: int | None = None, suffix: str = "_cum") -> DataFrame:
    """Add ``<col><suffix>``: sum of ``col`` over all rows with key ≤ this row's key.

    ``df`` must hold one row per distinct ``key`` (aggregate first); ties in
    the key therefore never split across ranges.
    """
    spark = df.sparkSession
    if buckets is None:
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = _bucket_bounds(df, key, buckets)
    # bucket = number of cut points strictly below the key (ranges are (b[i-1], b[i]])
    if bounds:
        arr = F.array(*[F.lit(b) for b in bounds])
        bucket = F.size(F.filter(arr, lambda b: b < F.col(key)))
    else:
        bucket = F.lit(0)
    b = df.withColumn("_bucket", bucket.cast("int"))
    w = Window.partitionBy("_bucket").orderBy(key).rowsBetween(Window.unboundedPreceding, 0)
    local = b.select("*", *[F.sum(c).over(w).alias(f"_local_{c}") for c in sum_cols])
    totals = b.groupBy("_bucket").agg(*[F.sum(c).alias(f"_tot_{c}") for c in sum_cols])
    # offsets: running total of the ranges before; the table has ≤ buckets rows
    wt = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_bucket", *[F.coalesce(F.sum(f"_tot_{c}").over(wt), F.lit(0))
                                         .alias(f"_off_{c}") for c in sum_cols])
    out = local.join(F.broadcast(offsets), "_bucket")
    return out.select(*df.columns, *[(F.col(f"_off_{c}") + F.col(f"_local_{c}")).alias(c + suffix)
                                     for c in sum_cols])


# buckets per unit of ln|value|: a bucket spans a factor of e^(1/2048) ≈ 1.0005
BUCKETS_PER_E = 2048


def _value_bucket(x: Column) -> Column:
    """A bucket number that never decreases with ``x`` (a double): the sign and
    ln|x| in fixed steps. Equal values share a bucket, whatever the scale of
    the data; all doubles fall into fewer than 7 million buckets."""
    step = F.floor(F.least(F.greatest(F.ln(F.abs(x)), F.lit(-750.0)), F.lit(750.0)) * BUCKETS_PER_E)
    size = step + 751 * BUCKETS_PER_E
    return F.when(x == 0, F.lit(0)).when(x < 0, -size).otherwise(size).cast("int")


def group_quantiles(df: DataFrame, by: Sequence[str], value: str, qs: Sequence[float],
                    names: Sequence[str] | None = None) -> DataFrame:
    """Exact, linearly interpolated quantiles of ``value`` per group (as
    ``percentile``), by one plan for every size and without a driver job.

    1. rows collapse to one count per distinct (group, value), combined map
       side, so ties are never sorted row by row;
    2. a histogram per group over ``_value_bucket`` (a bounded number of rows,
       whatever the size of the group) gets running counts, which name the
       buckets that hold the wanted ranks;
    3. only those buckets' distinct values get running counts of their own, and
       the order statistics at the floor and ceiling of ``q·(n−1)`` are
       interpolated.

    Rows with a null value or a null group key take no part. Without ``by``
    there is one row, of nulls if there is no value.
    """
    by = list(by)
    names = list(names or [f"q{i}" for i in range(len(qs))])
    x = df.filter(F.col(value).isNotNull() & _all_not_null(by))
    counts = (x.select(*by, F.col(value).cast("double").alias("_v")).groupBy(*by, "_v")
              .agg(F.count(F.lit(1)).alias("_c")).withColumn("_bucket", _value_bucket(F.col("_v"))))
    # no bucket is null; said here, or the join below infers it for one of its two sides, whose counts then differ in plan
    # from the other's and are scanned, counted and shuffled again
    counts = counts.filter(F.col("_bucket").isNotNull())
    whole = Window.partitionBy(*by)
    before = whole.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    hist = counts.groupBy(*by, "_bucket").agg(F.sum("_c").alias("_in")).select(
        *by, "_bucket", "_in", F.coalesce(F.sum("_in").over(before), F.lit(0)).alias("_before"),
        F.sum("_in").over(whole).alias("_n"))
    ranks = []
    for i, q in enumerate(qs):
        pos = F.lit(float(q)) * (F.col("_n") - 1)
        ranks += [F.struct(F.lit(i).alias("q"), F.lit(high).alias("high"), r.cast("long").alias("rank"))
                  for high, r in ((False, F.floor(pos)), (True, F.ceil(pos)))]
    held = F.filter(F.array(*ranks), lambda r: (r["rank"] >= F.col("_before"))
                    & (r["rank"] < F.col("_before") + F.col("_in")))
    wanted = hist.withColumn("_ranks", held).filter(F.size("_ranks") > 0).drop("_in")
    upto = Window.partitionBy(*by, "_bucket").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    last = F.col("_before") + F.sum("_c").over(upto)  # ranks of a value: last − count .. last − 1
    found = (counts.join(wanted, [*by, "_bucket"])
             .select(*by, "_v", "_c", "_n", "_ranks", last.alias("_last"))
             .select(*by, "_v", "_n", F.explode(F.filter("_ranks", lambda r: (r["rank"] < F.col("_last"))
                                                         & (r["rank"] >= F.col("_last") - F.col("_c")))).alias("_r")))
    one = found.groupBy(*by).agg(
        F.max("_n").alias("_n"),
        *[F.max(F.when((F.col("_r.q") == i) & (F.col("_r.high") == high), F.col("_v"))).alias(f"_{i}_{side}")
          for i in range(len(qs)) for side, high in (("lo", False), ("hi", True))])
    out = []
    for i, (q, name) in enumerate(zip(qs, names)):
        pos = F.lit(float(q)) * (F.col("_n") - 1)
        lo, hi = F.col(f"_{i}_lo"), F.col(f"_{i}_hi")
        out.append(F.when(lo == hi, lo).otherwise((F.ceil(pos) - pos) * lo + (pos - F.floor(pos)) * hi).alias(name))
    return one.select(*by, *out)


def _all_not_null(cols: Sequence[str]) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return cond
