"""Distribution summaries: moments, quantiles, histograms, ECDF, box stats.

All of them are aggregations with a bounded result (a row per statistic, bin
or thinned point), so nothing scales with the input but the scan itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .aggregate import combine_rows, quantile, quantiles_by
from .ranked import group_quantiles, ordered_cumsum

PERCENTILES = (1, 5, 10, 25, 50, 75, 90, 95, 99)


def sample_skew(x: Column | str) -> Column:
    """Bias-corrected skewness G1 (pandas ``skew``) from Spark's population g1."""
    x = F.col(x) if isinstance(x, str) else x
    n = F.count(x).cast("double")
    return F.skewness(x) * F.sqrt(n * (n - 1)) / (n - 2)


def sample_kurtosis(x: Column | str) -> Column:
    """Bias-corrected excess kurtosis G2 (pandas ``kurt``) from population g2."""
    x = F.col(x) if isinstance(x, str) else x
    n = F.count(x).cast("double")
    return (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.kurtosis(x) + 6)


def fare_summary(df: DataFrame, value: str = "MktFare", approx: bool = False) -> DataFrame:
    """count, mean, std, skewness, kurtosis, min, p1..p99, max, iqr, cv as
    (statistic, value) rows. Moments come from one aggregation pass; the
    percentiles from ``group_quantiles`` (no task ever holds all
    distinct values), or a sketch with ``approx``."""
    qs = [p / 100 for p in PERCENTILES]
    qn = [f"p{p}" for p in PERCENTILES]
    mom = df.agg(F.count(value).cast("double").alias("count"), F.avg(value).alias("mean"),
                 F.stddev_samp(value).alias("std"), sample_skew(value).alias("skewness"),
                 sample_kurtosis(value).alias("kurtosis"), F.min(value).alias("min"),
                 F.max(value).alias("max"))
    if approx:
        qt = df.agg(F.percentile_approx(value, qs, 10000).alias("_q")).select(
            *[F.col("_q")[i].alias(n) for i, n in enumerate(qn)])
    else:
        qt = group_quantiles(df, [], value, qs, qn)
    wide = combine_rows(mom, qt)
    cols = ["count", "mean", "std", "skewness", "kurtosis", "min"]
    exprs = [F.col(c).cast("double") for c in cols] + [F.col(n).cast("double") for n in qn]
    names = cols + qn
    exprs += [F.col("max").cast("double"), (F.col("p75") - F.col("p25")),
              F.try_divide(F.col("std"), F.col("mean"))]
    names += ["max", "iqr", "cv"]
    pairs = F.array(*[F.struct(F.lit(i).alias("ord"), F.lit(n).alias("statistic"), e.alias("value"))
                      for i, (n, e) in enumerate(zip(names, exprs))])
    return wide.select(F.inline(pairs))


def histogram(df: DataFrame, value: Column | str, bins: int, lo: float | None = None,
              hi: float | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Equal-width histogram on [lo, hi] (numpy rules: last bin closed, values
    outside dropped). Missing range → the data's min/max (one scalar pass)."""
    x = F.col(value) if isinstance(value, str) else value
    if lo is None or hi is None:
        r = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi")).first()
        lo = r["lo"] if lo is None else lo
        hi = r["hi"] if hi is None else hi
        if lo is None:
            lo, hi = 0.0, 1.0
        if hi == lo:
            lo, hi = lo - 0.5, hi + 0.5
    lo, hi = float(lo), float(hi)
    b = F.least(F.floor((x - F.lit(lo)) * F.lit(bins) / F.lit(hi - lo)), F.lit(bins - 1)).cast("int")
    keep = x.between(F.lit(lo), F.lit(hi))
    w = (hi - lo) / bins
    out = (df.filter(keep).groupBy(*by, b.alias("bin"))
           .agg(F.count(F.lit(1)).cast("bigint").alias("count")))
    return out.select(*by, "bin", (F.lit(lo) + F.col("bin") * F.lit(w)).alias("bin_lo"),
                      (F.lit(lo) + (F.col("bin") + 1) * F.lit(w)).alias("bin_hi"), "count")


def ecdf(df: DataFrame, value: str, max_points: int = 10000,
         buckets: int | None = None) -> DataFrame:
    """Thinned empirical CDF: rows ``i = 0, step, 2·step, ..`` of the sorted
    values with share ``(i+1)/n``, ``step = max(1, n // max_points)``.

    Rows are first collapsed to one per distinct value, running counts come
    from range buckets (no single-task window), and each value emits only
    the thinned indices that fall in its row range.
    """
    counts = (df.filter(F.col(value).isNotNull()).groupBy(value)
              .agg(F.count(F.lit(1)).alias("cnt")))
    n = counts.agg(F.sum("cnt")).first()[0] or 0
    if n == 0:
        return counts.select(F.col(value), F.lit(0.0).alias("ecdf")).limit(0)
    step = max(1, n // max_points)
    cum = ordered_cumsum(counts, value, ["cnt"], buckets)
    first = F.col("cnt_cum") - F.col("cnt")          # first 0-based row index of the value
    last = F.col("cnt_cum") - 1
    k0 = F.ceil(first / F.lit(step)) * F.lit(step)
    idx = F.when(k0 <= last, F.sequence(k0.cast("long"), last.cast("long"), F.lit(step).cast("long")))
    return (cum.select(value, F.explode(idx).alias("i"))
            .select(F.col(value), ((F.col("i") + 1) / F.lit(float(n))).alias("ecdf")))


def box_stats(df: DataFrame, value: str, upper: float | None = None,
              approx: bool = False) -> DataFrame:
    """Quartiles, 1.5·IQR whiskers (most extreme points inside the fences)
    and outlier count, on values capped at ``upper``."""
    x = F.least(F.col(value), F.lit(float(upper))) if upper is not None else F.col(value)
    capped = df.select(x.alias("_x")).filter(F.col("_x").isNotNull())
    if approx:
        q = capped.agg(quantile("_x", [0.25, 0.5, 0.75], True).alias("q")).first()["q"] or [None] * 3
    else:
        r = group_quantiles(capped, [], "_x", [0.25, 0.5, 0.75], ["q1", "q2", "q3"]).first()
        q = [r["q1"], r["q2"], r["q3"]] if r is not None else [None] * 3
    q1, q2, q3 = q
    iqr = (q3 - q1) if q1 is not None else None
    lo_f = q1 - 1.5 * iqr if iqr is not None else 0.0
    hi_f = q3 + 1.5 * iqr if iqr is not None else 0.0
    inside = F.col("_x").between(F.lit(lo_f), F.lit(hi_f))
    return capped.agg(
        F.lit(q1).cast("double").alias("q1"), F.lit(q2).cast("double").alias("median"),
        F.lit(q3).cast("double").alias("q3"), F.lit(iqr).cast("double").alias("iqr"),
        F.min(F.when(inside, F.col("_x"))).alias("whisker_lo"),
        F.max(F.when(inside, F.col("_x"))).alias("whisker_hi"),
        F.count_if(~inside).alias("n_outliers"))


def describe(df: DataFrame, columns: Sequence[str] | None = None,
             approx: bool = False) -> DataFrame:
    """count/mean/std/min/25%/50%/75%/max per numeric column, exact quantiles
    by default (Spark's ``summary`` is approximate). Moments in one pass; the
    quartiles of every column from one ``group_quantiles`` over the
    (column, value) pairs — the column name is the group."""
    num = ("int", "bigint", "smallint", "tinyint", "double", "float")
    columns = columns or [f.name for f in df.schema.fields
                          if f.dataType.simpleString() in num or
                          f.dataType.simpleString().startswith("decimal")]
    aggs = []
    for c in columns:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"{c}__count"), F.avg(x).alias(f"{c}__mean"),
                 F.stddev_samp(x).alias(f"{c}__std"), F.min(x).alias(f"{c}__min"),
                 F.max(x).alias(f"{c}__max")]
    wide = df.agg(*aggs)
    mom = wide.select(F.inline(F.array(*[F.struct(
        F.lit(c).alias("column"), F.col(f"{c}__count").cast("bigint").alias("count"),
        F.col(f"{c}__mean").alias("mean"), F.col(f"{c}__std").alias("std"),
        F.col(f"{c}__min").alias("min"), F.col(f"{c}__max").alias("max")) for c in columns])))
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v"))
                                         for c in columns])).alias("p")).select("p.*")
    if approx:
        qt = long.groupBy("column").agg(F.percentile_approx("v", [0.25, 0.5, 0.75], 10000).alias("q")).select(
            "column", F.col("q")[0].alias("p25"), F.col("q")[1].alias("p50"), F.col("q")[2].alias("p75"))
    else:
        qt = group_quantiles(long, ["column"], "v", [0.25, 0.5, 0.75], ["p25", "p50", "p75"])
    return mom.join(qt, "column", "left").select("column", "count", "mean", "std", "min", "p25", "p50",
                                                 "p75", "max")


def grouped_density(df: DataFrame, value: str, by: str, bins: int, lo: float, hi: float,
                    upper: float | None = None, approx: bool = False) -> DataFrame:
    """Per group: normalised histogram of (capped) values and the group median.

    The reference draws a kernel-smoothed violin; here the same data is
    returned as a histogram whose shares sum to 1 per group, plus the median.
    """
    x = F.least(F.col(value), F.lit(float(upper))) if upper is not None else F.col(value)
    capped = df.select(F.col(by), x.alias("_x")).filter(F.col(by).isNotNull() & F.col("_x").isNotNull())
    h = histogram(capped, "_x", bins, lo, hi, by=[by])
    share = F.col("count") / F.sum("count").over(Window.partitionBy(by))
    meds = quantiles_by(capped, [by], "_x", [0.5], ["median"], approx)
    return h.select(by, "bin", "bin_lo", "bin_hi", "count", share.alias("share")).join(meds, by)


def fare_segments(df: DataFrame, value: str, segments, approx: bool = False) -> DataFrame:
    """Rows per (possibly overlapping) band: count, % of all rows, median.

    Each row is expanded to the bands it falls in (at most two here), so one
    aggregation gives all bands; the all-rows total rides along as an extra
    pseudo-band and is spread to the ≤ 6 result rows by a window.
    """
    from .clean import segment_predicate
    x = F.col(value)
    labels = [F.when(segment_predicate(x, lo, hi, kind), F.lit(lab))
              for lab, lo, hi, kind in segments]
    labels.append(F.lit("__all__"))
    exp = df.select(x.alias("_x"), F.explode(F.array(*labels)).alias("segment")).filter(
        F.col("segment").isNotNull())
    g = exp.groupBy("segment").agg(F.count(F.lit(1)).alias("count"))
    g = g.join(quantiles_by(exp, ["segment"], "_x", [0.5], ["median"], approx), "segment", "left")
    total = F.max(F.when(F.col("segment") == "__all__", F.col("count"))).over(Window.partitionBy())
    order = {lab: i for i, (lab, *_r) in enumerate(segments)}
    ordc = None
    for lab, i in order.items():
        ordc = (F.when(F.col("segment") == lab, F.lit(i)) if ordc is None
                else ordc.when(F.col("segment") == lab, F.lit(i)))
    out = g.select("segment", ordc.alias("ord"), "count",
                   (F.col("count") * 100.0 / total).alias("pct"), "median")
    return out.filter(F.col("segment") != "__all__")


def kernel_density(df: DataFrame, value: str, by: str, bins: int, lo: float, hi: float,
                   upper: float | None = None) -> DataFrame:
    """Smoothed shape per group: ``by, bin, x, share``, a Gaussian kernel density at the centre of each of ``bins``
    equal bins over [lo, hi], as its share of the group's whole.

    Values count in their bin (clamped into the range), so the kernel is summed over bins and not over rows: a group
    is ``bins`` counts, whatever its size, and the convolution is ``bins²`` products. The bandwidth is Scott's,
    σ·n^(−1/5), from the group's own values; a group without spread is one bin wide.
    """
    given = F.col(value).cast("double")
    v = F.least(given, F.lit(float(upper))) if upper is not None else given
    width = (hi - lo) / bins
    rows = df.filter(given.isNotNull() & F.col(by).isNotNull()).select(by, v.alias("_v"))
    rows = rows.withColumn("_bin", F.greatest(F.least(F.floor((F.col("_v") - lo) / width), F.lit(bins - 1)), F.lit(0)))
    counts = rows.groupBy(by, "_bin").agg(F.count(F.lit(1)).alias("_c"))
    spread = rows.groupBy(by).agg(F.stddev_samp("_v").alias("_s"), F.count(F.lit(1)).alias("_n"))
    h = F.coalesce(F.nullif(F.col("_s") * F.pow("_n", F.lit(-0.2)), F.lit(0.0)), F.lit(width))
    near = counts.join(spread.select(by, h.alias("_h")), by).withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    z = (F.col("bin") - F.col("_bin")) * width / F.col("_h")
    smooth = near.groupBy(by, "bin").agg(F.sum(F.col("_c") * F.exp(-z * z / 2)).alias("_d"))
    whole = Window.partitionBy(by)  # ``bins`` rows
    return smooth.select(by, F.col("bin").cast("int").alias("bin"), (F.lit(lo) + (F.col("bin") + 0.5) * width).alias("x"),
                         (F.col("_d") / F.sum("_d").over(whole)).alias("share"))
