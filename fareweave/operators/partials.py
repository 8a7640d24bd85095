"""Aggregates over many quarters from stored partial aggregates.

One row per quarter and group holds what merges exactly (count, sum, minimum, maximum, mean and squared deviations) and
sketches that merge within their stated error (KLL for quantiles, HLL for distinct counts). A result over any range of
quarters combines these rows; the facts are read once, when their quarter is stored.

Squared deviations merge as ``Σ m2 + Σ n (mean − overall mean)²``, which does not cancel as sums of squares do.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

QUARTER = ("Year", "Quarter")
#: Relative rank error of the quantile sketch (k = 200) and standard error of the distinct count (lg k = 12).
QUANTILE_ERROR, DISTINCT_ERROR = 0.0165, 0.0163


def partial_aggregates(df: DataFrame, by: Sequence[str], values: Sequence[str] = (), distincts: Sequence[str] = (),
                       unit: Sequence[str] = QUARTER) -> DataFrame:
    """One row per ``unit`` and ``by``: mergeable parts of each value column and sketches of each distinct column."""
    aggs: list[Column] = [F.count(F.lit(1)).alias("rows")]
    for v in values:
        x = F.col(v).cast("double")
        aggs += [F.count(v).alias(f"{v}_n"), F.sum(x).alias(f"{v}_sum"), F.min(x).alias(f"{v}_min"),
                 F.max(x).alias(f"{v}_max"), F.avg(x).alias(f"{v}_avg"), (F.var_pop(x) * F.count(v)).alias(f"{v}_m2"),
                 F.kll_sketch_agg_double(x).alias(f"{v}_kll")]
    aggs += [F.hll_sketch_agg(F.col(d).cast("string")).alias(f"{d}_hll") for d in distincts]
    return df.groupBy(*unit, *by).agg(*aggs)


def combine_partials(parts: DataFrame, by: Sequence[str], values: Sequence[str] = (), distincts: Sequence[str] = (),
                     qs: Sequence[float] = (), unit: Sequence[str] = QUARTER) -> DataFrame:
    """The aggregates per ``by`` over all units of ``parts``: ``<v>_count, _sum, _mean, _min, _max, _std`` exactly,
    ``<v>_q<i>`` and ``<d>_nunique`` from the sketches, and ``_unit_count``."""
    aggs: list[Column] = [F.sum("rows").alias("rows"), F.count_distinct(*unit).alias("_unit_count")]
    for v in values:
        n, mean = F.col(f"{v}_n"), F.col(f"{v}_avg")
        # the parts of one group: a row per unit, so the list is as short as the range of units
        aggs += [F.sum(n).alias(f"{v}_count"), F.sum(f"{v}_sum").alias(f"{v}_sum"), F.min(f"{v}_min").alias(f"{v}_min"),
                 F.max(f"{v}_max").alias(f"{v}_max"), F.sum(f"{v}_m2").alias(f"_{v}_m2"),
                 F.collect_list(F.when(n > 0, F.struct(n.alias("n"), mean.alias("m")))).alias(f"_{v}_parts")]
        if qs:
            aggs.append(F.kll_merge_agg_double(f"{v}_kll").alias(f"_{v}_kll"))
    aggs += [F.hll_sketch_estimate(F.hll_union_agg(f"{d}_hll")).alias(f"{d}_nunique") for d in distincts]
    out = parts.groupBy(*by).agg(*aggs)
    cols = [*by, "rows", "_unit_count"]
    for v in values:
        mean = F.try_divide(f"{v}_sum", f"{v}_count")
        apart = F.aggregate(f"_{v}_parts", F.lit(0.0), lambda s, p: s + p["n"] * F.pow(p["m"] - mean, 2))
        std = F.sqrt(F.try_divide(F.col(f"_{v}_m2") + apart, F.col(f"{v}_count") - 1))
        cols += [f"{v}_count", f"{v}_sum", mean.alias(f"{v}_mean"), f"{v}_min", f"{v}_max", std.alias(f"{v}_std")]
        cols += [F.when(F.col(f"{v}_count") > 0, F.kll_sketch_get_quantile_double(f"_{v}_kll", F.lit(float(q)))).alias(
            f"{v}_q{i}") for i, q in enumerate(qs)]
    return out.select(*cols, *[f"{d}_nunique" for d in distincts])
