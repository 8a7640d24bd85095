"""Grouped aggregations.

Everything is one ``groupBy().agg()`` — Catalyst plans a partial
HashAggregate before the Exchange and a final one after, so each executor
pre-combines its rows and only one row per group and task is shuffled. This
also fixes the reference's quarter-by-quarter combine, which summed partial
means/min/max/std as if they were sums.

Exact medians use Spark's ``percentile`` (partial state is a value→count map,
bounded by distinct values per group, merged map-side); ``approx=True``
switches to ``percentile_approx`` whose state is a fixed-size sketch.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalar as S


def quantile(c: Column | str, q, approx: bool = False, accuracy: int = 10000) -> Column:
    """Exact (linear-interpolated) or approximate quantile(s)."""
    c = F.col(c) if isinstance(c, str) else c
    if approx:
        return F.percentile_approx(c, q, accuracy)
    return F.percentile(c, q)


def median(c: Column | str, approx: bool = False) -> Column:
    return quantile(c, 0.5, approx)


def quantiles_by(df: DataFrame, by: Sequence[str], value: str, qs: Sequence[float],
                 names: Sequence[str], approx: bool = False) -> DataFrame:
    """Per-group quantiles as a table (by..., names): exact through
    ``group_quantiles`` (no unbounded per-task state) or a sketch."""
    if approx:
        q = df.filter(F.col(value).isNotNull()).groupBy(*by).agg(
            F.percentile_approx(value, list(qs), 10000).alias("_q"))
        return q.select(*by, *[F.col("_q")[i].alias(n) for i, n in enumerate(names)])
    from .ranked import group_quantiles
    return group_quantiles(df, by, value, qs, names)


def combine_rows(*frames: DataFrame) -> DataFrame:
    """Place one-row frames side by side without a join: union them by name
    and keep each column's one non-null value (no cross or nested-loop join)."""
    cols = [c for f in frames for c in f.columns]
    if len(cols) != len(set(cols)):
        raise ValueError(f"column names collide: {cols}")
    u = frames[0]
    for f in frames[1:]:
        u = u.unionByName(f, allowMissingColumns=True)
    return u.agg(*[F.first(c, ignorenulls=True).alias(c) for c in cols])


def join_quantiles(stats: DataFrame, df: DataFrame, by: Sequence[str], value: str,
                   qs: Sequence[float], names: Sequence[str], approx: bool = False) -> DataFrame:
    """Attach per-group quantiles of ``df`` to a per-group ``stats`` table."""
    by = list(by)
    q = quantiles_by(df, by, value, qs, names, approx)
    if by:
        return stats.join(q, by, "left")
    return combine_rows(stats, q)


def median_by(df: DataFrame, by: Sequence[str], value: str, name: str = "median",
              approx: bool = False) -> DataFrame:
    """Per-group median as a table (by..., name) for values with unboundedly
    many distinct values: exact via range-bucketed ranking (no group's
    values are held by one task), or a fixed-size sketch with ``approx``."""
    if approx:
        return df.groupBy(*by).agg(F.percentile_approx(value, 0.5, 10000).alias(name))
    from .ranked import group_quantiles
    return group_quantiles(df, by, value, [0.5], [name])


# --- spec translators ---------------------------------------------------------

_FUNCS = {
    "sum": F.sum, "mean": F.avg, "avg": F.avg, "min": F.min, "max": F.max,
    "count": F.count, "std": F.stddev_samp, "var": F.var_samp,
    "median": lambda c: F.percentile(c, 0.5), "nunique": F.count_distinct,
    "first": F.first, "last": F.last,
}


def agg_spec(spec: Mapping[str, str | Sequence[str]]) -> list[Column]:
    """``{col: func | [func, ..]}`` → aggregate columns named ``{col}_{func}``.

    ``median`` inside a spec is Spark's ``percentile`` (state bounded by the
    distinct values of a group); for unbounded value sets use ``quantiles_by``."""
    out = []
    for col, funcs in spec.items():
        for fn in ([funcs] if isinstance(funcs, str) else funcs):
            if fn not in _FUNCS:
                raise ValueError(f"unknown aggregate {fn!r} for {col!r}")
            c = _FUNCS[fn](F.col(col))
            if fn in ("count", "nunique"):
                c = c.cast("bigint")
            out.append(c.alias(f"{col}_{fn}"))
    return out


_OPS = {"=": "__eq__", "==": "__eq__", "!=": "__ne__", "<": "__lt__", "<=": "__le__",
        ">": "__gt__", ">=": "__ge__"}


def filter_tuples(filters: Iterable[tuple], columns: Sequence[str] | None = None) -> Column | None:
    """``[(col, op, value), ..]`` → one conjunctive ``Column`` (``in`` → ``InSet``).

    Tuples naming a column not in ``columns`` are ignored (as the reference's
    loader does); returns None when nothing is left.
    """
    cond = None
    for col, op, val in filters:
        if columns is not None and col not in columns:
            continue
        c = F.col(col)
        if op == "in":
            p = c.isin(list(val))
        elif op == "not in":
            p = ~c.isin(list(val))
        elif op in _OPS:
            p = getattr(c, _OPS[op])(F.lit(val))
        else:
            raise ValueError(f"unsupported filter op {op!r}")
        cond = p if cond is None else cond & p
    return cond


def project_filter(df: DataFrame, columns: Sequence[str] | None = None,
                   filters: Iterable[tuple] = ()) -> DataFrame:
    """Column list + filter tuples; unknown columns ignored, none valid → error."""
    if columns is not None:
        keep = [c for c in columns if c in df.columns]
        if not keep:
            raise ValueError(f"none of the requested columns exist: {list(columns)}")
    else:
        keep = df.columns
    cond = filter_tuples(filters, df.columns)
    if cond is not None:
        df = df.filter(cond)
    return df.select(*keep)


def quarter_range(df: DataFrame, start: tuple[int, int], end: tuple[int, int],
                  year: str = "Year", quarter: str = "Quarter") -> DataFrame:
    """Rows of quarters ``start``..``end`` inclusive, as Year/Quarter predicates
    so a ``partitionBy(Year, Quarter)`` table prunes whole directories."""
    a = start[0] * 4 + start[1] - 1
    b = end[0] * 4 + end[1] - 1
    if b < a:
        raise ValueError(f"start {start} is after end {end}")
    y0, y1 = start[0], end[0]
    return df.filter(F.col(year).between(y0, y1)
                     & S.quarter_index(year, quarter).between(a, b))


def batch_aggregate(df: DataFrame, group_cols: Sequence[str],
                    spec: Mapping[str, str | Sequence[str]],
                    start: tuple[int, int] | None = None, end: tuple[int, int] | None = None,
                    filters: Iterable[tuple] = (), year: str = "Year",
                    quarter: str = "Quarter") -> DataFrame:
    """Group-by over a quarter range with an aggregation spec, plus
    ``_quarter_count`` (quarters in which each group occurs)."""
    if start is not None:
        df = quarter_range(df, start, end or start, year, quarter)
    cond = filter_tuples(filters, df.columns)
    if cond is not None:
        df = df.filter(cond)
    df = df.filter(_not_null(group_cols))
    return df.groupBy(*group_cols).agg(
        *agg_spec(spec),
        F.count_distinct(F.col(year), F.col(quarter)).cast("bigint").alias("_quarter_count"))


def _not_null(cols: Sequence[str]) -> Column:
    """pandas group-by drops null keys; Spark keeps them, so filter first."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return cond


def group_stats(df: DataFrame, by: Sequence[str] | str, value: str,
                stats: Sequence[str] = ("count", "mean", "median"),
                approx: bool = False, prefix: str = "") -> DataFrame:
    """Common named statistics of ``value`` per group; quantile statistics
    (median, p25, p75) come from ``join_quantiles``."""
    by = [by] if isinstance(by, str) else list(by)
    table = {
        "count": lambda: F.count(F.col(value)).cast("bigint"),
        "mean": lambda: F.avg(value),
        "std": lambda: F.stddev_samp(value),
        "min": lambda: F.min(value),
        "max": lambda: F.max(value),
        "sum": lambda: F.sum(value),
    }
    qmap = {"median": 0.5, "p25": 0.25, "p75": 0.75}
    base = df.filter(_not_null(by))
    plain = [s_ for s_ in stats if s_ not in qmap]
    aggs = [table[s_]().alias(prefix + s_) for s_ in plain] or [F.count(F.lit(1)).alias("_rows")]
    out = base.groupBy(*by).agg(*aggs)
    qn = [s_ for s_ in stats if s_ in qmap]
    if qn:
        out = join_quantiles(out, base, by, value, [qmap[s_] for s_ in qn], [prefix + s_ for s_ in qn], approx)
    return out.select(*by, *[prefix + s_ for s_ in stats])


def route_competition(df: DataFrame, route: str = "Route", fare: str = "MktFare",
                      carrier: str = "RPCarrier", distance: str = "MktDistance",
                      fpm: str = "FarePerMile", min_records: int = 100,
                      approx: bool = False) -> DataFrame:
    """Per route: records, median fare, distinct carriers, mean distance and
    mean fare-per-mile; routes with at least ``min_records`` rows."""
    base = df.filter(F.col(route).isNotNull())
    g = (base.groupBy(route)
         .agg(F.count(F.col(fare)).cast("bigint").alias("records"),
              F.count_distinct(carrier).cast("bigint").alias("carriers"),
              F.avg(distance).alias("mean_distance"),
              F.avg(fpm).alias("mean_fpm"))
         .filter(F.col("records") >= min_records))
    kept = base.join(g.select(route), route, "left_semi")
    g = join_quantiles(g, kept, [route], fare, [0.5], ["median_fare"], approx)
    return g.select(route, "records", "median_fare", "carriers", "mean_distance", "mean_fpm")


def carrier_tiers(df: DataFrame, carrier: str = "RPCarrier", fare: str = "MktFare",
                  fpm: str = "FarePerMile", distance: str = "MktDistance",
                  min_records: int = 1000, approx: bool = False) -> DataFrame:
    """Per carrier: records, median fare-per-mile, mean distance (records ≥ n).
    Fare per mile is continuous, so its median comes from ``median_by``."""
    base = df.filter(F.col(carrier).isNotNull())
    g = (base.groupBy(carrier)
         .agg(F.count(F.col(fare)).cast("bigint").alias("records"), F.avg(distance).alias("mean_distance"))
         .filter(F.col("records") >= min_records))
    med = median_by(base.join(g.select(carrier), carrier, "left_semi"), [carrier], fpm, "median_fpm", approx)
    return g.join(med, carrier, "left").select(carrier, "records", "median_fpm", "mean_distance")


def tier_spread(tiers: DataFrame, value: str = "median_fpm") -> DataFrame:
    """Cheapest, dearest and their ratio over an aggregated tier table."""
    return tiers.agg(F.min(value).alias("min_fpm"), F.max(value).alias("max_fpm"),
                     F.try_divide(F.max(value), F.min(value)).alias("spread_ratio"))


def market_share(df: DataFrame, route: str = "route", carrier: str = "TkCarrier",
                 passengers: str = "Passengers") -> DataFrame:
    """Carrier passengers / route passengers per (route, carrier).

    Two-level sum: the (route, carrier) partial aggregate is small, and the
    route total is a window over that small result partitioned by route.
    """
    from pyspark.sql import Window
    rc = (df.filter(F.col(route).isNotNull() & F.col(carrier).isNotNull())
          .groupBy(route, carrier).agg(F.sum(passengers).alias("_pax")))
    tot = F.sum("_pax").over(Window.partitionBy(route))
    return rc.select(route, carrier, F.try_divide(F.col("_pax"), tot).alias("carrier_market_share"))


def route_carrier_counts(df: DataFrame, route: str = "route",
                         carrier: str = "TkCarrier") -> DataFrame:
    """Distinct carriers per route (``COUNT(DISTINCT) OVER`` is not allowed in Spark)."""
    return (df.filter(F.col(route).isNotNull()).groupBy(route)
            .agg(F.count_distinct(carrier).cast("bigint").alias("route_competition")))


def top_counts(df: DataFrame, col: str, n: int = 10) -> DataFrame:
    """``value_counts().head(n)`` with a deterministic tie-break on the value."""
    return (df.filter(F.col(col).isNotNull()).groupBy(col)
            .agg(F.count(F.lit(1)).cast("bigint").alias("count"))
            .orderBy(F.col("count").desc(), F.col(col).asc()).limit(n))


def distincts(df: DataFrame, columns: Sequence[str], approx: bool = False) -> DataFrame:
    fn = F.approx_count_distinct if approx else F.count_distinct
    return df.agg(*[fn(c).cast("bigint").alias(f"n_{c}") for c in columns])


def carrier_consistency(df: DataFrame, rp: str = "RPCarrier", tk: str = "TkCarrier",
                        op: str = "OpCarrier") -> DataFrame:
    """All codes equal / ticketing differs / operating differs (null-safe)."""
    same_tk = F.col(rp).eqNullSafe(F.col(tk))
    same_op = F.col(rp).eqNullSafe(F.col(op))
    return df.agg(F.count_if(same_tk & same_op).alias("all_match"),
                  F.count_if(~same_tk).alias("tk_differs"),
                  F.count_if(~same_op).alias("op_differs"),
                  F.count(F.lit(1)).alias("rows"))


def fare_quality(df: DataFrame, fare: str = "MktFare", lo: float = 10.0,
                 hi: float = 5000.0) -> DataFrame:
    x = F.col(fare)
    n = F.count(F.lit(1))
    low, ok, high = x < lo, (x >= lo) & (x <= hi), x > hi
    return df.agg(F.count_if(low).alias("n_low"), F.count_if(ok).alias("n_valid"),
                  F.count_if(high).alias("n_extreme"), n.alias("rows"),
                  (F.count_if(low) * 100.0 / n).alias("pct_low"),
                  (F.count_if(ok) * 100.0 / n).alias("pct_valid"),
                  (F.count_if(high) * 100.0 / n).alias("pct_extreme"))


def premium_pivot(df: DataFrame, band: str, direct: str, value: str,
                  approx: bool = False) -> DataFrame:
    """Median ``value`` by band × direct flag pivoted to Direct/Connecting + ratio."""
    base = df.filter(F.col(band).isNotNull() & F.col(direct).isNotNull())
    med = median_by(base, [band, direct], value, "_med", approx)
    p = med.groupBy(band).pivot(direct, [True, False]).agg(F.first("_med"))
    return p.select(band, F.col("true").alias("Direct"), F.col("false").alias("Connecting"),
                    F.try_divide(F.col("true"), F.col("false")).alias("Premium"))


def table_profile(df: DataFrame, fare: str = "MktFare",
                  passengers: str = "Passengers", approx: bool = False) -> DataFrame:
    """Rows, columns, fare stats, total passengers and null counts in one pass."""
    aggs = [F.count(F.lit(1)).alias("rows"), F.lit(len(df.columns)).alias("columns")]
    if fare in df.columns:
        aggs += [F.avg(fare).alias("fare_mean"), F.min(fare).alias("fare_min"), F.max(fare).alias("fare_max")]
    if passengers in df.columns:
        aggs.append(F.sum(passengers).alias("total_passengers"))
    aggs += [F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in df.columns]
    out = df.agg(*aggs)
    if fare in df.columns:
        out = join_quantiles(out, df, [], fare, [0.5], ["fare_median"], approx)
    valid = F.col("rows") > 0
    if fare not in df.columns:
        valid = F.lit(False)
    return out.withColumn("valid", valid)
