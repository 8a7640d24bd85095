"""Cleaning filters and their retention reports.

Each filter is one ``filter`` Catalyst can push into the Parquet scan; each
report is one aggregation pass with ``count_if`` per rule, so nothing is
counted twice and nothing reaches the driver but one row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def trim_strings(df: DataFrame) -> DataFrame:
    """Strip leading/trailing whitespace (spaces, tabs, newlines) of every string column."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StringType):
            c = F.regexp_replace(F.regexp_replace(F.col(f.name), r"^\s+", ""), r"\s+$", "")
            out.append(c.alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def basic_clean_predicate(df: DataFrame, fare: str = "MktFare",
                          passengers: str = "Passengers") -> Column:
    cond = F.col(fare) > 0
    if passengers in df.columns:
        cond = cond & (F.col(passengers) > 0)
    return cond


def basic_clean(df: DataFrame, fare: str = "MktFare", passengers: str = "Passengers",
                trim: bool = True) -> DataFrame:
    """fare > 0 and passengers > 0 (when the column exists); strings trimmed."""
    out = df.filter(basic_clean_predicate(df, fare, passengers))
    return trim_strings(out) if trim else out


def basic_clean_report(df: DataFrame, fare: str = "MktFare",
                       passengers: str = "Passengers") -> DataFrame:
    """One row: rows before, after and removed by ``basic_clean``."""
    keep = basic_clean_predicate(df, fare, passengers)
    return df.agg(F.count(F.lit(1)).alias("rows_before"),
                  F.count_if(keep).alias("rows_after"),
                  F.count_if(~keep | keep.isNull()).alias("rows_removed"))


def usable_predicate(fare: str = "MktFare", bulk: str = "BulkFare",
                     passengers: str = "Passengers", max_fare: float = 10000.0) -> Column:
    return ((F.col(fare) > 0) & (F.col(fare) < max_fare) & (F.col(bulk) == 0)
            & (F.col(passengers) > 0))


def usable(df: DataFrame, **kw) -> DataFrame:
    """0 < fare < 10000, not a bulk fare, passengers > 0."""
    return df.filter(usable_predicate(**kw))


# fixed values: the reference's cleaning rule set
CLEANING_RULES = {
    "min_fare": 10.0,
    "max_fare": 5000.0,
    "min_distance": 50,
    "max_routing_ratio": 3.0,
    "min_passengers": 1,
    "drop_columns": ["BulkFare", "OriginCountry", "DestCountry"],
}


def rule_predicates(rules: Mapping, fare: str = "MktFare", distance: str = "MktDistance",
                    passengers: str = "Passengers") -> dict[str, Column]:
    """The rules the reference applies in its mask. ``max_routing_ratio`` and
    ``drop_columns`` are declared there but not applied, and are not here."""
    preds = {}
    if "min_fare" in rules:
        preds["min_fare"] = F.col(fare) >= F.lit(float(rules["min_fare"]))
    if "max_fare" in rules:
        preds["max_fare"] = F.col(fare) <= F.lit(float(rules["max_fare"]))
    if "min_distance" in rules:
        preds["min_distance"] = F.col(distance) >= F.lit(rules["min_distance"])
    if "min_passengers" in rules:
        preds["min_passengers"] = F.col(passengers) >= F.lit(rules["min_passengers"])
    return preds


def apply_rules(df: DataFrame, rules: Mapping = CLEANING_RULES, **cols) -> DataFrame:
    preds = list(rule_predicates(rules, **cols).values())
    cond = preds[0]
    for p in preds[1:]:
        cond = cond & p
    return df.filter(cond)


def rules_retention(df: DataFrame, rules: Mapping = CLEANING_RULES, **cols) -> DataFrame:
    """One row: before, after, retained %, and rows failing each rule."""
    preds = rule_predicates(rules, **cols)
    allp = None
    for p in preds.values():
        allp = p if allp is None else allp & p
    aggs = [F.count(F.lit(1)).alias("rows_before"), F.count_if(allp).alias("rows_after")]
    aggs += [F.count_if(~F.coalesce(p, F.lit(False))).alias(f"fail_{k}") for k, p in preds.items()]
    out = df.agg(*aggs)
    return out.withColumn("retained_pct",
                          F.try_divide(F.col("rows_after") * 100.0, F.col("rows_before")))


def column_constancy(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column: ``column, n_values`` (non-null values), ``constant`` (at most one distinct one).

    A column is constant if its least value is its greatest, so one pass of plain minima and maxima over all columns
    tells it: no distinct values are gathered and no row is expanded. Every column must be orderable.
    """
    columns = list(columns or df.columns)
    wide = df.agg(*[F.struct(F.lit(c).alias("column"), F.count(F.col(c)).alias("n_values"),
                             F.coalesce(F.min(F.col(c)).eqNullSafe(F.max(F.col(c))), F.lit(True)).alias("constant"))
                    .alias(f"_{k}") for k, c in enumerate(columns)])
    return wide.select(F.inline(F.array(*[f"_{k}" for k in range(len(columns))])))


def constant_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The columns with at most one distinct non-null value."""
    return column_constancy(df, columns).filter("constant").select("column")


# fixed values: the reference's five fare bands (inclusive ``between``; the
# bands overlap at 50 and 2000 exactly as in the reference)
FARE_SEGMENTS = [
    ("< $10 (staff/error)", None, 10.0, "lt"),
    ("$10-$50 (ultra-low)", 10.0, 50.0, "between"),
    ("$50-$2000 (typical)", 50.0, 2000.0, "between"),
    ("$2000-$5000 (premium)", 2000.0, 5000.0, "between"),
    ("> $5000 (extreme)", 5000.0, None, "gt"),
]


def segment_predicate(x: Column, lo, hi, kind: str) -> Column:
    if kind == "lt":
        return x < F.lit(hi)
    if kind == "gt":
        return x > F.lit(lo)
    return x.between(F.lit(lo), F.lit(hi))
