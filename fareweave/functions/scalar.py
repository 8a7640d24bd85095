"""Scalar column functions for the market and calendar tables.

All of them are built-in Spark expressions, so they stay inside whole-stage
codegen; none needs a Python UDF.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# fixed values: bin edges and labels of the reference's three distance cuts
DISTANCE_BANDS = ([0, 500, 1000, 2000, 3000, 5000, 15000],
                  ["<500", "500-1k", "1k-2k", "2k-3k", "3k-5k", "5k+"])
PREMIUM_BANDS = ([0, 500, 1000, 2000, 3000, 15000],
                 ["<500", "500-1k", "1k-2k", "2k-3k", "3k+"])
DISTANCE_CATEGORIES = ([0, 500, 1000, 2000, 5000, 20000],
                       ["short", "medium", "long", "very_long", "ultra_long"])

# fixed values: quarter → season and geography code → label
SEASONS = {1: "winter", 2: "spring", 3: "summer", 4: "fall"}
GEO_LABELS = {1: "Non-Contiguous (HI, AK, Territories)", 2: "Contiguous (Lower 48)"}


def route_key(origin: Column | str, dest: Column | str, sep: str = "-") -> Column:
    """``origin<sep>dest`` — the reference uses ``-``, ``_`` and `` -> ``."""
    return F.concat_ws(sep, _c(origin), _c(dest))


def days_ahead(departure: Column | str, collected: Column | str) -> Column:
    """Whole days from collection to departure (negative when in the past)."""
    return F.datediff(_c(departure), F.to_date(_c(collected)))


def lead_clip(days: Column | str, lo: int = 0, hi: int = 365) -> Column:
    return F.least(F.greatest(_c(days), F.lit(lo)), F.lit(hi))


def weeks_ahead(days: Column | str) -> Column:
    return F.floor(_c(days) / 7).cast("int")


def weekday_mon0(d: Column | str) -> Column:
    """Day of week with Monday = 0 (pandas ``dayofweek``)."""
    return F.weekday(_c(d))


def fare_per_mile(fare: Column | str, dist: Column | str) -> Column:
    return _c(fare) / F.greatest(_c(dist), F.lit(1.0))


def routing_ratio(flown: Column | str, nonstop: Column | str) -> Column:
    return _c(flown) / F.greatest(_c(nonstop), F.lit(1.0))


def is_direct_coupons(coupons: Column | str) -> Column:
    return _c(coupons) == 1


def is_connecting(coupons: Column | str) -> Column:
    return (_c(coupons) > 1).cast("int")


def is_direct_stops(stops: Column | str) -> Column:
    """Direct when stop count is 0; a missing count counts as 0."""
    return F.coalesce(_c(stops), F.lit(0)) == 0


def quarter_label(year: Column | str, quarter: Column | str) -> Column:
    """``YYYY Qn``."""
    return F.concat(_c(year).cast("string"), F.lit(" Q"), _c(quarter).cast("string"))


def cut_labels(x: Column | str, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed interval labels ``(e[i], e[i+1]]``; outside → null (pandas ``cut``)."""
    if len(labels) != len(edges) - 1:
        raise ValueError("need one label per interval")
    x = _c(x)
    expr = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = (x > F.lit(lo)) & (x <= F.lit(hi))
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr


def cut_regular_bin(x: Column | str, width: float = 100.0, lo: float = 0.0,
                    hi: float = 5900.0) -> Column:
    """Index of the right-closed regular bin ``(lo + (k-1)w, lo + kw]``; null outside."""
    x = _c(x)
    k = F.ceil((x - F.lit(lo)) / F.lit(width))
    return F.when((x > F.lit(lo)) & (x <= F.lit(hi)), k.cast("int"))


def bin_midpoint(k: Column | str, width: float = 100.0, lo: float = 0.0) -> Column:
    return F.lit(lo) + (_c(k) - 0.5) * F.lit(width)


def value_map(x: Column | str, mapping: Mapping, default=None) -> Column:
    """Literal dict lookup with a default (a ``CASE`` Catalyst folds to a switch)."""
    x = _c(x)
    expr = None
    for k, v in mapping.items():
        expr = F.when(x == F.lit(k), F.lit(v)) if expr is None else expr.when(x == F.lit(k), F.lit(v))
    return expr.otherwise(F.lit(default)) if default is not None else expr


def season(quarter: Column | str) -> Column:
    return value_map(quarter, SEASONS)


def log10_floor1(x: Column | str) -> Column:
    return F.log10(F.greatest(_c(x), F.lit(1.0)))


def cap(x: Column | str, upper: float) -> Column:
    return F.least(_c(x), F.lit(float(upper)))


def date_prefix(x: Column | str) -> Column:
    """First 10 characters of a date/time text as the date key."""
    return F.substring(_c(x).cast("string"), 1, 10)


def month_start(d: Column | str) -> Column:
    return F.trunc(_c(d), "month")


def quarter_from_name(name: Column | str) -> tuple[Column, Column]:
    """(year, quarter) from ``..YYYY_Q..`` / ``..YYYY-Q..`` names; null unless valid."""
    name = _c(name)
    y = F.regexp_extract(name, r"(\d{4})[_-](\d)", 1)
    q = F.regexp_extract(name, r"(\d{4})[_-](\d)", 2)
    yi = y.try_cast("int")
    qi = q.try_cast("int")
    ok = yi.between(2000, 2030) & qi.between(1, 4)
    return F.when(ok, yi), F.when(ok, qi)


def quarter_index(year: Column | str, quarter: Column | str) -> Column:
    """Ordinal ``year*4 + quarter - 1`` (orders quarters, makes ranges one predicate)."""
    return _c(year) * 4 + _c(quarter) - 1


def quarter_sequence(start: tuple[int, int], end: tuple[int, int]) -> Column:
    """Array of quarter ordinals from ``start`` to ``end`` inclusive."""
    a = start[0] * 4 + start[1] - 1
    b = end[0] * 4 + end[1] - 1
    if b < a:
        raise ValueError(f"start {start} is after end {end}")
    return F.sequence(F.lit(a), F.lit(b))


def trend_text(diff: Column | str) -> Column:
    """``stable`` if |diff| < 1, else ``up £x`` / ``down £x``."""
    d = _c(diff)
    whole = F.bround(F.abs(d), 0)  # Python's "%.0f" rounds half to even
    return (F.when(F.abs(d) < 1, F.lit("stable"))
            .when(d > 0, F.format_string("up £%.0f", whole))
            .otherwise(F.format_string("down £%.0f", whole)))


def outlook(prob: Column | str, threshold: float = 0.45, short: bool = False) -> Column:
    p = _c(prob)
    if short:
        return F.when(p >= threshold, F.lit("may drop")).otherwise(F.lit("may rise"))
    return (F.when(p >= threshold, F.lit("Price predicted to drop"))
            .otherwise(F.lit("Price predicted to increase")))


def confidence(prob: Column | str, threshold: float = 0.45) -> Column:
    d = F.abs(_c(prob) - F.lit(threshold))
    return F.when(d > 0.25, F.lit("High")).when(d > 0.10, F.lit("Medium")).otherwise(F.lit("Low"))


def round_half_even(x: Column | str, digits: int = 1) -> Column:
    """Half-even rounding (pandas ``round``); Spark ``round`` is half-up."""
    return F.bround(_c(x), digits)
