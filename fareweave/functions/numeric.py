"""Numeric helpers shared by operators and oracles.

Averages and interpolated percentiles are summed in a different order by
every engine, so compared outputs are reported to 1e-4 with a half-up rule
that both engines compute identically on doubles (``round`` on doubles does
not: Spark rounds the decimal text, DuckDB the binary value).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def r4(c: Column | str) -> Column:
    """Half-up to 4 decimals: ``floor(x*1e4 + 0.5) / 1e4`` (null stays null)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.floor(c * 10000 + 0.5) / 10000


def r4_sql(expr: str) -> str:
    """The same rounding as SQL text (DuckDB and Spark agree on it)."""
    return f"floor(({expr}) * 10000 + 0.5) / 10000"


def money_sum(c: Column | str) -> Column:
    """Exact sum of cent amounts: add as DECIMAL(18,2), return a double."""
    c = F.col(c) if isinstance(c, str) else c
    return F.sum(c.cast("decimal(18,2)")).cast("double")


def safe_div(num: Column, den: Column) -> Column:
    """Division that yields null instead of failing on a zero divisor (ANSI)."""
    return F.try_divide(num, den)


def ieee_divide(num: Column, den: Column) -> Column:
    """Division of doubles as IEEE 754 has it (and DuckDB): a zero divisor gives ±infinity or NaN, not an error (ANSI)."""
    inf = F.lit(float("inf"))
    at_zero = (F.when(num.isNull(), F.lit(None)).when(F.isnan(num) | (num == 0), F.lit(float("nan")))
               .when(num > 0, inf).otherwise(-inf))
    return F.when(den == 0, at_zero).otherwise(F.try_divide(num, den))


def r4_ieee(c: Column | str) -> Column:
    """``r4`` for values that may be NaN or infinite, which stay so (Spark's ``floor`` makes a long of them)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(F.isnan(c) | (F.abs(c) == F.lit(float("inf"))), c).otherwise(r4(c))
