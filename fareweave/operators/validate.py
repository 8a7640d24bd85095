"""Request validation as one ordered ``CASE``: the value or the first error.

"Today" is the ``as_of`` argument (a column or literal), never the clock, so
a replay validates exactly as it did the first time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: airports accepted in commands
VALID_AIRPORTS = ("BKK", "HAN", "LHR", "MAN", "SGN")

# fixed values: the user-facing error messages, in the order they are checked
MESSAGES = {
    "missing": "Missing arguments. See /help for usage.",
    "route": "Route '%s' looks wrong. Use ORIGIN-DEST format, e.g. `LHR-SGN`.",
    "airport": "Airport '%s' not recognised.\nSupported: %s",
    "need_range": "Need START and END dates. See /help.",
    "need_date": "Need a date. See /help.",
    "bad_date": "Date '%s' is invalid. Use `yyyy-mm-dd`, e.g. `2026-09-15`.",
    "past": "Date %s is in the past.",
    "order": "START date must be before END date.",
}


def _parse_day(s: Column) -> Column:
    return F.to_date(F.try_to_timestamp(s, F.lit("yyyy-M-d")))  # with or without leading zeros


def validate_requests(df: DataFrame, args: str = "args", as_of="as_of", need_date: bool = True,
                      need_range: bool = False, airports=VALID_AIRPORTS) -> DataFrame:
    """Adds ``route``, ``origin``, ``dest``, ``start``/``end`` or ``date`` and
    ``error`` (null when valid). ``args`` is an array of command words."""
    a = F.col(args)
    today = F.col(as_of) if isinstance(as_of, str) else F.lit(as_of).cast("date")
    n = F.coalesce(F.size(a), F.lit(0))
    route = F.upper(F.get(a, 0))
    origin = F.substring_index(route, "-", 1)
    dest = F.expr("substring(upper(get({0}, 0)), instr(upper(get({0}, 0)), '-') + 1)".format(args))
    known = F.array(*[F.lit(x) for x in airports])
    bad_airport = F.when(~F.array_contains(known, origin), origin).otherwise(dest)
    supported = ", ".join(sorted(airports))

    def date_err(s: Column) -> Column:
        d = _parse_day(s)
        return (F.when(d.isNull(), F.format_string(MESSAGES["bad_date"], s))
                .when(d < today, F.format_string(MESSAGES["past"], s)))

    err = (F.when(n == 0, F.lit(MESSAGES["missing"]))
           .when(~route.contains("-"),
                 F.format_string(MESSAGES["route"], route))
           .when(~F.array_contains(known, origin) | ~F.array_contains(known, dest),
                 F.format_string(MESSAGES["airport"], bad_airport, F.lit(supported))))
    if need_range:
        s, e = F.get(a, 1), F.get(a, 2)
        err = (err.when(n < 3, F.lit(MESSAGES["need_range"]))
               .when(date_err(s).isNotNull(), date_err(s))
               .when(date_err(e).isNotNull(), date_err(e))
               .when(_parse_day(s) > _parse_day(e), F.lit(MESSAGES["order"])))
        extra = [(s, "start"), (e, "end")]
    elif need_date:
        d = F.get(a, 1)
        err = (err.when(n < 2, F.lit(MESSAGES["need_date"]))
               .when(date_err(d).isNotNull(), date_err(d)))
        extra = [(d, "date")]
    else:
        extra = []
    out = df.select("*", err.alias("error"))
    ok = F.col("error").isNull()
    return out.select("*", F.when(ok, route).alias("route"), F.when(ok, origin).alias("origin"),
                      F.when(ok, dest).alias("dest"), *[F.when(ok, c).alias(name) for c, name in extra])
