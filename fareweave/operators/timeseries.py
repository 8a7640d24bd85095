"""Price-calendar time series: lead time, calendar parts, lags, rolling
means, look-ahead labels, as-of serving features and the temporal split.

Series are (route, departure_date) — each holds one observation per
collection day, so every ordered window below is bounded by the number of
collection days, never by the table. Route-level means are aggregated with
a map-side partial ``groupBy`` and joined back (AQE broadcasts the small
route table), never computed with a window over a whole route, which would
put a hot route into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalar as S

SERIES = ("route", "departure_date")


def with_lead_time(df: DataFrame, departure: str = "departure_date",
                   collected: str = "collected_at", keep_negative: bool = False) -> DataFrame:
    """``collected_date`` (the day) and ``days_ahead``; rows in the past dropped."""
    out = (df.withColumn("collected_date", F.to_date(F.col(collected)))
           .withColumn("days_ahead", S.days_ahead(departure, "collected_date")))
    return out if keep_negative else out.filter(F.col("days_ahead") >= 0)


def build_features(df: DataFrame) -> DataFrame:
    """Clip lead time to [0, 365], weeks, weekday/month/weekend, route key."""
    return (df.withColumn("days_ahead", S.lead_clip("days_ahead"))
            .withColumn("weeks_ahead", S.weeks_ahead("days_ahead"))
            .withColumn("dep_dow", S.weekday_mon0("departure_date"))
            .withColumn("dep_month", F.month("departure_date"))
            .withColumn("dep_is_weekend", (F.col("dep_dow") >= 5).cast("int"))
            .withColumn("col_dow", S.weekday_mon0("collected_date"))
            .withColumn("route", S.route_key("origin", "destination")))


def series_window(series: Sequence[str] = SERIES, order: str = "collected_date") -> Window:
    return Window.partitionBy(*series).orderBy(order)


def group_mean(df: DataFrame, by: str, value: str, name: str, few: bool = False) -> DataFrame:
    """Mean of ``value`` per ``by`` joined back to every row (skew-safe). ``few`` says that the groups are few: their
    means are broadcast and the rows stay where they are, not shuffled to one partition per group."""
    means = df.groupBy(by).agg(F.avg(value).alias(name))
    return df.join(F.broadcast(means) if few else means, by, "left")


def add_lag_features(df: DataFrame, series: Sequence[str] = SERIES, order: str = "collected_date",
                     price: str = "price", causal: bool = False) -> DataFrame:
    """lag 1 and lag 7 *observations*, mean of the 3 previous observations,
    price change; gaps filled with the route mean (over the route's whole
    history, as the reference does; ``causal=True`` uses only the route's rows
    of strictly earlier collection times)."""
    w = series_window(series, order)
    out = (df.withColumn("price_lag1", F.lag(price, 1).over(w))
           .withColumn("price_lag7", F.lag(price, 7).over(w))
           .withColumn("price_roll3", F.avg(price).over(w.rowsBetween(-3, -1)))
           .withColumn("price_change", F.col(price) - F.col("price_lag1")))
    if causal:
        earlier = Window.partitionBy("route").orderBy("_t").rangeBetween(Window.unboundedPreceding, -1)
        days = out.groupBy("route", order).agg(F.sum(price).alias("_s"), F.count(price).alias("_n"))
        days = days.withColumn("_t", F.unix_micros(F.col(order).cast("timestamp")))
        days = days.select("route", order, F.try_divide(F.sum("_s").over(earlier), F.sum("_n").over(earlier)).alias(
            "_route_mean"))
        out = out.join(days, ["route", order], "left")
    else:
        # rows dealt by route would stay so in the windows and the files that follow: a task per route, however many rows
        out = group_mean(out, "route", price, "_route_mean", few=True)
    for c in ("price_lag1", "price_lag7", "price_roll3"):
        out = out.withColumn(c, F.coalesce(F.col(c), F.col("_route_mean")))
    return out.withColumn("price_change", F.coalesce(F.col("price_change"), F.lit(0.0))).drop("_route_mean")


def add_wait_target(df: DataFrame, drop_threshold: float = 0.02, horizon: int = 7,
                    series: Sequence[str] = SERIES, order: str = "collected_date",
                    price: str = "price") -> DataFrame:
    """``should_wait`` = price ``horizon`` observations ahead is lower by more
    than ``drop_threshold``; rows without that future are dropped."""
    w = series_window(series, order)
    out = df.withColumn("price_future7", F.lead(price, horizon).over(w))
    out = out.filter(F.col("price_future7").isNotNull())
    return out.withColumn("should_wait",
                          (F.col("price_future7") < F.col(price) * (1 - drop_threshold)).cast("int"))


def add_trend(df: DataFrame) -> DataFrame:
    return df.withColumn("trend", F.col("price_lag1") - F.col("price_lag7"))


def training_frame(calendar: DataFrame, drop_threshold: float = 0.02) -> DataFrame:
    """load → features → lags → target → trend (the reference's training data)."""
    cal = with_lead_time(calendar)
    return add_trend(add_wait_target(add_lag_features(build_features(cal)), drop_threshold))


def temporal_split_point(df: DataFrame, col: str = "collected_date", q: float = 0.8) -> DataFrame:
    """One row: the interpolated ``q`` quantile of the collection time."""
    micros = F.unix_micros(F.col(col).cast("timestamp"))
    return df.agg(F.timestamp_micros(F.percentile(micros, q).cast("long")).alias("split_at"))


def temporal_split(df: DataFrame, col: str = "collected_date", q: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """(train, test) with test = rows collected strictly after the quantile."""
    split = temporal_split_point(df, col, q).first()["split_at"]
    ts = F.col(col).cast("timestamp")
    return df.filter(ts <= F.lit(split)), df.filter(ts > F.lit(split))


def last_n_features(history: DataFrame, requests: DataFrame, keys: Sequence[str] = SERIES,
                    as_of: str = "as_of", n: int = 7, days: int | None = None,
                    price: str = "price", order: str = "collected_at") -> DataFrame:
    """As-of serving features per request row.

    Observations of the request's key known on or before its ``as_of`` day
    (and, only if ``days`` is set, within the last ``days`` calendar days
    before it) are ranked newest first; the latest gives ``price_lag1``, the oldest
    of the newest ``n`` gives ``price_lag7``, the newest three average to
    ``price_roll3``. Requests without history keep null features and
    ``has_history = false``. The join is an equi-join on the key with the
    as-of bound as a residual predicate, so it shuffles on the key only.
    """
    keys = list(keys)
    h = history.select(*keys, F.col(order).alias("_t"), F.col(price).alias("_p"))
    r = requests.select(*keys, as_of).distinct()
    j = r.join(h, keys, "inner").filter(F.to_date("_t") <= F.col(as_of))
    if days is not None:
        j = j.filter(F.to_date("_t") > F.date_sub(F.col(as_of), days))
    w = Window.partitionBy(*keys, as_of).orderBy(F.col("_t").desc())
    j = j.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n)
    feats = j.groupBy(*keys, as_of).agg(
        F.max_by("_p", F.struct(F.lit(-1) * F.col("_rn"))).alias("price_lag1"),
        F.max_by("_p", F.col("_rn")).alias("price_lag7"),
        F.avg(F.when(F.col("_rn") <= 3, F.col("_p"))).alias("price_roll3"),
        F.count(F.lit(1)).alias("n_obs"))
    return (requests.join(feats, [*keys, as_of], "left")
            .withColumn("has_history", F.col("n_obs").isNotNull()))


def fill_with_route_average(df: DataFrame, averages: DataFrame, route: str = "route",
                            default: float = 400.0,
                            cols: Sequence[str] = ("price_lag1", "price_lag7", "price_roll3")) -> DataFrame:
    """Requests without history take the route average, else ``default``."""
    j = df.join(averages.select(route, F.col("route_avg")), route, "left")
    fb = F.coalesce(F.col("route_avg"), F.lit(default))
    for c in cols:
        j = j.withColumn(c, F.when(F.col("has_history"), F.col(c)).otherwise(fb))
    return j.drop("route_avg")


def route_averages(df: DataFrame, route: str = "route", price: str = "price") -> DataFrame:
    return df.groupBy(route).agg(F.avg(price).alias("route_avg"))
