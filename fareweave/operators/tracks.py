"""Tracked trips: state from an append-only event log, expiry, current
prices and price-drop alerts.

The reference keeps a mutable SQL table (upsert / deactivate / update last
notified price). Here the table is an event log and its state is a
``max_by`` aggregation per key — a map-side-combined aggregate, so any
number of events per key costs one small row per task.

Alerts (batch twin of the stateful stream): with a track's prices in time
order, row ``i`` alerts iff it *qualifies* — ``(baseline − price)/baseline
≥ drop`` — and its price is below every earlier qualifying price. The
reference remembers the last alerted price and requires ``price < last``
(falling back to the baseline when none, or 0, is stored); that remembered
price is always the minimum of the earlier qualifying prices, so the rule is
a running ``min`` over earlier rows of the track.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

TRACK_KEY = ("user_id", "origin", "destination", "departure_date")


def track_state(events: DataFrame, key=TRACK_KEY, seq: str = "seq", op: str = "op",
                baseline: str = "baseline_price") -> DataFrame:
    """Latest state per key. ``track`` (re)activates with a fresh baseline and
    clears the last notified price; ``untrack`` deactivates; an ``untrack``
    of a key never tracked leaves no row."""
    k = list(key)
    is_track = F.col(op) == "track"
    g = events.groupBy(*k).agg(
        F.max_by(F.col(op), F.col(seq)).alias("_last_op"),
        F.max_by(F.when(is_track, F.col(baseline)), F.when(is_track, F.col(seq))).alias("baseline_price"),
        F.min(F.when(is_track, F.col(seq))).alias("id"),
        F.max(F.when(is_track, F.col(seq))).alias("tracked_seq"))
    return (g.filter(F.col("id").isNotNull())
            .select(F.col("id"), *k, "baseline_price", (F.col("_last_op") == "track").alias("active"),
                    F.lit(None).cast("double").alias("last_notified_price"), "tracked_seq"))


def expire(tracks: DataFrame, as_of, date: str = "departure_date") -> DataFrame:
    """Deactivate tracks whose departure day (midnight) is before ``as_of``."""
    ts = F.lit(as_of).cast("timestamp") if not hasattr(as_of, "_jc") else as_of
    expired = F.col(date).cast("timestamp") < ts
    return tracks.withColumn("active", F.col("active") & ~expired)


def user_tracks(tracks: DataFrame, order=("user_id", "departure_date", "origin", "destination")) -> DataFrame:
    return tracks.filter(F.col("active")).orderBy(*order)


def current_prices(calendar: DataFrame, as_of_day=None, key=("origin", "destination", "departure_date"),
                   ts: str = "collected_at", price: str = "price") -> DataFrame:
    """Latest observed price per (route, departure) — on or before ``as_of_day``."""
    c = calendar
    if as_of_day is not None:
        c = c.filter(F.to_date(ts) <= F.lit(as_of_day).cast("date"))
    return c.groupBy(*key).agg(F.max_by(price, ts).alias("current_price"), F.max(ts).alias("price_at"))


def alerts(tracks: DataFrame, prices: DataFrame, drop: float = 0.05,
           key=("origin", "destination", "departure_date"), ts: str = "collected_at",
           price: str = "price") -> DataFrame:
    """Every alert each active track would have received, in time order."""
    t = tracks.filter(F.col("active"))
    j = t.join(prices.select(*key, ts, price), list(key))
    b = F.col("baseline_price")
    qualifies = F.try_divide(b - F.col(price), b) >= F.lit(drop)  # a zero baseline never qualifies
    w = Window.partitionBy("id").orderBy(ts).rowsBetween(Window.unboundedPreceding, -1)
    last = F.min(F.when(qualifies, F.col(price))).over(w)
    j = j.withColumn("_q", qualifies).withColumn("_last", F.coalesce(F.nullif(last, F.lit(0.0)), b))
    return (j.filter(F.col("_q") & (F.col(price) < F.col("_last")))
            .withColumn("drop_pct", F.try_divide(b - F.col(price), b) * 100)
            .drop("_q", "_last"))
