"""Price-drop alerts as a stateful stream.

Keyed by track id, the state is the last notified price. Each micro-batch's
prices for a track are taken in time order: a price alerts when it is at
least ``drop`` below the baseline and below the last notified price (the
baseline when none — or 0 — is stored), and then becomes the new last
notified price. ``applyInPandasWithState`` keeps that state in the
checkpointed state store, so a restarted query resumes where it stopped.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout

ALERT_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("user_id", T.LongType()),
    T.StructField("collected_at", T.TimestampNTZType()), T.StructField("price", T.DoubleType()),
    T.StructField("baseline_price", T.DoubleType())])
STATE_SCHEMA = T.StructType([T.StructField("last_notified", T.DoubleType())])


def _step(key, batches: Iterator[pd.DataFrame], state, drop: float) -> Iterator[pd.DataFrame]:
    pdf = pd.concat(list(batches), ignore_index=True).sort_values("collected_at", kind="stable")
    last = state.get[0] if state.exists else None
    out = []
    for row in pdf.itertuples(index=False):
        base = row.baseline_price
        ref = last if last else base
        if base and (base - row.price) / base >= drop and row.price < ref:
            out.append((row.id, row.user_id, row.collected_at, row.price, base))
            last = row.price
    if last is not None:
        state.update((float(last),))
    if out:
        yield pd.DataFrame(out, columns=[f.name for f in ALERT_SCHEMA.fields])


def alert_stream(prices: DataFrame, tracks: DataFrame, drop: float = 0.05) -> DataFrame:
    """Stream of alerts: price stream ⋈ active tracks (static), stateful per id."""
    active = tracks.filter("active").select("id", "user_id", "origin", "destination", "departure_date",
                                             "baseline_price")
    j = prices.join(active, ["origin", "destination", "departure_date"])
    j = j.select("id", "user_id", "collected_at", "price", "baseline_price")

    def fn(key, batches, state):
        return _step(key, batches, state, drop)

    return j.groupBy("id").applyInPandasWithState(fn, ALERT_SCHEMA, STATE_SCHEMA, "append",
                                                  GroupStateTimeout.NoTimeout)
