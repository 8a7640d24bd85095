"""Tracked trips as running jobs: an idempotent streaming upsert and expiry by event-time timers.

``TrackStore`` keeps the tracks table as mergeable per-batch deltas. Every micro-batch writes what its events say about
each key under its own batch id; a replayed batch writes the same folder again, so it changes nothing, and the table is
one aggregation over the deltas. ``compact`` merges finished batches into a base, which bounds what a read merges.

``expiry_stream`` holds one timer per active track, set to its departure day (midnight). The watermark is moved on by
the price snapshots that arrive; when it passes the timer the track expires.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout

from ..operators.tracks import TRACK_KEY

EVENT_SCHEMA = T.StructType([
    T.StructField("seq", T.LongType()), T.StructField("user_id", T.LongType()),
    T.StructField("origin", T.StringType()), T.StructField("destination", T.StringType()),
    T.StructField("departure_date", T.DateType()), T.StructField("op", T.StringType()),
    T.StructField("baseline_price", T.DoubleType())])
DELTA_SCHEMA = T.StructType([*EVENT_SCHEMA.fields[1:5], T.StructField("last_seq", T.LongType()),
                             T.StructField("last_op", T.StringType()), T.StructField("id", T.LongType()),
                             T.StructField("tracked_seq", T.LongType()), T.StructField("baseline_price", T.DoubleType())])


def deltas_of(events: DataFrame) -> DataFrame:
    """What some events say about each key; mergeable with what others say."""
    tracked = F.when(F.col("op") == "track", F.col("seq"))
    return events.groupBy(*TRACK_KEY).agg(
        F.max("seq").alias("last_seq"), F.max_by("op", "seq").alias("last_op"), F.min(tracked).alias("id"),
        F.max(tracked).alias("tracked_seq"),
        F.max_by(F.when(F.col("op") == "track", F.col("baseline_price")), tracked).alias("baseline_price"))


def merge(deltas: DataFrame) -> DataFrame:
    return deltas.groupBy(*TRACK_KEY).agg(
        F.max("last_seq").alias("last_seq"), F.max_by("last_op", "last_seq").alias("last_op"), F.min("id").alias("id"),
        F.max("tracked_seq").alias("tracked_seq"), F.max_by("baseline_price", "tracked_seq").alias("baseline_price"))


class TrackStore:
    """The tracks table under ``path``: ``base_<n>`` holds the batches up to n merged, ``batch_<n>`` one batch each."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def _finished(self, kind: str) -> list[int]:
        root = self.spark._jvm.org.apache.hadoop.fs.Path(os.path.join(self.path, f"{kind}_*", "_SUCCESS"))
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return sorted(int(re.search(rf"{kind}_(\d+)/_SUCCESS$", f.getPath().toString())[1]) for f in fs.globStatus(root) or [])

    def upsert(self, events: DataFrame, batch_id: int) -> None:
        """A micro-batch's events; a batch that a base holds already is left alone."""
        if batch_id > max(self._finished("base"), default=-1):
            deltas_of(events).write.mode("overwrite").parquet(os.path.join(self.path, f"batch_{batch_id}"))

    def batches(self) -> list[int]:
        """The recorded batch ids that no base holds."""
        base = max(self._finished("base"), default=-1)
        return [n for n in self._finished("batch") if n > base]

    def deltas(self) -> DataFrame:
        parts = [f"base_{n}" for n in self._finished("base")[-1:]] + [f"batch_{n}" for n in self.batches()]
        if not parts:
            return self.spark.createDataFrame([], DELTA_SCHEMA)
        return self.spark.read.schema(DELTA_SCHEMA).parquet(*[os.path.join(self.path, p) for p in parts])

    def compact(self) -> None:
        """Merge all recorded batches into a new base. Batches are recorded in order, so none before it is open."""
        upto = max(self.batches(), default=None)
        if upto is not None:
            merge(self.deltas()).write.mode("overwrite").parquet(os.path.join(self.path, f"base_{upto}"))

    def tracks(self) -> DataFrame:
        """The state, as ``operators.tracks.track_state`` gives it for all events."""
        return merge(self.deltas()).filter(F.col("id").isNotNull()).select(
            "id", *TRACK_KEY, "baseline_price", (F.col("last_op") == "track").alias("active"),
            F.lit(None).cast("double").alias("last_notified_price"), "tracked_seq")


def event_stream(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    return spark.readStream.schema(EVENT_SCHEMA).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def run_upserts(events: DataFrame, store: TrackStore, checkpoint: str, compact_every: int = 50) -> None:
    """Bring the store up to date with all available events, then stop."""
    def upsert(batch: DataFrame, batch_id: int) -> None:
        store.upsert(batch, batch_id)
        if len(store.batches()) >= compact_every:
            store.compact()

    q = events.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(upsert).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


EXPIRED_SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("departure_date", T.DateType())])
_TIMER = T.StructType([T.StructField("departure_date", T.DateType())])


def _timer(key, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
    if state.hasTimedOut:
        day = state.get[0]
        state.remove()
        yield pd.DataFrame({"id": [key[0]], "departure_date": [day]})
        return
    for pdf in batches:
        for day in pdf["departure_date"]:
            state.update((day,))
            state.setTimeoutTimestamp(int(pd.Timestamp(day).timestamp() * 1000))


def expiry_stream(tracks: DataFrame, snapshots: DataFrame, delay: str = "0 seconds") -> DataFrame:
    """``id, departure_date`` of the tracks whose departure day lies before the watermark, as it passes.

    ``tracks`` (a stream of ``id, departure_date``; it must come before the watermark reaches them) sets the timers;
    ``snapshots`` (a stream with ``event_ts``) only moves the watermark and is dropped before the shuffle.
    """
    timers = tracks.select("id", "departure_date", F.lit(1).alias("timer"),
                           F.lit("1970-01-01 00:00:01").cast("timestamp").alias("event_ts"))
    clock = snapshots.select(F.lit(-1).cast("long").alias("id"), F.lit(None).cast("date").alias("departure_date"),
                             F.lit(0).alias("timer"), "event_ts")
    both = timers.union(clock).withWatermark("event_ts", delay)
    # only the timers go on; the condition needs the event time, so it can't be pushed below the watermark, which the
    # snapshots must pass
    kept = both.filter(F.unix_seconds("event_ts") * F.col("timer") > 0)
    return kept.groupBy("id").applyInPandasWithState(_timer, EXPIRED_SCHEMA, _TIMER, "append",
                                                     GroupStateTimeout.EventTimeTimeout)
