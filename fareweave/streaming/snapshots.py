"""Daily snapshot files as a stream.

Snapshots land as Parquet partitioned by ``collected_date`` (append, one
partition per day — the reference's read-concat-rewrite of the day's file
becomes a plain append). A file-source stream picks them up with an
``availableNow`` trigger and a checkpoint, so every file is processed
exactly once across runs, and a re-run of the job never re-reads a day.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path

CALENDAR_SCHEMA = T.StructType([
    T.StructField("origin", T.StringType()), T.StructField("destination", T.StringType()),
    T.StructField("departure_date", T.DateType()), T.StructField("collected_at", T.TimestampNTZType()),
    T.StructField("price", T.DoubleType()), T.StructField("collected_date", T.DateType())])


def append_daily(df: DataFrame, path: str, day_col: str = "collected_date") -> None:
    """Append snapshot rows, one directory per day."""
    df.write.mode("append").partitionBy(day_col).parquet(path)


def snapshot_stream(spark: SparkSession, path: str, schema: T.StructType = CALENDAR_SCHEMA,
                    files_per_trigger: int = 1) -> DataFrame:
    """Stream of snapshot rows; event time ``event_ts`` is a zoned timestamp
    (the watermark requires TIMESTAMP, the files hold TIMESTAMP_NTZ)."""
    s = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
         .parquet(path))
    return s.withColumn("event_ts", F.col("collected_at").cast("timestamp"))


def run_available_now(df: DataFrame, sink: str, checkpoint: str,
                      partition_by: tuple[str, ...] = ()) -> list:
    """Process everything available, append the output, then stop; the batches' progress reports."""
    w = df.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    w = w.outputMode("append").format("parquet").option("path", sink)
    if partition_by:
        w = w.partitionBy(*partition_by)
    q = w.start()
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return q.recentProgress


def run_changes(df: DataFrame, sink: str, checkpoint: str) -> None:
    """Process everything available and write the rows each batch changes (update output); a batch that is done again
    replaces its folder."""
    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(os.path.join(sink, f"batch={number}"))

    q = (df.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
         .outputMode("update").foreachBatch(write).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def state_figures(progress: list) -> tuple[int, int]:
    """(rows that came too late for a stateful operator, most state rows held after a batch)."""
    ops = [o for p in progress for o in p.stateOperators]
    return (sum(o.numRowsDroppedByWatermark for o in ops), max((o.numRowsTotal for o in ops), default=0))


def land_in_day_order(df: DataFrame, path: str, day_col: str = "collected_date") -> None:
    """Append one day after the other, as a daily collector does: a file stream takes files by age."""
    for row in df.select(day_col).distinct().orderBy(day_col).collect():  # one row a collection day
        append_daily(df.filter(F.col(day_col) == F.lit(row[0])).coalesce(1), path, day_col)


def lowest_per_day(stream: DataFrame, delay: str = "1 day") -> DataFrame:
    """Minimum price per route and collection day (tumbling 1-day windows). In append output a day comes out once the
    watermark has passed its end, and its state goes; rows for a day that is out are late and dropped (and counted)."""
    route = F.concat_ws("-", "origin", "destination")
    return (stream.withWatermark("event_ts", delay)
            .groupBy(F.window("event_ts", "1 day"), route.alias("route"))
            .agg(F.min("price").alias("min_price")))


def dedup(stream: DataFrame, keys: list[str], delay: str = "2 days") -> DataFrame:
    """Drop re-delivered rows (a forced re-run appends a day twice)."""
    return stream.withWatermark("event_ts", delay).dropDuplicatesWithinWatermark(keys)


def fresh_run_dirs(spark: SparkSession, name: str) -> tuple[str, str]:
    """(sink, checkpoint) folders unique to one run, under the shared folder."""
    base = scratch_path(spark, f"streams/{name}-{uuid.uuid4().hex[:12]}")
    return os.path.join(base, "sink"), os.path.join(base, "checkpoint")
