"""The streaming tracks table and its timers against their batch twins."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fareweave.operators import tracks as TR
from fareweave.plans import track_plans as TP
from fareweave.sources import fixtures as fx
from fareweave.streaming import track_stream as TS

from .conftest import SF_SMALL

TRACKS = ["id", *TR.TRACK_KEY, "baseline_price", "active", "last_notified_price", "tracked_seq"]


def state(df):
    return sorted(map(tuple, df.select(TRACKS).collect()), key=repr)


@pytest.fixture()
def events(spark):
    return fx.track_events(spark, SF_SMALL)


def test_replayed_and_reordered_batches_change_nothing(spark, events, tmp_path):
    store = TS.TrackStore(spark, str(tmp_path))
    want = state(TR.track_state(events))
    parts = [events.filter(F.col("seq") % 3 == k) for k in range(3)]
    for batch in (0, 1, 1, 0, 2, 2):
        store.upsert(parts[batch], batch)
    assert store.batches() == [0, 1, 2] and state(store.tracks()) == want
    store.compact()
    assert store.batches() == [] and state(store.tracks()) == want
    store.upsert(parts[1], 1)  # held by the base already
    assert store.batches() == [] and state(store.tracks()) == want
    assert state(TS.TrackStore(spark, str(tmp_path / "none")).tracks()) == []


def test_an_unfinished_batch_is_not_part_of_the_table(spark, events, tmp_path):
    store = TS.TrackStore(spark, str(tmp_path))
    store.upsert(events.filter("seq < 1000"), 0)
    (tmp_path / "batch_1").mkdir()  # died before its end marker
    assert store.batches() == [0]
    assert state(store.tracks()) == state(TR.track_state(events.filter("seq < 1000")))


def test_timers_go_off_only_behind_the_watermark(spark, tmp_path):
    from fareweave.streaming import snapshots as SN
    day = [dt.date(2024, 1, d) for d in range(1, 6)]
    spark.createDataFrame([(k, d) for k, d in enumerate(day)], "id long, departure_date date").write.parquet(
        str(tmp_path / "tracks"))
    snaps = str(tmp_path / "snaps")
    sink, ckpt = str(tmp_path / "sink"), str(tmp_path / "ckpt")

    def run():
        timers = spark.readStream.schema("id long, departure_date date").parquet(str(tmp_path / "tracks"))
        SN.run_available_now(TS.expiry_stream(timers, SN.snapshot_stream(spark, snaps)), sink, ckpt)
        return sorted(r.id for r in spark.read.schema(TS.EXPIRED_SCHEMA).parquet(sink).collect())

    def snapshot(at):
        SN.append_daily(spark.createDataFrame([("A", "B", day[0], dt.datetime.fromisoformat(at), 1.0)],
                                              "origin string, destination string, departure_date date, collected_at "
                                              "timestamp_ntz, price double").withColumn(
            "collected_date", F.to_date("collected_at")), snaps)

    snapshot("2024-01-02T00:00:00")
    assert run() == [0]                      # day 2 itself is not past yet
    snapshot("2024-01-04T09:00:00")
    assert run() == [0, 1, 2, 3]             # a later run goes on from the stored timers


def test_stream_equals_batch_expiry(spark):
    as_of = fx.stored(spark, SF_SMALL, "calendar").agg(F.max("collected_at")).first()[0]
    tracks = TP.tracks(spark, SF_SMALL).filter("active")
    want = {r.id for r in TR.expire(tracks, as_of).filter(~F.col("active")).collect()}
    from fareweave.plans.stream_plans import st_track_expiry_stream
    assert {r.id for r in st_track_expiry_stream(spark, SF_SMALL).collect()} == want and want
