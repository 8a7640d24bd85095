"""The quarterly pipeline: incremental runs, broken and empty quarters, status from metadata."""

import os

import pytest
from pyspark.sql import functions as F

from fareweave.plans import source_plans as SP
from fareweave.sources import files as FL
from fareweave.sources import quarters as Q

from .conftest import SF_SMALL

HEADER = ",".join(n for n, _ in FL.MARKET_FIELDS) + "," + FL.PHANTOM


def line(itin, fare="100.0"):
    return f"{itin},m{itin},1, N01 ,N02,A,B,C,0.0,1.0,{fare},500.0,1,500.0,500.0,2,"


def put(base, year, quarter, lines):
    folder = os.path.join(base, f"Year={year}", f"Quarter={quarter}")
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, "part-0.csv"), "w") as f:
        f.write("\n".join([HEADER, *lines]) + "\n")


@pytest.fixture()
def pipeline(spark, tmp_path):
    csv = str(tmp_path / "csv")
    put(csv, 2000, 1, [line(k) for k in range(5)])
    put(csv, 2000, 2, ["not,a,line", "neither"])   # broken
    put(csv, 2000, 3, [])                           # header only
    put(csv, 2001, 1, [line(1), line(2, "bad"), line(3, "0")])
    return Q.QuarterPipeline(spark, csv, str(tmp_path / "base"))


def state(p, span=((2000, 1), (2001, 2))):
    return {(r.Year, r.Quarter): (r.stage, r.next_action, r.parquet_rows) for r in p.status(span).collect()}


def test_broken_and_empty_quarters_fail_alone_and_stay_pending(spark, pipeline):
    p = pipeline
    assert p.span() == ((2000, 1), (2001, 1))
    p.run(((2000, 1), (2001, 1)), features=True)
    assert state(p) == {
        (2000, 1): ("processed", "complete", 5), (2000, 2): ("csv", "convert_to_parquet", 0),
        (2000, 3): ("csv", "convert_to_parquet", 0), (2000, 4): ("not_started", "download", 0),
        (2001, 1): ("processed", "complete", 1), (2001, 2): ("not_started", "download", 0)}
    r = p.report().where("stage = 'parquet'").first()
    assert (r.pending, r.processed, r.skipped, r.failed, r.missing, r.rows) == (4, 2, 0, 2, 1, 6) and r.bytes > 0
    notes = {(c.Year, c.Quarter): c.note for c in p.commits().where("outcome = 'failed'").collect()}
    assert notes == {(2000, 2): "no readable row", (2000, 3): "no readable row"}
    assert [r.Origin for r in spark.read.parquet(p.parquet).select("Origin").distinct().collect()] == ["N01"]


def test_a_second_run_converts_only_what_changed(spark, pipeline):
    p, span = pipeline, ((2000, 1), (2001, 1))
    p.run(span, features=True)
    files = Q.list_quarters(spark, p.parquet)
    assert {(r.Year, r.Quarter) for r in p.pending(span).collect()} == {(2000, 2), (2000, 3)}
    p.run(span, features=True)
    assert Q.list_quarters(spark, p.parquet) == files
    put(p.csv, 2000, 2, [line(k) for k in range(3)])             # mended
    put(p.csv, 2001, 1, [line(k) for k in range(4)])             # replaced
    p.run(span, features=True)
    s = state(p)
    assert s[2000, 2] == ("processed", "complete", 3) and s[2001, 1][2] == 4
    assert Q.list_quarters(spark, p.parquet)[2000, 1] == files[2000, 1]
    got = {(r.run, r.stage): (r.processed, r.skipped, r.failed) for r in p.report().collect()}
    assert got[2, "parquet"] == (0, 2, 2) and (2, "features") not in got
    assert got[3, "parquet"] == (2, 1, 1) and got[3, "features"] == (2, 0, 0)
    feats = spark.read.parquet(p.features).groupBy("Year", "Quarter").count().collect()
    assert {(r.Year, r.Quarter): r["count"] for r in feats} == {(2000, 1): 5, (2000, 2): 3, (2001, 1): 4}


def test_a_damaged_parquet_quarter_is_converted_again(spark, pipeline):
    p, span = pipeline, ((2000, 1), (2001, 1))
    p.run(span)
    folder = os.path.join(p.parquet, "Year=2000", "Quarter=1")
    for name in os.listdir(folder):
        if name.endswith(".parquet"):
            with open(os.path.join(folder, name), "wb") as f:
                f.write(b"not parquet")
        elif name.endswith(".crc"):
            os.remove(os.path.join(folder, name))
    assert state(p)[2000, 1] == ("parquet", "reconvert", 0)
    p.run(span)
    assert state(p)[2000, 1] == ("parquet", "process_features", 5)


def test_rows_come_from_footers(spark):
    path = SP.quarter_pipeline(spark, SF_SMALL).parquet
    with Q._footer_session(spark) as own:
        text = Q.footer_count(own, path)._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*)]" in text and "PushedGroupBy: [Year, Quarter]" in text
    assert set(Q.footer_rows(spark, path)) == {tuple(r) for r in spark.read.parquet(path).groupBy(
        "Year", "Quarter").agg(F.count("*")).collect()}
