"""Rows of larger or unusual tables that queries once failed on."""

from __future__ import annotations

import math
import re
import time

import numpy as np
from pyspark.sql import functions as F

from fareweave.functions.numeric import r4_ieee
from fareweave.llm import overlap_join
from fareweave.llm.common import connected_components, materialize
from fareweave.operators import ranked, regression, timeseries
from fareweave.plans.registry import QUERIES, load_all
from fareweave.sources import fixtures as fx
from fareweave.sources import landing, responses

from .conftest import SF_SMALL


def test_constant_regressor_gives_nan(spark):
    """Routes that all have the same number of carriers leave the normal equations without a solution."""
    df = spark.createDataFrame([(1.0, 25, 10.0), (2.0, 25, 20.0), (4.0, 25, 35.0)], "y double, x1 long, x2 double")
    r = regression.ols2(df, "y", "x1", "x2").select(*[r4_ieee(c).alias(c) for c in (
        "coef_x1", "coef_x2", "intercept", "r2")], "n").first()
    assert all(math.isnan(v) for v in r[:4]) and r.n == 3


def test_constant_answer_and_empty_frame(spark):
    df = spark.createDataFrame([(3.0, 1, 10.0), (3.0, 2, 20.0), (3.0, 7, 35.0)], "y double, x1 long, x2 double")
    r = regression.ols2(df, "y", "x1", "x2").first()
    assert r.coef_x1 == 0 and r.coef_x2 == 0 and r.intercept == 3 and math.isnan(r.r2)
    empty = regression.ols2(df.limit(0), "y", "x1", "x2").first()
    assert empty.coef_x1 is None and empty.r2 is None and empty.n == 0


def _journeys(spark):
    return spark.createDataFrame([("a", "2024-02-01", "2024-03-01", 250.0, 700, 1, "Brand#1, KIND", "LHR -> DXB -> SGN")], """itinerary_id
        string, collected_at string, search_date string, price_raw double, duration_minutes int, stop_count int, carrier_names string,
        segment_route string""").withColumn("search_date", F.to_date("search_date"))


def test_responses_are_parsed_once(spark):
    """A filter on the status must not be pushed below the parse, where it would parse (and build) the text again."""
    deals = responses.parse_roundtrip(responses.roundtrip_documents(_journeys(spark)))
    plan = deals._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1
    r = deals.first()
    assert (r.out_transit_airports, r.ret_transit_airports, r.out_transit_countries) == (["DXB"], ["DXB"], ["AE"])
    assert (r.flight_id, r.total_duration_min, r.total_stops, r.trip_length_days) == ("a", 1445, 2, 7)


def test_partitioned_write_sorts_nothing(spark, tmp_path):
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key, None)
    with landing.open_writers(spark):
        assert int(spark.conf.get(key)) == landing.OPEN_FILES
        spark.range(1000).select("id", (F.col("id") % 100).alias("day")).write.partitionBy("day").parquet(str(tmp_path / "t"))
    assert spark.conf.get(key, None) == before
    assert spark.read.parquet(str(tmp_path / "t")).agg(F.count("*"), F.sum("id")).first()[:] == (1000, 499500)


def test_open_days_and_asked_years_are_there(spark):
    load_all()
    days = QUERIES["st_lowest_per_day"](spark, SF_SMALL).agg(F.max("date")).first()[0]
    assert days == fx.calendar(spark, SF_SMALL).agg(F.max("collected_date")).first()[0]
    assert QUERIES["src_csv_years_quarters"](spark, SF_SMALL).where("Year between 1992 and 1999").count() == 32


def test_a_written_step_leaves_no_shuffle_files(spark):
    """Many steps of an operator must not hold all their shuffles on disk at once."""
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def held() -> set[str]:
        files = disk.getAllFiles()
        return {files.apply(k).getName() for k in range(files.size()) if files.apply(k).getName().startswith("shuffle_")}

    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, setting = held(), spark.conf.get(key, None)
    got = materialize(spark.range(10_000).groupBy((F.col("id") % 100).alias("k")).count(), "test")
    deadline = time.time() + 10
    while held() - before and time.time() < deadline:
        time.sleep(0.1)
    assert not held() - before and spark.conf.get(key, None) == setting
    assert got.count() == 100 and got.agg(F.sum("count")).first()[0] == 10_000


def test_range_join_goes_in_rounds(spark, monkeypatch):
    """No round shuffles more than a few copies of the vectors, however many blocks there are; results are as in one round."""
    from fareweave.llm import metric_range_join as MR

    rng = np.random.default_rng(3)
    base = rng.normal(size=(20, 4))
    rows = [(k, [float(x) for x in base[k % 20] + rng.normal(scale=0.2, size=4)]) for k in range(200)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    whole = sorted(tuple(r) for r in MR.range_join(df).collect())
    names, written = [], MR.materialize
    monkeypatch.setattr(MR, "materialize", lambda d, name: names.append((name, d)) or written(d, name))
    monkeypatch.setattr(MR, "BLOCK_ROWS", 20)
    monkeypatch.setattr(MR, "TILE_ROWS", 7)
    assert sorted(tuple(r) for r in MR.range_join(df, cell_rows=50).collect()) == whole
    assert sum(name == "partners" for name, _ in names) >= 4
    assert all(dict(d.dtypes)["vec"] == "array<float>" for name, d in names if name in ("vectors", "classes", "placed"))


def test_parse_reads_only_what_is_asked_for(spark):
    """The same rows as from the whole response, junk and fields of another kind included, by a narrow schema."""
    good = responses.roundtrip_documents(_journeys(spark))
    odd = spark.createDataFrame([("junk",), ('{"status": true}',), ('{"status": true, "data": {"itineraries": [{"id": "b", '
                                 '"legs": [{"departure": "2024-03-01T10:00:00", "origin": "x"}]}]}}',)], "json string")
    docs = good.union(odd)
    whole = responses.parse_roundtrip(docs)
    for leg in responses.LEG_FIELDS:
        some = responses.parse_roundtrip(docs, legs=[leg])
        names = ["flight_id", "price_gbp", f"out_{leg}", f"ret_{leg}", "total_stops", "trip_length_days"]
        assert sorted(some.select(*names).collect(), key=str) == sorted(whole.select(*names).collect(), key=str), leg
    few = responses.narrow(responses.SEARCH_RESPONSE, ["status", "data.itineraries.legs.segments.operatingCarrier.iataCode"])
    assert few.simpleString() == ("struct<status:boolean,data:struct<itineraries:array<struct<legs:array<struct<segments:"
                                  "array<struct<operatingCarrier:struct<iataCode:string>>>>>>>>>")
    columns = ["itinerary_id", "departure", "seg0_origin", "seg0_duration", "seg1_flight"]
    flat = responses.parse_flat(docs, columns).select(*columns)
    assert sorted(flat.collect(), key=str) == sorted(responses.flat_itineraries(responses.parse_search(docs)).select(
        *columns).collect(), key=str)


def test_csv_export_writes_no_view(spark, tmp_path, monkeypatch):
    from fareweave.plans import source_plans

    def no_view(*_):
        raise AssertionError("the export needs no stored view")

    def land(spark, sf, kind, write):
        write(str(tmp_path / kind))
        return str(tmp_path / kind)

    monkeypatch.setattr(fx, "stored", no_view)
    monkeypatch.setattr(source_plans, "land_once", land)
    path = source_plans.market_csv(spark, SF_SMALL)
    assert spark.read.option("header", True).csv(path).count() == fx.market(spark, SF_SMALL).count()


def test_small_tables_are_few_files(spark):
    """However many partitions a step has: a file a partition cost a process for each change of its rights, and an executor's
    memory was counted twice while one started."""
    keys = {"spark.sql.shuffle.partitions": "50", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        rows = materialize(spark.range(0, 40_000, 1, 60), "test", 40_000)
        assert len(rows.inputFiles()) == 3 and rows.count() == 40_000
        found = connected_components(spark.range(0, 2_000, 1, 60).select(
            F.col("id").alias("a"), (F.col("id") % 100).alias("b")), "a", "b")
        assert len(found.inputFiles()) == 1
        assert found.count() == 2_000 and found.where("component != node % 100").isEmpty()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_coupons_are_not_shuffled_for_their_customers(spark):
    """Customers join the orders before the much larger line items do."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, -1)
    try:
        plan = fx.market(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.set(key, before)
    at = next(k for k, line in enumerate(plan) if "hashpartitioning(o_custkey" in line)
    depth = len(plan[at]) - len(plan[at].lstrip(" :+-"))
    below = []
    for line in plan[at + 1:]:
        if len(line) - len(line.lstrip(" :+-")) <= depth:
            break
        below.append(line)
    assert any("o_orderkey" in line for line in below) and not any("l_orderkey" in line for line in below)


def test_training_rows_are_not_dealt_by_route(spark):
    """A frame dealt by route had one file, and a fit one task, for a route or two, however many rows they hold."""
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        frame = timeseries.training_frame(fx.calendar(spark, SF_SMALL).where("origin = 'LHR' and destination = 'SGN'"))
        at = {r.at for r in frame.select("price_lag1", F.spark_partition_id().alias("at")).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(at) > 1


def test_quantiles_count_their_values_once(spark):
    """The histogram and the search in its buckets read one shuffle of the counts, not one each."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, -1)
    try:
        df = spark.range(1000).select((F.col("id") % 3).alias("g"), F.when(F.col("id") > 2, (F.col("id") * 7 % 101).cast(
            "double")).alias("v")).union(spark.createDataFrame([(1, float("nan")), (2, 0.0), (2, -5.0)], "g long, v double"))
        found = ranked.group_quantiles(df, ["g"], "v", [0.0, 0.5, 0.95])
        got = {r.g: tuple(r)[1:] for r in found.collect()}
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(key, before)
    assert "ReusedExchange" in plan
    want = df.groupBy("g").agg(F.percentile("v", [0.0, 0.5, 0.95]).alias("q")).collect()
    assert got == {r.g: tuple(r.q) for r in want} and got[2][0] == -5.0


def test_cell_members_are_shuffled_once(spark):
    """The pairs of set and cell are the largest shuffle of the near duplicates: the centres and the members read one."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, -1)
    try:
        parts = spark.createDataFrame([(k % 40, k % 7 + 100 * (k % 3)) for k in range(400)] + [(99, -1)], "id long, cell long")
        met = overlap_join._met(parts)
        got = sorted(tuple(r) for r in met.collect())
        plan = met._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.set(key, before)
    by_cell = {}
    for k, cell in {tuple(r) for r in parts.collect()}:
        by_cell.setdefault(cell, set()).add(k)
    assert got == sorted((k, cell, min(ids)) for cell, ids in by_cell.items() if len(ids) > 1 for k in ids)
    assert len(re.findall(r"- Exchange hashpartitioning\(cell", plan)) == 1, plan


def test_cheapest_deals_parse_only_what_they_tell(spark, monkeypatch):
    """And the pairs of a leg's segments are made once, whatever is told of them."""
    from fareweave.plans import itinerary_plans as IP

    asked = []
    deals = IP.deals
    monkeypatch.setattr(IP, "deals", lambda spark, sf, *legs: asked.append(set(legs)) or deals(spark, sf, *legs))
    monkeypatch.setattr(IP, "land_parquet", lambda spark, sf, kind, build: build() and f"{SF_SMALL}/lineitem.parquet")
    IP.topk_deals(spark, SF_SMALL)
    IP.fn_deal_line(spark, SF_SMALL)
    IP.fn_deal_card(spark, SF_SMALL)
    assert all(legs and "transit_countries" not in legs for legs in asked) and len(asked) == 3
    assert asked[0] == {"origin", "destination"} and not asked[1] & {"arrival", "flight_numbers", "layover_hours"}
    docs = responses.roundtrip_documents(_journeys(spark))
    plan = responses.parse_roundtrip(docs, legs=responses.TRANSITS)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("transform(it#") <= 2, plan


def test_deals_are_written_whole(spark, tmp_path, monkeypatch):
    """All fields of a deal, those that are null too, and the metadata block, by either of the two queries."""
    from fareweave.plans import itinerary_plans as IP
    from fareweave.plans import source_plans as SP

    def land(spark, sf, kind, write):
        if not (tmp_path / kind).exists():
            write(str(tmp_path / kind))
        return str(tmp_path / kind)

    odd = spark.createDataFrame([('{"status": true, "data": {"itineraries": [{"id": "b"}]}}',)], "json string")
    monkeypatch.setattr(IP, "land_once", land, raising=False)
    monkeypatch.setattr(landing, "land_once", land)
    monkeypatch.setattr(IP, "roundtrip_docs", lambda *_: responses.roundtrip_documents(_journeys(spark)).union(odd))
    assert sorted(IP.snk_deals_json(spark, SF_SMALL).collect(), key=str)[0][:4] == ("a", 250.0, "LHR", "SGN")
    (at,) = tmp_path.iterdir()
    told = {(r.out_origin, r["count"], r.cheapest, r.average) for r in spark.read.json(str(at / "metadata")).collect()}
    assert told == {("LHR", 1, 250.0, 250.0), (None, 1, 0.0, 0.0)}
    lines = [r.value for r in spark.read.text(str(at / "flights")).collect()]
    assert len(lines) == 2 and all(line.count("out_layover_hours") == 1 and '"ret_departure_date"' in line for line in lines)
    assert ("LHR", "SGN", 1, 250.0, 250.0) in {tuple(r) for r in SP.src_deals_json(spark, SF_SMALL).collect()}
