"""Hand-made edge frames (FIXTURES.md §3) and property checks against brute force."""

import datetime as dt
import itertools
import json
import random

import pytest
from pyspark.sql import functions as F

from fareweave.functions import scalar as S
from fareweave.functions import text as TX
from fareweave.operators import distribution as D
from fareweave.operators import metrics as M
from fareweave.operators import sample as SM
from fareweave.operators import skyline as SK
from fareweave.operators import timeseries as TS
from fareweave.operators import tracks as TR
from fareweave.operators import validate as VD
from fareweave.sources import responses as RS


def test_cut_label_edges(spark):
    vals = [0.0, 500.0, 500.01, 1000.0, 15000.0, 15000.01, None]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r[0] for r in df.select(S.cut_labels("x", *S.DISTANCE_BANDS)).collect()]
    assert got == [None, "<500", "500-1k", "500-1k", "5k+", None, None]


def test_half_even_hours(spark):
    df = spark.createDataFrame([(75,), (105,), (15,)], "m int")
    got = [r[0] for r in df.select(F.bround(F.col("m") / 60, 1)).collect()]
    assert got == [1.2, 1.8, 0.2]


def test_histogram_range_ends(spark):
    df = spark.createDataFrame([(0.0,), (10.0,), (5.0,), (10.5,), (-1.0,)], "x double")
    h = {r["bin"]: r["count"] for r in D.histogram(df, "x", 10, 0.0, 10.0).collect()}
    assert h == {0: 1, 5: 1, 9: 1}  # 10.0 falls in the last (closed) bin; outside dropped


def _series(spark, prices):
    rows = [("LHR", "SGN", dt.date(2024, 3, 1), dt.datetime(2024, 1, 1 + i, 8), p) for i, p in enumerate(prices)]
    return spark.createDataFrame(rows, "origin string, destination string, departure_date date, "
                                       "collected_at timestamp_ntz, price double")


@pytest.mark.parametrize("n", [1, 3, 7, 8])
def test_lags_short_series(spark, n):
    prices = [100.0 + i for i in range(n)]
    f = TS.add_lag_features(TS.build_features(TS.with_lead_time(_series(spark, prices))))
    rows = f.orderBy("collected_date").collect()
    mean = sum(prices) / n
    assert rows[0].price_lag1 == pytest.approx(mean)
    assert rows[0].price_change == 0.0
    for i, r in enumerate(rows):
        assert r.price_lag7 == pytest.approx(prices[i - 7] if i >= 7 else mean)
        prev = prices[max(0, i - 3):i]
        assert r.price_roll3 == pytest.approx(sum(prev) / len(prev) if prev else mean)
    t = TS.add_wait_target(f).count()
    assert t == max(0, n - 7)


def _dominates(q, p):
    return all(a <= b for a, b in zip(q, p)) and any(a < b for a, b in zip(q, p))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_skyline_equals_brute_force(spark, seed):
    rnd = random.Random(seed)
    rows = [("g%d" % rnd.randint(0, 2), float(rnd.randint(1, 30)), rnd.randint(1, 30), rnd.randint(0, 2), f"id{i}")
            for i in range(300)]
    rows += [rows[0][:4] + ("dup",)]  # an exact duplicate point
    df = spark.createDataFrame(rows, "g string, price_raw double, duration_minutes int, stop_count int, "
                                     "itinerary_id string")
    got = {r.itinerary_id for r in SK.pareto_front(df, ["g"]).collect()}
    want = {r[4] for r in rows if not any(q[0] == r[0] and _dominates(q[1:4], r[1:4]) for q in rows)}
    assert got == want


def test_skyline_reads_stop_counts_from_the_data(spark):
    df = spark.createDataFrame([("g", 1.0, 1, 0, "a"), ("g", 2.0, 2, 3, "b"), ("g", 0.5, 9, 7, "c")],
                               "g string, price_raw double, duration_minutes int, stop_count int, itinerary_id string")
    assert {r.itinerary_id for r in SK.pareto_front(df, ["g"]).collect()} == {"a", "c"}
    assert SK.pareto_front(df.limit(0), ["g"]).count() == 0


def test_skyline_single_and_all_dominated(spark):
    df = spark.createDataFrame([("g", 1.0, 1, 0, "a"), ("g", 2.0, 2, 1, "b"), ("g", 3.0, 3, 2, "c"),
                                ("h", 5.0, 5, 1, "z")],
                               "g string, price_raw double, duration_minutes int, stop_count int, itinerary_id string")
    assert {r.itinerary_id for r in SK.pareto_front(df, ["g"]).collect()} == {"a", "z"}


def _alerts_sequential(baseline, prices, drop=0.05):
    last, out = None, []
    for p in prices:
        ref = last or baseline
        if (baseline - p) / baseline >= drop and p < ref:
            out.append(p)
            last = p
    return out


@pytest.mark.parametrize("prices", [[95.0, 95.0, 94.0], [100.0, 120.0, 90.0, 96.0, 80.0], [94.9999, 96.0],
                                    [50.0, 60.0, 40.0]])
def test_alerts_running_min_equals_sequential(spark, prices):
    tracks = spark.createDataFrame([(1, 7, "LHR", "SGN", dt.date(2024, 3, 1), 100.0, True)],
                                   "id long, user_id long, origin string, destination string, "
                                   "departure_date date, baseline_price double, active boolean")
    got = [r.price for r in TR.alerts(tracks, _series(spark, prices)).orderBy("collected_at").collect()]
    assert got == _alerts_sequential(100.0, prices)


def test_track_state_reactivation_and_expiry(spark):
    ev = spark.createDataFrame([(1, 5, "LHR", "SGN", dt.date(2024, 3, 1), "track", 400.0),
                                (2, 5, "LHR", "SGN", dt.date(2024, 3, 1), "untrack", 401.0),
                                (3, 5, "LHR", "SGN", dt.date(2024, 3, 1), "track", 380.0),
                                (4, 6, "MAN", "HAN", dt.date(2024, 1, 2), "track", 300.0),
                                (5, 7, "MAN", "HAN", dt.date(2024, 3, 2), "untrack", 300.0)],
                               "seq long, user_id long, origin string, destination string, departure_date date, "
                               "op string, baseline_price double")
    st = {r.user_id: r for r in TR.track_state(ev).collect()}
    assert set(st) == {5, 6} and st[5].active and st[5].baseline_price == 380.0
    exp = {r.user_id: r.active for r in TR.expire(TR.track_state(ev), "2024-02-01 00:00:00").collect()}
    assert exp == {5: True, 6: False}


def _doc(legs):
    return json.dumps({"status": True, "data": {"itineraries": [{"id": "x", "price": {"raw": 10.0}, "legs": legs}]}})


def test_json_edge_documents(spark):
    seg = lambda a, b: {"origin": {"displayCode": a}, "destination": {"displayCode": b},
                        "marketingCarrier": {"alternateId": "AB"}, "flightNumber": "1"}
    five = [seg(a, b) for a, b in zip("ABCDE", "BCDEF")]
    docs = [_doc([]), _doc([{"segments": []}]), _doc([{"segments": five, "stopCount": 4}]),
            _doc([{"segments": [seg("A", "B")]}]), "{not json", json.dumps({"data": {}})]
    df = spark.createDataFrame([(d,) for d in docs], "json string")
    flat = RS.flat_itineraries(RS.parse_search(df)).collect()
    assert len(flat) == 3  # no legs → no row; malformed / empty → no row
    paths = sorted(r.segment_route for r in flat)
    assert paths == ["", "A -> B", "A -> B -> C -> D -> E -> F"]
    five_row = [r for r in flat if r.num_segments == 5][0]
    assert five_row.seg3_dest == "E" and five_row.seg0_flight == "AB1" and five_row.carrier_names == ""


def test_transits_short_and_null(spark):
    docs = [_doc([{"segments": []}, {"segments": []}])]
    rt = RS.parse_roundtrip(spark.createDataFrame([(d,) for d in docs], "json string")).collect()[0]
    assert rt.out_transit_airports == [] and rt.out_layover_hours == [] and rt.ret_flight_numbers == []


def test_requests_first_error(spark):
    rows = [(["LHR-SGN", "2024-03-01"],), (["LHRSGN", "2024-03-01"],), (["LHR-XXX", "2024-03-01"],),
            (["LHR-SGN", "bad"],), (["LHR-SGN", "2024-01-01"],), ([],), (["LHR-SGN"],)]
    df = spark.createDataFrame(rows, "args array<string>").withColumn("as_of", F.lit(dt.date(2024, 2, 1)))
    errs = [r.error for r in VD.validate_requests(df).collect()]
    assert errs[0] is None
    assert errs[1].startswith("Route 'LHRSGN' looks wrong")
    assert errs[2].startswith("Airport 'XXX' not recognised")
    assert errs[3].startswith("Date 'bad' is invalid")
    assert errs[4] == "Date 2024-01-01 is in the past."
    assert errs[5] == "Missing arguments. See /help for usage."
    assert errs[6] == "Need a date. See /help."
    win = spark.createDataFrame([(["LHR-SGN", "2024-03-05", "2024-03-01"],)], "args array<string>")
    win = win.withColumn("as_of", F.lit(dt.date(2024, 2, 1)))
    assert VD.validate_requests(win, need_range=True).first().error == "START date must be before END date."


def test_metrics_edges(spark):
    df = spark.createDataFrame([(0, 0.1), (1, 0.2), (0, 0.2), (1, 0.3)], "y int, s double")
    c = M.classification_metrics(df, "y", "s", 0.9).first()
    assert c.precision == 0.0 and c.recall == 0.0 and c.accuracy == 0.5
    # tied scores count half: pairs (pos, neg): (0.2,0.1)=1, (0.2,0.2)=0.5, (0.3,0.1)=1, (0.3,0.2)=1
    assert M.auc(df, "y", "s", buckets=3).first().auc == pytest.approx(3.5 / 4)
    r = M.regression_metrics(spark.createDataFrame([(0.0, 1.0), (2.0, 1.0)], "y double, p double"), "y", "p").first()
    assert r.mape == pytest.approx(50.0)  # the zero actual is left out, not infinite


def test_auc_matches_brute_force(spark):
    rnd = random.Random(5)
    rows = [(rnd.randint(0, 1), round(rnd.random(), 2)) for _ in range(400)]
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    want = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p, n in itertools.product(pos, neg)) / (len(pos) * len(neg))
    got = M.auc(spark.createDataFrame(rows, "y int, s double"), "y", "s", buckets=7).first().auc
    assert got == pytest.approx(want)


def test_ecdf_matches_brute_force(spark):
    rnd = random.Random(9)
    vals = [float(rnd.randint(0, 50)) for _ in range(2500)]
    got = sorted((r[0], r[1]) for r in D.ecdf(spark.createDataFrame([(v,) for v in vals], "x double"), "x",
                                                  max_points=100, buckets=5).collect())
    s = sorted(vals)
    step = max(1, len(s) // 100)
    want = sorted((s[i], (i + 1) / len(s)) for i in range(0, len(s), step))
    assert got == want


def test_sample_exact_and_nested(spark):
    df = spark.range(0, 3000).select(F.col("id").cast("string").alias("k"), (F.col("id") % 3).alias("q"))
    s10 = {r.k for r in SM.exact_sample(df, ["q"], "k", 0.1).collect()}
    s20 = {r.k for r in SM.exact_sample(df, ["q"], "k", 0.2).collect()}
    assert len(s10) == 300 and len(s20) == 600 and s10 <= s20


def test_text_formats(spark):
    df = spark.createDataFrame([(0, 1.25), (125, 2.5), (60, 0.75), (5, None)], "m int, h double")
    r = df.select(TX.fmt_minutes("m").alias("a"), TX.fmt_time(F.lit("2024-03-05T10:07:00Z")).alias("t"),
                  TX.fmt_time(F.lit("garbage")).alias("bad")).collect()
    assert [x.a for x in r] == ["N/A", "2h 5m", "1h", "5m"]
    assert r[0].t == "05/03 10:07" and r[0].bad == "N/A"
    link = spark.range(1).select(TX.search_link(F.lit("LHR"), F.lit("SGN"), F.lit("2026-10-15").cast("date"))).first()[0]
    assert link == "https://www.skyscanner.net/transport/flights/lhr/sgn/261015/?adultsv2=1&cabinclass=economy"


def test_sample_deal_card(spark):
    """The reference's one literal sample deal (LHR⇄SGN via PEK, £1428.22)."""
    seg = lambda a, b, d, r: {"origin": {"displayCode": a}, "destination": {"displayCode": b, "flightPlaceId": b},
                              "departure": d, "arrival": r, "operatingCarrier": {"iataCode": "CA", "flightNumber": "938"}}
    out = {"origin": {"displayCode": "LHR"}, "destination": {"displayCode": "SGN"}, "durationInMinutes": 1305,
           "stopCount": 1, "departure": "2024-03-01T21:00:00", "arrival": "2024-03-03T06:45:00",
           "segments": [seg("LHR", "PEK", "2024-03-01T21:00:00", "2024-03-02T14:00:00"),
                        seg("PEK", "SGN", "2024-03-02T16:30:00", "2024-03-03T06:45:00")]}
    ret = dict(out, origin={"displayCode": "SGN"}, destination={"displayCode": "LHR"}, durationInMinutes=1400,
               departure="2024-03-15T08:00:00", arrival="2024-03-16T07:20:00",
               segments=[seg("SGN", "PEK", "2024-03-15T08:00:00", "2024-03-15T14:00:00"),
                         seg("PEK", "LHR", "2024-03-15T15:15:00", "2024-03-16T07:20:00")])
    doc = json.dumps({"status": True, "data": {"itineraries": [{"id": "d1", "price": {"raw": 1428.22},
                                                                "legs": [out, ret]}]}})
    rt = RS.parse_roundtrip(spark.createDataFrame([(doc,)], "json string"))
    card = rt.select(TX.deal_card(F.lit(1), F.lit("LHR"), F.lit("SGN"), F.col("out_departure_date"),
                                  F.col("ret_departure_date"))).first()[0]
    assert "*Price:* £1428.22" in card and "Via: PEK" in card and "Layovers: 2.5h" in card
    assert "Flight(s): CA938, CA938" in card and "Duration: 21h 45m" in card
    r = rt.first()
    assert r.trip_length_days == 13 and r.total_stops == 2 and r.out_transit_airports == ["PEK"]


def test_group_quantiles_skewed(spark):
    """A hot group with half of its rows at one value, tiny groups, negative,
    zero, tiny and huge values, nulls; equal to ``percentile``."""
    from fareweave.operators.ranked import group_quantiles
    rnd = random.Random(11)
    rows = [("hot", rnd.randint(-400, 900) / 7.0) for _ in range(3000)] + [("hot", 100.0)] * 3000
    rows += [("cold", float(i)) for i in range(3)] + [("one", 5.0), ("hot", None), (None, 1.0)]
    rows += [("wide", v) for v in (-1e300, -1e-300, -0.0, 0.0, 1e-300, 3.0, 3.0000000001, 1e300)]
    rows += [("real", rnd.random()) for _ in range(2000)]
    df = spark.createDataFrame(rows, "g string, v double")
    qs = [0.0, 0.01, 0.1, 0.25, 0.5, 0.9, 0.95, 1.0]
    got = {r.g: [r[f"q{i}"] for i in range(len(qs))] for r in group_quantiles(df, ["g"], "v", qs).collect()}
    want = {r.g: list(r.p) for r in df.filter("g is not null").groupBy("g").agg(
        F.percentile("v", qs).alias("p")).collect()}
    assert set(got) == set(want)
    for g in want:
        assert got[g] == pytest.approx(want[g], rel=1e-12), g
    assert group_quantiles(df, [], "v", [0.5]).first().q0 == df.agg(F.percentile("v", 0.5)).first()[0]
    assert group_quantiles(df.limit(0), [], "v", [0.5]).first().q0 is None
    assert group_quantiles(df.limit(0), ["g"], "v", [0.5]).count() == 0


def test_top_n_and_cheapest_path_on_hot_group(spark):
    from fareweave.operators import itinerary as IT
    rnd = random.Random(4)
    rows = [("hot" if rnd.random() < 0.8 else f"g{rnd.randint(0, 3)}", f"p{rnd.randint(0, 5)}",
             float(rnd.randint(1, 400)), f"id{i}") for i in range(5000)]
    df = spark.createDataFrame(rows, "g string, path string, price_raw double, itinerary_id string").repartition(7)
    got = sorted((r.g, r.itinerary_id) for r in IT.top_n(df, 3, [F.col("price_raw"), F.col("itinerary_id")],
                                                          by=["g"]).collect())
    want = []
    for g in {r[0] for r in rows}:
        want += [(g, r[3]) for r in sorted((r for r in rows if r[0] == g), key=lambda r: (r[2], r[3]))[:3]]
    assert got == sorted(want)
    best = {(r.g, r.path): r.itinerary_id for r in IT.cheapest_per_path(df, ["g"], path="path", n=None).collect()}
    for (g, p), iid in best.items():
        cands = sorted((r for r in rows if r[0] == g and r[1] == p), key=lambda r: (r[2], r[3]))
        assert iid == cands[0][3]


def test_closed_form_ols_equals_spark_ml(spark):
    """Two-regressor OLS from moments equals LinearRegression(solver='normal')."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    from fareweave.operators.regression import ols2
    rnd = random.Random(2)
    rows = [(float(rnd.randint(1, 9)), float(rnd.randint(100, 6000))) for _ in range(300)]
    rows = [(c, d, 50 + 12 * c + 0.03 * d + rnd.gauss(0, 20)) for c, d in rows]
    df = spark.createDataFrame(rows, "carriers double, dist double, y double")
    mine = ols2(df, "y", "carriers", "dist", ("b1", "b2")).first()
    vec = VectorAssembler(inputCols=["carriers", "dist"], outputCol="f").transform(df)
    lr = LinearRegression(featuresCol="f", labelCol="y", solver="normal", regParam=0.0).fit(vec)
    assert mine.b1 == pytest.approx(lr.coefficients[0], rel=1e-9)
    assert mine.b2 == pytest.approx(lr.coefficients[1], rel=1e-9)
    assert mine.intercept == pytest.approx(lr.intercept, rel=1e-9)
    assert mine.r2 == pytest.approx(lr.summary.r2, rel=1e-9)



def test_landing_is_keyed_by_input_files(spark, tmp_path):
    """A landing is reused for unchanged inputs and redone when an input file changes."""
    import os
    import shutil

    from fareweave.sources.landing import land_once, landed_path
    src = tmp_path / "sf"
    src.mkdir()
    shutil.copy("/root/testdata/sf0.001/region.parquet", src / "region.parquet")
    calls = []

    def write(path):
        calls.append(path)
        spark.read.parquet(str(src / "region.parquet")).write.mode("overwrite").parquet(path)

    p1 = land_once(spark, str(src), "edge_test", write)
    p2 = land_once(spark, str(src), "edge_test", write)
    assert p1 == p2 and len(calls) == 1
    os.utime(src / "region.parquet", (1, 1))  # the input changed
    assert landed_path(spark, str(src), "edge_test") != p1
