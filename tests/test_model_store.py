"""Stored models: fitted once, versioned by inputs and settings, equal scores after a reload."""

from pyspark.sql import functions as F

from fareweave.operators import models as MD
from fareweave.plans import calendar_plans as CP
from fareweave.plans import model_plans as MP
from fareweave.sources import model_store as MS

from .conftest import SF_SMALL


def test_reloaded_models_score_equally_and_are_fitted_once(spark):
    train, test = MP.split(spark, SF_SMALL)
    fits = []

    def fit(s):
        fits.append(s["max_iter"])
        return MD.price_pipeline(s["features"], max_iter=s["max_iter"], max_bins=MD.bins_for(train)).fit(train)

    settings = {"features": MD.PRICE_FEATURES, "max_iter": 2, "test": "reload"}
    first = MS.fit_once(spark, SF_SMALL, "test_price", settings, fit)
    again = MS.load_model(spark, first.path, first.version)
    assert again.settings == settings and again.model is not first.model
    assert MS.fit_once(spark, SF_SMALL, "test_price", settings, fit).path == first.path and fits == [2]
    key = ["route", "departure_date", "collected_date", "estimated_price"]
    a, b = (sorted(map(tuple, m.transform(test).select(key).collect())) for m in (first, again))
    assert a == b and len(a) > 0
    other = MS.fit_once(spark, SF_SMALL, "test_price", settings | {"max_iter": 1}, fit)
    assert other.version != first.version and other.path != first.path and fits == [2, 1]
    assert MS.model_version(spark, "/root/testdata/sf0.01", settings) != first.version


def test_batch_scores_equal_one_by_one_scores(spark):
    got = {(r.route, r.departure_date, r.as_of): r for r in CP.ml_score_batch(spark, SF_SMALL).collect()}
    assert len({r.estimated_price for r in got.values()}) > 1
    one = CP.serving_requests(spark, SF_SMALL).orderBy("route", "departure_date", "as_of").first()
    alone = CP.scored_requests(spark, SF_SMALL, spark.createDataFrame([one])).collect()
    assert alone == [got[(one.route, one.departure_date, one.as_of)]]
    for r in got.values():
        away = abs(r.wait_probability - r.wait_threshold)
        assert r.confidence == ("High" if away > 0.2501 else "Medium" if 0.1001 < away < 0.2499 else "Low" if away < 0.0999
                                else r.confidence)
        assert r.action == ("Price predicted to drop" if r.wait_probability >= 0.45 else "Price predicted to increase")


def test_journeys_without_a_score_are_kept(spark):
    j = spark.createDataFrame([("a", "x", 1), ("b", None, 2)], "itinerary_id string, route string, n int")
    s = spark.createDataFrame([("x", "drop")], "route string, action string")
    got = CP._outlook_of(j, s, ["route"], ["action"]).orderBy("itinerary_id").collect()
    assert [tuple(r) for r in got] == [("a", "x", 1, "drop"), ("b", None, 2, "n/a")]
    assert CP.journey_outlook(spark, SF_SMALL).where(F.col("action") == "n/a").count() == 0
