"""Model fits, evaluation and artefact files (rows-only checks: a fitted
boosted-tree model has no SQL oracle; pytest checks the pieces)."""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import r4
from ..operators import metrics as M
from ..operators import models as MD
from ..operators import timeseries as TS
from ..sources import fixtures as fx
from ..session import scratch_path
from ..sources.landing import land_at, land_parquet
from ..sources.model_store import StoredModel, fit_once
from .registry import register


def training_frame(spark: SparkSession, sf: str) -> DataFrame:
    """The training table, landed once: the fits pass over it many times."""
    path = land_parquet(spark, sf, "training_frame", lambda: TS.training_frame(fx.stored(spark, sf, "calendar")))
    return spark.read.parquet(path)


def split(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return TS.temporal_split(training_frame(spark, sf))


def price_model(spark: SparkSession, sf: str) -> StoredModel:
    """The stored price regressor, fitted on the train side of the temporal split."""
    settings = {"model": "GBTRegressor", "features": MD.PRICE_FEATURES, "seed": 42, "max_iter": 50, "split": 0.8}

    def fit(s: dict):
        train, _ = split(spark, sf)
        return MD.price_pipeline(s["features"], seed=s["seed"], max_iter=s["max_iter"],
                                 max_bins=MD.bins_for(train)).fit(train)
    return fit_once(spark, sf, "price", settings, fit)


def wait_model(spark: SparkSession, sf: str) -> StoredModel:
    """The stored wait classifier with the threshold it is served at."""
    settings = {"model": "GBTClassifier", "features": MD.CLF_FEATURES, "seed": 42, "max_iter": 50, "split": 0.8,
                "wait_threshold": MD.WAIT_THRESHOLD}

    def fit(s: dict):
        train, _ = split(spark, sf)
        return MD.wait_pipeline(s["features"], seed=s["seed"], max_iter=s["max_iter"],
                                max_bins=MD.bins_for(train)).fit(train)
    return fit_once(spark, sf, "wait", settings, fit)


def scored(spark: SparkSession, sf: str, features: DataFrame) -> DataFrame:
    """Serving features with the stored models' scores, action, confidence and roundings."""
    wait = wait_model(spark, sf)
    raw = MD.fitted_scores(features, price_model(spark, sf), wait)
    return MD.apply_outlook(raw, wait.settings["wait_threshold"])


@register("ml_price_model")
def ml_price_model(spark, sf):
    """Gradient-boosted price regressor (route indexed, 8 features) scored on
    the temporal test split."""
    _, test = split(spark, sf)
    return price_model(spark, sf).transform(test).select("route", "departure_date", "collected_date", "price",
                                                         r4("estimated_price").alias("estimated_price"))


@register("ml_wait_model")
def ml_wait_model(spark, sf):
    """Gradient-boosted wait classifier; probability of class 1 and the
    outlook at the 0.45 threshold."""
    _, test = split(spark, sf)
    model = wait_model(spark, sf)
    p = MD.wait_probability(model.transform(test))
    return p.select("route", "departure_date", "collected_date", "should_wait",
                    r4("wait_probability").alias("wait_probability"),
                    (F.col("wait_probability") >= model.settings["wait_threshold"]).cast("int").alias("predicted"))


def evaluation(spark: SparkSession, sf: str) -> DataFrame:
    reg, clf = price_model(spark, sf), wait_model(spark, sf)
    _, test = split(spark, sf)
    done = MD.wait_probability(clf.transform(reg.transform(test).drop("features", "route_idx")))
    rm = M.regression_metrics(done, "price", "estimated_price").withColumnRenamed("n", "n_test")
    cm = M.classification_metrics(done, "should_wait", "wait_probability", clf.settings["wait_threshold"]).drop("n")
    au = M.auc(done, "should_wait", "wait_probability")
    from ..operators.aggregate import combine_rows
    return combine_rows(rm, cm, au)


@register("ml_evaluate")
def ml_evaluate(spark, sf):
    """MAE, RMSE, R², MAPE, AUC, accuracy, precision, recall on the test split."""
    e = evaluation(spark, sf)
    return e.select(*[r4(c).alias(c) for c in ("mae", "rmse", "r2", "mape", "auc", "accuracy", "precision",
                                               "recall")], "n_test")


def importance_frame(spark: SparkSession, sf: str) -> DataFrame:
    stored = price_model(spark, sf)
    rows = MD.feature_importance(stored.model, stored.settings["features"])
    return spark.createDataFrame(rows, "feature string, importance double")


@register("ml_importance")
def ml_importance(spark, sf):
    """Regressor feature importances (normalised gain; the reference's are
    split counts, so the ranking is comparable, the values are not)."""
    return importance_frame(spark, sf).select("feature", r4("importance").alias("importance"))


@register("topk_features")
def topk_features(spark, sf):
    """The 5 most important features, ascending for display."""
    top = importance_frame(spark, sf).orderBy(F.col("importance").desc(), "feature").limit(5)
    return top.orderBy("importance", "feature").select("feature", r4("importance").alias("importance"))


def _version(spark: SparkSession, sf: str) -> str:
    """What a landed evaluation depends on: both models' versions."""
    return f"{price_model(spark, sf).version}_{wait_model(spark, sf).version}"


METRICS = ("mae double, rmse double, r2 double, mape double, n_test long, accuracy double, precision double, recall double, "
           "auc double, evaluated_at string")


@register("snk_metrics")
def snk_metrics(spark, sf):
    """Metrics written as JSON next to the models and read back; written again only for other models."""
    path = land_at(spark, scratch_path(spark, f"metrics_json_{_version(spark, sf)}"),
                   lambda p: evaluation(spark, sf).withColumn("evaluated_at", F.lit("2024-02-01T00:00:00"))
                   .coalesce(1).write.mode("overwrite").json(p))
    return spark.read.schema(METRICS).json(path)


@register("snk_importance")
def snk_importance(spark, sf):
    """Feature importances written as CSV with a header and read back."""
    path = land_at(spark, scratch_path(spark, f"importance_csv_{price_model(spark, sf).version}"),
                   lambda p: importance_frame(spark, sf).coalesce(1).write.mode("overwrite").option("header", True).csv(p))
    return spark.read.schema("feature string, importance double").option("header", True).csv(path)
