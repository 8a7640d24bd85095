"""Model scoring, serving post-processing and Spark ML fits.

The reference's fitted boosted-tree artefacts are absent from its checkout,
so fitting is done with Spark ML (``GBTRegressor`` / ``GBTClassifier`` in a
``Pipeline``), and serving scores with the fitted, stored models
(``fitted_scores``). ``baseline_scores`` is a transparent rule for checking the
serving post-processing against SQL, where no fitted model can be.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalar as S

WAIT_THRESHOLD = 0.45
PRICE_FEATURES = ["days_ahead", "dep_dow", "dep_month", "col_dow", "route",
                  "price_lag1", "price_lag7", "price_roll3"]
CLF_FEATURES = PRICE_FEATURES + ["price", "trend"]


def half_up(x, digits: int):
    """Half-up rounding on the binary value (same in every engine)."""
    m = 10 ** digits
    return F.floor(F.col(x) * m + 0.5) / m if isinstance(x, str) else F.floor(x * m + 0.5) / m


def baseline_scores(features: DataFrame) -> DataFrame:
    """Stand-in scores: estimate = mean of the last 3 prices; wait probability
    falls as the recent trend rises (logistic in £10 steps)."""
    p = 1 / (1 + F.exp((F.col("price_lag1") - F.col("price_lag7")) / 10))
    return (features.withColumn("estimated_price", F.col("price_roll3"))
            .withColumn("wait_probability", half_up(p, 4)))


def fitted_scores(features: DataFrame, price_model, wait_model) -> DataFrame:
    """Scores of serving features by the two fitted pipelines: the estimate from
    the regressor; the classifier also takes the last observed price as ``price``
    and ``trend`` = lag 1 − lag 7, as at training time."""
    x = features.withColumn("price", F.col("price_lag1")).withColumn("trend", F.col("price_lag1") - F.col("price_lag7"))
    priced = price_model.transform(x).drop("features", "route_idx")
    return wait_probability(wait_model.transform(priced)).drop(
        "features", "route_idx", "rawPrediction", "probability", "prediction", "price", "trend")


def apply_outlook(scored: DataFrame, threshold: float = WAIT_THRESHOLD) -> DataFrame:
    """Action, confidence and rounding exactly as the reference's serving code."""
    p = F.col("wait_probability")
    return (scored.withColumn("action", S.outlook(p, threshold))
            .withColumn("confidence", S.confidence(p, threshold))
            .withColumn("wait_threshold", F.lit(threshold))
            .withColumn("confidence_distance", half_up(F.abs(p - F.lit(threshold)), 4))
            .withColumn("wait_probability", half_up(p, 4))
            .withColumn("estimated_price", half_up("estimated_price", 2))
            .withColumn("last_observed_price", half_up("price_lag1", 2)))


# --- Spark ML fits (R-checked) ---------------------------------------------------

def price_pipeline(features: Sequence[str] = PRICE_FEATURES, label: str = "price",
                   seed: int = 42, max_iter: int = 50, max_bins: int = 64):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import StringIndexer, VectorAssembler
    from pyspark.ml.regression import GBTRegressor
    num = [c for c in features if c != "route"]
    idx = StringIndexer(inputCol="route", outputCol="route_idx", handleInvalid="keep")
    vec = VectorAssembler(inputCols=num + ["route_idx"], outputCol="features", handleInvalid="keep")
    gbt = GBTRegressor(labelCol=label, featuresCol="features", seed=seed, maxIter=max_iter,
                       maxBins=max_bins, predictionCol="estimated_price")
    return Pipeline(stages=[idx, vec, gbt])


def wait_pipeline(features: Sequence[str] = CLF_FEATURES, label: str = "should_wait",
                  seed: int = 42, max_iter: int = 50, max_bins: int = 64):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import StringIndexer, VectorAssembler
    num = [c for c in features if c != "route"]
    idx = StringIndexer(inputCol="route", outputCol="route_idx", handleInvalid="keep")
    vec = VectorAssembler(inputCols=num + ["route_idx"], outputCol="features", handleInvalid="keep")
    gbt = GBTClassifier(labelCol=label, featuresCol="features", seed=seed, maxIter=max_iter,
                        maxBins=max_bins)
    return Pipeline(stages=[idx, vec, gbt])


def bins_for(df: DataFrame, col: str = "route") -> int:
    """Bins that hold every route and the one for unseen routes."""
    return max(64, df.agg(F.count_distinct(col)).first()[0] + 2)


def wait_probability(pred: DataFrame) -> DataFrame:
    from pyspark.ml.functions import vector_to_array
    return pred.withColumn("wait_probability", vector_to_array("probability")[1])


def feature_importance(model, names: Sequence[str]) -> list[tuple[str, float]]:
    """(feature, importance) of the last stage (a small list, not data)."""
    imp = model.stages[-1].featureImportances.toArray().tolist()
    num = [c for c in names if c != "route"] + ["route"]
    return sorted(zip(num, imp), key=lambda t: -t[1])
