"""Regression and classification metrics as aggregations.

AUC is exact and tie-aware (the Mann-Whitney form): scores are collapsed to
one row per distinct score with positive/negative counts, negatives below
each score come from a range-bucketed running sum (no single-task window),
and ``AUC = Σ pos(s)·(neg_below(s) + neg(s)/2) / (P·N)``. Spark's
``BinaryClassificationEvaluator`` bins scores by default and is not exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ranked import ordered_cumsum


def regression_metrics(df: DataFrame, label: str, pred: str) -> DataFrame:
    y, p = F.col(label), F.col(pred)
    err = y - p
    n = F.count(F.lit(1))
    return df.agg(
        F.avg(F.abs(err)).alias("mae"),
        F.sqrt(F.avg(err * err)).alias("rmse"),
        (1 - F.sum(err * err) / (F.var_pop(y) * n)).alias("r2"),
        (F.avg(F.abs(F.try_divide(err, y))) * 100).alias("mape"),
        n.alias("n"))


def classification_metrics(df: DataFrame, label: str, score: str,
                           threshold: float = 0.45) -> DataFrame:
    """accuracy, precision, recall at ``score >= threshold`` (0 when undefined)."""
    y = F.col(label) == 1
    yhat = F.col(score) >= F.lit(threshold)
    tp = F.count_if(y & yhat)
    fp = F.count_if(~y & yhat)
    fn = F.count_if(y & ~yhat)
    n = F.count(F.lit(1))
    return df.agg(
        ((tp + F.count_if(~y & ~yhat)) / n).alias("accuracy"),
        F.coalesce(F.try_divide(tp, tp + fp), F.lit(0.0)).alias("precision"),
        F.coalesce(F.try_divide(tp, tp + fn), F.lit(0.0)).alias("recall"),
        n.alias("n"))


def auc(df: DataFrame, label: str, score: str, buckets: int | None = None) -> DataFrame:
    """Exact ROC AUC with ties counted half (one row)."""
    per = (df.groupBy(F.col(score).alias("_s"))
           .agg(F.count_if(F.col(label) == 1).cast("double").alias("_pos"),
                F.count_if(F.col(label) != 1).cast("double").alias("_neg")))
    cum = ordered_cumsum(per, "_s", ["_neg"], buckets)
    below = F.col("_neg_cum") - F.col("_neg")
    return cum.agg(F.try_divide(F.sum(F.col("_pos") * (below + F.col("_neg") / 2)),
                                F.sum("_pos") * F.sum("_neg")).alias("auc"))
