"""Fitted pipelines kept under the shared folder: fitted once, stored with their settings, loaded to score.

A model is stored as ``<shared folder>/tables/model_<name>_<version>`` with a ``meta`` record beside its stages. The
version is a digest of the input files' identity and of every setting, so changed inputs or settings are another
version and never read an older one. A half-written model has no end marker and is written again.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path
from .landing import LANDING_VERSION, _input_tag, land_at

#: Models this driver has loaded, by application and path (a few pipelines of a bounded number of trees).
_LOADED: dict[tuple[str, str], "StoredModel"] = {}


@dataclass(frozen=True)
class StoredModel:
    """A fitted pipeline with the settings it was fitted under."""
    path: str
    version: str
    settings: dict
    model: PipelineModel

    def transform(self, df: DataFrame) -> DataFrame:
        return self.model.transform(df)


def model_version(spark: SparkSession, sf_dir: str, settings: dict) -> str:
    text = json.dumps([LANDING_VERSION, _input_tag(spark, sf_dir), settings], sort_keys=True)
    return hashlib.sha1(text.encode()).hexdigest()[:12]


def load_model(spark: SparkSession, path: str, version: str) -> StoredModel:
    """The model at ``path`` as it was stored."""
    record = spark.read.schema("settings string").json(os.path.join(path, "meta")).first()
    return StoredModel(path, version, json.loads(record["settings"]), PipelineModel.load(os.path.join(path, "model")))


def fit_once(spark: SparkSession, sf_dir: str, name: str, settings: dict,
             fit: Callable[[dict], PipelineModel]) -> StoredModel:
    """The stored model of these inputs and settings; ``fit(settings)`` runs only if there is none."""
    version = model_version(spark, sf_dir, settings)
    path = scratch_path(spark, f"model_{name}_{version}")

    def write(at: str) -> None:
        fit(settings).write().overwrite().save(os.path.join(at, "model"))
        record = spark.createDataFrame([(json.dumps(settings, sort_keys=True),)], "settings string")
        record.coalesce(1).write.mode("overwrite").json(os.path.join(at, "meta"))

    land_at(spark, path, write)
    key = (spark.sparkContext.applicationId, path)
    if key not in _LOADED:
        _LOADED[key] = load_model(spark, path, version)
    return _LOADED[key]
