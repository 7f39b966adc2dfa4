"""Registered model keys (rows-only checks: tree learners have no SQL oracle).

Each model is trained once per (session, scale folder) and shared by its
metrics and importance keys. Hyper-parameters and sample fractions are the
reference's.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tarmac.operators import fares as fr
from tarmac.plans import models
from tarmac.sources import testviews as tv

#: The fixture's row key: samples are those of the ``sampled_rows`` query.
KEY = ("ROW_KEY",)
_TRAINED: dict[tuple, models.TrainedModel] = {}


def _trained(spark: SparkSession, sf_dir: str, name: str) -> models.TrainedModel:
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _TRAINED:
        flights = tv.flights(spark, sf_dir)
        if name == "delay_rf":
            _TRAINED[key] = models.train_delay_rf(flights, sample_key=KEY)
        elif name == "fare_gbt":
            _TRAINED[key] = models.train_fare_gbt(
                fr.repair_fare_scale(tv.fares(spark, sf_dir)), sample_key=KEY)
        elif name == "delay_gbt":
            _TRAINED[key] = models.train_delay_gbt(flights, sample_key=KEY)
        else:
            raise KeyError(name)
    return _TRAINED[key]


def delay_model_metrics(spark, d) -> DataFrame:
    return _trained(spark, d, "delay_rf").metrics


def delay_feature_importance(spark, d) -> DataFrame:
    return _trained(spark, d, "delay_rf").importances


def fare_model_metrics(spark, d) -> DataFrame:
    return _trained(spark, d, "fare_gbt").metrics


def delay_model_v2_metrics(spark, d) -> DataFrame:
    return _trained(spark, d, "delay_gbt").metrics


def delay_feature_importance_v2(spark, d) -> DataFrame:
    return _trained(spark, d, "delay_gbt").importances


def model_comparison(spark, d) -> DataFrame:
    base = _trained(spark, d, "delay_rf").metrics
    improved = _trained(spark, d, "delay_gbt").metrics
    return models.model_comparison(base, improved)


def model_queries() -> dict:
    return {
        "delay_model_metrics": delay_model_metrics,
        "delay_feature_importance": delay_feature_importance,
        "fare_model_metrics": fare_model_metrics,
        "delay_model_v2_metrics": delay_model_v2_metrics,
        "delay_feature_importance_v2": delay_feature_importance_v2,
        "model_comparison": model_comparison,
    }
