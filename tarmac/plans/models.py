"""Delay and fare regressors on ``pyspark.ml`` (ML-1..11, SNK-3).

Training is distributed by Spark ML: ``StringIndexer`` counts categories with
one aggregation, tree learners compute split statistics per level across
executors. Evaluation is a single aggregate pass (rmse, mae and r2 together)
instead of three evaluator jobs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.operators import features as ft
from tarmac.plans.sinks import save_model
from tarmac.session import ensure_checkpoint_dir


def regression_metrics(preds: DataFrame, label: str, prediction: str = "prediction",
                       digits=(2, 2, 4)) -> DataFrame:
    """ML-8: one-row rmse, mae, r2 in one aggregate pass.

    r2 = 1 - SSE / (n * var_pop(label)), the definition RegressionEvaluator uses.
    """
    err = F.col(label) - F.col(prediction)
    agg = preds.agg(F.avg(err * err).alias("_mse"), F.avg(F.abs(err)).alias("_mae"),
                    F.sum(err * err).alias("_sse"), F.var_pop(label).alias("_var"),
                    F.count(F.lit(1)).alias("_n"))
    r2 = F.lit(1.0) - F.try_divide(F.col("_sse"), F.col("_var") * F.col("_n"))
    return agg.select(F.round(F.sqrt("_mse"), digits[0]).alias("rmse"),
                      F.round("_mae", digits[1]).alias("mae"),
                      F.round(r2, digits[2]).alias("r2"))


def importance_table(spark, names: list[str], model) -> DataFrame:
    """ML-9: feature importances, largest first (one row per feature)."""
    values = model.featureImportances.toArray().tolist()
    rows = [(n, float(v)) for n, v in zip(names, values)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature")


@dataclass
class TrainedModel:
    pipeline: PipelineModel
    metrics: DataFrame        # one row: model, target, rmse, mae, r2, hyper-parameters
    importances: DataFrame | None
    predictions: DataFrame

    def save(self, path: str) -> None:
        """SNK-3: overwrite the fitted pipeline at ``path``."""
        save_model(self.pipeline, path)


def metrics_record(metrics: DataFrame, model: str, target: str, params: dict) -> DataFrame:
    """ML-10: one row: model, target, rmse, mae, r2, then the hyper-parameters."""
    extra = [F.lit(v).alias(k) for k, v in params.items()]
    return metrics.select(F.lit(model).alias("model"), F.lit(target).alias("target"),
                          "rmse", "mae", "r2", *extra)


#: Flag column of the rows to train with, and their part.
IN_TRAIN, TRAIN_FRACTION = "in_train", 0.8


def _drawn(df: DataFrame, fraction: float, keys: tuple[str, ...], seed: int) -> DataFrame:
    """The key-hash sample with its train flag."""
    return ft.sample_by_key(df, fraction, keys, seed).withColumn(
        IN_TRAIN, F.coalesce(ft.in_share(keys, TRAIN_FRACTION, seed, draw=1), F.lit(False)))


# Model inputs, in the order the published models and importances use.
RF_INPUTS = ["carrier_idx", "origin_idx", "dest_idx", "month", "day_of_week", "is_weekend",
             "is_summer", "is_holiday_season", "is_winter", "DISTANCE"]
RF_NAMES = ["carrier", "origin", "destination", "month", "day_of_week", "is_weekend",
            "is_summer", "is_holiday_season", "is_winter", "distance"]


def train_delay_rf(flights: DataFrame, sample_fraction: float = 0.40, seed: int = 42,
                   num_trees: int = 50, max_depth: int = 8, min_instances: int = 10,
                   sample_key: tuple[str, ...] = ft.FLIGHT_KEY) -> TrainedModel:
    """ML-4: RandomForest on the baseline delay frame (baseline model).

    Sample and split follow the hash of ``sample_key``, so reruns fit the same rows.
    """
    # Tree learners checkpoint to the shared folder (checkpointInterval) when
    # one is set; set it before fitting.
    ensure_checkpoint_dir(flights.sparkSession)
    drawn = _drawn(flights, sample_fraction, sample_key, seed)
    train, test = ft.stored_split(ft.rf_features(drawn, keep=(IN_TRAIN,)), IN_TRAIN)
    card = ft.category_cardinality(train).first()
    max_bins = int(card["max_bins"])
    # one indexer, one counting pass for all three category columns
    stages = [StringIndexer(inputCols=["OP_CARRIER", "ORIGIN", "DEST"],
                            outputCols=["carrier_idx", "origin_idx", "dest_idx"],
                            handleInvalid="keep")]
    stages.append(VectorAssembler(inputCols=RF_INPUTS, outputCol="features",
                                  handleInvalid="keep"))
    stages.append(RandomForestRegressor(featuresCol="features", labelCol="DEP_DELAY",
                                        numTrees=num_trees, maxDepth=max_depth,
                                        maxBins=max_bins, minInstancesPerNode=min_instances,
                                        featureSubsetStrategy="auto", seed=seed,
                                        # a row's node in each tree is kept, not searched from
                                        # the roots at every level; the splits are the same
                                        cacheNodeIds=True))
    fitted = Pipeline(stages=stages).fit(train)
    preds = fitted.transform(test)
    metrics = metrics_record(regression_metrics(preds, "DEP_DELAY"), "RandomForestRegressor",
                           "DEP_DELAY", {"num_trees": num_trees, "max_depth": max_depth,
                                         "max_bins": max_bins})
    imp = importance_table(flights.sparkSession, RF_NAMES, fitted.stages[-1])
    return TrainedModel(fitted, metrics, imp, preds)


# Inputs of the fare model.
FARE_INPUTS = ["origin_idx", "QUARTER", "YEAR", "DISTANCE", "yield_per_mile", "is_peak_quarter"]


def train_fare_gbt(fares: DataFrame, sample_fraction: float = 0.40, seed: int = 42,
                   max_iter: int = 50, max_depth: int = 6, step_size: float = 0.1,
                   sample_key: tuple[str, ...] = ft.FARE_KEY) -> TrainedModel:
    """ML-5: GBT on the fare frame (expects batch-repaired fares)."""
    # GBT checkpoints its running predictions every checkpointInterval (10)
    # iterations into the shared folder, which cuts lineage across iterations.
    ensure_checkpoint_dir(fares.sparkSession)
    drawn = _drawn(fares, sample_fraction, sample_key, seed)
    train, test = ft.stored_split(ft.fare_features(drawn, keep=(IN_TRAIN,)), IN_TRAIN)
    max_bins = int(ft.fare_cardinality(train).first()["max_bins"])
    stages = [StringIndexer(inputCol="ORIGIN", outputCol="origin_idx", handleInvalid="keep"),
              VectorAssembler(inputCols=FARE_INPUTS, outputCol="features", handleInvalid="keep"),
              GBTRegressor(featuresCol="features", labelCol="ITIN_FARE", maxIter=max_iter,
                           maxDepth=max_depth, maxBins=max_bins, stepSize=step_size, seed=seed)]
    fitted = Pipeline(stages=stages).fit(train)
    preds = fitted.transform(test)
    metrics = metrics_record(regression_metrics(preds, "ITIN_FARE"), "GBTRegressor", "ITIN_FARE",
                           {"max_iter": max_iter, "max_depth": max_depth, "max_bins": max_bins})
    return TrainedModel(fitted, metrics, None, preds)


# Inputs of the improved delay model.
DELAY_V2_INPUTS = ["carrier_idx", "month", "day_of_week", "dep_hour", "is_weekend", "is_summer",
                   "is_holiday_season", "is_winter", "DISTANCE", "CRS_ELAPSED_TIME",
                   "weather_delay_signal", *ft.HISTORY_COLUMNS]


def train_delay_gbt(flights: DataFrame, sample_fraction: float = 0.20, seed: int = 42,
                    max_iter: int = 30, max_depth: int = 6, max_bins: int = 64,
                    step_size: float = 0.08, subsampling_rate: float = 0.8,
                    exclude_leaky: bool = False, split_key: str | None = None,
                    sample_key: tuple[str, ...] = ft.FLIGHT_KEY) -> TrainedModel:
    """ML-6: improved GBT delay model with history (target-mean) features.

    ``exclude_leaky`` drops the same-flight weather delay, which is not known
    before departure; the reference keeps it. ``split_key`` splits by the last digit of
    that column instead of the hash of ``sample_key``; the sample is by the hash either way.
    """
    # GBT checkpoints its running predictions every checkpointInterval (10)
    # iterations into the shared folder, which cuts lineage across iterations.
    ensure_checkpoint_dir(flights.sparkSession)
    drawn = _drawn(flights, sample_fraction, sample_key, seed)
    if split_key:
        drawn = drawn.withColumn(IN_TRAIN, F.pmod(F.col(split_key), F.lit(10)) < 8)
    train, test = ft.stored_split(ft.delay_base(drawn, keep=(IN_TRAIN,)), IN_TRAIN)
    history = ft.fit_history(train)
    train_x, test_x = history.transform(train), history.transform(test)
    inputs = [c for c in DELAY_V2_INPUTS if not (exclude_leaky and c == "weather_delay_signal")]
    stages = [StringIndexer(inputCol="OP_CARRIER", outputCol="carrier_idx", handleInvalid="keep"),
              VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="keep"),
              GBTRegressor(featuresCol="features", labelCol="DEP_DELAY", maxIter=max_iter,
                           maxDepth=max_depth, maxBins=max_bins, stepSize=step_size,
                           subsamplingRate=subsampling_rate, seed=seed)]
    fitted = Pipeline(stages=stages).fit(train_x)
    preds = fitted.transform(test_x)
    metrics = metrics_record(regression_metrics(preds, "DEP_DELAY"), "GBTRegressor", "DEP_DELAY",
                           {"sample_fraction": sample_fraction, "max_iter": max_iter,
                            "max_depth": max_depth, "max_bins": max_bins,
                            "feature_count": len(inputs)})
    imp = importance_table(flights.sparkSession, inputs, fitted.stages[-1])
    return TrainedModel(fitted, metrics, imp, preds)


def model_comparison(baseline: DataFrame | None, improved: DataFrame) -> DataFrame:
    """ML-11: one record ``baseline, improved_v2, delta`` (improved - baseline per metric).

    Without a baseline the record has ``improved_v2`` alone. Both inputs are one-row
    metric tables, so the pairing is a one-row join.
    """
    new = improved.select(F.lit(1).alias("_k"), F.struct(*improved.columns).alias("improved_v2"))
    if baseline is None:
        return new.drop("_k")
    old = baseline.select(F.lit(1).alias("_k"), F.struct(*baseline.columns).alias("baseline"))
    change = lambda m, digits: F.round(
        F.col(f"improved_v2.{m}") - F.col(f"baseline.{m}"), digits).alias(f"{m}_change")
    return new.join(old, on="_k").select(
        "baseline", "improved_v2",
        F.struct(change("rmse", 2), change("mae", 2), change("r2", 4)).alias("delta"))
