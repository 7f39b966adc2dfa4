"""Model pipeline, evaluator equivalence, bundle and sinks."""

import json
import os

from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def test_regression_metrics_equal_evaluator(spark):
    from pyspark.ml.evaluation import RegressionEvaluator
    from tarmac.plans.models import regression_metrics
    rows = [(float(i % 17), float((i * 7) % 13)) for i in range(200)]
    df = spark.createDataFrame(rows, "y double, prediction double")
    ours = regression_metrics(df, "y", digits=(9, 9, 9)).first()
    for metric in ("rmse", "mae", "r2"):
        ref = RegressionEvaluator(labelCol="y", metricName=metric).evaluate(df)
        assert abs(getattr(ours, metric) - ref) < 1e-8


def test_delay_gbt_small(spark):
    from tarmac.plans import models
    from tarmac.sources import testviews as tv
    trained = models.train_delay_gbt(tv.flights(spark, SF), sample_fraction=1.0, max_iter=3,
                                     max_depth=3, split_key=None)
    m = trained.metrics.first()
    assert m.model == "GBTRegressor" and m.feature_count == 18
    assert m.rmse > 0 and m.mae > 0
    imp = trained.importances.collect()
    assert len(imp) == 18 and abs(sum(r.importance for r in imp) - 1.0) < 1e-6


def test_rf_save_load_predictions(spark, tmp_path):
    from pyspark.ml import PipelineModel
    from tarmac.plans import models
    from tarmac.sources import testviews as tv
    trained = models.train_delay_rf(tv.flights(spark, SF), sample_fraction=1.0, num_trees=3,
                                    max_depth=3)
    path = str(tmp_path / "rf")
    trained.save(path)
    again = PipelineModel.load(path)
    test = trained.predictions.drop("prediction", "features", "carrier_idx", "origin_idx",
                                    "dest_idx")
    a = sorted(r.prediction for r in trained.pipeline.transform(test).collect())
    b = sorted(r.prediction for r in again.transform(test).collect())
    assert a == b


def test_model_comparison(spark):
    from tarmac.plans.models import model_comparison
    b = spark.createDataFrame([(36.73, 18.08, 0.0175)], "rmse double, mae double, r2 double")
    i = spark.createDataFrame([(26.76, 14.92, 0.1132)], "rmse double, mae double, r2 double")
    r = model_comparison(b, i).first()
    assert r.baseline.rmse == 36.73 and r.improved_v2.rmse == 26.76
    r = r.delta
    assert (r.rmse_change, r.mae_change, r.r2_change) == (-9.97, -3.16, 0.0957)
    alone = model_comparison(None, i)
    assert alone.columns == ["improved_v2"] and alone.first().improved_v2.r2 == 0.1132


def test_results_bundle_writes_one_document(spark, tmp_path):
    from tarmac.plans.batch_reports import build_reports, bundle_sections_from
    from tarmac.plans.bundle import SECTIONS, results_bundle
    from tarmac.plans.catalog import FIX
    from tarmac.plans.sinks import save_record
    from tarmac.sources import dimensions, testviews as tv
    carriers = dimensions.carriers(spark)
    reports = build_reports(spark, tv.flights(spark, SF), tv.fares(spark, SF), tv.weather(spark, SF),
                            tv.airports(spark, SF), carriers, FIX)
    sections = bundle_sections_from(reports, carriers)
    assert ("weather_by_station", "seasonal_weather") not in reports._made
    bundle = results_bundle(spark, sections)
    assert bundle.count() == 1
    out = str(tmp_path / "bundle")
    save_record(bundle, out)
    files = [f for f in os.listdir(out) if f.endswith(".json")]
    assert len(files) == 1
    doc = json.loads(open(os.path.join(out, files[0])).readline())
    assert set(SECTIONS) <= set(doc) and doc["meta"]["total_airports"] == len(doc["airports"])
    assert doc["carrier_names"]["DL"] == "Delta Air Lines" and len(doc["carrier_names"]) == 16
    for name in SECTIONS:
        if name != "carrier_names":
            key = sections[name].columns[0]
            assert [r.get(key) for r in doc[name]] == [r[key] for r in sections[name].collect()]


def test_save_table_csv_and_parquet(spark, tmp_path):
    from tarmac.plans.sinks import save_table
    df = spark.range(5).withColumn("y", F.col("id") * 2)
    save_table(df, str(tmp_path / "p"))
    save_table(df, str(tmp_path / "c"), fmt="csv")
    assert spark.read.parquet(str(tmp_path / "p")).count() == 5
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).count() == 5


def test_published_records(spark):
    from tarmac.operators.recommend import ensemble_summary_record, thresholds_record
    e = ensemble_summary_record(spark).first()
    assert e.weights["delay_score"] == 0.5 and e.recommendation_logic["BUY"].startswith(">=") is False
    t = thresholds_record(spark).first()
    assert t.cheap_fare_threshold == 300.0 and "AVOID" in t.recommendation_logic
