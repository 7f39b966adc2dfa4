"""The command line runs the report pipeline end to end on parquet inputs."""

import os

SF = "/root/testdata/sf0.001"


def test_cli_reports(spark, tmp_path):
    from tarmac.cli import main
    from tarmac.sources import testviews as tv
    wh = tmp_path / "wh"
    for name in ("flights", "fares", "weather"):
        tv.view(spark, SF, name).drop("ROW_KEY").write.parquet(str(wh / name))
    out = tmp_path / "processed"
    main(["reports", "--flights", str(wh / "flights"), "--fares", str(wh / "fares"),
          "--weather", str(wh / "weather"), "--out", str(out), "--output-format", "csv"])
    written = set(os.listdir(out))
    assert {"airport_traffic_top", "route_lookup", "results_bundle", "fare_by_year",
            "recommendation_thresholds", "ensemble_model_summary"} <= written
    top = spark.read.option("header", True).csv(str(out / "airport_traffic_top"))
    assert top.count() == 25


def test_cli_models(spark, tmp_path):
    from tarmac.cli import main
    from tarmac.sources import testviews as tv
    wh = tmp_path / "wh"
    for name in ("flights", "fares"):
        tv.view(spark, SF, name).drop("ROW_KEY").write.parquet(str(wh / name))
    processed, models = tmp_path / "processed", tmp_path / "models"
    main(["models", "--flights", str(wh / "flights"), "--fares", str(wh / "fares"),
          "--out", str(models), "--processed", str(processed)])
    assert {"delay_rf_model", "fare_gbt_model", "delay_rf_model_v2"} <= set(os.listdir(models))
    m = spark.read.json(str(processed / "delay_model_metrics_v2")).first()
    assert m.feature_count == 18 and m.model_path.endswith("delay_rf_model_v2")
    cmp = spark.read.json(str(processed / "delay_model_comparison_v2")).first()
    assert cmp.delta.rmse_change is not None and cmp.baseline.rmse > 0
    from tarmac.session import ensure_checkpoint_dir
    assert not os.path.exists(os.path.join(ensure_checkpoint_dir(spark).removeprefix("file:"), "tables"))
