"""Node tables against the fitted models they come from, and key samples."""

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from tarmac.operators import features as ft
from tarmac.plans import forest

SF = "/root/testdata/sf0.001"
INPUTS = ["idx", "DISTANCE", "month", "dep_hour"]


@pytest.fixture(scope="module")
def rows(spark):
    from tarmac.sources import testviews as tv
    return ft.delay_base(tv.flights(spark, SF), keep=("ROW_KEY",))


@pytest.mark.parametrize("kind, settings", [
    (RandomForestRegressor, {"numTrees": 5, "maxDepth": 4}), (GBTRegressor, {"maxIter": 4, "maxDepth": 3, "stepSize": 0.3})])
def test_nodes_score_like_the_model(rows, kind, settings):
    learner = kind(featuresCol="features", labelCol="DEP_DELAY", maxBins=64, seed=1, **settings)
    fitted = Pipeline(stages=[
        StringIndexer(inputCol="OP_CARRIER", outputCol="idx", handleInvalid="keep"),
        VectorAssembler(inputCols=INPUTS, outputCol="features", handleInvalid="keep"), learner]).fit(rows)
    model = fitted.stages[-1]
    nodes = forest.node_table(model)
    assert nodes.where("categories is not null").count() > 0 and nodes.where("threshold is not null").count() > 0
    assert nodes.count() == model.totalNumNodes
    scored = fitted.transform(rows).withColumnRenamed("prediction", "want").withColumn("v", vector_to_array("features"))
    got = forest.score(scored, nodes, "v")
    plan = got._jdf.queryExecution().executedPlan().toString()
    top = plan.split("Subquery")[0]
    assert "Python" not in top and "Join" not in top and "Exchange" not in top.split("Scan")[0], plan
    assert got.where(F.abs(F.col("prediction") - F.col("want")) > 1e-9).count() == 0 and got.count() == rows.count()
    table = forest.importances(nodes, INPUTS, per_tree=kind is RandomForestRegressor).collect()
    want = dict(zip(INPUTS, model.featureImportances.toArray().tolist(), strict=True))
    assert {r.feature: round(r.importance, 9) for r in table} == {n: round(v, 9) for n, v in want.items()}
    assert [r.importance for r in table] == sorted((r.importance for r in table), reverse=True)


def test_literal_forest(spark):
    trees = [(1.0, {0: ("x", 1.0, 1, 2, 3.0), 1: 10.0, 2: ("y", {2, 5}, 3, 4, 1.0), 3: 20.0, 4: 30.0}),
             (0.5, {0: 4.0})]
    nodes = forest.forest_from_rows(spark, trees, ("x", "y"))
    data = spark.createDataFrame([(1, 1.0, 0.0), (2, 2.0, 5.0), (3, 2.0, 1.0), (4, None, None), (5, float("nan"), 2.0)],
                                 "id int, x double, y double")
    got = {r.id: r.prediction for r in forest.score(data, nodes, ["x", "y"]).collect()}
    assert got == {1: 12.0, 2: 22.0, 3: 32.0, 4: 32.0, 5: 22.0}
    visits = {(r.tree, r.node): r.visits for r in forest.with_visits(data, nodes, ["x", "y"]).collect()}
    assert visits == {(0, 0): 5, (0, 1): 1, (0, 2): 4, (0, 3): 2, (0, 4): 2, (1, 0): 5}
    table = forest.importances(forest.with_visits(data, nodes, ["x", "y"]), ("x", "y", "z")).collect()
    assert [(r.feature, round(r.importance, 6)) for r in table] == [("x", 0.789474), ("y", 0.210526), ("z", 0.0)]
    assert forest.score(data.limit(0), nodes, ["x", "y"]).count() == 0


def test_key_samples_do_not_depend_on_partitions(spark):
    from tarmac.plans.catalog import queries
    rows = spark.range(20_000).withColumn("k", F.when(F.col("id") % 9 > 0, F.col("id") % 7000))
    drawn = [{r.id for r in ft.sample_by_key(rows.repartition(n), 0.3, ("k",)).collect()} for n in (2, 7)]
    assert drawn[0] == drawn[1] and 5200 < len(drawn[0]) < 6800
    assert {r.id for r in ft.sample_by_key(rows, 0.1, ("k",)).collect()} < drawn[0]
    assert ft.sample_by_key(rows, 1.0, ("k",)).count() == 20_000 and ft.sample_by_key(rows, 0.0, ("k",)).count() == 0
    train = ft.sample_by_key(rows, 0.3, ("k",)).where(ft.in_share(("k",), 0.8, draw=1)).count() / len(drawn[0])
    assert 0.75 < train < 0.85
    seeds = [{r.id for r in ft.sample_by_key(rows, 0.3, ("k",), seed).collect()} for seed in (1, 2)]
    assert seeds[0] != seeds[1]
    assert queries()["sampled_rows"](spark, SF).groupBy("model").count().count() == 3


def test_refits_are_equal(spark):
    from tarmac.plans.models import train_fare_gbt
    from tarmac.operators.fares import repair_fare_scale
    from tarmac.sources import testviews as tv
    fares = repair_fare_scale(tv.fares(spark, SF))
    metrics = [tuple(train_fare_gbt(fares.repartition(n), max_iter=2, max_depth=2, sample_key=("ROW_KEY",))
                     .predictions.agg(F.count("*"), F.sum("ITIN_FARE").cast("decimal(20,4)")).first()) for n in (2, 7)]
    assert metrics[0] == metrics[1]
