"""Fitted tree ensembles as a table of nodes, scored by a plan (ML-4..7, ML-9).

One row a node: a saved random forest or boosted ensemble read back as a plain table, which
any engine can score, diff or store with the reports. Scoring walks all trees of a
row inside one JVM expression over an array of nodes; the table is bounded by trees x
2**(depth + 1) rows, measured, and reaches the rows as one value (a scalar subquery), so
scoring neither joins, shuffles nor multiplies the rows and calls no Python.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.functions.exprs import c
from tarmac.operators.joins import scratch_path

NODES = ("tree int, weight double, node int, prediction double, gain double, visits double, feature int, "
         "threshold double, categories array<double>, left int, right int")
#: Nodes that may be sent to every task at once; about 100 bytes each. The models here have 26,000 at most.
MAX_NODES = 200_000


def forest_from_rows(spark: SparkSession, trees: Sequence[tuple[float, Mapping]], inputs: Sequence[str]) -> DataFrame:
    """A node table from literal trees: (weight, {node: leaf prediction or split}).

    A split is (feature, threshold or set of left categories, left, right, gain); nodes are
    numbered from 0, the root, without gaps.
    """
    rows = []
    for t, (weight, nodes) in enumerate(trees):
        for i, node in sorted(nodes.items()):
            if isinstance(node, tuple):
                feature, cut, left, right, gain = node
                cats = sorted(map(float, cut)) if isinstance(cut, set) else None
                rows.append((t, weight, i, 0.0, gain, None, list(inputs).index(feature),
                             None if cats is not None else float(cut), cats, left, right))
            else:
                rows.append((t, weight, i, float(node), None, None, -1, None, None, -1, -1))
    return spark.createDataFrame(rows, NODES)


def node_table(model) -> DataFrame:
    """The nodes of a fitted forest or boosted ensemble, from its saved form.

    ``weight`` is a tree's part of the prediction: equal parts for a forest, step sizes for
    boosting. ``visits`` counts the training rows of a node, ``gain`` its split's.
    """
    spark = SparkSession.getActiveSession()
    path = scratch_path(spark, "forest")
    model.write().save(path)
    saved = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*")
    split = F.col("split")
    plain = split["numCategories"] == -1
    values = split["leftCategoriesOrThreshold"]
    inner = F.col("leftChild") >= 0
    weights = spark.createDataFrame([(i, float(w)) for i, w in enumerate(model.treeWeights)], "tree int, weight double")
    parts = len(model.treeWeights) if "Forest" in type(model).__name__ else 1
    return saved.join(F.broadcast(weights), F.col("treeID") == F.col("tree")).select(
        "tree", (F.col("weight") / parts).alias("weight"), F.col("id").alias("node"), "prediction",
        F.when(inner, F.col("gain")).alias("gain"), F.get("impurityStats", F.lit(0)).alias("visits"),
        F.when(inner, split["featureIndex"]).otherwise(-1).alias("feature"),
        F.when(inner & plain, F.get(values, F.lit(0))).alias("threshold"),
        F.when(inner & ~plain, values).alias("categories"),
        F.col("leftChild").alias("left"), F.col("rightChild").alias("right"))


def _packed(nodes: DataFrame) -> DataFrame:
    """One row: ``trees``, array of (weight, nodes by number), behind a check of its size."""
    n = nodes.count()
    if n > MAX_NODES:
        raise ValueError(f"{n} nodes are more than the {MAX_NODES} that may be sent to every task")
    fields = [f.name for f in nodes.schema if f.name not in ("tree", "weight", "visits", "gain")]
    tree = nodes.groupBy("tree", "weight").agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("nodes"))
    return tree.agg(F.array_sort(F.collect_list(F.struct("tree", "weight", "nodes"))).alias("trees"))


def _goes_left(node: Column, values: Column) -> Column:
    value = F.get(values, node["feature"])
    return F.when(node["categories"].isNull(), value <= node["threshold"]).otherwise(
        F.array_contains(node["categories"], value))


def _path(tree: Column, values: Column, depth: int) -> Column:
    """Node numbers from the root to the leaf that a row reaches (the leaf repeated at the end)."""
    def step(at: Column, _: Column) -> Column:
        node = F.get(tree["nodes"], F.element_at(at, -1))
        return F.concat(at, F.array(F.when(node["feature"] < 0, node["node"]).when(
            _goes_left(node, values), node["left"]).otherwise(node["right"])))

    return F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.array(F.lit(0)), step)


def _leaf(tree: Column, values: Column, depth: int) -> Column:
    def step(at: Column, _: Column) -> Column:
        node = F.get(tree["nodes"], at)
        return F.when(node["feature"] < 0, at).when(_goes_left(node, values), node["left"]).otherwise(node["right"])

    return F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.lit(0), step)


def _depth(nodes: DataFrame) -> int:
    """Levels below the root of the deepest tree; the links are as bounded as the packed table."""
    links = {(r.tree, r.node): (r.left, r.right)
             for r in nodes.where("feature >= 0").select("tree", "node", "left", "right").collect()}
    level, depth = {key for key in links if key[1] == 0}, 0
    while level:
        depth += 1
        level = {(t, child) for t, n in level for child in links[t, n]} & links.keys()
    return depth


def _beside(rows: DataFrame, packed: DataFrame) -> DataFrame:
    """``rows`` with the packed trees."""
    return rows.withColumn("trees", packed.scalar())


def score(rows: DataFrame, nodes: DataFrame, inputs: Sequence[str] | str) -> DataFrame:
    """``rows`` with ``prediction``: the weighted sum of the leaves that a row reaches.

    ``inputs``: the feature columns in the order of the nodes' feature numbers, or one array
    column. A null or NaN value goes right, as larger values do.
    """
    packed = _packed(nodes)
    depth = max(1, _depth(nodes))
    values = F.col(inputs) if isinstance(inputs, str) else F.array(*[c(i).cast("double") for i in inputs])
    leaves = F.transform("trees", lambda t: t["weight"] * F.get(t["nodes"], _leaf(t, F.col("_v"), depth))["prediction"])
    total = F.aggregate(leaves, F.lit(0.0), lambda a, b: a + b)
    return _beside(rows.withColumn("_v", values), packed).withColumn("prediction", total).drop("trees", "_v")


def with_visits(rows: DataFrame, nodes: DataFrame, inputs: Sequence[str]) -> DataFrame:
    """``nodes`` with ``visits`` counted anew: the ``rows`` that pass each node."""
    packed = _packed(nodes)
    depth = max(1, _depth(nodes))
    values = F.array(*[c(i).cast("double") for i in inputs])
    paths = F.flatten(F.transform("trees", lambda t: F.transform(
        F.array_distinct(_path(t, F.col("_v"), depth)), lambda n: F.struct(t["tree"].alias("tree"), n.alias("node")))))
    seen = _beside(rows.withColumn("_v", values), packed).select(F.explode(paths).alias("p")) \
        .groupBy("p.tree", "p.node").agg(F.count(F.lit(1)).cast("double").alias("visits"))
    return nodes.drop("visits").join(seen, ["tree", "node"], "left").na.fill(0.0, ["visits"]).select(
        *[f.split()[0] for f in NODES.split(", ")])


def importances(nodes: DataFrame, names: Sequence[str], per_tree: bool = True) -> DataFrame:
    """ML-9: ``feature, importance``, largest first: gains weighted by visits, summing to one.

    ``per_tree`` (forests) brings each tree's sum to one first; boosted ensembles add up
    as they are. Features without a split have importance 0.
    """
    gains = nodes.where("feature >= 0").groupBy("tree", "feature").agg(F.sum(c("gain") * c("visits")).alias("g"))
    if per_tree:
        whole = gains.groupBy("tree").agg(F.sum("g").alias("t"))
        gains = gains.join(whole, "tree").select("feature", F.when(c("t") > 0, c("g") / c("t")).alias("g"))
    total = gains.agg(F.sum("g").alias("t"))
    summed = gains.groupBy("feature").agg(F.sum("g").alias("g")).withColumn("_one", F.lit(1)) \
        .join(total.withColumn("_one", F.lit(1)), "_one")
    every = nodes.sparkSession.createDataFrame(list(enumerate(names)), "feature int, name string")
    return every.join(summed, "feature", "left").select(
        c("name").alias("feature"), F.coalesce(F.try_divide(c("g"), c("t")), F.lit(0.0)).alias("importance")) \
        .orderBy(F.desc("importance"), "feature")
