"""Work per row and per file of the CSV conversion and the forest fit, on rows made here."""

from pyspark.sql import functions as F


def _drop(spark, folder, rows=300_000):
    """One CSV file of more than ``SMALL_FILE`` bytes; every 97th delay is no number."""
    df = spark.range(0, rows, 1, 1).select(
        F.lit("2015-03-04").alias("FL_DATE"), F.concat(F.lit("A"), F.col("id") % 7).alias("ORIGIN"),
        F.lit("B").alias("DEST"), F.when(F.col("id") % 97 == 0, "n/a").otherwise("5").alias("DEP_DELAY"),
        F.when(F.col("id") % 101 != 0, "12.5").alias("ARR_DELAY"), F.repeat(F.lit("x"), 20).alias("note"))
    df.write.option("header", True).csv(folder)


def test_first_line_of_a_large_file_without_python(spark, tmp_path, monkeypatch):
    from pyspark.sql import DataFrame
    from tarmac.sources import files
    folder = str(tmp_path / "drop")
    _drop(spark, folder)

    def passed(*_):
        raise AssertionError("every line of the file goes through Python")

    for kind in {DataFrame, type(spark.range(1))}:
        monkeypatch.setattr(kind, "mapInArrow", passed)
    monkeypatch.setattr(files, "SMALL_FILE", 1 << 20)
    (file, line), = files._first_lines(spark, [folder])
    assert file.endswith(".csv") and line == "FL_DATE,ORIGIN,DEST,DEP_DELAY,ARR_DELAY,note"


def test_first_lines_of_split_files(spark, tmp_path, monkeypatch):
    """Only the split at byte 0 of a file gives its first line."""
    from tarmac.sources import files
    folder = str(tmp_path / "drop")
    spark.range(0, 4000, 1, 2).select(F.format_string("row %05d", "id").alias("only")) \
        .write.option("header", True).csv(folder)
    monkeypatch.setattr(files, "SMALL_FILE", 1)
    split = files._split_files

    def tiny(s):
        out = split(s)
        out.conf.set("spark.sql.files.maxPartitionBytes", "2000")
        return out

    monkeypatch.setattr(files, "_split_files", tiny)
    lines = files._first_lines(spark, [folder])
    assert [line for _, line in lines] == ["only", "only"] and len({f for f, _ in lines}) == 2


def test_conversion_casts_each_text_once(spark, tmp_path, monkeypatch):
    from pyspark.sql import Column
    from pyspark.sql.types import StringType
    from tarmac.sources import files
    from tarmac.sources.convert import convert_csv
    folder, table = str(tmp_path / "drop"), str(tmp_path / "table")
    _drop(spark, folder, 970)
    casts, kind = [], type(F.col("x"))
    real = kind.try_cast
    monkeypatch.setattr(kind, "try_cast", lambda self, t: casts.append(t) or real(self, t))
    assert issubclass(kind, Column)
    report = convert_csv(spark, "flights", folder, table, quarantine=True)
    assert len([t for t in casts if not isinstance(t, StringType)]) == 3  # FL_DATE, DEP_DELAY, ARR_DELAY
    assert (report["rows"], report["kept"], report["quarantined"], report["DEP_DELAY"]) == (970, 960, 10, 10)
    bad = files.read_quarantine(spark, table).collect()
    assert {(r["column"], r["text"], r["reason"]) for r in bad} == {("DEP_DELAY", "n/a", "not double")}
    assert all('"note":"xxxxxxxxxxxxxxxxxxxx"' in r["row"] and files.TYPED not in r["row"] for r in bad)
    kept = files.read_flights(spark, table, "parquet")
    assert kept.where("ARR_DELAY = 12.5 and DEP_DELAY = 5").count() == 951
    assert not [c for c in spark.read.parquet(table).columns if c.startswith(files.TYPED)]


def test_forest_keeps_the_nodes_of_its_rows(spark):
    """The splits are those of a fit that searches every row's node from the roots."""
    from pyspark.ml import Pipeline
    from tarmac.operators import features as ft
    from tarmac.plans import forest, models
    i = F.col("id")
    flights = spark.range(0, 600, 1, 1).select(
        F.date_add(F.lit("2015-01-01").cast("date"), (i % 365).cast("int")).alias("FL_DATE"),
        F.concat(F.lit("C"), i % 5).alias("OP_CARRIER"), F.concat(F.lit("A"), i % 7).alias("ORIGIN"),
        F.concat(F.lit("B"), i % 11).alias("DEST"), (i % 24).cast("int").alias("CRS_DEP_TIME"),
        (i % 13 * 100).cast("double").alias("DISTANCE"), (i * 37 % 101).cast("double").alias("DEP_DELAY"))
    got = models.train_delay_rf(flights, sample_fraction=1.0, num_trees=3, max_depth=4).pipeline.stages
    rf = got[-1]
    assert rf.getCacheNodeIds()
    train, _ = ft.stored_split(ft.rf_features(models._drawn(flights, 1.0, ft.FLIGHT_KEY, 42),
                                              keep=(models.IN_TRAIN,)), models.IN_TRAIN)
    plain = models.RandomForestRegressor(
        featuresCol="features", labelCol="DEP_DELAY", numTrees=3, maxDepth=4, maxBins=rf.getMaxBins(),
        minInstancesPerNode=10, featureSubsetStrategy="auto", seed=42, cacheNodeIds=False)
    other = Pipeline(stages=[*got[:-1], plain]).fit(train).stages[-1]
    nodes = [sorted(forest.node_table(m).toPandas().astype(str).itertuples(index=False)) for m in (rf, other)]
    assert len(nodes[0]) > 9 and nodes[0] == nodes[1]


def test_model_sample_is_read_by_all_cores(spark, monkeypatch):
    """Rows of one writing task reach the passes of a fit in even tasks, each row once."""
    from tarmac.operators import features as ft
    monkeypatch.setattr(ft, "SAMPLE_FILE_ROWS", 1000, raising=False)
    rows = spark.range(0, 40_000, 1, 1).select("id", (F.col("id") % 5 > 0).alias("t"))
    train, test = ft.stored_split(rows, "t")
    sizes = [r["count"] for r in train.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) >= spark.sparkContext.defaultParallelism
    assert max(sizes) <= 1.5 * 32_000 / spark.sparkContext.defaultParallelism
    assert {r.id for r in train.collect()} == {i for i in range(40_000) if i % 5}
    assert train.count() == 32_000 and test.count() == 8_000
