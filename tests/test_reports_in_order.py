"""Row numbers of sorted frames, saved bundles, route requests, flights with weather."""

import json

import pytest
from pyspark.sql import functions as F

from tarmac.operators import flight_weather as fw
from tarmac.operators.positions import numbered, positions, with_row_numbers
from tarmac.plans import routes

SF = "/root/testdata/sf0.001"


def test_row_numbers_over_partitions(spark):
    rows = spark.range(0, 30_000, numPartitions=9).withColumn("v", F.xxhash64("id") % 100)
    got = with_row_numbers(rows, F.desc("v"), F.asc("id"))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and got.columns == ["id", "v", "position"]
    want = sorted(((r.id, r.v) for r in rows.collect()), key=lambda r: (-r[1], r[0]))
    assert [(r.id, r.v) for r in sorted(got.collect(), key=lambda r: r.position)] == want
    assert sorted(r.position for r in got.collect()) == list(range(1, 30_001))
    assert numbered(rows.limit(0)).count() == 0


def test_positions_of_named_frames(spark):
    a = spark.createDataFrame([("x", 3), (None, 9), ("y", 5)], "k string, n int")
    b = spark.range(500).withColumn("m", F.col("id") % 7)
    got = positions({"a": a.orderBy(F.desc("n")), "b": b.orderBy("m", F.desc("id"))}, {"a": ("k",), "b": ("m", "id")})
    rows = {(r.report, r.position): r.key for r in got.collect()}
    assert [rows["a", i] for i in (1, 2, 3)] == ["null", "y", "x"]
    want = sorted(((i % 7, i) for i in range(500)), key=lambda r: (r[0], -r[1]))
    assert [rows["b", i + 1] for i in range(500)] == [f"{m}|{i}" for m, i in want] and len(rows) == 503


def test_bundle_records_are_json(spark, tmp_path):
    from tarmac.plans.bundle import SECTIONS, bundle_records, results_bundle
    from tarmac.plans.catalog import queries
    from tarmac.plans.sinks import save_record
    carriers = spark.createDataFrame([("ZZ", 'Zed "Air"\\'), ("AA", "American"), (None, "none")], "code string, name string")
    odd = spark.createDataFrame([("é\"\\", None, 2)], "name string, v double, n int")
    sections = {name: odd for name in SECTIONS} | {"carrier_names": carriers}
    bundle = results_bundle(spark, sections)
    save_record(bundle, str(tmp_path / "bundle"))
    rows = {(r.section, r.position): r.record for r in bundle_records(spark, str(tmp_path / "bundle"), bundle.schema).collect()}
    assert json.loads(rows["airports", 1]) == {"name": "é\"\\", "v": 0.0, "n": 2}
    assert json.loads(rows["carrier_names", 2]) == {"code": "ZZ", "name": 'Zed "Air"\\'} and len(rows) == 16
    assert bundle_records(spark, str(tmp_path / "none"), bundle.schema).count() == 0
    for r in queries()["bundle_records"](spark, SF).collect():
        assert json.loads(r.record)


@pytest.fixture(scope="module")
def facts(spark):
    return spark.createDataFrame(
        [("A", "B", None, 5.0, 200.0, "LOW", 0.9, "BUY", 2, "X"), ("B", "A", None, None, None, None, None, None, None, None)],
        "ORIGIN string, DEST string, latest_date date, expected_delay_min double, estimated_fare_usd double, "
        "delay_risk string, ensemble_score double, recommendation string, carriers_on_route long, best_carrier string")


def test_requests_join_stored_routes_in_place(spark, facts, tmp_path):
    from tarmac.sources.files import read_requests
    many = spark.range(3000).select(F.concat(F.lit("O"), F.col("id") % 60).alias("ORIGIN"),
                                    F.concat(F.lit("D"), (F.col("id") / 60).cast("int")).alias("DEST"),
                                    *[F.lit(None).cast(f.dataType).alias(f.name) for f in facts.schema.fields[2:]])
    routes.save_routes(facts.unionByName(many), "routes_test", str(tmp_path / "routes"), buckets=8)
    (tmp_path / "asked.csv").write_text("origin,DEST,travel_date,note\nA,B,2024-05-05,x\nA,B,,\nA,Q,2024-05-06,\n"
                                        ",B,soon,\nA,B,2024-05-05,x\n")
    days = spark.createDataFrame([(1, 11.0), (2, 12.0)], "day_of_week int, avg_dep_delay double")
    asked = read_requests(spark, str(tmp_path / "asked.csv"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        spark.sql("DROP TABLE routes_test")
        known = routes.open_routes(spark, "routes_test", str(tmp_path / "routes"))
        got = routes.answer(asked, known, days)
        rows = got.collect()
        plan = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 << 20))
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
    by = {(r.ORIGIN, r.DEST, str(r.travel_date)): r for r in rows}
    assert len(rows) == 5 and by["A", "B", "2024-05-05"].weekday_avg_delay == 11.0
    assert by["A", "B", "None"].recommendation == "BUY" and by["A", "B", "None"].day_of_week is None
    assert by["A", "Q", "2024-05-06"].recommendation is None and by["A", "Q", "2024-05-06"].weekday_avg_delay == 12.0
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")  # else the plan does not say
    try:
        one = spark.table("routes_test").where("route = 'A>B'")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    assert "SelectedBucketsCount: 1 out of 8" in one


def test_route_command(spark, tmp_path):
    from tarmac.sources import testviews as tv
    from tarmac import cli
    tv.flights(spark, SF).write.parquet(str(tmp_path / "flights"))
    tv.fares(spark, SF).write.parquet(str(tmp_path / "fares"))
    (tmp_path / "asked.csv").write_text("ORIGIN,DEST,travel_date\nFRANCE,CHINA,1996-03-01\nMARS,CHINA,1996-03-02\n")
    base = ["route", "--requests", str(tmp_path / "asked.csv"), "--routes", str(tmp_path / "routes")]
    cli.main([*base, "--out", str(tmp_path / "one"), "--flights", str(tmp_path / "flights"), "--fares", str(tmp_path / "fares")])
    cli.main([*base, "--out", str(tmp_path / "two")])  # from the stored routes
    one, two = (sorted(map(str, spark.read.parquet(str(tmp_path / n)).collect())) for n in ("one", "two"))
    assert one == two and len(one) == 2
    spark.sql("DROP TABLE IF EXISTS tarmac_routes")


def test_moments_merge(spark):
    rows = spark.range(4000).select((F.col("id") % 13).alias("part"), (F.rand(3) * 5 + 1e6).alias("x")) \
        .withColumn("y", F.when(F.rand(4) > 0.1, F.col("x") * 2 + F.rand(5)))
    parts = fw.pair_moments(rows, ["part"], "x", "y")
    whole = fw.correlation(fw.merge_moments(parts, []), "r", [], 9).first().r
    pairs = rows.where("y is not null")
    assert whole == pytest.approx(pairs.corr("x", "y"), abs=1e-6)
    halves = fw.merge_moments(parts.withColumn("half", F.col("part") % 2), ["half"])
    again = fw.correlation(fw.merge_moments(halves, []), "r", [], 9).first().r
    assert again == pytest.approx(whole, abs=1e-8)
    flat = spark.createDataFrame([(1, 2.0, 3.0), (1, 2.0, 4.0)], "part int, x double, y double")
    assert fw.correlation(fw.pair_moments(flat, ["part"], "x", "y"), "r", ["part"]).first().r is None


def test_days_without_weather_or_airport_stay(spark):
    flights = spark.createDataFrame([("A", "2020-01-01", 5.0, None), ("A", "2020-01-01", 7.0, 2.0), ("B", "2020-01-02", None, None),
                                     (None, "2020-01-01", 1.0, 1.0)], "ORIGIN string, d string, DEP_DELAY double, WEATHER_DELAY double") \
        .withColumn("FL_DATE", F.to_date("d"))
    weather = spark.createDataFrame([("s1", "2020-01-01", 1.0), ("s2", "2020-01-01", 3.0), ("s3", "2020-01-02", 9.0)],
                                    "NAME string, d string, PRCP double").withColumn("DATE", F.to_date("d"))
    weather = weather.withColumns({m: F.lit(1.0) for m in ("SNOW", "TMAX", "TMIN", "AWND")})
    stations = spark.createDataFrame([("s1", "A"), ("s2", "A"), ("s9", "B")], "NAME string, airport string")
    daily = fw.flight_weather_daily(flights, weather, stations)
    got = {(r.airport, str(r.day)): (r.flights, r.dep_delay, r.PRCP, r.station_days) for r in daily.collect()}
    assert got == {("A", "2020-01-01"): (2, 6.0, 2.0, 2), ("B", "2020-01-02"): (1, None, None, None),
                   (None, "2020-01-01"): (1, 1.0, None, None)}
    assert {r.airport for r in fw.weather_delay_corr(daily).collect()} == {"A", "B", None}
