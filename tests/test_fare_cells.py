"""Fare summaries whose batch repair is decided after the scan, in batch and in streams."""

import os

import pytest

from tarmac.operators import fares as fr
from tarmac.plans import summary as sm
from tarmac.testing.compare import _rows_hash

SF = "/root/testdata/sf0.01"
SCHEMA = "YEAR int, QUARTER int, ORIGIN string, ITIN_FARE double, ITIN_YIELD double, DISTANCE double"


def same(a, b):
    assert sorted(a.columns) == sorted(b.columns)
    left, right = (_rows_hash(x.columns, [tuple(r) for r in x.collect()]) for x in (a, b))
    assert left[0] == right[0], (sorted(set(left[1]) - set(right[1]))[:3], sorted(set(right[1]) - set(left[1]))[:3])


DIRECT = {
    "fare_by_year": fr.fare_by_year, "fare_by_quarter": fr.fare_by_quarter,
    "most_expensive_airports": lambda f: fr.most_expensive_airports(f, 500),
    "cheapest_airports": lambda f: fr.cheapest_airports(f, 500), "price_trend": fr.price_trend,
    "best_value_airports": lambda f: fr.best_value_airports(f, 500), "fare_summary": fr.fare_summary,
    "fare_by_origin": fr.fare_by_origin,
}


@pytest.mark.parametrize("name", sorted(DIRECT))
def test_cells_give_the_direct_reports(spark, name):
    from tarmac.plans.catalog import queries
    from tarmac.sources import testviews as tv
    same(queries()[name](spark, SF), DIRECT[name](fr.clean_fares(fr.repair_fare_scale(tv.fares(spark, SF)))))


def test_one_scan(spark, tmp_path):
    from tarmac.sources import testviews as tv
    tv.fares(spark, "/root/testdata/sf0.001").write.parquet(str(tmp_path / "fares"))
    settled = sm.settled_fares(sm.fare_cells(spark.read.parquet(str(tmp_path / "fares"))))
    plan = sm.fare_reports(settled, {"origin_fares": 5})["fare_by_year"]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "Join" not in plan


ROWS = [(2018, 1, "A", 2.0, 0.02, 100.0), (2018, 1, "B", 3.0, None, 0.0), (2018, 1, None, -1.0, 0.1, None),
        (2018, 2, "A", 400.0, 2.0, 200.0), (2018, 2, "A", None, 2.0, 200.0), (None, 2, "A", 1.0, 0.01, 10.0),
        (2018, 3, "C", None, None, None), (2018, 4, "C", -5.0, None, 3.0), (2018, 2, "D", 6000.0, 1.0, 9.0)]


def test_edges(spark):
    fares = spark.createDataFrame(ROWS, SCHEMA)
    cells = sm.fare_cells(fares)
    same(fr.fare_batch_audit(fares, means=sm.cell_batch_means(cells)), fr.fare_batch_audit(fares))
    direct = fr.clean_fares(fr.repair_fare_scale(fares))
    got = sm.fare_reports(sm.settled_fares(cells), {"origin_fares": 0})
    same(got["fare_by_year"], fr.fare_by_year(direct))
    same(got["best_value_airports"], fr.best_value_airports(direct, 0))
    assert sm.settled_fares(sm.fare_cells(fares.limit(0))).count() == 0


def test_batches_of_any_key(spark):
    """Two files of one quarter are two batches, each with its own scale."""
    fares = spark.createDataFrame([(*r, f"f{i % 2}") for i, r in enumerate(ROWS)], SCHEMA + ", source_file string")
    direct = fr.clean_fares(fr.repair_fare_scale(fares, ("source_file",)))
    got = sm.settled_fares(sm.fare_cells(fares, ("source_file",)), ("source_file",))
    same(sm.fare_reports(got, {"origin_fares": 0})["price_trend"], fr.price_trend(direct))


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_a_late_file_turns_its_batch(spark, tmp_path, fmt):
    from tarmac.streaming.ingest import compact, merged_summary, start_summary_stream
    land, table = str(tmp_path / "landing"), str(tmp_path / "cells")
    drops = [[(2018, 1, "A", 30.0, 0.3, 100.0), (2018, 1, "B", 40.0, 0.4, 200.0), (2018, 2, "A", 300.0, 3.0, 100.0)],
             [(2018, 1, "A", 900.0, 9.0, 100.0), (2018, 1, "C", 800.0, None, 0.0)]]
    seen = []
    for i, rows in enumerate(drops):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.option("header", True).format(fmt).save(
            os.path.join(land, f"drop{i}"))
        query = start_summary_stream(spark, os.path.join(land, "*"), table, fmt, kind="fares")
        query.awaitTermination(200)
        assert query.exception() is None
        cells = merged_summary(spark, table, "fares")
        every = spark.createDataFrame([r for d in drops[:i + 1] for r in d], SCHEMA)
        audit = fr.fare_batch_audit(every, means=sm.cell_batch_means(cells))
        same(audit, fr.fare_batch_audit(every))
        same(sm.fare_reports(sm.settled_fares(cells), {"origin_fares": 0})["most_expensive_airports"],
             fr.most_expensive_airports(fr.clean_fares(fr.repair_fare_scale(every)), 0))
        seen.append({r.QUARTER: r.status for r in audit.collect()})
    assert seen == [{1: "fixed", 2: "clean"}, {1: "clean", 2: "clean"}]
    compact(spark, table, "fares")
    same(merged_summary(spark, table, "fares"), cells)


def test_weather_stream(spark, tmp_path):
    from tarmac.sources import testviews as tv
    from tarmac.streaming.ingest import merged_summary, start_summary_stream
    weather = tv.weather(spark, "/root/testdata/sf0.001")
    for i in range(2):
        weather.where(f"month(DATE) % 2 = {i}").coalesce(1).write.parquet(str(tmp_path / f"land/drop{i}"))
    query = start_summary_stream(spark, str(tmp_path / "land/*"), str(tmp_path / "sum"), kind="weather",
                                 max_files_per_trigger=1)
    query.awaitTermination(200)
    assert query.exception() is None
    merged = sm.weather_reports(merged_summary(spark, str(tmp_path / "sum"), "weather"))
    for name, df in sm.weather_reports(sm.weather_summary(weather)).items():
        same(merged[name], df)
