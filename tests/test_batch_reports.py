"""The one-scan batch reports must give exactly the registered (direct) reports."""

import pytest

from tarmac.plans.catalog import FIX, queries
from tarmac.testing.compare import _rows_hash

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def reports(spark):
    from tarmac.plans.batch_reports import build_reports
    from tarmac.sources import testviews as tv
    return build_reports(spark, tv.flights(spark, SF), tv.fares(spark, SF), tv.weather(spark, SF),
                         tv.airports(spark, SF), tv.brand_carriers(spark, SF), thresholds=FIX)


def test_batch_reports_cover_registered(reports):
    assert set(NAMES) <= set(reports)


NAMES = ["airport_traffic_top", "most_departures", "most_arrivals", "busiest_airports",
         "top_dep_delays", "top_arr_delays", "delay_causes", "monthly_delays", "daily_delays",
         "cancellation_rates", "weather_delays_by_airport", "weather_delays_by_month",
         "worst_weather_airports", "delay_type_breakdown", "airport_nodes", "route_edges",
         "route_statistics", "route_lookup", "fare_by_year", "fare_by_quarter",
         "most_expensive_airports", "cheapest_airports", "price_trend", "best_value_airports",
         "fare_summary", "fare_by_origin", "weather_by_station", "seasonal_weather",
         "fare_batch_audit", "fare_batch_status", "route_recommendations", "airport_nodes_geo", "busiest_routes",
         "route_lookup_export", "carrier_comparison"]


@pytest.mark.parametrize("name", NAMES)
def test_batch_report_equals_direct(spark, reports, name):
    direct = queries()[name](spark, SF)
    got = reports[name]
    assert sorted(got.columns) == sorted(direct.columns)
    assert {f.name: f.dataType for f in got.schema} == {f.name: f.dataType for f in direct.schema}
    h1, k1 = _rows_hash(got.columns, [tuple(r) for r in got.collect()])
    h2, k2 = _rows_hash(direct.columns, [tuple(r) for r in direct.collect()])
    assert h1 == h2, (sorted(set(k1) - set(k2))[:3], sorted(set(k2) - set(k1))[:3])


def test_batch_run_writes_everything(spark, tmp_path):
    from tarmac.plans.batch_reports import run
    from tarmac.sources import dimensions, testviews as tv
    sf = "/root/testdata/sf0.001"
    names = run(spark, tv.flights(spark, sf), tv.fares(spark, sf), tv.weather(spark, sf),
                tv.airports(spark, sf), dimensions.carriers(spark), str(tmp_path / "out"))
    assert "results_bundle" in names
    assert spark.read.parquet(str(tmp_path / "out" / "airport_traffic_top")).count() == 25


def test_other_minutes_on_both_paths(spark):
    from tarmac.operators import delays, network, weather
    from tarmac.plans.batch_reports import build_reports
    from tarmac.sources import testviews as tv
    flights = tv.flights(spark, SF)
    t = {**FIX, "over_minutes": 40, "severe_minutes": 75}
    reports = build_reports(spark, flights, tv.fares(spark, SF), tv.weather(spark, SF),
                            tv.airports(spark, SF), tv.brand_carriers(spark, SF), thresholds=t)
    direct = {"top_dep_delays": delays.top_dep_delays(flights, t["top_dep_delays"], 40),
              "route_lookup": network.route_lookup(flights, t["route_lookup"], 40),
              "worst_weather_airports": weather.worst_weather_airports(flights, t["worst_weather_airports"], 75)}
    for name, want in direct.items():
        got = reports[name].select(*want.columns)
        assert _rows_hash(want.columns, [tuple(r) for r in got.collect()])[0] \
            == _rows_hash(want.columns, [tuple(r) for r in want.collect()])[0], name
