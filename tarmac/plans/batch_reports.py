"""The whole report pipeline (traffic, delay, fare, weather and network
reports plus the route tables) as Spark jobs over shared summaries.

Scans: flights, fares and weather once each. The three summaries are written to the session's checkpoint
folder, so every report after that reads a small table, lineage is cut, and
a lost executor never triggers a rescan of the facts. Reports are written
with distributed writers; nothing is collected to the driver.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Mapping
from functools import cache

from pyspark.sql import DataFrame, SparkSession

from tarmac.functions.defaults import THRESHOLDS
from tarmac.operators import fares as fr, network, recommend
from tarmac.operators.joins import materialize
from tarmac.plans import summary as sm
from tarmac.plans.bundle import SECTIONS, results_bundle
from tarmac.plans.sinks import save_record, save_table

class Reports(Mapping):
    """Reports by name; a report's group and the summary it needs are made on first use."""

    def __init__(self, groups: dict[tuple[str, ...], Callable[[], dict[str, DataFrame]]]):
        self._group = {name: key for key in groups for name in key}
        self._make, self._made = groups, {}

    def __getitem__(self, name: str) -> DataFrame:
        key = self._group[name]
        if key not in self._made:
            self._made[key] = self._make[key]()
        return self._made[key][name]

    def __iter__(self):
        return iter(self._group)

    def __len__(self) -> int:
        return len(self._group)


def build_reports(spark: SparkSession, flights: DataFrame, fares: DataFrame, weather: DataFrame,
                  airports: DataFrame, carriers: DataFrame, thresholds: dict | None = None,
                  top_airports: int = 25, flight_summary: DataFrame | None = None,
                  fare_cells: DataFrame | None = None, weather_summary: DataFrame | None = None) -> Reports:
    """Every report as a DataFrame over the materialized summaries.

    Only what is asked for is built: without a weather report no weather is scanned.
    ``fares`` are raw (the batch repair is applied here). ``flight_summary``, ``fare_cells``
    and ``weather_summary`` may bring the summaries that streaming ingestion keeps
    instead of a scan of the facts.
    """
    t = {**THRESHOLDS, **(thresholds or {})}

    @cache
    def flight_sum() -> DataFrame:
        made = sm.flight_summary(flights, None, t["over_minutes"], t["severe_minutes"]) \
            if flight_summary is None else flight_summary
        return materialize(made, "flight-summary")

    @cache
    def cells() -> DataFrame:
        return materialize(sm.fare_cells(fares) if fare_cells is None else fare_cells, "fare-cells")

    @cache
    def means() -> DataFrame:
        return sm.cell_batch_means(cells())

    @cache
    def fare_sum() -> DataFrame:
        return materialize(sm.settled_fares(cells()), "fare-summary")

    @cache
    def weather_sum() -> DataFrame:
        return materialize(sm.weather_summary(weather) if weather_summary is None else weather_summary,
                           "weather-summary")

    one = lambda name, make: {(name,): lambda: {name: make()}}
    reports: Reports = Reports({
        ("airport_traffic_top", "most_departures", "most_arrivals", "busiest_airports"):
            lambda: sm.traffic_reports(flight_sum(), top_airports),
        ("top_dep_delays", "top_arr_delays", "delay_causes", "monthly_delays", "daily_delays",
         "cancellation_rates"): lambda: sm.delay_reports(flight_sum(), t),
        ("weather_delays_by_airport", "weather_delays_by_month", "worst_weather_airports",
         "delay_type_breakdown"): lambda: sm.weather_delay_reports(flight_sum(), t),
        ("airport_nodes", "route_edges", "route_statistics", "route_lookup"):
            lambda: sm.network_reports(flight_sum(), t),
        ("fare_by_year", "fare_by_quarter", "most_expensive_airports", "cheapest_airports",
         "price_trend", "best_value_airports", "fare_summary", "fare_by_origin"):
            lambda: sm.fare_reports(fare_sum(), t),
        ("weather_by_station", "seasonal_weather"): lambda: sm.weather_reports(weather_sum()),
        **one("fare_batch_audit", lambda: fr.fare_batch_audit(fares, means=means())),
        **one("fare_batch_status", lambda: fr.fare_batch_status(fares, means=means())),
        **one("route_recommendations", lambda: recommend.route_recommendations(
            reports["route_statistics"], reports["fare_by_origin"], fare_cuts=t["fare_cuts"],
            volume_cuts=t["volume_cuts"])),
        **one("airport_nodes_geo", lambda: network.airport_nodes_geo(reports["airport_nodes"], airports)),
        **one("busiest_routes", lambda: network.busiest_routes(reports["route_edges"])),
        **one("route_lookup_export", lambda: network.route_lookup_export(reports["route_lookup"])),
        **one("carrier_comparison", lambda: recommend.carrier_comparison(reports["route_lookup"], carriers)),
    })
    return reports


def bundle_sections_from(reports: Mapping[str, DataFrame], carriers: DataFrame
                         ) -> dict[str, DataFrame]:
    """Map pipeline reports to the bundle's section names."""
    names = {"airports": "airport_nodes_geo", "busiest_routes": "busiest_routes",
             "route_lookup": "route_lookup_export", "most_expensive": "most_expensive_airports",
             "cheapest": "cheapest_airports", "best_value": "best_value_airports",
             "worst_weather": "worst_weather_airports"}
    out = {s: reports[names.get(s, s)] for s in SECTIONS if s != "carrier_names"}
    out["carrier_names"] = carriers
    return out


def run(spark: SparkSession, flights: DataFrame, fares: DataFrame, weather: DataFrame,
        airports: DataFrame, carriers: DataFrame, out_dir: str, fmt: str = "parquet",
        thresholds: dict | None = None, **summaries: DataFrame | None) -> list[str]:
    """Build and write every report plus the results bundle under ``out_dir``.

    ``summaries``: the streamed summaries that ``build_reports`` takes.
    """
    reports = build_reports(spark, flights, fares, weather, airports, carriers, thresholds, **summaries)
    for name, df in reports.items():
        save_table(df, os.path.join(out_dir, name), fmt)
    # SNK-2: the one-row fare summary is also published as a JSON record.
    save_record(reports["fare_summary"], os.path.join(out_dir, "fare_summary_record"))
    bundle = results_bundle(spark, bundle_sections_from(reports, carriers))
    save_record(bundle, os.path.join(out_dir, "results_bundle"))
    return sorted(reports) + ["fare_summary_record", "results_bundle"]
