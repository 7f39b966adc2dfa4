"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per key.

Each query builds the fixture views from the scale folder's parquet tables
and runs one operator over the whole tables. Thresholds use the fixture
values (FIXTURES.md §5) so that results are neither empty nor everything at
sf0.01; the operators' defaults stay the reference's values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.operators import airports as ap
from tarmac.operators import delays, fares as fr, features as ft, flight_weather, network, positions
from tarmac.operators import recommend, traffic
from tarmac.operators import weather as wx
from tarmac.operators.joins import checked_broadcast, materialize, scratch_path
from tarmac.plans import forest, roundtrip
from tarmac.sources import dimensions
from tarmac.sources import testviews as tv

# Fixture thresholds (reference defaults in the operator signatures).
FIX = {
    "top_dep_delays": 2000, "top_arr_delays": 2000, "worst_weather_airports": 2000,
    "cancellation_rates": 2300, "route_statistics": 100, "route_lookup": 4,
    "weather_delays_by_airport": 100, "origin_fares": 500,
    "fare_cuts": (2500, 2540), "volume_cuts": (200, 130), "state": "AMERICA",
}


#: A small forest over delay features, for the check of node-table scoring in both engines: per
#: tree its weight and its nodes by number: (feature, threshold or set of left categories, left,
#: right, gain), or a leaf's prediction.
FOREST_INPUTS = ("DISTANCE", "dep_hour", "month", "is_weekend", "carrier_digit")
FOREST = [
    (0.5, {0: ("DISTANCE", 400.0, 1, 2, 30.0), 1: ("month", 6.0, 3, 4, 12.5), 2: ("carrier_digit", {1, 3}, 5, 6, 4.0),
           3: 11.25, 4: 7.5, 5: 20.0, 6: 31.0}),
    (0.25, {0: ("dep_hour", 11.0, 1, 2, 8.0), 1: 2.0, 2: ("is_weekend", 0.0, 3, 4, 2.25), 3: 6.0,
            4: ("DISTANCE", 800.0, 5, 6, 1.0), 5: -3.0, 6: 4.5}),
    (0.25, {0: 100.0}),
]


def _flights(spark, d):
    return tv.flights(spark, d)


def _fares(spark, d):
    """Fares after the batch-scale repair (the reference repairs before any report)."""
    return fr.repair_fare_scale(tv.fares(spark, d))


def _fare_report(name):
    """A fare report from one scan of the raw fares: the repair is decided in the summary."""
    def run(spark, d):
        from tarmac.plans import summary as sm
        return sm.fare_reports(sm.settled_fares(sm.fare_cells(tv.fares(spark, d))), FIX)[name]
    return run


def _batch_means(spark, d):
    from tarmac.plans import summary as sm
    return sm.cell_batch_means(sm.fare_cells(tv.fares(spark, d)))


def _route_stats(spark, d):
    return recommend.route_statistics(_flights(spark, d), min_flights=FIX["route_statistics"])


def _recommendations(spark, d):
    return recommend.route_recommendations(
        _route_stats(spark, d), _fare_report("fare_by_origin")(spark, d),
        fare_cuts=FIX["fare_cuts"], volume_cuts=FIX["volume_cuts"])


def _lookup(spark, d):
    return network.route_lookup(_flights(spark, d), min_flights=FIX["route_lookup"])


def _delay_split(spark, d):
    base = ft.delay_base(_flights(spark, d), keep=("ROW_KEY",))
    train, test = ft.split_by_key(base, "ROW_KEY", 8)
    return base, train, test


def _route_facts(spark, d):
    """Routes and weekday delays from one flight summary: one scan of flights, one of fares."""
    from tarmac.plans import routes, summary as sm
    measures = ("n", "date_max", "dep_sum", "dep_n", "arr_dep_sum", "arr_dep_n")
    s = sm.with_absent_measures(materialize(sm.flight_summary(_flights(spark, d), measures), "flight-summary"))
    return routes.route_facts(s, _fare_report("fare_by_origin")(spark, d), FIX), \
        sm.delay_reports(s, FIX)["daily_delays"]


def route_report(spark, d):
    """RAM-7 over requests derived from the data: every route on its latest flight date."""
    from tarmac.plans.routes import answer
    facts, days = _route_facts(spark, d)
    facts = materialize(facts, "routes")
    return answer(facts.select("ORIGIN", "DEST", F.col("latest_date").alias("travel_date")), facts, days)


def route_requests(spark, d):
    """RAM-7: a requests file read against the stored, bucketed routes.

    Requests: every nation pair with a supplier-side flight date (known routes), the same
    with an unknown destination, and without a date.
    """
    from tarmac.plans.routes import answer, open_routes, save_routes
    from tarmac.sources.files import read_requests
    facts, days = _route_facts(spark, d)
    path = scratch_path(spark, "routes")
    table = "routes_" + path.rsplit("-", 1)[1]
    save_routes(facts, table, f"{path}/table")
    asked = _flights(spark, d).where("ROW_KEY % 50 = 0").select(
        "ROW_KEY", "ORIGIN", F.when(F.col("ROW_KEY") % 3 == 0, F.lit("NOWHERE")).otherwise(F.col("DEST")).alias("DEST"),
        F.when(F.col("ROW_KEY") % 4 > 0, F.col("FL_DATE")).alias("travel_date"))
    asked.drop("ROW_KEY").write.option("header", True).csv(f"{path}/requests")
    return answer(read_requests(spark, f"{path}/requests"), open_routes(spark, table, f"{path}/table"), days)


def sampled_rows(spark, d):
    """SMP-1/2: the rows that the three model fits draw, and which of them train."""
    def drawn(model, view, fraction):
        return ft.sample_by_key(view, fraction, ("ROW_KEY",)).select(
            F.lit(model).alias("model"), "ROW_KEY", ft.in_share(("ROW_KEY",), 0.8, draw=1).alias("in_train"))
    flights, fares = _flights(spark, d), tv.fares(spark, d)
    return drawn("delay_rf", flights, 0.4).unionByName(drawn("fare_gbt", fares, 0.4)) \
        .unionByName(drawn("delay_gbt", flights, 0.2))


def _literal_forest(spark):
    return forest.forest_from_rows(spark, FOREST, FOREST_INPUTS)


def forest_scores(spark, d):
    """ML-4..7: scores of a small literal forest for every flight, by its node table."""
    base, _, _ = _delay_split(spark, d)
    carriers = F.substring("OP_CARRIER", -1, 1).cast("double").alias("carrier_digit")
    rows = base.select("ROW_KEY", "DISTANCE", "dep_hour", "month", "is_weekend", carriers)
    scored = forest.score(rows, _literal_forest(spark), list(FOREST_INPUTS))
    return scored.select("ROW_KEY", F.round("prediction", 6).alias("prediction"))


def forest_importances(spark, d):
    """ML-9: importances of the literal forest, weighted by the flights that reach each node."""
    base, _, _ = _delay_split(spark, d)
    carriers = F.substring("OP_CARRIER", -1, 1).cast("double").alias("carrier_digit")
    rows = base.select("ROW_KEY", "DISTANCE", "dep_hour", "month", "is_weekend", carriers)
    nodes = forest.with_visits(rows, _literal_forest(spark), list(FOREST_INPUTS))
    return forest.importances(nodes, list(FOREST_INPUTS)).select(
        "feature", F.round("importance", 6).alias("importance"))


def delay_features(spark, d):
    """ML-12 + JON-4: the improved model's frame with history features.

    History tables come from the training rows (``ROW_KEY % 10 < 8``) and are
    joined to every row; history columns are rounded to 6 places for the
    cross-engine check.
    """
    base, train, _ = _delay_split(spark, d)
    model = ft.fit_history(train.drop("ROW_KEY"))
    out = model.transform(base.drop("ROW_KEY"))
    return out.select(*ft.DELAY_BASE, *[F.round(col, 6).alias(col) for col in ft.HISTORY_COLUMNS])


def _history(name):
    def run(spark, d):
        _, train, _ = _delay_split(spark, d)
        return ft.history_table(train, name, digits=6)
    return run


def carrier_index(spark, d):
    """ML-1: StringIndexer order of carriers (frequency desc, ties by label)."""
    from pyspark.ml.feature import StringIndexer
    _, train, _ = _delay_split(spark, d)
    model = StringIndexer(inputCol="OP_CARRIER", outputCol="carrier_idx",
                          handleInvalid="keep").fit(train)
    labels = [(lab, float(i)) for i, lab in enumerate(model.labelsArray[0])]
    return spark.createDataFrame(labels, "OP_CARRIER string, carrier_idx double")


def index_tables(spark, d):
    """ML-1: StringIndexer order of the delay model's airports and the fare model's origins."""
    from pyspark.ml.feature import StringIndexer
    _, train, _ = _delay_split(spark, d)
    fares = ft.fare_features(_fares(spark, d)).select(F.col("ORIGIN").alias("FARE_ORIGIN"))
    labels = []
    for frame, column in ((train, "ORIGIN"), (train, "DEST"), (fares, "FARE_ORIGIN")):
        model = StringIndexer(inputCol=column, outputCol="idx", handleInvalid="keep").fit(frame)
        labels += [(column, lab, float(i)) for i, lab in enumerate(model.labelsArray[0])]
    return spark.createDataFrame(labels, "column_name string, label string, idx double")


ASSEMBLED = ("month", "day_of_week", "dep_hour", "is_weekend", "DISTANCE", "weather_delay_signal")


def assembled_features(spark, d):
    """ML-2: the assembler's vectors of the delay model's numeric inputs, taken apart again."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array
    base, _, _ = _delay_split(spark, d)
    vectors = VectorAssembler(inputCols=list(ASSEMBLED), outputCol="features",
                              handleInvalid="keep").transform(base)
    parts = vectors.select("ROW_KEY", vector_to_array("features").alias("v"))
    return parts.select("ROW_KEY", *[F.col("v")[i].alias(f"f{i}") for i in range(len(ASSEMBLED))])


def metrics_comparison(spark, d):
    """ML-10, ML-11, JON-6: the comparison record of two predictors that need no training:
    the global mean (baseline) and the route mean (improved)."""
    from tarmac.plans.models import model_comparison, regression_metrics
    _, train, test = _delay_split(spark, d)
    mean = ft.fit_history(train.drop("ROW_KEY"), names=("route",)).global_avg_delay
    constant = test.withColumn("prediction", F.lit(mean))
    record = model_comparison(regression_metrics(constant, "DEP_DELAY"), model_eval(spark, d))
    return record.select(*[F.col(f"{part}.{m}").alias(f"{part}_{m}")
                           for part in ("baseline", "improved_v2") for m in ("rmse", "mae", "r2")],
                         "delta.*")


def model_eval(spark, d):
    """ML-8: rmse / mae / r2 of a route-mean predictor on the held-out rows.

    Routes unseen in training fall back to the training mean, exactly as the
    history features do.
    """
    from tarmac.plans.models import regression_metrics
    _, train, test = _delay_split(spark, d)
    hist = ft.fit_history(train.drop("ROW_KEY"), names=("route",))
    route = checked_broadcast(hist.tables["route"], hist.rows["route"])
    preds = test.join(route, on=["ORIGIN", "DEST"], how="left").withColumn(
        "prediction", F.coalesce(F.col("route_avg_delay"), F.lit(hist.global_avg_delay)))
    return regression_metrics(preds, "DEP_DELAY", "prediction")


def metrics_record(spark, d):
    """ML-10: the metrics record of the route-mean predictor, with its settings."""
    from tarmac.plans.models import metrics_record as record
    return record(model_eval(spark, d), "RouteMean", "DEP_DELAY",
                  {"train_tenths": 8, "feature_count": 2, "fallback": "global mean"})


def record_counts(spark, d):
    """AGG-33: row totals of the inputs and of the model frames.

    One scan per source: every total of a source is a conditional count in
    the same aggregate (the fares also pay the one batch-means pass of the
    repair).
    """
    def rows(df, counts):
        agg = df.agg(*[F.count_if(cond).alias(f"c{i}") for i, (_, cond) in enumerate(counts)])
        pairs = ", ".join(f"'{name}', c{i}" for i, (name, _) in enumerate(counts))
        return agg.selectExpr(f"stack({len(counts)}, {pairs}) AS (table_name, row_count)")

    everything = F.lit(True)
    flights = rows(_flights(spark, d), [("flights", everything),
                                        ("rf_features", ft.rf_rows()),
                                        ("delay_base", ft.delay_rows())])
    fares = rows(ft.with_fare_derived(_fares(spark, d)),
                 [("fares", everything),
                  ("clean_fares", F.col("ITIN_FARE").isNotNull() & (F.col("ITIN_FARE") > 10)
                   & (F.col("ITIN_FARE") < 5000)),
                  ("fare_features", ft.fare_rows() & ft.fare_yield_ok())])
    weather = rows(tv.weather(spark, d), [("weather", everything)])
    return flights.unionByName(fares).unionByName(weather)


#: The reports that come in an order, and the columns that identify their rows.
ORDERED = {
    "airport_traffic_top": ("airport",), "most_departures": ("ORIGIN",), "most_arrivals": ("DEST",),
    "busiest_airports": ("airport",), "top_dep_delays": ("ORIGIN",), "top_arr_delays": ("DEST",),
    "monthly_delays": ("month",), "daily_delays": ("day_of_week",), "cancellation_rates": ("OP_CARRIER",),
    "fare_by_year": ("YEAR",), "fare_by_quarter": ("QUARTER",), "most_expensive_airports": ("ORIGIN",),
    "cheapest_airports": ("ORIGIN",), "price_trend": ("YEAR", "QUARTER"), "best_value_airports": ("ORIGIN",),
    "fare_batch_audit": ("YEAR", "QUARTER"), "weather_by_station": ("NAME",), "seasonal_weather": ("month",),
    "weather_delays_by_airport": ("ORIGIN",), "weather_delays_by_month": ("month",),
    "worst_weather_airports": ("ORIGIN",), "airport_nodes": ("airport",), "route_edges": ("ORIGIN", "DEST"),
    "route_recommendations": ("ORIGIN", "DEST"), "airport_nodes_geo": ("code",),
    "busiest_routes": ("origin", "dest"), "route_lookup_export": ("origin", "dest", "carrier"),
}


def _reports(spark, d, carriers):
    """Every report over the whole tables, each fact table scanned once."""
    from tarmac.plans.batch_reports import build_reports
    return build_reports(spark, _flights(spark, d), tv.fares(spark, d), tv.weather(spark, d),
                         tv.airports(spark, d), carriers, thresholds=FIX)


#: The fixture's flights end before its weather begins: days by which weather is taken back.
WEATHER_SHIFT = 6205


def _daily(spark, d):
    weather = tv.weather(spark, d).withColumn("DATE", F.date_sub("DATE", WEATHER_SHIFT))
    return flight_weather.flight_weather_daily(_flights(spark, d), weather, tv.station_map(spark, d))


def flight_weather_daily(spark, d):
    """Flights and weather of each airport and day."""
    return flight_weather.rounded(_daily(spark, d))


def weather_delay_corr(spark, d):
    """Correlation of a day's weather with its mean departure delay, by airport and over all."""
    return flight_weather.weather_delay_corr(_daily(spark, d))


def report_positions(spark, d):
    """SRT-1..3, LIM-1/2: the place of every row in every ordered report."""
    return positions.positions(_reports(spark, d, dimensions.carriers(spark)), ORDERED)


def _bundle(spark, d):
    """RAM-6: the results bundle, from reports over one scan of each fact table."""
    from tarmac.plans.batch_reports import bundle_sections_from
    from tarmac.plans.bundle import results_bundle
    carriers = tv.brand_carriers(spark, d)
    return results_bundle(spark, bundle_sections_from(_reports(spark, d, carriers), carriers))


def bundle_records(spark, d):
    """SNK-4, RAM-6, SRC-8: the bundle written as JSON, read back, and taken apart into records."""
    from tarmac.plans.bundle import bundle_records as records
    from tarmac.plans.sinks import save_record
    bundle, path = _bundle(spark, d), scratch_path(spark, "bundle")
    save_record(bundle, path)
    return records(spark, path, bundle.schema)


def bundle_sections(spark, d):
    """RAM-6: rows per section of the results bundle.

    The sections come from the one-scan pipeline (flights, fares and weather
    each scanned once into a shared summary), not from ~20 separate scans.
    """
    from tarmac.plans.bundle import section_counts
    from tarmac.plans.batch_reports import bundle_sections_from
    carriers = dimensions.carriers(spark)
    return section_counts(bundle_sections_from(_reports(spark, d, carriers), carriers))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    q: dict[str, Callable[[SparkSession, str], DataFrame]] = {
        # traffic and delays
        "airport_traffic_top": lambda s, d: traffic.airport_traffic(_flights(s, d), top_n=25),
        "most_departures": lambda s, d: traffic.most_departures(_flights(s, d)),
        "most_arrivals": lambda s, d: traffic.most_arrivals(_flights(s, d)),
        "busiest_airports": lambda s, d: traffic.busiest_airports(_flights(s, d)),
        "top_dep_delays": lambda s, d: delays.top_dep_delays(_flights(s, d),
                                                             FIX["top_dep_delays"]),
        "top_arr_delays": lambda s, d: delays.top_arr_delays(_flights(s, d),
                                                             FIX["top_arr_delays"]),
        "delay_causes": lambda s, d: delays.delay_causes(_flights(s, d)),
        "monthly_delays": lambda s, d: delays.monthly_delays(_flights(s, d)),
        "daily_delays": lambda s, d: delays.daily_delays(_flights(s, d)),
        "cancellation_rates": lambda s, d: delays.cancellation_rates(
            _flights(s, d), FIX["cancellation_rates"]),
        # airport dimension (the reference's RDD section)
        "airports_list": lambda s, d: ap.airports_list(tv.airports(s, d)),
        "airport_count": lambda s, d: ap.airport_count(tv.airports(s, d)),
        "airport_codes": lambda s, d: ap.airport_codes(tv.airports(s, d)),
        "airports_in_state": lambda s, d: ap.airports_in_state(tv.airports(s, d), FIX["state"]),
        "airport_pairs": lambda s, d: ap.airport_pairs(tv.airports(s, d), 5),
        "airports_by_state": lambda s, d: ap.airports_by_state(tv.airports(s, d)),
        # fares
        "fare_scale_repair": lambda s, d: _fares(s, d),
        "fare_batch_audit": lambda s, d: fr.fare_batch_audit(tv.fares(s, d), means=_batch_means(s, d)),
        "fare_batch_status": lambda s, d: fr.fare_batch_status(tv.fares(s, d), means=_batch_means(s, d)),
        **{name: _fare_report(name) for name in (
            "fare_by_year", "fare_by_quarter", "most_expensive_airports", "cheapest_airports", "price_trend",
            "best_value_airports", "fare_summary", "fare_by_origin")},
        # weather
        "weather_by_station": lambda s, d: wx.weather_by_station(tv.weather(s, d)),
        "weather_delays_by_airport": lambda s, d: wx.weather_delays_by_airport(
            _flights(s, d), FIX["weather_delays_by_airport"]),
        "weather_delays_by_month": lambda s, d: wx.weather_delays_by_month(_flights(s, d)),
        "worst_weather_airports": lambda s, d: wx.worst_weather_airports(
            _flights(s, d), FIX["worst_weather_airports"]),
        "delay_type_breakdown": lambda s, d: wx.delay_type_breakdown(_flights(s, d)),
        "seasonal_weather": lambda s, d: wx.seasonal_weather(tv.weather(s, d)),
        # routes and recommendation
        "route_statistics": _route_stats,
        "route_recommendations": _recommendations,
        # network
        "airport_nodes": lambda s, d: network.airport_nodes(_flights(s, d)),
        "route_edges": lambda s, d: network.route_edges(_flights(s, d)),
        "route_lookup": _lookup,
        "airport_nodes_geo": lambda s, d: network.airport_nodes_geo(
            network.airport_nodes(_flights(s, d)), tv.airports(s, d), 24),
        "busiest_routes": lambda s, d: network.busiest_routes(
            network.route_edges(_flights(s, d)), 50),
        "route_lookup_export": lambda s, d: network.route_lookup_export(_lookup(s, d), 5000),
        "carrier_comparison": lambda s, d: recommend.carrier_comparison(
            _lookup(s, d), tv.brand_carriers(s, d)),
        "route_report": route_report,
        "route_requests": route_requests,
        # features
        "rf_features": lambda s, d: ft.rf_features(_flights(s, d)),
        "fare_features": lambda s, d: ft.fare_features(_fares(s, d)),
        "delay_features": delay_features,
        "carrier_index": carrier_index,
        "category_cardinality": lambda s, d: ft.category_cardinality(
            ft.rf_features(_flights(s, d))),
        "fare_cardinality": lambda s, d: ft.fare_cardinality(ft.fare_features(_fares(s, d))),
        "model_eval": model_eval,
        "index_tables": index_tables,
        "assembled_features": assembled_features,
        "metrics_comparison": metrics_comparison,
        "metrics_record": metrics_record,
        "sampled_rows": sampled_rows,
        "flight_weather_daily": flight_weather_daily,
        "weather_delay_corr": weather_delay_corr,
        "forest_scores": forest_scores,
        "forest_importances": forest_importances,
        "record_counts": record_counts,
        "bundle_sections": bundle_sections,
        "bundle_records": bundle_records,
        "report_positions": report_positions,
    }
    q.update(roundtrip.queries())
    for name in ft.HISTORY_SPECS:
        q[f"delay_history_{name}"] = _history(name)
    return q
