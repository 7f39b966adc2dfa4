"""Shared summaries: every report of a step from one scan of its fact table.

Run one by one, the reports of the delay, weather and network steps scan the
flights table about twenty times. Here the flights are scanned once into a
summary holding only mergeable measures (counts, sums, conditional counts,
max) for two grouping sets computed in the same pass: carrier-routes
(ORIGIN, DEST, OP_CARRIER) and calendar cells (month, day_of_week). Its size
is bounded by airports x airports x carriers + 84 rows, not by the number of
flights, so after the one scan every report is a small roll-up. Averages are
``sum / count`` of the same non-null rows ``avg`` would use, so the reports
equal the direct operators'.

Fares get the same treatment keyed by (YEAR, QUARTER, ORIGIN), with the batch repair
decided after the scan, and weather keyed by (NAME, month).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarmac.functions.defaults import THRESHOLDS
from tarmac.functions.exprs import c, quarter_label
from tarmac.operators.fares import BATCH_KEYS, batch_status
from tarmac.operators.recommend import delay_risk
from tarmac.schemas import FLIGHT_SCHEMA

FLIGHT_KEYS = ["ORIGIN", "DEST", "OP_CARRIER", "month", "day_of_week"]
ROUTE_SET = ["ORIGIN", "DEST", "OP_CARRIER"]
CALENDAR_SET = ["month", "day_of_week"]


def _gid(keys: list[str]) -> int:
    """grouping_id of a set: one bit per FLIGHT_KEYS column, 1 = rolled up."""
    return int("".join("0" if k in keys else "1" for k in FLIGHT_KEYS), 2)


ROUTE_GID, CALENDAR_GID = _gid(ROUTE_SET), _gid(CALENDAR_SET)


def routes_part(s: DataFrame) -> DataFrame:
    return s.where(c("gid") == ROUTE_GID)


def calendar_part(s: DataFrame) -> DataFrame:
    return s.where(c("gid") == CALENDAR_GID)


CAUSES = {"CARRIER_DELAY": "carrier", "WEATHER_DELAY": "weather", "NAS_DELAY": "nas",
          "SECURITY_DELAY": "security", "LATE_AIRCRAFT_DELAY": "late"}


def _sum_n(col: str, name: str, cond=None) -> list:
    """sum and non-null count of ``col`` (optionally only where ``cond``)."""
    v = c(col) if cond is None else F.when(cond, c(col))
    return [F.sum(v).alias(f"{name}_sum"), F.count(v).alias(f"{name}_n")]


def flight_summary(flights: DataFrame, only: tuple[str, ...] | None = None,
                   over_minutes: float = THRESHOLDS["over_minutes"],
                   severe_minutes: float = THRESHOLDS["severe_minutes"]) -> DataFrame:
    """One scan of the flights -> mergeable measures per summary key.

    ``dep_over`` and ``arr_over`` count delays over ``over_minutes``, ``wx_severe`` weather
    delays over ``severe_minutes``.

    ``only`` names the measures to compute; Catalyst drops the others and their columns.
    """
    dep, arr, wx = c("DEP_DELAY"), c("ARR_DELAY"), c("WEATHER_DELAY")
    measures = [F.count(F.lit(1)).alias("n"), F.max("FL_DATE").alias("date_max")]
    measures += _sum_n("DEP_DELAY", "dep") + [F.count_if(dep > over_minutes).alias("dep_over")]
    measures += _sum_n("ARR_DELAY", "arr") + [F.count_if(arr > over_minutes).alias("arr_over")]
    measures += _sum_n("ARR_DELAY", "arr_dep", dep.isNotNull())
    measures += _sum_n("CANCELLED", "cancelled") + [F.count_if(c("CANCELLED") == 1)
                                                    .alias("cancelled_eq1")]
    measures += _sum_n("DISTANCE", "dist")
    # rows with a positive weather delay are counted by ``weather_pos`` below
    measures += [F.sum(F.when(wx > 0, wx)).alias("wx_pos_sum"),
                 F.max(F.when(wx > 0, wx)).alias("wx_pos_max"),
                 F.count_if(wx > severe_minutes).alias("wx_severe")]
    measures += _sum_n("DEP_DELAY", "dep_wx", wx.isNotNull())
    for col, name in CAUSES.items():
        measures += _sum_n(col, name) + [F.count_if(c(col) > 0).alias(f"{name}_pos")]
    out = (flights.withColumns({"month": F.month("FL_DATE"),
                                "day_of_week": F.dayofweek("FL_DATE")})
           .groupingSets([ROUTE_SET, CALENDAR_SET], *FLIGHT_KEYS)
           .agg(*measures, F.grouping_id().alias("gid")))
    return out if only is None else out.select(*FLIGHT_KEYS, *only, "gid")


def merged(parts: DataFrame, keys: list[str]) -> DataFrame:
    """Partial summaries added up: minima and maxima by name, all else are sums."""
    ops = {"_max": F.max, "_min": F.min}
    return parts.groupBy(*keys).agg(*[
        ops.get(m[-4:], F.sum)(m).alias(m) for m in parts.columns if m not in keys])


def with_absent_measures(s: DataFrame) -> DataFrame:
    """A summary of some measures with the others as nulls, so that every report can be planned."""
    every = flight_summary(s.sparkSession.createDataFrame([], FLIGHT_SCHEMA)).schema
    return s.select(*[F.col(f.name) if f.name in s.columns else F.lit(None).cast(f.dataType).alias(f.name)
                      for f in every.fields])


def _avg(name: str, digits: int = 2):
    return F.round(F.try_divide(F.sum(f"{name}_sum"), F.sum(f"{name}_n")), digits)


def _pct(part: str, whole: str):
    return F.round(F.try_divide(F.sum(part), F.sum(whole)) * 100, 2)


def _by_airport(sides: DataFrame):
    """Group departure-side and arrival-side rows by airport, keeping a null
    departure code apart from a null arrival code (full-outer-join semantics
    without a join)."""
    return sides.groupBy("airport", F.when(c("airport").isNull(), c("is_dep")).alias("null_side"))


def latest_route_dates(s: DataFrame) -> DataFrame:
    """(ORIGIN, DEST, travel_date): every known route on its latest flight date."""
    return (routes_part(s).where(c("ORIGIN").isNotNull() & c("DEST").isNotNull())
            .groupBy("ORIGIN", "DEST").agg(F.max("date_max").alias("travel_date")))


def traffic_reports(s: DataFrame, top_n: int = 25) -> dict[str, DataFrame]:
    s = routes_part(s)
    dep = s.groupBy("ORIGIN").agg(F.sum("n").alias("departure_count"))
    arr = s.groupBy("DEST").agg(F.sum("n").alias("arrival_count"))
    sides = (dep.select(c("ORIGIN").alias("airport"), F.lit(True).alias("is_dep"),
                        c("departure_count").alias("k"))
             .unionByName(arr.select(c("DEST").alias("airport"), F.lit(False).alias("is_dep"),
                                     c("arrival_count").alias("k"))))
    both = (_by_airport(sides)
            .agg(F.coalesce(F.sum(F.when(c("is_dep"), c("k"))), F.lit(0)).alias("departure_count"),
                 F.coalesce(F.sum(F.when(~c("is_dep"), c("k"))), F.lit(0)).alias("arrival_count"))
            .select("airport", "departure_count", "arrival_count",
                    (c("departure_count") + c("arrival_count")).alias("total_traffic")))
    busiest = (dep.select(c("ORIGIN").alias("airport"), c("departure_count").alias("k"))
               .unionByName(arr.select(c("DEST").alias("airport"), c("arrival_count").alias("k")))
               .groupBy("airport").agg(F.sum("k").alias("total_traffic")))
    return {
        "airport_traffic_top": both.orderBy(F.desc("total_traffic"),
                                            F.asc_nulls_last("airport")).limit(top_n),
        "most_departures": dep.withColumnRenamed("departure_count", "total_departures")
                              .orderBy(F.desc("total_departures"), F.asc_nulls_last("ORIGIN")),
        "most_arrivals": arr.withColumnRenamed("arrival_count", "total_arrivals")
                            .orderBy(F.desc("total_arrivals"), F.asc_nulls_last("DEST")),
        "busiest_airports": busiest.orderBy(F.desc("total_traffic"), F.asc_nulls_last("airport")),
    }


def delay_reports(s: DataFrame, t: dict) -> dict[str, DataFrame]:
    cal, s = calendar_part(s), routes_part(s)

    def by_airport(key, side, name, min_n):
        return (s.groupBy(key)
                .agg(_avg(side).alias(name), F.sum(f"{side}_n").alias("total_flights"),
                     _pct(f"{side}_over", f"{side}_n").alias("pct_over_15min"))
                .where(c("total_flights") > min_n)
                .orderBy(F.desc(name), F.asc_nulls_last(key)))

    def by_period(key):
        return (cal.where(c("dep_n") > 0).groupBy(key).agg(_avg("dep").alias("avg_dep_delay"))
                .orderBy(key))

    return {
        "top_dep_delays": by_airport("ORIGIN", "dep", "avg_dep_delay_min", t["top_dep_delays"]),
        "top_arr_delays": by_airport("DEST", "arr", "avg_arr_delay_min", t["top_arr_delays"]),
        "delay_causes": cal.agg(*[_avg(name).alias(alias) for name, alias in [
            ("carrier", "avg_carrier_delay_min"), ("weather", "avg_weather_delay_min"),
            ("nas", "avg_nas_delay_min"), ("security", "avg_security_delay_min"),
            ("late", "avg_late_aircraft_min")]]),
        "monthly_delays": by_period("month"),
        "daily_delays": by_period("day_of_week"),
        "cancellation_rates": (s.groupBy("OP_CARRIER")
                               .agg(F.round(F.try_divide(F.sum("cancelled_sum"),
                                                         F.sum("cancelled_n")) * 100, 2)
                                    .alias("cancellation_rate_pct"),
                                    F.sum("n").alias("total_flights"))
                               .where(c("total_flights") > t["cancellation_rates"])
                               .orderBy(F.desc("cancellation_rate_pct"),
                                        F.asc_nulls_last("OP_CARRIER"))),
    }


def weather_delay_reports(s: DataFrame, t: dict) -> dict[str, DataFrame]:
    cal, s = calendar_part(s), routes_part(s)
    return {
        "weather_delays_by_airport": (
            s.groupBy("ORIGIN")
            .agg(F.round(F.try_divide(F.sum("wx_pos_sum"), F.sum("weather_pos")), 2)
                 .alias("avg_weather_delay_min"),
                 F.sum("weather_pos").alias("weather_delayed_flights"),
                 F.round(F.max("wx_pos_max"), 2).alias("max_weather_delay_min"))
            .where(c("weather_delayed_flights") > t["weather_delays_by_airport"])
            .orderBy(F.desc("avg_weather_delay_min"), F.asc_nulls_last("ORIGIN"))),
        "weather_delays_by_month": (
            cal.where(c("weather_n") > 0).groupBy("month")
            .agg(_avg("weather").alias("avg_weather_delay"),
                 _avg("dep_wx").alias("avg_total_delay"),
                 F.sum("weather_n").alias("total_flights"))
            .orderBy("month")),
        "worst_weather_airports": (
            s.groupBy("ORIGIN")
            .agg(_avg("weather").alias("avg_weather_delay_min"),
                 _pct("wx_severe", "n").alias("pct_severe_weather_delay"),
                 F.sum("n").alias("total_flights"))
            .where(c("total_flights") > t["worst_weather_airports"])
            .orderBy(F.desc_nulls_last("avg_weather_delay_min"), F.asc_nulls_last("ORIGIN"))),
        "delay_type_breakdown": cal.agg(*[
            _pct(f"{name}_pos", "n").alias(alias) for name, alias in [
                ("weather", "pct_weather_caused"), ("carrier", "pct_carrier_caused"),
                ("nas", "pct_nas_caused"), ("late", "pct_late_aircraft_caused"),
                ("security", "pct_security_caused")]]),
    }


def network_reports(s: DataFrame, t: dict) -> dict[str, DataFrame]:
    s = routes_part(s)
    routes = s.groupBy("ORIGIN", "DEST").agg(
        F.sum("n").alias("n"), F.sum("dep_sum").alias("dep_sum"), F.sum("dep_n").alias("dep_n"),
        F.sum("arr_sum").alias("arr_sum"), F.sum("arr_n").alias("arr_n"),
        F.sum("arr_dep_sum").alias("arr_dep_sum"), F.sum("arr_dep_n").alias("arr_dep_n"),
        F.sum("dist_sum").alias("dist_sum"), F.sum("dist_n").alias("dist_n"))

    def side(key, partner, delay, is_dep):
        return routes.groupBy(c(key).alias("airport")).agg(
            F.lit(is_dep).alias("is_dep"), F.count(partner).alias("routes"),
            F.sum("n").alias("total"),
            F.round(F.try_divide(F.sum(f"{delay}_sum"), F.sum(f"{delay}_n")), 2).alias("avg"))

    def pick(is_dep: bool, col: str, zero):
        cond = c("is_dep") if is_dep else ~c("is_dep")
        return F.coalesce(F.max(F.when(cond, c(col))), F.lit(zero))

    sides = side("ORIGIN", "DEST", "dep", True).unionByName(side("DEST", "ORIGIN", "arr", False))
    nodes = (_by_airport(sides)
             .agg(pick(True, "routes", 0).alias("outbound_routes"),
                  pick(True, "total", 0).alias("total_departures"),
                  pick(True, "avg", 0.0).alias("avg_dep_delay"),
                  pick(False, "routes", 0).alias("inbound_routes"),
                  pick(False, "total", 0).alias("total_arrivals"),
                  pick(False, "avg", 0.0).alias("avg_arr_delay"))
             .withColumns({"total_degree": c("outbound_routes") + c("inbound_routes"),
                           "total_traffic": c("total_departures") + c("total_arrivals")})
             .withColumn("network_importance_score",
                         F.round(c("total_traffic") / 1000000 * c("total_degree"), 2))
             .select("airport", "outbound_routes", "total_departures", "avg_dep_delay",
                     "inbound_routes", "total_arrivals", "avg_arr_delay", "total_degree",
                     "total_traffic", "network_importance_score"))
    edges = routes.select(
        "ORIGIN", "DEST", c("n").alias("flight_count"),
        F.round(F.try_divide(c("dep_sum"), c("dep_n")), 2).alias("avg_delay"),
        F.round(F.try_divide(c("dist_sum"), c("dist_n")), 0).alias("avg_distance"))
    stats = (routes.where(c("ORIGIN").isNotNull() & c("DEST").isNotNull() & (c("dep_n") > 0))
             .select("ORIGIN", "DEST",
                     F.round(c("dep_sum") / c("dep_n"), 2).alias("hist_avg_dep_delay"),
                     F.round(F.try_divide(c("arr_dep_sum"), c("arr_dep_n")), 2)
                     .alias("hist_avg_arr_delay"),
                     c("dep_n").alias("total_flights"))
             .where(c("total_flights") > t["route_statistics"])
             .withColumn("delay_risk", delay_risk(c("hist_avg_dep_delay"))))
    lookup = (s.groupBy("ORIGIN", "DEST", "OP_CARRIER")
              .agg(F.sum("n").alias("total_flights"), _avg("dep").alias("avg_dep_delay_min"),
                   _avg("arr").alias("avg_arr_delay_min"), _avg("weather").alias("avg_weather_delay"),
                   _avg("carrier").alias("avg_carrier_delay"),
                   _pct("dep_over", "n").alias("pct_delayed_over_15min"),
                   _pct("cancelled_eq1", "n").alias("cancellation_rate_pct"))
              .where(c("total_flights") > t["route_lookup"]))
    return {
        "airport_nodes": nodes.orderBy(F.desc("total_traffic"), F.asc_nulls_last("airport")),
        "route_edges": edges.orderBy(F.desc("flight_count"), F.asc_nulls_last("ORIGIN"),
                                     F.asc_nulls_last("DEST")),
        "route_statistics": stats,
        "route_lookup": lookup,
    }


FARE_KEYS = ["YEAR", "QUARTER", "ORIGIN"]
#: The two readings of a batch's fares before its scale is known.
READINGS = ("raw", "scaled")


def fare_cells(fares: DataFrame, batch_keys=BATCH_KEYS, low: float = 10, high: float = 5000,
               factor: float = 100.0) -> DataFrame:
    """One scan of the raw fares, whatever the scale of their batches turns out to be.

    Whether a batch is stored ``factor`` times too small shows in the mean of all its
    positive fares, known only after the scan. So every measure is kept for both
    readings, as stored (``raw_``) and multiplied (``scaled_``), each with its own
    fare range, beside the sum and count of the batch mean. Counts, sums, minima and maxima are
    mergeable: cells of several scans or micro-batches add up, and a late file may still
    turn its batch. ``settled_fares`` makes the choice. The cells are bounded by
    batches x airports, not by the fares.
    """
    fare, miles = c("ITIN_FARE"), c("DISTANCE")
    measures = [F.count(F.lit(1)).alias("batch_rows"), F.sum(F.when(fare > 0, fare)).alias("batch_pos_sum"),
                F.count_if(fare > 0).alias("batch_pos_n")]
    for reading in READINGS:
        up = (lambda v: v) if reading == "raw" else (lambda v: v * factor)
        clean = fare.isNotNull() & (up(fare) > low) & (up(fare) < high)
        far = clean & miles.isNotNull() & (miles > 0)
        sums = {"fare": (up(fare), clean), "yield": (up(c("ITIN_YIELD")), clean), "pos_fare": (up(fare), far),
                "pos_dist": (miles, far), "pos_yield": (up(c("ITIN_YIELD")), far)}
        measures += [F.count_if(clean).alias(f"{reading}_n"), F.count_if(far).alias(f"{reading}_pos_n"),
                     F.min(F.when(clean, up(fare))).alias(f"{reading}_fare_min"),
                     F.max(F.when(clean, up(fare))).alias(f"{reading}_fare_max")]
        for name, (value, rows) in sums.items():
            measures += [F.sum(F.when(rows, value)).alias(f"{reading}_{name}_sum"),
                         F.count(F.when(rows, value)).alias(f"{reading}_{name}_n")]
    return fares.groupBy(*dict.fromkeys([*FARE_KEYS, *batch_keys])).agg(*measures)


def cell_batch_means(cells: DataFrame, batch_keys=BATCH_KEYS) -> DataFrame:
    """``batch_fare_means`` of the fares that went into ``cells``."""
    return cells.groupBy(*batch_keys).agg(
        F.try_divide(F.sum("batch_pos_sum"), F.sum("batch_pos_n")).alias("batch_avg_fare"),
        F.sum("batch_rows").alias("batch_rows"))


def settled_fares(cells: DataFrame, batch_keys=BATCH_KEYS, threshold: float = 50.0) -> DataFrame:
    """The summary of repaired, cleaned fares: of each cell the reading that its batch's mean asks for.

    The mean is a window over the cells of a batch, at most one per airport and
    period; null batch keys are a batch like any other.
    """
    batch = Window.partitionBy(*batch_keys)
    mean = F.try_divide(F.sum("batch_pos_sum").over(batch), F.sum("batch_pos_n").over(batch))
    known = cells.withColumn("batch_avg_fare", mean)
    fixed = batch_status(threshold) == "fixed"
    names = [m.removeprefix("raw_") for m in cells.columns if m.startswith("raw_")]
    return known.select(*FARE_KEYS, *[F.when(fixed, c(f"scaled_{m}")).otherwise(c(f"raw_{m}")).alias(m)
                                      for m in names]).where(c("n") > 0)


def fare_reports(f: DataFrame, t: dict) -> dict[str, DataFrame]:
    def origin(min_n):
        return (f.groupBy("ORIGIN")
                .agg(_avg("fare").alias("avg_fare_usd"), _avg("yield", 4).alias("avg_yield_per_mile"),
                     F.sum("n").alias("total_itineraries"))
                .where(c("total_itineraries") > min_n))

    base = origin(t["origin_fares"])
    return {
        "fare_by_year": (f.groupBy("YEAR")
                         .agg(_avg("fare").alias("avg_fare_usd"),
                              F.round(F.min("fare_min"), 2).alias("min_fare_usd"),
                              F.round(F.max("fare_max"), 2).alias("max_fare_usd"),
                              F.sum("n").alias("total_itineraries")).orderBy("YEAR")),
        "fare_by_quarter": (f.groupBy("QUARTER")
                            .agg(_avg("fare").alias("avg_fare_usd"),
                                 F.sum("n").alias("total_itineraries"))
                            .withColumn("quarter_label", quarter_label(c("QUARTER")))
                            .orderBy("QUARTER")),
        "most_expensive_airports": base.orderBy(F.desc("avg_fare_usd"), F.asc_nulls_last("ORIGIN")),
        "cheapest_airports": base.orderBy("avg_fare_usd", F.asc_nulls_last("ORIGIN")),
        "price_trend": (f.groupBy("YEAR", "QUARTER")
                        .agg(_avg("fare").alias("avg_fare_usd"),
                             F.sum("n").alias("total_itineraries")).orderBy("YEAR", "QUARTER")),
        "best_value_airports": (f.groupBy("ORIGIN")
                                .agg(_avg("pos_fare").alias("avg_fare_usd"),
                                     _avg("pos_dist", 0).alias("avg_distance_miles"),
                                     _avg("pos_yield", 4).alias("avg_cents_per_mile"),
                                     F.sum("pos_n").alias("total_itineraries"))
                                .where(c("total_itineraries") > t["origin_fares"])
                                .orderBy(F.asc_nulls_first("avg_cents_per_mile"),
                                         F.asc_nulls_last("ORIGIN"))),
        "fare_summary": f.agg(_avg("fare").alias("overall_avg_fare"),
                              F.round(F.min("fare_min"), 2).alias("overall_min_fare"),
                              F.round(F.max("fare_max"), 2).alias("overall_max_fare"),
                              F.sum("n").alias("total_records")),
        "fare_by_origin": (f.where(c("ORIGIN").isNotNull()).groupBy("ORIGIN")
                           .agg(_avg("fare").alias("hist_avg_fare"),
                                _avg("yield", 4).alias("hist_avg_yield"))),
    }


def weather_summary(weather: DataFrame) -> DataFrame:
    """One scan of the station-days keyed by (NAME, month)."""
    measures = [F.count(F.lit(1)).alias("n")]
    for col in ("PRCP", "SNOW", "TMAX", "TMIN", "AWND"):
        measures += _sum_n(col, col.lower())
    return (weather.withColumn("month", F.month(c("DATE").try_cast("date")))
            .groupBy("NAME", "month").agg(*measures))


def weather_reports(w: DataFrame) -> dict[str, DataFrame]:
    return {
        "weather_by_station": (
            w.groupBy("NAME")
            .agg(_avg("prcp", 4).alias("avg_daily_precipitation"),
                 _avg("snow", 4).alias("avg_daily_snow"), _avg("tmax").alias("avg_max_temp"),
                 _avg("tmin").alias("avg_min_temp"), _avg("awnd").alias("avg_wind_speed"),
                 F.sum("n").alias("days_recorded"))
            .orderBy(F.desc_nulls_last("avg_daily_precipitation"), F.asc_nulls_last("NAME"))),
        "seasonal_weather": (
            w.groupBy("month")
            .agg(_avg("prcp", 4).alias("avg_precipitation"), _avg("snow", 4).alias("avg_snowfall"),
                 _avg("tmax").alias("avg_max_temp"), _avg("awnd").alias("avg_wind_speed"))
            .orderBy("month")),
    }
