"""DuckDB oracle SQL for every registered relational query.

Each text defines the fixture views it needs as CTEs (same view SQL as the
Spark side) and computes the report with plain SQL. Conventions that keep
both engines bit-equal: rounding through the shortest decimal text of the
double (that is what Spark rounds half-up), weekday + 1, and
INTEGER / BIGINT casts where DuckDB widens types.
"""

from __future__ import annotations

from tarmac.operators.features import HISTORY_SPECS
from tarmac.plans.catalog import FIX, FOREST, FOREST_INPUTS, ORDERED
from tarmac.sources.testviews import duckdb_with


def R(expr: str, digits: int = 2) -> str:
    """Spark's ``round(double, d)``: half-up on the shortest decimal form of the double."""
    return f"CAST(round(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38,17)), {digits}) AS DOUBLE)"


def PCT(cond: str, total: str = "count(*)") -> str:
    return R(f"CAST(count(CASE WHEN {cond} THEN 1 END) AS DOUBLE) / {total} * 100")


BATCH_STATUS = ("CASE WHEN batch_avg_fare IS NULL THEN 'unclassified' WHEN batch_avg_fare < 50 "
                "THEN 'fixed' ELSE 'clean' END")

# Extra CTEs derived from the base views.
DERIVED = {
    "batch": "batch AS (SELECT YEAR, QUARTER, avg(CASE WHEN ITIN_FARE > 0 THEN ITIN_FARE END) "
             "AS batch_avg_fare, count(*) AS batch_rows FROM fares GROUP BY YEAR, QUARTER)",
    "rfares": "rfares AS (SELECT f.ROW_KEY, f.YEAR, f.QUARTER, f.ORIGIN, f.DISTANCE, "
              "CASE WHEN b.batch_avg_fare < 50 THEN f.ITIN_FARE * 100 ELSE f.ITIN_FARE END "
              "AS ITIN_FARE, CASE WHEN b.batch_avg_fare < 50 THEN f.ITIN_YIELD * 100 "
              "ELSE f.ITIN_YIELD END AS ITIN_YIELD FROM fares f LEFT JOIN batch b "
              "ON f.YEAR IS NOT DISTINCT FROM b.YEAR AND f.QUARTER IS NOT DISTINCT FROM b.QUARTER)",
    "cfares": "cfares AS (SELECT * FROM rfares WHERE ITIN_FARE IS NOT NULL AND ITIN_FARE > 10 "
              "AND ITIN_FARE < 5000)",
    "base": "base AS (SELECT ROW_KEY, OP_CARRIER, ORIGIN, DEST, "
            "CAST(month(FL_DATE) AS INTEGER) AS month, "
            "CAST(dayofweek(FL_DATE) + 1 AS INTEGER) AS day_of_week, "
            "CAST(floor(CAST(CRS_DEP_TIME AS DOUBLE) / 100.0) AS DOUBLE) AS dep_hour, "
            "CASE WHEN dayofweek(FL_DATE) + 1 IN (1, 7) THEN 1.0E0 ELSE 0.0E0 END AS is_weekend, "
            "CASE WHEN month(FL_DATE) IN (6, 7, 8) THEN 1.0E0 ELSE 0.0E0 END AS is_summer, "
            "CASE WHEN month(FL_DATE) IN (11, 12) THEN 1.0E0 ELSE 0.0E0 END AS is_holiday_season, "
            "CASE WHEN month(FL_DATE) IN (12, 1, 2) THEN 1.0E0 ELSE 0.0E0 END AS is_winter, "
            "DISTANCE, CRS_ELAPSED_TIME, coalesce(WEATHER_DELAY, 0.0) AS weather_delay_signal, "
            "DEP_DELAY FROM flights WHERE DEP_DELAY IS NOT NULL AND ORIGIN IS NOT NULL "
            "AND DEST IS NOT NULL AND OP_CARRIER IS NOT NULL AND DISTANCE IS NOT NULL "
            "AND CRS_DEP_TIME IS NOT NULL AND CRS_ELAPSED_TIME IS NOT NULL "
            "AND DEP_DELAY >= -30 AND DEP_DELAY <= 240 AND DISTANCE > 0 AND CRS_ELAPSED_TIME > 0)",
    "train": "train AS (SELECT * FROM base WHERE ROW_KEY % 10 < 8)",
    "test": "test AS (SELECT * FROM base WHERE ROW_KEY % 10 >= 8)",
    "route_stats": "route_stats AS (SELECT ORIGIN, DEST, " + R("avg(DEP_DELAY)") +
                   " AS hist_avg_dep_delay, " + R("avg(ARR_DELAY)") + " AS hist_avg_arr_delay, "
                   "count(*) AS total_flights FROM flights WHERE ORIGIN IS NOT NULL AND DEST IS "
                   f"NOT NULL AND DEP_DELAY IS NOT NULL GROUP BY ORIGIN, DEST HAVING count(*) > "
                   f"{FIX['route_statistics']})",
    "fbo": "fbo AS (SELECT ORIGIN, " + R("avg(ITIN_FARE)") + " AS hist_avg_fare, " +
           R("avg(ITIN_YIELD)", 4) + " AS hist_avg_yield FROM cfares WHERE ORIGIN IS NOT NULL "
           "GROUP BY ORIGIN)",
    "lookup": "lookup AS (SELECT ORIGIN, DEST, OP_CARRIER, count(*) AS total_flights, " +
              R("avg(DEP_DELAY)") + " AS avg_dep_delay_min, " + R("avg(ARR_DELAY)") +
              " AS avg_arr_delay_min, " + R("avg(WEATHER_DELAY)") + " AS avg_weather_delay, " +
              R("avg(CARRIER_DELAY)") + " AS avg_carrier_delay, " + PCT("DEP_DELAY > 15") +
              " AS pct_delayed_over_15min, " + PCT("CANCELLED = 1") +
              " AS cancellation_rate_pct FROM flights GROUP BY ORIGIN, DEST, OP_CARRIER "
              f"HAVING count(*) > {FIX['route_lookup']})",
    "nodes": "nodes AS (SELECT airport, outbound_routes, total_departures, avg_dep_delay, "
             "inbound_routes, total_arrivals, avg_arr_delay, "
             "outbound_routes + inbound_routes AS total_degree, "
             "total_departures + total_arrivals AS total_traffic, " +
             R("CAST(total_departures + total_arrivals AS DOUBLE) / 1000000 * "
               "(outbound_routes + inbound_routes)") + " AS network_importance_score FROM ("
             "SELECT coalesce(o.airport, i.airport) AS airport, "
             "coalesce(o.outbound_routes, 0) AS outbound_routes, "
             "coalesce(o.total_departures, 0) AS total_departures, "
             "coalesce(o.avg_dep_delay, 0.0) AS avg_dep_delay, "
             "coalesce(i.inbound_routes, 0) AS inbound_routes, "
             "coalesce(i.total_arrivals, 0) AS total_arrivals, "
             "coalesce(i.avg_arr_delay, 0.0) AS avg_arr_delay FROM "
             "(SELECT ORIGIN AS airport, count(DISTINCT DEST) AS outbound_routes, "
             "count(*) AS total_departures, " + R("avg(DEP_DELAY)") + " AS avg_dep_delay "
             "FROM flights GROUP BY ORIGIN) o FULL OUTER JOIN "
             "(SELECT DEST AS airport, count(DISTINCT ORIGIN) AS inbound_routes, "
             "count(*) AS total_arrivals, " + R("avg(ARR_DELAY)") + " AS avg_arr_delay "
             "FROM flights GROUP BY DEST) i ON o.airport = i.airport))",
    "edges": "edges AS (SELECT ORIGIN, DEST, count(*) AS flight_count, " + R("avg(DEP_DELAY)") +
             " AS avg_delay, " + R("avg(DISTANCE)", 0) + " AS avg_distance FROM flights "
             "GROUP BY ORIGIN, DEST)",
    "daily": "daily AS (SELECT CAST(dayofweek(FL_DATE) + 1 AS INTEGER) AS day_of_week, " +
             R("avg(DEP_DELAY)") + " AS avg_dep_delay FROM flights WHERE DEP_DELAY IS NOT NULL "
             "GROUP BY 1)",
    "recs": None,  # filled below (needs the constants)
    "carriers": None,
}

_fc, _vc = FIX["fare_cuts"], FIX["volume_cuts"]
DERIVED["recs"] = (
    "recs AS (SELECT *, CASE WHEN ensemble_score >= 0.75 THEN 'BUY' WHEN ensemble_score >= 0.45 "
    "THEN 'HOLD' ELSE 'AVOID' END AS recommendation FROM (SELECT *, " +
    R("delay_score * 0.5 + fare_score * 0.35 + volume_score * 0.15", 4) +
    " AS ensemble_score FROM (SELECT r.ORIGIN, r.DEST, r.hist_avg_dep_delay, "
    "r.hist_avg_arr_delay, r.total_flights, CASE WHEN r.hist_avg_dep_delay < 10 THEN 'LOW' "
    "WHEN r.hist_avg_dep_delay < 25 THEN 'MEDIUM' ELSE 'HIGH' END AS delay_risk, "
    "f.hist_avg_fare, f.hist_avg_yield, "
    "CASE WHEN r.hist_avg_dep_delay < 10 THEN 1.0E0 WHEN r.hist_avg_dep_delay < 25 THEN 0.5E0 "
    "ELSE 0.0E0 END AS delay_score, "
    f"CASE WHEN f.hist_avg_fare < {_fc[0]} THEN 1.0E0 WHEN f.hist_avg_fare < {_fc[1]} THEN 0.5E0 "
    "ELSE 0.0E0 END AS fare_score, "
    f"CASE WHEN r.total_flights >= {_vc[0]} THEN 1.0E0 WHEN r.total_flights >= {_vc[1]} "
    "THEN 0.75E0 ELSE 0.5E0 END AS volume_score "
    "FROM route_stats r LEFT JOIN fbo f ON r.ORIGIN = f.ORIGIN) s0) s1)")

# The carrier dimension, as in tarmac.sources.dimensions.
def _carriers_cte() -> str:
    from tarmac.sources.dimensions import CARRIERS
    rows = ", ".join(f"('{code}', '{name}')" for code, name in CARRIERS)
    return f"carriers AS (SELECT * FROM (VALUES {rows}) t(code, name))"


DERIVED["carriers"] = _carriers_cte()

# Which CTEs each derived CTE needs (base views first).
NEEDS = {
    "batch": ["fares"], "rfares": ["fares", "batch"], "cfares": ["fares", "batch", "rfares"],
    "base": ["flights"], "train": ["flights", "base"], "test": ["flights", "base"],
    "route_stats": ["flights"], "fbo": ["fares", "batch", "rfares", "cfares"],
    "lookup": ["flights"], "nodes": ["flights"], "edges": ["flights"], "daily": ["flights"],
    "recs": ["flights", "route_stats", "fares", "batch", "rfares", "cfares", "fbo"],
    "carriers": [],
}
DERIVED["daily_weather"] = (
    "station_days AS (SELECT m.airport, w.DATE - 6205 AS day, count(*) AS station_days, avg(PRCP) AS PRCP, "
    "avg(SNOW) AS SNOW, avg(TMAX) AS TMAX, avg(TMIN) AS TMIN, avg(AWND) AS AWND FROM weather w JOIN station_map m "
    "ON w.NAME = m.NAME GROUP BY 1, 2),\n"
    "daily_weather AS (SELECT f.*, s.station_days, s.PRCP, s.SNOW, s.TMAX, s.TMIN, s.AWND FROM ("
    "SELECT ORIGIN AS airport, FL_DATE AS day, count(*) AS flights, avg(DEP_DELAY) AS dep_delay, "
    "avg(WEATHER_DELAY) AS weather_delay FROM flights GROUP BY 1, 2) f "
    "LEFT JOIN station_days s ON f.airport = s.airport AND f.day = s.day)")
NEEDS["daily_weather"] = ["flights", "weather", "station_map"]
VIEW_NAMES = ["flights", "fares", "weather", "airports", "brand_carriers", "station_map"]


def sql(body: str, *ctes: str) -> str:
    """``WITH`` every needed view and derived CTE, then ``body``."""
    order: list[str] = []
    for name in ctes:
        for dep in NEEDS.get(name, []) + [name]:
            if dep not in order:
                order.append(dep)
    views = [n for n in VIEW_NAMES if n in order]
    derived = [n for n in order if n not in VIEW_NAMES]
    head = duckdb_with(*views) if views else "WITH "
    parts = [DERIVED[n] for n in derived]
    if views and parts:
        head = head.rstrip("\n") + ",\n"
    return head + ",\n".join(parts) + "\n" + body


def _traffic_top(n: int) -> str:
    return sql(
        "SELECT coalesce(d.airport, a.airport) AS airport, coalesce(d.departure_count, 0) AS "
        "departure_count, coalesce(a.arrival_count, 0) AS arrival_count, "
        "coalesce(d.departure_count, 0) + coalesce(a.arrival_count, 0) AS total_traffic "
        "FROM (SELECT ORIGIN AS airport, count(*) AS departure_count FROM flights GROUP BY ORIGIN) d "
        "FULL OUTER JOIN (SELECT DEST AS airport, count(*) AS arrival_count FROM flights "
        "GROUP BY DEST) a ON d.airport = a.airport "
        f"ORDER BY total_traffic DESC, airport ASC NULLS LAST LIMIT {n}", "flights")


def _delay_by(key: str, col: str, name: str, min_n: int) -> str:
    return sql(
        f"SELECT {key}, {R(f'avg({col})')} AS {name}, count(*) AS total_flights, "
        f"{PCT(f'{col} > 15')} AS pct_over_15min FROM flights WHERE {col} IS NOT NULL "
        f"GROUP BY {key} HAVING count(*) > {min_n}", "flights")


def _origin_fares(min_n: int) -> str:
    return sql(
        f"SELECT ORIGIN, {R('avg(ITIN_FARE)')} AS avg_fare_usd, {R('avg(ITIN_YIELD)', 4)} AS "
        f"avg_yield_per_mile, count(*) AS total_itineraries FROM cfares GROUP BY ORIGIN "
        f"HAVING count(*) > {min_n}", "cfares")


def _history(name: str) -> str:
    keys, source, out = HISTORY_SPECS[name]
    k = ", ".join(keys)
    return sql(f"SELECT {k}, {R(f'avg({source})', 6)} AS {out} FROM train GROUP BY {k}", "train")


RF_SELECT = (
    "SELECT OP_CARRIER, ORIGIN, DEST, CAST(month(FL_DATE) AS INTEGER) AS month, "
    "CAST(dayofweek(FL_DATE) + 1 AS INTEGER) AS day_of_week, "
    "CASE WHEN dayofweek(FL_DATE) + 1 IN (1, 7) THEN 1.0E0 ELSE 0.0E0 END AS is_weekend, "
    "CASE WHEN month(FL_DATE) IN (6, 7, 8) THEN 1.0E0 ELSE 0.0E0 END AS is_summer, "
    "CASE WHEN month(FL_DATE) IN (11, 12) THEN 1.0E0 ELSE 0.0E0 END AS is_holiday_season, "
    "CASE WHEN month(FL_DATE) IN (12, 1, 2) THEN 1.0E0 ELSE 0.0E0 END AS is_winter, "
    "DISTANCE, DEP_DELAY FROM flights WHERE DEP_DELAY IS NOT NULL AND ORIGIN IS NOT NULL "
    "AND DEST IS NOT NULL AND OP_CARRIER IS NOT NULL AND DISTANCE IS NOT NULL")

FARE_FEATURE_SELECT = (
    "SELECT ORIGIN, QUARTER, YEAR, DISTANCE, yield_per_mile, is_peak_quarter, ITIN_FARE FROM ("
    "SELECT ORIGIN, CAST(QUARTER AS DOUBLE) AS QUARTER, CAST(YEAR AS DOUBLE) AS YEAR, DISTANCE, "
    "ITIN_FARE, CASE WHEN ITIN_YIELD IS NOT NULL AND NOT isnan(ITIN_YIELD) AND ITIN_YIELD > 0 "
    "THEN ITIN_YIELD ELSE ITIN_FARE / DISTANCE END AS yield_per_mile, "
    "CASE WHEN QUARTER IN (2, 3) THEN 1.0E0 ELSE 0.0E0 END AS is_peak_quarter FROM rfares "
    "WHERE ITIN_FARE IS NOT NULL AND ORIGIN IS NOT NULL AND DISTANCE IS NOT NULL AND YEAR IS NOT "
    "NULL AND QUARTER IS NOT NULL AND ITIN_FARE > 10 AND ITIN_FARE < 5000 AND DISTANCE > 0) x "
    "WHERE yield_per_mile IS NOT NULL AND NOT isnan(yield_per_mile) AND yield_per_mile > 0 "
    "AND yield_per_mile < 1000")


def _delay_features() -> str:
    hist = {}
    for name, (keys, source, out) in HISTORY_SPECS.items():
        hist[name] = (f"h_{name} AS (SELECT {', '.join(keys)}, avg({source}) AS {out} "
                      f"FROM train GROUP BY {', '.join(keys)})")
    g = "g AS (SELECT avg(DEP_DELAY) AS gm FROM train)"
    joins = " ".join(
        f"LEFT JOIN h_{name} ON " + " AND ".join(f"b.{k} = h_{name}.{k}" for k in keys)
        for name, (keys, _, _) in HISTORY_SPECS.items())
    cols = ", ".join(
        (R(f"coalesce({out}, g.gm)", 6) if out != "origin_weather_delay_avg"
         else R(f"coalesce({out}, 0.0)", 6)) + f" AS {out}"
        for _, (_, _, out) in HISTORY_SPECS.items())
    body = ("SELECT b.OP_CARRIER, b.ORIGIN, b.DEST, b.month, b.day_of_week, b.dep_hour, "
            "b.is_weekend, b.is_summer, b.is_holiday_season, b.is_winter, b.DISTANCE, "
            "b.CRS_ELAPSED_TIME, b.weather_delay_signal, b.DEP_DELAY, " + cols +
            f" FROM base b CROSS JOIN g {joins}")
    text = sql(body, "train")
    extra = ",\n".join(list(hist.values()) + [g])
    return text.replace("\nSELECT b.OP_CARRIER", ",\n" + extra + "\nSELECT b.OP_CARRIER", 1)


def _model_eval() -> str:
    body = (
        "SELECT " + R("sqrt(avg((y - p) * (y - p)))") + " AS rmse, " + R("avg(abs(y - p))") +
        " AS mae, " + R("1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*))", 4) + " AS r2 "
        "FROM (SELECT t.DEP_DELAY AS y, coalesce(r.m, g.gm) AS p FROM test t "
        "LEFT JOIN (SELECT ORIGIN, DEST, avg(DEP_DELAY) AS m FROM train GROUP BY ORIGIN, DEST) r "
        "ON t.ORIGIN = r.ORIGIN AND t.DEST = r.DEST "
        "CROSS JOIN (SELECT avg(DEP_DELAY) AS gm FROM train) g) e")
    return sql(body, "train", "test")


def _metrics_comparison() -> str:
    def metrics(name: str, p: str) -> str:
        return (f"SELECT {R('sqrt(avg((y - ' + p + ') * (y - ' + p + ')))')} AS {name}_rmse, "
                f"{R('avg(abs(y - ' + p + '))')} AS {name}_mae, "
                + R(f"1 - sum((y - {p}) * (y - {p})) / (var_pop(y) * count(*))", 4) + f" AS {name}_r2 FROM e")
    body = (
        "SELECT b.*, i.*, " + R("improved_v2_rmse - baseline_rmse") + " AS rmse_change, " +
        R("improved_v2_mae - baseline_mae") + " AS mae_change, " +
        R("improved_v2_r2 - baseline_r2", 4) + " AS r2_change FROM (" +
        metrics("baseline", "gm") + ") b CROSS JOIN (" + metrics("improved_v2", "p") + ") i")
    errors = (
        "e AS (SELECT t.DEP_DELAY AS y, coalesce(r.m, g.gm) AS p, g.gm FROM test t "
        "LEFT JOIN (SELECT ORIGIN, DEST, avg(DEP_DELAY) AS m FROM train GROUP BY ORIGIN, DEST) r "
        "ON t.ORIGIN = r.ORIGIN AND t.DEST = r.DEST "
        "CROSS JOIN (SELECT avg(DEP_DELAY) AS gm FROM train) g)")
    return sql("SELECT * FROM (WITH " + errors + " " + body + ") x", "train", "test")


def _index_tables() -> str:
    def one(column: str, label: str, source: str) -> str:
        return (f"SELECT '{column}' AS column_name, {label} AS label, CAST(row_number() OVER "
                f"(ORDER BY count(*) DESC, {label}) - 1 AS DOUBLE) AS idx FROM {source} GROUP BY {label}")
    body = " UNION ALL ".join([one("ORIGIN", "ORIGIN", "train"), one("DEST", "DEST", "train"),
                               one("FARE_ORIGIN", "ORIGIN", f"({FARE_FEATURE_SELECT}) f")])
    return sql(body, "train", "rfares")


def _record_counts() -> str:
    parts = [
        ("flights", "SELECT count(*) FROM flights"),
        ("fares", "SELECT count(*) FROM fares"),
        ("clean_fares", "SELECT count(*) FROM cfares"),
        ("weather", "SELECT count(*) FROM weather"),
        ("rf_features", f"SELECT count(*) FROM ({RF_SELECT}) x"),
        ("fare_features", f"SELECT count(*) FROM ({FARE_FEATURE_SELECT}) x"),
        ("delay_base", "SELECT count(*) FROM base"),
    ]
    body = " UNION ALL ".join(f"SELECT '{n}' AS table_name, ({q}) AS row_count"
                              for n, q in parts)
    return sql(body, "flights", "weather", "cfares", "base")


def _route_report(requests: str = "SELECT ORIGIN, DEST, max(FL_DATE) AS travel_date FROM flights WHERE ORIGIN IS "
                                  "NOT NULL AND DEST IS NOT NULL GROUP BY ORIGIN, DEST") -> str:
    body = (
        "SELECT q.ORIGIN, q.DEST, q.travel_date, "
        "CAST(dayofweek(q.travel_date) + 1 AS INTEGER) AS day_of_week, "
        "dayofweek(q.travel_date) + 1 IN (1, 7) AS is_weekend, "
        "r.hist_avg_dep_delay AS expected_delay_min, r.hist_avg_fare AS estimated_fare_usd, "
        "r.delay_risk, r.ensemble_score, r.recommendation, dd.avg_dep_delay AS weekday_avg_delay, "
        "b.carriers_on_route, b.best_carrier FROM "
        f"({requests}) q "
        "LEFT JOIN recs r ON q.ORIGIN = r.ORIGIN AND q.DEST = r.DEST "
        "LEFT JOIN (SELECT ORIGIN, DEST, count(*) AS carriers_on_route, "
        "min(CASE WHEN rn = 1 THEN OP_CARRIER END) AS best_carrier FROM "
        "(SELECT *, row_number() OVER (PARTITION BY ORIGIN, DEST ORDER BY avg_dep_delay_min "
        "ASC NULLS LAST, OP_CARRIER ASC NULLS LAST) AS rn FROM lookup) l GROUP BY ORIGIN, DEST) b "
        "ON q.ORIGIN = b.ORIGIN AND q.DEST = b.DEST "
        "LEFT JOIN daily dd ON dd.day_of_week = CAST(dayofweek(q.travel_date) + 1 AS INTEGER)")
    return sql(body, "recs", "lookup", "daily")


def _bundle_sections() -> str:
    f = FIX
    counts = [
        ("airports", "SELECT least(count(*), 24) FROM nodes"),
        ("busiest_routes", "SELECT least(count(*), 50) FROM edges"),
        ("route_lookup", "SELECT least(count(*), 5000) FROM lookup"),
        ("carrier_names", "SELECT count(*) FROM carriers"),
        ("fare_by_year", "SELECT count(DISTINCT YEAR) FROM cfares"),
        ("fare_by_quarter", "SELECT count(DISTINCT QUARTER) FROM cfares"),
        ("monthly_delays", "SELECT count(DISTINCT month(FL_DATE)) FROM flights "
                           "WHERE DEP_DELAY IS NOT NULL"),
        ("daily_delays", "SELECT count(*) FROM daily"),
        ("delay_causes", "SELECT 1"),
        ("most_expensive", f"SELECT count(*) FROM (SELECT ORIGIN FROM cfares GROUP BY ORIGIN "
                           f"HAVING count(*) > {f['origin_fares']}) x"),
        ("cheapest", f"SELECT count(*) FROM (SELECT ORIGIN FROM cfares GROUP BY ORIGIN "
                     f"HAVING count(*) > {f['origin_fares']}) x"),
        ("best_value", f"SELECT count(*) FROM (SELECT ORIGIN FROM cfares WHERE DISTANCE IS NOT "
                       f"NULL AND DISTANCE > 0 GROUP BY ORIGIN HAVING count(*) > "
                       f"{f['origin_fares']}) x"),
        ("worst_weather", f"SELECT count(*) FROM (SELECT ORIGIN FROM flights GROUP BY ORIGIN "
                          f"HAVING count(*) > {f['worst_weather_airports']}) x"),
        ("top_dep_delays", f"SELECT count(*) FROM (SELECT ORIGIN FROM flights WHERE DEP_DELAY "
                           f"IS NOT NULL GROUP BY ORIGIN HAVING count(*) > "
                           f"{f['top_dep_delays']}) x"),
        ("top_arr_delays", f"SELECT count(*) FROM (SELECT DEST FROM flights WHERE ARR_DELAY "
                           f"IS NOT NULL GROUP BY DEST HAVING count(*) > "
                           f"{f['top_arr_delays']}) x"),
    ]
    body = " UNION ALL ".join(f"SELECT '{n}' AS section, CAST(({q}) AS BIGINT) AS row_count"
                              for n, q in counts)
    return sql(body, "nodes", "edges", "lookup", "carriers", "cfares", "daily")



def _desc(*parts: str) -> str:
    return ", ".join(f"{p} DESC NULLS LAST" if i == 0 else f"{p} ASC NULLS LAST" for i, p in enumerate(parts))


REPORT_ORDER = {
    "airport_traffic_top": _desc("total_traffic", "airport"),
    "most_departures": _desc("total_departures", "ORIGIN"), "most_arrivals": _desc("total_arrivals", "DEST"),
    "busiest_airports": _desc("total_traffic", "airport"),
    "top_dep_delays": _desc("avg_dep_delay_min", "ORIGIN"), "top_arr_delays": _desc("avg_arr_delay_min", "DEST"),
    "monthly_delays": "month ASC NULLS FIRST", "daily_delays": "day_of_week ASC NULLS FIRST",
    "cancellation_rates": _desc("cancellation_rate_pct", "OP_CARRIER"),
    "fare_by_year": "YEAR ASC NULLS FIRST", "fare_by_quarter": "QUARTER ASC NULLS FIRST",
    "most_expensive_airports": _desc("avg_fare_usd", "ORIGIN"),
    "cheapest_airports": "avg_fare_usd ASC NULLS FIRST, ORIGIN ASC NULLS LAST",
    "price_trend": "YEAR ASC NULLS FIRST, QUARTER ASC NULLS FIRST",
    "best_value_airports": "avg_cents_per_mile ASC NULLS FIRST, ORIGIN ASC NULLS LAST",
    "fare_batch_audit": "YEAR ASC NULLS FIRST, QUARTER ASC NULLS FIRST",
    "weather_by_station": _desc("avg_daily_precipitation", "NAME"), "seasonal_weather": "month ASC NULLS FIRST",
    "weather_delays_by_airport": _desc("avg_weather_delay_min", "ORIGIN"),
    "weather_delays_by_month": "month ASC NULLS FIRST",
    "worst_weather_airports": _desc("avg_weather_delay_min", "ORIGIN"),
    "airport_nodes": _desc("total_traffic", "airport"), "route_edges": _desc("flight_count", "ORIGIN", "DEST"),
    "route_recommendations": "ensemble_score DESC NULLS LAST, total_flights DESC NULLS LAST, "
                             "ORIGIN ASC NULLS LAST, DEST ASC NULLS LAST",
    "airport_nodes_geo": _desc("total_traffic", "code"), "busiest_routes": _desc("flight_count", "origin", "dest"),
    "route_lookup_export": _desc("total_flights", "origin", "dest", "carrier"),
    "delay_causes": "avg_weather_delay_min",
}


def _report_positions(q: dict[str, str]) -> str:
    parts = []
    for name, keys in ORDERED.items():
        key = ", ".join(f"coalesce(CAST({k} AS VARCHAR), 'null')" for k in keys)
        parts.append(f"SELECT '{name}' AS report, row_number() OVER (ORDER BY {REPORT_ORDER[name]}) AS position, "
                     f"concat_ws('|', {key}) AS key FROM ({q[name]}) r")
    return " UNION ALL ".join(parts)


#: The bundle's sections: report, then its fields as written, d: fractional, i: whole, s: text.
BUNDLE_FIELDS = {
    "airports": ("airport_nodes_geo", "code:s lat:d lon:d state:s total_departures:i total_arrivals:i "
                 "total_traffic:i outbound_routes:i avg_dep_delay:d avg_arr_delay:d network_score:d"),
    "busiest_routes": ("busiest_routes", "origin:s dest:s flight_count:i avg_delay:d avg_distance:d"),
    "route_lookup": ("route_lookup_export", "origin:s dest:s carrier:s total_flights:i avg_dep_delay:d "
                     "avg_arr_delay:d avg_weather_delay:d avg_carrier_delay:d pct_delayed:d cancellation_rate:d"),
    "fare_by_year": ("fare_by_year", "YEAR:i avg_fare_usd:d min_fare_usd:d max_fare_usd:d total_itineraries:i"),
    "fare_by_quarter": ("fare_by_quarter", "QUARTER:i avg_fare_usd:d total_itineraries:i quarter_label:s"),
    "monthly_delays": ("monthly_delays", "month:i avg_dep_delay:d"),
    "daily_delays": ("daily_delays", "day_of_week:i avg_dep_delay:d"),
    "delay_causes": ("delay_causes", "avg_carrier_delay_min:d avg_weather_delay_min:d avg_nas_delay_min:d "
                     "avg_security_delay_min:d avg_late_aircraft_min:d"),
    "most_expensive": ("most_expensive_airports", "ORIGIN:s avg_fare_usd:d avg_yield_per_mile:d total_itineraries:i"),
    "cheapest": ("cheapest_airports", "ORIGIN:s avg_fare_usd:d avg_yield_per_mile:d total_itineraries:i"),
    "best_value": ("best_value_airports", "ORIGIN:s avg_fare_usd:d avg_distance_miles:d avg_cents_per_mile:d "
                   "total_itineraries:i"),
    "worst_weather": ("worst_weather_airports", "ORIGIN:s avg_weather_delay_min:d pct_severe_weather_delay:d "
                      "total_flights:i"),
    "top_dep_delays": ("top_dep_delays", "ORIGIN:s avg_dep_delay_min:d total_flights:i pct_over_15min:d"),
    "top_arr_delays": ("top_arr_delays", "DEST:s avg_arr_delay_min:d total_flights:i pct_over_15min:d"),
}


def _json_text(fields: str) -> str:
    """One record as JSON: missing numbers 0, fractional ones with four digits."""
    def text(field: str) -> str:
        name, kind = field.split(":")
        value = {"s": f"'\"' || replace(replace({name}, '\\', '\\\\'), '\"', '\\\"') || '\"'",
                 "i": f"CAST(coalesce({name}, 0) AS VARCHAR)",
                 "d": f"CAST(CAST(coalesce({name}, 0.0) AS DECIMAL(28,4)) AS VARCHAR)"}[kind]
        return f"'\"{name}\":' || coalesce({value}, 'null')"
    return "'{' || " + " || ',' || ".join(text(f) for f in fields.split()) + " || '}'"


def _bundle_records(q: dict[str, str]) -> str:
    parts = [f"SELECT '{section}' AS section, row_number() OVER (ORDER BY {REPORT_ORDER[report]}) AS position, "
             f"{_json_text(fields)} AS record FROM ({q[report]}) r"
             for section, (report, fields) in BUNDLE_FIELDS.items()]
    names = sql("SELECT code, name FROM brand_carriers", "brand_carriers")
    parts.append("SELECT 'carrier_names' AS section, row_number() OVER (ORDER BY code) AS position, " +
                 _json_text("code:s name:s") + f" AS record FROM ({names}) r")
    return " UNION ALL ".join(parts)


def _in_share(fraction: float, draw: int = 0) -> str:
    return (f"CAST('0x' || substr(md5('42|' || CAST(ROW_KEY AS VARCHAR)), {1 + 8 * draw}, 8) AS BIGINT) < "
            f"{round(fraction * 2 ** 32)}")


def _sampled_rows() -> str:
    parts = [f"SELECT '{model}' AS model, ROW_KEY, {_in_share(0.8, 1)} AS in_train FROM {view} "
             f"WHERE {_in_share(fraction)}"
             for model, view, fraction in (("delay_rf", "flights", 0.4), ("fare_gbt", "fares", 0.4),
                                           ("delay_gbt", "flights", 0.2))]
    return sql(" UNION ALL ".join(parts), "flights", "fares")


FOREST_ROWS = ("(SELECT ROW_KEY, DISTANCE, dep_hour, month, is_weekend, "
               "CAST(right(OP_CARRIER, 1) AS DOUBLE) AS carrier_digit FROM base) x")


def _left(split: tuple) -> str:
    feature, cut = split[:2]
    return (f"{feature} IN ({', '.join(str(float(v)) for v in sorted(cut))})" if isinstance(cut, set)
            else f"{feature} <= {cut}")


def _forest_scores() -> str:
    def tree(nodes: dict, i: int) -> str:
        node = nodes[i]
        if not isinstance(node, tuple):
            return f"CAST({node} AS DOUBLE)"
        return f"CASE WHEN {_left(node)} THEN {tree(nodes, node[2])} ELSE {tree(nodes, node[3])} END"
    total = " + ".join(f"CAST({weight} AS DOUBLE) * ({tree(nodes, 0)})" for weight, nodes in FOREST)
    return sql(f"SELECT ROW_KEY, {R(total, 6)} AS prediction FROM {FOREST_ROWS}", "base")


def _forest_importances() -> str:
    rows = []

    def walk(t: int, nodes: dict, i: int, path: str) -> None:
        node = nodes[i]
        if isinstance(node, tuple):
            rows.append(f"SELECT {t} AS tree, '{node[0]}' AS feature, {node[4]} * count(CASE WHEN {path} THEN 1 END) "
                        f"AS g FROM {FOREST_ROWS}")
            walk(t, nodes, node[2], f"{path} AND {_left(node)}")
            walk(t, nodes, node[3], f"{path} AND NOT ({_left(node)})")
    for t, (_, nodes) in enumerate(FOREST):
        walk(t, nodes, 0, "TRUE")
    names = " UNION ALL ".join(f"SELECT '{name}' AS feature" for name in FOREST_INPUTS)
    body = (f"SELECT n.feature, {R('coalesce(s.g / s.whole, 0.0)', 6)} AS importance FROM ({names}) n LEFT JOIN ("
            "SELECT feature, sum(share) AS g, sum(sum(share)) OVER () AS whole FROM ("
            "SELECT feature, g / sum(g) OVER (PARTITION BY tree) AS share FROM (" + " UNION ALL ".join(rows) +
            ") a) b GROUP BY feature) s ON n.feature = s.feature")
    return sql(body, "base")


def _malformed_values() -> str:
    spoiled = [("DEP_DELAY", 97, "'n/a'", "double"), ("FL_DATE", 101, "'someday'", "date"),
               ("DISTANCE", 103, "CAST(DISTANCE AS VARCHAR) || ' mi'", "double")]
    parts = [f"SELECT ROW_KEY AS row_key, '{name}' AS column_name, {text} AS text, 'not {kind}' AS reason "
             f"FROM flights WHERE ROW_KEY % {every} = 0" for name, every, text, kind in spoiled]
    good = " AND ".join(f"ROW_KEY % {every} <> 0" for _, every, _, _ in spoiled)
    parts.append(f"SELECT NULL AS row_key, 'kept' AS column_name, CAST(count(*) AS VARCHAR) AS text, "
                 f"NULL AS reason FROM flights WHERE {good}")
    return sql(" UNION ALL ".join(parts), "flights")


def _flight_weather() -> str:
    measures = {"dep_delay": 2, "weather_delay": 2, "PRCP": 4, "SNOW": 4, "TMAX": 2, "TMIN": 2, "AWND": 2}
    columns = ", ".join(f"{R(m, digits)} AS {m}" for m, digits in measures.items())
    return sql(f"SELECT airport, day, flights, station_days, {columns} FROM daily_weather", "daily_weather")


def _weather_corr() -> str:
    def one(m: str) -> str:
        both = f"CASE WHEN {m} IS NOT NULL AND dep_delay IS NOT NULL THEN"
        flat = f"coalesce(var_pop({both} {m} END), 0) = 0 OR coalesce(var_pop({both} dep_delay END), 0) = 0"
        return f"CASE WHEN {flat} THEN NULL ELSE {R(f'corr({m}, dep_delay)', 6)} END AS corr_{m.lower()}"
    columns = ", ".join(one(m) for m in ("PRCP", "SNOW", "TMAX", "TMIN", "AWND"))
    return sql(f"SELECT airport, count(*) AS days, {columns} FROM daily_weather WHERE airport IS NOT NULL "
               f"GROUP BY airport UNION ALL SELECT NULL AS airport, count(*) AS days, {columns} FROM daily_weather "
               "WHERE airport IS NOT NULL", "daily_weather")


def oracle_sql() -> dict[str, str]:
    st = FIX["state"]
    q = {
        "airport_traffic_top": _traffic_top(25),
        "most_departures": sql("SELECT ORIGIN, count(*) AS total_departures FROM flights "
                               "GROUP BY ORIGIN", "flights"),
        "most_arrivals": sql("SELECT DEST, count(*) AS total_arrivals FROM flights "
                             "GROUP BY DEST", "flights"),
        "busiest_airports": sql(
            "SELECT airport, CAST(sum(n) AS BIGINT) AS total_traffic FROM ("
            "SELECT ORIGIN AS airport, count(*) AS n FROM flights GROUP BY ORIGIN UNION ALL "
            "SELECT DEST AS airport, count(*) AS n FROM flights GROUP BY DEST) u "
            "GROUP BY airport", "flights"),
        "top_dep_delays": _delay_by("ORIGIN", "DEP_DELAY", "avg_dep_delay_min",
                                    FIX["top_dep_delays"]),
        "top_arr_delays": _delay_by("DEST", "ARR_DELAY", "avg_arr_delay_min",
                                    FIX["top_arr_delays"]),
        "delay_causes": sql(
            f"SELECT {R('avg(CARRIER_DELAY)')} AS avg_carrier_delay_min, "
            f"{R('avg(WEATHER_DELAY)')} AS avg_weather_delay_min, "
            f"{R('avg(NAS_DELAY)')} AS avg_nas_delay_min, "
            f"{R('avg(SECURITY_DELAY)')} AS avg_security_delay_min, "
            f"{R('avg(LATE_AIRCRAFT_DELAY)')} AS avg_late_aircraft_min FROM flights", "flights"),
        "monthly_delays": sql(
            f"SELECT CAST(month(FL_DATE) AS INTEGER) AS month, {R('avg(DEP_DELAY)')} AS "
            "avg_dep_delay FROM flights WHERE DEP_DELAY IS NOT NULL GROUP BY 1", "flights"),
        "daily_delays": sql("SELECT * FROM daily", "daily"),
        "cancellation_rates": sql(
            f"SELECT OP_CARRIER, {R('avg(CAST(CANCELLED AS DOUBLE)) * 100')} AS "
            "cancellation_rate_pct, count(*) AS total_flights FROM flights GROUP BY OP_CARRIER "
            f"HAVING count(*) > {FIX['cancellation_rates']}", "flights"),
        "airports_list": sql("SELECT code, name, state FROM airports", "airports"),
        "airport_count": sql("SELECT count(*) AS airport_count FROM airports", "airports"),
        "airport_codes": sql("SELECT code FROM airports", "airports"),
        "airports_in_state": sql(f"SELECT code, name FROM airports WHERE state = '{st}'",
                                 "airports"),
        "airport_pairs": sql("SELECT code, name FROM airports ORDER BY code LIMIT 5", "airports"),
        "airports_by_state": sql(
            "SELECT state, string_agg(code, ',' ORDER BY code) AS codes, count(*) AS "
            "airport_count FROM airports GROUP BY state", "airports"),
        "fare_scale_repair": sql("SELECT * FROM rfares", "rfares"),
        "fare_batch_audit": sql(
            f"SELECT YEAR, QUARTER, {R('batch_avg_fare')} AS batch_avg_fare, batch_rows, "
            f"{BATCH_STATUS} AS status, " +
            R("CASE WHEN batch_avg_fare < 50 THEN batch_avg_fare * 100 ELSE batch_avg_fare END") +
            " AS repaired_avg_fare FROM batch", "batch"),
        "fare_batch_status": sql(
            f"SELECT {BATCH_STATUS} AS status, "
            "count(*) AS batches, CAST(sum(batch_rows) AS BIGINT) AS rows FROM batch GROUP BY 1",
            "batch"),
        "fare_by_year": sql(
            f"SELECT YEAR, {R('avg(ITIN_FARE)')} AS avg_fare_usd, {R('min(ITIN_FARE)')} AS "
            f"min_fare_usd, {R('max(ITIN_FARE)')} AS max_fare_usd, count(*) AS "
            "total_itineraries FROM cfares GROUP BY YEAR", "cfares"),
        "fare_by_quarter": sql(
            f"SELECT QUARTER, {R('avg(ITIN_FARE)')} AS avg_fare_usd, count(*) AS "
            "total_itineraries, CASE QUARTER WHEN 1 THEN 'Q1 Jan-Mar' WHEN 2 THEN 'Q2 Apr-Jun' "
            "WHEN 3 THEN 'Q3 Jul-Sep' WHEN 4 THEN 'Q4 Oct-Dec' END AS quarter_label "
            "FROM cfares GROUP BY QUARTER", "cfares"),
        "most_expensive_airports": _origin_fares(FIX["origin_fares"]),
        "cheapest_airports": _origin_fares(FIX["origin_fares"]),
        "price_trend": sql(
            f"SELECT YEAR, QUARTER, {R('avg(ITIN_FARE)')} AS avg_fare_usd, count(*) AS "
            "total_itineraries FROM cfares GROUP BY YEAR, QUARTER", "cfares"),
        "best_value_airports": sql(
            f"SELECT ORIGIN, {R('avg(ITIN_FARE)')} AS avg_fare_usd, {R('avg(DISTANCE)', 0)} AS "
            f"avg_distance_miles, {R('avg(ITIN_YIELD)', 4)} AS avg_cents_per_mile, count(*) AS "
            "total_itineraries FROM cfares WHERE DISTANCE IS NOT NULL AND DISTANCE > 0 "
            f"GROUP BY ORIGIN HAVING count(*) > {FIX['origin_fares']}", "cfares"),
        "fare_summary": sql(
            f"SELECT {R('avg(ITIN_FARE)')} AS overall_avg_fare, {R('min(ITIN_FARE)')} AS "
            f"overall_min_fare, {R('max(ITIN_FARE)')} AS overall_max_fare, count(*) AS "
            "total_records FROM cfares", "cfares"),
        "fare_by_origin": sql("SELECT * FROM fbo", "fbo"),
        "weather_by_station": sql(
            f"SELECT NAME, {R('avg(PRCP)', 4)} AS avg_daily_precipitation, {R('avg(SNOW)', 4)} "
            f"AS avg_daily_snow, {R('avg(TMAX)')} AS avg_max_temp, {R('avg(TMIN)')} AS "
            f"avg_min_temp, {R('avg(AWND)')} AS avg_wind_speed, count(*) AS days_recorded "
            "FROM weather GROUP BY NAME", "weather"),
        "weather_delays_by_airport": sql(
            f"SELECT ORIGIN, {R('avg(WEATHER_DELAY)')} AS avg_weather_delay_min, count(*) AS "
            f"weather_delayed_flights, {R('max(WEATHER_DELAY)')} AS max_weather_delay_min "
            "FROM flights WHERE WEATHER_DELAY IS NOT NULL AND WEATHER_DELAY > 0 GROUP BY ORIGIN "
            f"HAVING count(*) > {FIX['weather_delays_by_airport']}", "flights"),
        "weather_delays_by_month": sql(
            f"SELECT CAST(month(FL_DATE) AS INTEGER) AS month, {R('avg(WEATHER_DELAY)')} AS "
            f"avg_weather_delay, {R('avg(DEP_DELAY)')} AS avg_total_delay, count(*) AS "
            "total_flights FROM flights WHERE WEATHER_DELAY IS NOT NULL GROUP BY 1", "flights"),
        "worst_weather_airports": sql(
            f"SELECT ORIGIN, {R('avg(WEATHER_DELAY)')} AS avg_weather_delay_min, "
            f"{PCT('WEATHER_DELAY > 30')} AS pct_severe_weather_delay, count(*) AS total_flights "
            f"FROM flights GROUP BY ORIGIN HAVING count(*) > {FIX['worst_weather_airports']}",
            "flights"),
        "delay_type_breakdown": sql(
            f"SELECT {PCT('WEATHER_DELAY > 0')} AS pct_weather_caused, "
            f"{PCT('CARRIER_DELAY > 0')} AS pct_carrier_caused, "
            f"{PCT('NAS_DELAY > 0')} AS pct_nas_caused, "
            f"{PCT('LATE_AIRCRAFT_DELAY > 0')} AS pct_late_aircraft_caused, "
            f"{PCT('SECURITY_DELAY > 0')} AS pct_security_caused FROM flights", "flights"),
        "seasonal_weather": sql(
            f"SELECT CAST(month(DATE) AS INTEGER) AS month, {R('avg(PRCP)', 4)} AS "
            f"avg_precipitation, {R('avg(SNOW)', 4)} AS avg_snowfall, {R('avg(TMAX)')} AS "
            f"avg_max_temp, {R('avg(AWND)')} AS avg_wind_speed FROM weather GROUP BY 1",
            "weather"),
        "route_statistics": sql(
            "SELECT *, CASE WHEN hist_avg_dep_delay < 10 THEN 'LOW' WHEN hist_avg_dep_delay < 25 "
            "THEN 'MEDIUM' ELSE 'HIGH' END AS delay_risk FROM route_stats", "route_stats"),
        "route_recommendations": sql("SELECT * FROM recs", "recs"),
        "airport_nodes": sql("SELECT * FROM nodes", "nodes"),
        "route_edges": sql("SELECT * FROM edges", "edges"),
        "route_lookup": sql("SELECT * FROM lookup", "lookup"),
        "airport_nodes_geo": sql(
            "SELECT n.airport AS code, CASE WHEN a.code IS NULL THEN 0.0E0 ELSE a.lat END AS lat, "
            "CASE WHEN a.code IS NULL THEN 0.0E0 ELSE a.lon END AS lon, "
            "CASE WHEN a.code IS NULL THEN 'Unknown' ELSE a.state END AS state, "
            "n.total_departures, n.total_arrivals, n.total_traffic, n.outbound_routes, "
            "n.avg_dep_delay, n.avg_arr_delay, n.network_importance_score AS network_score "
            "FROM (SELECT * FROM nodes ORDER BY total_traffic DESC, airport ASC NULLS LAST "
            "LIMIT 24) n LEFT JOIN airports a ON n.airport = a.code", "nodes", "airports"),
        "busiest_routes": sql(
            "SELECT ORIGIN AS origin, DEST AS dest, flight_count, coalesce(avg_delay, 0.0) AS "
            "avg_delay, coalesce(avg_distance, 0.0) AS avg_distance FROM edges ORDER BY "
            "flight_count DESC, ORIGIN ASC NULLS LAST, DEST ASC NULLS LAST LIMIT 50", "edges"),
        "route_lookup_export": sql(
            "SELECT ORIGIN AS origin, DEST AS dest, OP_CARRIER AS carrier, total_flights, "
            "coalesce(avg_dep_delay_min, 0.0) AS avg_dep_delay, coalesce(avg_arr_delay_min, 0.0) "
            "AS avg_arr_delay, coalesce(avg_weather_delay, 0.0) AS avg_weather_delay, "
            "coalesce(avg_carrier_delay, 0.0) AS avg_carrier_delay, "
            "coalesce(pct_delayed_over_15min, 0.0) AS pct_delayed, "
            "coalesce(cancellation_rate_pct, 0.0) AS cancellation_rate FROM lookup ORDER BY "
            "total_flights DESC, ORIGIN ASC NULLS LAST, DEST ASC NULLS LAST, "
            "OP_CARRIER ASC NULLS LAST LIMIT 5000", "lookup"),
        "carrier_comparison": sql(
            "SELECT l.ORIGIN, l.DEST, l.OP_CARRIER, c.name AS carrier_name, l.total_flights, "
            "l.avg_dep_delay_min, l.avg_arr_delay_min, l.pct_delayed_over_15min, "
            "l.cancellation_rate_pct, CAST(row_number() OVER (PARTITION BY l.ORIGIN, l.DEST "
            "ORDER BY l.avg_dep_delay_min ASC NULLS LAST, l.OP_CARRIER ASC NULLS LAST) AS INTEGER) "
            "AS rank_on_route FROM lookup l LEFT JOIN brand_carriers c ON l.OP_CARRIER = c.code",
            "lookup", "brand_carriers"),
        "route_report": _route_report(),
        "route_requests": _route_report(
            "SELECT ORIGIN, CASE WHEN ROW_KEY % 3 = 0 THEN 'NOWHERE' ELSE DEST END AS DEST, CASE WHEN ROW_KEY % 4 > 0 "
            "THEN FL_DATE END AS travel_date FROM flights WHERE ROW_KEY % 50 = 0"),
        "rf_features": sql(RF_SELECT, "flights"),
        "fare_features": sql(FARE_FEATURE_SELECT, "rfares"),
        "delay_features": _delay_features(),
        "carrier_index": sql(
            "SELECT OP_CARRIER, CAST(row_number() OVER (ORDER BY count(*) DESC, OP_CARRIER) - 1 "
            "AS DOUBLE) AS carrier_idx FROM train GROUP BY OP_CARRIER", "train"),
        "category_cardinality": sql(
            "SELECT num_origins, num_dests, num_carriers, CAST((floor((greatest(num_origins, "
            "num_dests, num_carriers) + 50) / 128) + 1) * 128 AS BIGINT) AS max_bins FROM ("
            "SELECT count(DISTINCT ORIGIN) AS num_origins, count(DISTINCT DEST) AS num_dests, "
            f"count(DISTINCT OP_CARRIER) AS num_carriers FROM ({RF_SELECT}) x) y", "flights"),
        "fare_cardinality": sql(
            "SELECT num_fare_origins, CAST((floor(num_fare_origins / 128) + 1) * 128 AS BIGINT) "
            "AS max_bins FROM (SELECT count(DISTINCT ORIGIN) AS num_fare_origins FROM "
            f"({FARE_FEATURE_SELECT}) x) y", "rfares"),
        "model_eval": _model_eval(),
        "index_tables": _index_tables(),
        "metrics_comparison": _metrics_comparison(),
        "assembled_features": sql(
            "SELECT ROW_KEY, CAST(month AS DOUBLE) AS f0, CAST(day_of_week AS DOUBLE) AS f1, dep_hour AS f2, "
            "is_weekend AS f3, DISTANCE AS f4, CAST(weather_delay_signal AS DOUBLE) AS f5 FROM base", "base"),
        "sampled_rows": _sampled_rows(),
        "flight_weather_daily": _flight_weather(),
        "weather_delay_corr": _weather_corr(),
        "forest_scores": _forest_scores(),
        "forest_importances": _forest_importances(),
        "malformed_values": _malformed_values(),
        "record_counts": _record_counts(),
        "bundle_sections": _bundle_sections(),
        "flights_roundtrip": sql(
            "SELECT CAST(year(FL_DATE) AS INTEGER) AS year, ORIGIN, count(*) AS n, sum(CANCELLED) AS cancelled, "
            "min(FL_DATE) AS first_date, max(DEP_DELAY) AS max_dep_delay, sum(ARR_DELAY) AS arr_sum, "
            "count(WEATHER_DELAY) AS weather_n, max(DEST) AS last_dest, min(CRS_DEP_TIME) AS first_dep "
            "FROM flights WHERE year(FL_DATE) BETWEEN 1993 AND 2100 GROUP BY 1, 2", "flights"),
        "fares_roundtrip": sql(
            f"SELECT YEAR, QUARTER, count(*) AS n, {R('avg(ITIN_FARE)')} AS avg_fare, "
            "count(ITIN_YIELD) AS yield_n, max(ORIGIN) AS last_origin FROM rfares GROUP BY YEAR, QUARTER",
            "rfares"),
        "weather_roundtrip": sql(
            "SELECT NAME, CAST(year(DATE) AS INTEGER) AS year, count(*) AS n, count(AWND) AS wind_n, "
            "max(TMAX) AS max_temp, min(TMIN) AS min_temp, max(DATE) AS last_date FROM weather GROUP BY 1, 2",
            "weather"),
        "fare_file_audit": sql(
            f"SELECT batch, {R('batch_avg_fare')} AS batch_avg_fare, batch_rows, {BATCH_STATUS} AS status, " +
            R("CASE WHEN batch_avg_fare < 50 THEN batch_avg_fare * 100 ELSE batch_avg_fare END") +
            " AS repaired_avg_fare FROM (SELECT batch, avg(CASE WHEN f > 0 THEN f END) AS batch_avg_fare, "
            "count(*) AS batch_rows FROM (SELECT concat_ws('_', YEAR, QUARTER, ROW_KEY % 3) AS batch, "
            "CASE WHEN ROW_KEY % 3 = 1 THEN ITIN_FARE / 100 WHEN ROW_KEY % 3 = 0 THEN ITIN_FARE END AS f "
            "FROM fares) GROUP BY batch)", "fares"),
    }
    for name in HISTORY_SPECS:
        q[f"delay_history_{name}"] = _history(name)
    q["metrics_record"] = ("SELECT 'RouteMean' AS model, 'DEP_DELAY' AS target, rmse, mae, r2, 8 AS train_tenths, "
                           f"2 AS feature_count, 'global mean' AS fallback FROM ({q['model_eval']}) e")
    q["saved_reports"] = (
        "SELECT 'departures' AS report, ORIGIN AS key, CAST(total_departures AS DOUBLE) AS value "
        f"FROM ({q['most_departures']}) d UNION ALL SELECT 'stations' AS report, NAME AS key, "
        f"coalesce(avg_wind_speed, 0.0) AS value FROM ({q['weather_by_station']}) w UNION ALL SELECT 'causes' AS report, "
        f"NULL AS key, coalesce(avg_nas_delay_min, 0.0) AS value FROM ({q['delay_causes']}) c")
    q["report_positions"] = _report_positions(q)
    q["bundle_records"] = _bundle_records(q)
    return q
