"""Route-graph metrics and the exported node / edge / lookup lists
(AGG-26..29, GRF-1..4, JON-2, JON-5, RAM-3..5).

The graph is two DataFrames: nodes (airports) and weighted edges (routes).
No graph library is needed: every metric is a group-by.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.functions.defaults import THRESHOLDS
from tarmac.functions.exprs import c, pct_rows, ravg
from tarmac.operators.traffic import airport_roles

NODE_COLUMNS = ["airport", "outbound_routes", "total_departures", "avg_dep_delay",
                "inbound_routes", "total_arrivals", "avg_arr_delay", "total_degree",
                "total_traffic", "network_importance_score"]


def airport_nodes(flights: DataFrame) -> DataFrame:
    """AGG-26/27 + GRF-1..3: degree, weighted degree, delays and importance per airport.

    One scan: each flight becomes a departure row and an arrival row; a
    route-level aggregate (map-side partial, so a hub airport never reaches
    one task as raw rows) feeds a second aggregate over that small result
    that puts both roles side by side. Two shuffles of partial aggregates
    replace the reference's two scans, two count-distinct plans and a full
    outer join. Missing sides are 0, as after the outer join and
    ``fillna(0)``.
    """
    roles = airport_roles(
        flights,
        dep={"partner": c("DEST"), "delay": c("DEP_DELAY")},
        arr={"partner": c("ORIGIN"), "delay": c("ARR_DELAY")},
    )
    # Route level first: one row per (airport, role, partner) with count, sum and
    # count of delays. Distinct partners are then just the non-null partner rows.
    per_route = (roles.groupBy("airport", "null_side", "is_dep", "partner")
                 .agg(F.count(F.lit(1)).alias("n"), F.sum("delay").alias("s"),
                      F.count("delay").alias("k")))
    dep, arr = c("is_dep"), ~c("is_dep")

    def mean(side):
        return F.round(F.coalesce(F.try_divide(F.sum(F.when(side, c("s"))),
                                               F.sum(F.when(side, c("k")))), F.lit(0.0)), 2)

    nodes = (per_route.groupBy("airport", "null_side")
             .agg(F.count(F.when(dep, c("partner"))).alias("outbound_routes"),
                  F.coalesce(F.sum(F.when(dep, c("n"))), F.lit(0)).alias("total_departures"),
                  mean(dep).alias("avg_dep_delay"),
                  F.count(F.when(arr, c("partner"))).alias("inbound_routes"),
                  F.coalesce(F.sum(F.when(arr, c("n"))), F.lit(0)).alias("total_arrivals"),
                  mean(arr).alias("avg_arr_delay")))
    nodes = nodes.withColumns({
        "total_degree": c("outbound_routes") + c("inbound_routes"),
        "total_traffic": c("total_departures") + c("total_arrivals"),
    }).withColumn("network_importance_score",
                  F.round(c("total_traffic") / 1000000 * c("total_degree"), 2))
    return nodes.select(*NODE_COLUMNS).orderBy(F.desc("total_traffic"),
                                               F.asc_nulls_last("airport"))


def route_edges(flights: DataFrame) -> DataFrame:
    """AGG-28 / GRF-4: weighted directed edge list, busiest first."""
    return (flights.groupBy("ORIGIN", "DEST")
            .agg(F.count(F.lit(1)).alias("flight_count"),
                 ravg("DEP_DELAY").alias("avg_delay"),
                 ravg("DISTANCE", 0).alias("avg_distance"))
            .orderBy(F.desc("flight_count"), F.asc_nulls_last("ORIGIN"),
                     F.asc_nulls_last("DEST")))


def route_lookup(flights: DataFrame, min_flights: int = THRESHOLDS["route_lookup"], over_minutes: float = THRESHOLDS["over_minutes"]
                 ) -> DataFrame:
    """AGG-29: per (ORIGIN, DEST, OP_CARRIER) delay and cancellation profile."""
    return (flights.groupBy("ORIGIN", "DEST", "OP_CARRIER")
            .agg(F.count(F.lit(1)).alias("total_flights"),
                 ravg("DEP_DELAY").alias("avg_dep_delay_min"),
                 ravg("ARR_DELAY").alias("avg_arr_delay_min"),
                 ravg("WEATHER_DELAY").alias("avg_weather_delay"),
                 ravg("CARRIER_DELAY").alias("avg_carrier_delay"),
                 pct_rows(c("DEP_DELAY") > over_minutes).alias("pct_delayed_over_15min"),
                 pct_rows(c("CANCELLED") == 1).alias("cancellation_rate_pct"))
            .where(c("total_flights") > min_flights))


def airport_nodes_geo(nodes: DataFrame, airports: DataFrame, top_n: int = 24) -> DataFrame:
    """RAM-3 / JON-5: the busiest ``top_n`` nodes with coordinates and state.

    Airports missing from the dimension get lat 0, lon 0, state "Unknown";
    a listed airport without coordinates keeps null ones. The dimension is
    a fixed-size table, so it is broadcast.
    """
    top = nodes.orderBy(F.desc("total_traffic"), F.asc_nulls_last("airport")).limit(top_n)
    dim = airports.select(c("code").alias("_code"), c("lat").alias("_lat"),
                          c("lon").alias("_lon"), c("state").alias("_state"))
    joined = top.join(F.broadcast(dim), top["airport"] == dim["_code"], "left")
    known = c("_code").isNotNull()
    return joined.select(
        c("airport").alias("code"),
        F.when(known, c("_lat")).otherwise(F.lit(0.0)).alias("lat"),
        F.when(known, c("_lon")).otherwise(F.lit(0.0)).alias("lon"),
        F.when(known, c("_state")).otherwise(F.lit("Unknown")).alias("state"),
        F.coalesce(c("total_departures"), F.lit(0)).alias("total_departures"),
        F.coalesce(c("total_arrivals"), F.lit(0)).alias("total_arrivals"),
        F.coalesce(c("total_traffic"), F.lit(0)).alias("total_traffic"),
        F.coalesce(c("outbound_routes"), F.lit(0)).alias("outbound_routes"),
        F.coalesce(c("avg_dep_delay"), F.lit(0.0)).alias("avg_dep_delay"),
        F.coalesce(c("avg_arr_delay"), F.lit(0.0)).alias("avg_arr_delay"),
        F.coalesce(c("network_importance_score"), F.lit(0.0)).alias("network_score"),
    ).orderBy(F.desc("total_traffic"), F.asc_nulls_last("code"))


def busiest_routes(edges: DataFrame, top_n: int = 50) -> DataFrame:
    """RAM-4: the ``top_n`` busiest edges, nulls as 0."""
    top = edges.orderBy(F.desc("flight_count"), F.asc_nulls_last("ORIGIN"),
                        F.asc_nulls_last("DEST")).limit(top_n)
    return top.select(c("ORIGIN").alias("origin"), c("DEST").alias("dest"),
                      c("flight_count"),
                      F.coalesce(c("avg_delay"), F.lit(0.0)).alias("avg_delay"),
                      F.coalesce(c("avg_distance"), F.lit(0.0)).alias("avg_distance"))


def route_lookup_export(lookup: DataFrame, max_rows: int = 5000) -> DataFrame:
    """RAM-5: at most ``max_rows`` carrier-routes for the web page, busiest first.

    The reference takes an unordered ``limit``; the busiest routes with a
    key tie-break make the kept rows well defined.
    """
    top = lookup.orderBy(F.desc("total_flights"), F.asc_nulls_last("ORIGIN"),
                         F.asc_nulls_last("DEST"), F.asc_nulls_last("OP_CARRIER")).limit(max_rows)
    z = F.lit(0.0)
    return top.select(
        c("ORIGIN").alias("origin"), c("DEST").alias("dest"), c("OP_CARRIER").alias("carrier"),
        c("total_flights"),
        F.coalesce(c("avg_dep_delay_min"), z).alias("avg_dep_delay"),
        F.coalesce(c("avg_arr_delay_min"), z).alias("avg_arr_delay"),
        F.coalesce(c("avg_weather_delay"), z).alias("avg_weather_delay"),
        F.coalesce(c("avg_carrier_delay"), z).alias("avg_carrier_delay"),
        F.coalesce(c("pct_delayed_over_15min"), z).alias("pct_delayed"),
        F.coalesce(c("cancellation_rate_pct"), z).alias("cancellation_rate"),
    )
