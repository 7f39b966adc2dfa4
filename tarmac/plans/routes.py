"""Route requests answered from a stored table of routes (RAM-7).

``route_facts`` has one row a route: everything the route page shows, from one aggregate over
the flight summary. Saved with ``save_routes`` it is bucketed by its route, one text of both
airports, as Spark prunes buckets by one column only: a batch of requests is dealt to the
buckets and joined in place, the routes are neither shuffled nor sorted, and a single
route is read from one bucket's files.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.functions.defaults import THRESHOLDS
from tarmac.functions.exprs import c
from tarmac.operators import recommend
from tarmac.plans import summary as sm

ROUTE = ("ORIGIN", "DEST")
KEY = "route"
BUCKETS = 64


def route_facts(flight_summary: DataFrame, origin_fares: DataFrame, thresholds: dict | None = None) -> DataFrame:
    """One row per route of the summary: statistics, fare, advice, carriers and latest date.

    Statistics and advice are null where ``route_statistics`` leaves the route out; the best
    carrier is the one with the least average delay among those of ``route_lookup``.
    """
    t = {**THRESHOLDS, **(thresholds or {})}
    delay = F.round(F.try_divide("dep_sum", "dep_n"), 2)
    listed = c("n") > t["route_lookup"]
    # per carrier-route already: the summary's own rows of the route set are one per carrier
    ranked = F.struct(delay.isNull().alias("none"), delay.alias("delay"), c("OP_CARRIER").isNull().alias("unnamed"),
                      c("OP_CARRIER").alias("carrier"))
    routes = sm.routes_part(flight_summary).where(c("ORIGIN").isNotNull() & c("DEST").isNotNull()) \
        .groupBy(*ROUTE).agg(
            F.max("date_max").alias("latest_date"), F.sum("dep_n").alias("dep_n"), F.sum("dep_sum").alias("dep_sum"),
            F.sum("arr_dep_sum").alias("arr_sum"), F.sum("arr_dep_n").alias("arr_n"),
            F.count_if(listed).alias("carriers"), F.min(F.when(listed, ranked)).alias("best"))
    stats = routes.select(
        *ROUTE, "latest_date", F.when(c("carriers") > 0, c("carriers")).alias("carriers_on_route"),
        c("best.carrier").alias("best_carrier"), F.round(F.try_divide("dep_sum", "dep_n"), 2).alias("hist_avg_dep_delay"),
        F.round(F.try_divide("arr_sum", "arr_n"), 2).alias("hist_avg_arr_delay"), c("dep_n").alias("total_flights")) \
        .withColumn("delay_risk", recommend.delay_risk(c("hist_avg_dep_delay")))
    advised = recommend.scored_routes(stats, origin_fares, fare_cuts=t["fare_cuts"], volume_cuts=t["volume_cuts"])
    known = c("total_flights") > t["route_statistics"]
    kept = {"hist_avg_dep_delay": "expected_delay_min", "hist_avg_fare": "estimated_fare_usd",
            "delay_risk": "delay_risk", "ensemble_score": "ensemble_score", "recommendation": "recommendation"}
    return advised.select(*ROUTE, "latest_date", *[F.when(known, c(name)).alias(alias) for name, alias in kept.items()],
                          "carriers_on_route", "best_carrier")


def route_key() -> Column:
    """One text for a route; null for a request without both airports."""
    return F.concat("ORIGIN", F.lit(">"), "DEST")


def answer(requests: DataFrame, routes: DataFrame, weekday_delays: DataFrame) -> DataFrame:
    """RAM-7: each request (ORIGIN, DEST, travel_date) with what is known of its route and weekday.

    Requests without a known route or date keep nulls there; none is lost.
    """
    days = weekday_delays.select(c("day_of_week").alias("_day"), c("avg_dep_delay").alias("weekday_avg_delay"))
    weekday = F.dayofweek("travel_date")
    known = routes.drop("latest_date", *ROUTE) if KEY in routes.columns \
        else routes.withColumn(KEY, route_key()).drop("latest_date", *ROUTE)
    asked = requests.select(*ROUTE, "travel_date", route_key().alias(KEY), weekday.alias("day_of_week"), weekday.isin(1, 7).alias("is_weekend"))
    # seven weekdays: a proven bound
    return asked.join(known, KEY, "left") \
        .join(F.broadcast(days), c("day_of_week") == c("_day"), "left") \
        .select("ORIGIN", "DEST", "travel_date", "day_of_week", "is_weekend", "expected_delay_min",
                "estimated_fare_usd", "delay_risk", "ensemble_score", "recommendation", "weekday_avg_delay",
                "carriers_on_route", "best_carrier")


def save_routes(routes: DataFrame, table: str, path: str, buckets: int = BUCKETS) -> None:
    """Write ``routes`` bucketed and sorted by route at ``path`` and register them as ``table``."""
    keyed = routes.withColumn(KEY, route_key())
    keyed.repartition(buckets, KEY).write.mode("overwrite").bucketBy(buckets, KEY).sortBy(KEY) \
        .option("path", path).format("parquet").saveAsTable(table)  # one file a bucket
    layout = json.dumps({"buckets": buckets, "columns": keyed.schema.simpleString()[len("struct<"):-1]})
    routes.sparkSession.createDataFrame([(layout,)], "value string").coalesce(1) \
        .write.mode("overwrite").text(f"{path}_layout")


def open_routes(spark: SparkSession, table: str, path: str) -> DataFrame:
    """The routes saved at ``path``, registered as ``table`` in a session that has not seen them."""
    if not spark.catalog.tableExists(table):
        layout = json.loads(spark.read.text(f"{path}_layout").first()["value"])
        columns = ", ".join(f"`{f.split(':')[0]}` {f.split(':')[1]}" for f in layout["columns"].split(","))
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY ({KEY}) SORTED BY ({KEY}) "
                  f"INTO {int(layout['buckets'])} BUCKETS LOCATION '{path}'")
    return spark.table(table)
