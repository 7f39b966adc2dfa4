"""Airport traffic reports (AGG-1..4, JON-1, SET-1).

The reference counts departures and arrivals in two aggregates and joins
them. Here each flight is emitted once per role (departure at ORIGIN,
arrival at DEST) and one aggregate counts both: one scan of the fact table
and one shuffle of map-side partial counts instead of two scans, two
shuffles and a join. A hub holding a third of all flights costs nothing
extra: the partial aggregate collapses it to one row per task before the
shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def airport_roles(flights: DataFrame, dep: dict | None = None, arr: dict | None = None
                  ) -> DataFrame:
    """One row per (flight, role): ``airport``, ``is_dep`` plus role-specific columns.

    ``dep`` / ``arr`` map output names to the departure-side and
    arrival-side column expressions (same names in both dicts).
    ``null_side`` keeps a null departure airport apart from a null arrival
    airport, which is what a full outer join on the key does.
    """
    dep = dep or {}
    arr = arr or {}
    dep_fields = [F.col("ORIGIN").alias("airport"), F.lit(True).alias("is_dep")] + [
        v.alias(k) for k, v in dep.items()]
    arr_fields = [F.col("DEST").alias("airport"), F.lit(False).alias("is_dep")] + [
        v.alias(k) for k, v in arr.items()]
    roles = flights.select(F.explode(F.array(F.struct(*dep_fields), F.struct(*arr_fields)))
                           .alias("r")).select("r.*")
    return roles.withColumn("null_side", F.when(F.col("airport").isNull(), F.col("is_dep")))


def airport_traffic(flights: DataFrame, top_n: int | None = 25) -> DataFrame:
    """AGG-1: departure_count, arrival_count, total_traffic per airport, top ``top_n``.

    Keeps the outer-join semantics of the reference: an airport seen on one
    side only gets 0 on the other, and null codes are not merged.
    """
    counts = (airport_roles(flights)
              .groupBy("airport", "null_side")
              .agg(F.count_if(F.col("is_dep")).alias("departure_count"),
                   F.count_if(~F.col("is_dep")).alias("arrival_count"))
              .select("airport", "departure_count", "arrival_count",
                      (F.col("departure_count") + F.col("arrival_count")).alias("total_traffic")))
    ordered = counts.orderBy(F.desc("total_traffic"), F.asc_nulls_last("airport"))
    return ordered.limit(top_n) if top_n else ordered


def most_departures(flights: DataFrame) -> DataFrame:
    """AGG-2: flights per ORIGIN, most first."""
    return (flights.groupBy("ORIGIN").agg(F.count(F.lit(1)).alias("total_departures"))
            .orderBy(F.desc("total_departures"), F.asc_nulls_last("ORIGIN")))


def most_arrivals(flights: DataFrame) -> DataFrame:
    """AGG-3: flights per DEST, most first."""
    return (flights.groupBy("DEST").agg(F.count(F.lit(1)).alias("total_arrivals"))
            .orderBy(F.desc("total_arrivals"), F.asc_nulls_last("DEST")))


def busiest_airports(flights: DataFrame) -> DataFrame:
    """AGG-4: departures + arrivals per airport via bag union; null codes merge."""
    return (airport_roles(flights).groupBy("airport")
            .agg(F.count(F.lit(1)).alias("total_traffic"))
            .orderBy(F.desc("total_traffic"), F.asc_nulls_last("airport")))
