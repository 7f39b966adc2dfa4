"""Delay and cancellation reports (AGG-5..10, FLT-1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.functions.defaults import THRESHOLDS
from tarmac.functions.exprs import c, pct_rows, ravg


def _delay_by_airport(flights, key, delay_col, avg_name, min_flights, over_minutes):
    return (flights.where(c(delay_col).isNotNull())
            .groupBy(key)
            .agg(ravg(delay_col).alias(avg_name),
                 F.count(F.lit(1)).alias("total_flights"),
                 pct_rows(c(delay_col) > over_minutes).alias("pct_over_15min"))
            .where(c("total_flights") > min_flights)
            .orderBy(F.desc(avg_name), F.asc_nulls_last(key)))


def top_dep_delays(flights: DataFrame, min_flights: int = THRESHOLDS["top_dep_delays"], over_minutes: float = THRESHOLDS["over_minutes"]
                   ) -> DataFrame:
    """AGG-5: average departure delay per ORIGIN over flights with a delay."""
    return _delay_by_airport(flights, "ORIGIN", "DEP_DELAY", "avg_dep_delay_min",
                             min_flights, over_minutes)


def top_arr_delays(flights: DataFrame, min_flights: int = THRESHOLDS["top_arr_delays"], over_minutes: float = THRESHOLDS["over_minutes"]
                   ) -> DataFrame:
    """AGG-6: average arrival delay per DEST over flights with a delay."""
    return _delay_by_airport(flights, "DEST", "ARR_DELAY", "avg_arr_delay_min",
                             min_flights, over_minutes)


def delay_causes(flights: DataFrame) -> DataFrame:
    """AGG-7: global average of each cause column (nulls skipped)."""
    return flights.agg(
        ravg("CARRIER_DELAY").alias("avg_carrier_delay_min"),
        ravg("WEATHER_DELAY").alias("avg_weather_delay_min"),
        ravg("NAS_DELAY").alias("avg_nas_delay_min"),
        ravg("SECURITY_DELAY").alias("avg_security_delay_min"),
        ravg("LATE_AIRCRAFT_DELAY").alias("avg_late_aircraft_min"),
    )


def monthly_delays(flights: DataFrame) -> DataFrame:
    """AGG-8: average departure delay by calendar month."""
    return (flights.where(c("DEP_DELAY").isNotNull())
            .groupBy(F.month("FL_DATE").alias("month"))
            .agg(ravg("DEP_DELAY").alias("avg_dep_delay"))
            .orderBy("month"))


def daily_delays(flights: DataFrame) -> DataFrame:
    """AGG-9: average departure delay by weekday (1 = Sunday)."""
    return (flights.where(c("DEP_DELAY").isNotNull())
            .groupBy(F.dayofweek("FL_DATE").alias("day_of_week"))
            .agg(ravg("DEP_DELAY").alias("avg_dep_delay"))
            .orderBy("day_of_week"))


def cancellation_rates(flights: DataFrame, min_flights: int = THRESHOLDS["cancellation_rates"]) -> DataFrame:
    """AGG-10: cancelled share per carrier, in percent."""
    return (flights.groupBy("OP_CARRIER")
            .agg(F.round(F.avg(c("CANCELLED").cast("double")) * 100, 2)
                 .alias("cancellation_rate_pct"),
                 F.count(F.lit(1)).alias("total_flights"))
            .where(c("total_flights") > min_flights)
            .orderBy(F.desc("cancellation_rate_pct"), F.asc_nulls_last("OP_CARRIER")))
