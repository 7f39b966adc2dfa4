"""Station weather and weather-delay reports (AGG-18..23, FLT-2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.functions.defaults import THRESHOLDS
from tarmac.functions.exprs import c, pct_of_total, pct_rows, ravg


def weather_by_station(weather: DataFrame) -> DataFrame:
    """AGG-18: per-station averages, wettest first."""
    return (weather.groupBy("NAME")
            .agg(ravg("PRCP", 4).alias("avg_daily_precipitation"),
                 ravg("SNOW", 4).alias("avg_daily_snow"),
                 ravg("TMAX").alias("avg_max_temp"),
                 ravg("TMIN").alias("avg_min_temp"),
                 ravg("AWND").alias("avg_wind_speed"),
                 F.count(F.lit(1)).alias("days_recorded"))
            .orderBy(F.desc_nulls_last("avg_daily_precipitation"), F.asc_nulls_last("NAME")))


def weather_delays_by_airport(flights: DataFrame, min_flights: int = THRESHOLDS["weather_delays_by_airport"]) -> DataFrame:
    """AGG-19: flights with a positive weather delay, per ORIGIN."""
    return (flights.where(c("WEATHER_DELAY").isNotNull() & (c("WEATHER_DELAY") > 0))
            .groupBy("ORIGIN")
            .agg(ravg("WEATHER_DELAY").alias("avg_weather_delay_min"),
                 F.count(F.lit(1)).alias("weather_delayed_flights"),
                 F.round(F.max("WEATHER_DELAY"), 2).alias("max_weather_delay_min"))
            .where(c("weather_delayed_flights") > min_flights)
            .orderBy(F.desc("avg_weather_delay_min"), F.asc_nulls_last("ORIGIN")))


def weather_delays_by_month(flights: DataFrame) -> DataFrame:
    """AGG-20: flights with a recorded weather delay, per month."""
    return (flights.where(c("WEATHER_DELAY").isNotNull())
            .groupBy(F.month("FL_DATE").alias("month"))
            .agg(ravg("WEATHER_DELAY").alias("avg_weather_delay"),
                 ravg("DEP_DELAY").alias("avg_total_delay"),
                 F.count(F.lit(1)).alias("total_flights"))
            .orderBy("month"))


def worst_weather_airports(flights: DataFrame, min_flights: int = THRESHOLDS["worst_weather_airports"],
                           severe_minutes: float = THRESHOLDS["severe_minutes"]) -> DataFrame:
    """AGG-21: average over recorded weather delays; severe share over all flights."""
    return (flights.groupBy("ORIGIN")
            .agg(ravg("WEATHER_DELAY").alias("avg_weather_delay_min"),
                 pct_rows(c("WEATHER_DELAY") > severe_minutes).alias("pct_severe_weather_delay"),
                 F.count(F.lit(1)).alias("total_flights"))
            .where(c("total_flights") > min_flights)
            .orderBy(F.desc_nulls_last("avg_weather_delay_min"), F.asc_nulls_last("ORIGIN")))


def delay_type_breakdown(flights: DataFrame) -> DataFrame:
    """AGG-22: share of all flights with each cause > 0.

    The reference collects the row count first and divides by it as a
    literal; here the count is part of the same single-pass aggregate.
    """
    total = F.count(F.lit(1))
    return flights.agg(
        pct_of_total(c("WEATHER_DELAY") > 0, total).alias("pct_weather_caused"),
        pct_of_total(c("CARRIER_DELAY") > 0, total).alias("pct_carrier_caused"),
        pct_of_total(c("NAS_DELAY") > 0, total).alias("pct_nas_caused"),
        pct_of_total(c("LATE_AIRCRAFT_DELAY") > 0, total).alias("pct_late_aircraft_caused"),
        pct_of_total(c("SECURITY_DELAY") > 0, total).alias("pct_security_caused"),
    )


def seasonal_weather(weather: DataFrame) -> DataFrame:
    """AGG-23: monthly weather averages across all stations."""
    return (weather.groupBy(F.month(c("DATE").try_cast("date")).alias("month"))
            .agg(ravg("PRCP", 4).alias("avg_precipitation"),
                 ravg("SNOW", 4).alias("avg_snowfall"),
                 ravg("TMAX").alias("avg_max_temp"),
                 ravg("AWND").alias("avg_wind_speed"))
            .orderBy("month"))
