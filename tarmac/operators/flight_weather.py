"""Flights joined with the weather of their airport and day, and correlations over it.

Stations belong to airports by a table that the user brings (``NAME``, ``airport``); a station
may serve several airports and an airport may have several stations. Flights are brought
down to airport-days before the join, so it has airports x days rows, not flights.

Correlations come from centred moments (count, means, squared deviations), which are merged
without the loss of digits that plain sums of squares have; parts of any cut of the days,
by airport, month or file, add up to those of the whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.functions.exprs import c

WEATHER = ("PRCP", "SNOW", "TMAX", "TMIN", "AWND")
DIGITS = {"dep_delay": 2, "weather_delay": 2, "PRCP": 4, "SNOW": 4, "TMAX": 2, "TMIN": 2, "AWND": 2}


def station_days(weather: DataFrame, station_map: DataFrame) -> DataFrame:
    """``airport, day``, its station records and their mean weather."""
    # the caller's table: whether it is broadcast is left to its measured size
    mapped = weather.join(station_map.select(c("NAME").alias("_name"), "airport"), c("NAME") == c("_name"))
    return mapped.groupBy("airport", c("DATE").alias("day")).agg(
        F.count(F.lit(1)).alias("station_days"), *[F.avg(m).alias(m) for m in WEATHER])


def flight_weather_daily(flights: DataFrame, weather: DataFrame, station_map: DataFrame) -> DataFrame:
    """Per origin and day: flights, mean delays, and the weather there (null where none is known)."""
    cells = flights.groupBy(c("ORIGIN").alias("airport"), c("FL_DATE").alias("day")).agg(
        F.count(F.lit(1)).alias("flights"), F.avg("DEP_DELAY").alias("dep_delay"),
        F.avg("WEATHER_DELAY").alias("weather_delay"))
    return cells.join(station_days(weather, station_map), ["airport", "day"], "left")


def rounded(daily: DataFrame) -> DataFrame:
    return daily.select("airport", "day", "flights", "station_days",
                        *[F.round(m, digits).alias(m) for m, digits in DIGITS.items()])


def pair_moments(df: DataFrame, keys: list[str], x: str, y: str) -> DataFrame:
    """Per key the centred moments of the rows that have both ``x`` and ``y``: ``n, mx, my, sxx, syy, sxy``."""
    both = df.where(c(x).isNotNull() & c(y).isNotNull())
    n = F.count(F.lit(1))
    return both.groupBy(*keys).agg(
        n.alias("n"), F.avg(x).alias("mx"), F.avg(y).alias("my"), (F.var_pop(x) * n).alias("sxx"),
        (F.var_pop(y) * n).alias("syy"), (F.covar_pop(x, y) * n).alias("sxy"))


def merge_moments(parts: DataFrame, keys: list[str]) -> DataFrame:
    """Moments of disjoint parts as those of the whole, by ``keys`` (none: of everything).

    Each part's deviations are moved from its own means to the common ones. Parts are
    small tables (one row per cut and key), read twice.
    """
    parts = parts.withColumn("_whole", F.lit(1))
    on = {k: f"_{i}" for i, k in enumerate([*keys, "_whole"])}
    means = parts.groupBy(*[c(k).alias(name) for k, name in on.items()]).agg(
        F.sum("n").alias("_n"), (F.sum(c("n") * c("mx")) / F.sum("n")).alias("_mx"),
        (F.sum(c("n") * c("my")) / F.sum("n")).alias("_my"))
    same = F.lit(True)
    for k, name in on.items():
        same = same & c(k).eqNullSafe(c(name))
    dx, dy = c("mx") - c("_mx"), c("my") - c("_my")
    moved = parts.join(means, same).select(
        *keys, "_n", "_mx", "_my", (c("sxx") + c("n") * dx * dx).alias("sxx"),
        (c("syy") + c("n") * dy * dy).alias("syy"), (c("sxy") + c("n") * dx * dy).alias("sxy"))
    return moved.groupBy(*keys, c("_n").alias("n"), c("_mx").alias("mx"), c("_my").alias("my")).agg(
        F.sum("sxx").alias("sxx"), F.sum("syy").alias("syy"), F.sum("sxy").alias("sxy"))


def correlation(moments: DataFrame, name: str, keys: list[str], digits: int = 6) -> DataFrame:
    """``keys`` and the correlation as ``name``; null where a side never varies."""
    return moments.select(*keys, F.round(F.try_divide("sxy", F.sqrt(c("sxx") * c("syy"))), digits).alias(name))


def weather_delay_corr(daily: DataFrame, delay: str = "dep_delay") -> DataFrame:
    """``airport, days`` and the correlation of each weather measure with ``delay``.

    The row without airport is over all airports, merged from their moments; days without an
    airport are left out.
    """
    known = daily.where(c("airport").isNotNull())
    counts = known.groupBy("airport").agg(F.count(F.lit(1)).alias("days"))
    by_airport, overall = counts, counts.agg(F.coalesce(F.sum("days"), F.lit(0)).alias("days")) \
        .select(F.lit(None).cast("string").alias("airport"), "days")
    for m in WEATHER:
        moments, name = pair_moments(known, ["airport"], m, delay), f"corr_{m.lower()}"
        by_airport = by_airport.join(correlation(moments, name, ["airport"]), "airport", "left")
        whole = correlation(merge_moments(moments, []), name, []).withColumn("_none", F.lit(True))
        overall = overall.join(whole, c("airport").isNull() == c("_none"), "left").drop("_none")
    return by_airport.unionByName(overall)
