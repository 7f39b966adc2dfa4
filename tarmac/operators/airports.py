"""The airport-dimension operations the reference does with an RDD (RDD-1..6),
expressed on the DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def airports_list(airports: DataFrame) -> DataFrame:
    """RDD-6: (code, name, state) with the fixed schema."""
    return airports.select("code", "name", "state").orderBy("code")


def airport_count(airports: DataFrame) -> DataFrame:
    """RDD-1: number of airports."""
    return airports.agg(F.count(F.lit(1)).alias("airport_count"))


def airport_codes(airports: DataFrame) -> DataFrame:
    """RDD-2: the codes."""
    return airports.select("code").orderBy("code")


def airports_in_state(airports: DataFrame, state: str = "Texas") -> DataFrame:
    """RDD-3: airports of one state."""
    return airports.where(F.col("state") == state).select("code", "name").orderBy("code")


def airport_pairs(airports: DataFrame, n: int = 5) -> DataFrame:
    """RDD-4: the first ``n`` (code, name) pairs by code."""
    return airports.select("code", "name").orderBy("code").limit(n)


def airports_by_state(airports: DataFrame) -> DataFrame:
    """RDD-5: sorted airport codes per state, comma-separated.

    A state holds a handful of airports, so the list per group is small.
    """
    return (airports.groupBy("state")
            .agg(F.array_join(F.sort_array(F.collect_list("code")), ",").alias("codes"),
                 F.count(F.lit(1)).alias("airport_count"))
            .orderBy("state"))
