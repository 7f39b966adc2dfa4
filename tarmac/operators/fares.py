"""Fare batch repair and fare reports (RAM-1/2, FLT-3/4, AGG-11..17, AGG-25)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.functions.exprs import c, quarter_label, ravg

BATCH_KEYS = ("YEAR", "QUARTER")


def batch_fare_means(fares: DataFrame, batch_keys=BATCH_KEYS) -> DataFrame:
    """Mean positive fare and row count per batch (one batch = one source file)."""
    keys = list(batch_keys)
    return (fares.groupBy(*keys)
            .agg(F.avg(F.when(c("ITIN_FARE") > 0, c("ITIN_FARE"))).alias("batch_avg_fare"),
                 F.count(F.lit(1)).alias("batch_rows")))


def batch_status(threshold: float = 50.0):
    """A batch's status by its mean: one rule for repair and audit.

    A batch without a positive fare has no mean; it is left alone as ``unclassified``.
    """
    return (F.when(c("batch_avg_fare").isNull(), "unclassified")
            .when(c("batch_avg_fare") < threshold, "fixed").otherwise("clean"))


def repair_fare_scale(fares: DataFrame, batch_keys=BATCH_KEYS, threshold: float = 50.0,
                      factor: float = 100.0, means: DataFrame | None = None) -> DataFrame:
    """RAM-1: batches whose mean positive fare is below ``threshold`` were stored
    ``factor`` times too small; scale their fare and yield back up.

    The batch means are a partial aggregate with one row per batch. With the
    default calendar-quarter batches that is at most four rows per year, a
    proven bound, so the means are broadcast back to the rows and the fact
    table is never shuffled. Other batch keys (e.g. a source-file column)
    are left to AQE, which broadcasts only below its measured-size
    threshold. The input is not modified. ``means`` may pass batch means
    computed (and stored) once for several uses.
    """
    keys = list(batch_keys)
    means = (means if means is not None else batch_fare_means(fares, keys)).select(
        *[c(k).alias(f"_batch_{k}") for k in keys], "batch_avg_fare")
    if tuple(keys) == BATCH_KEYS:
        means = F.broadcast(means)
    scaled = batch_status(threshold) == "fixed"
    same = F.lit(True)
    for k in keys:  # rows with a null key are a batch too, as in the audit
        same = same & c(k).eqNullSafe(c(f"_batch_{k}"))
    out = fares.join(means, on=same, how="left")
    return out.withColumns({
        "ITIN_FARE": F.when(scaled, c("ITIN_FARE") * factor).otherwise(c("ITIN_FARE")),
        "ITIN_YIELD": F.when(scaled, c("ITIN_YIELD") * factor).otherwise(c("ITIN_YIELD")),
    }).select(*fares.columns)


def fare_batch_audit(fares: DataFrame, batch_keys=BATCH_KEYS, threshold: float = 50.0,
                     factor: float = 100.0, means: DataFrame | None = None) -> DataFrame:
    """RAM-2: one row per batch with its mean, row count and repair status."""
    keys = list(batch_keys)
    scaled = batch_status(threshold) == "fixed"
    return ((means if means is not None else batch_fare_means(fares, keys))
            .select(*keys,
                    F.round("batch_avg_fare", 2).alias("batch_avg_fare"),
                    "batch_rows",
                    batch_status(threshold).alias("status"),
                    F.round(F.when(scaled, c("batch_avg_fare") * factor)
                            .otherwise(c("batch_avg_fare")), 2).alias("repaired_avg_fare"))
            .orderBy(*keys))


def fare_batch_status(fares: DataFrame, batch_keys=BATCH_KEYS, threshold: float = 50.0,
                      means: DataFrame | None = None) -> DataFrame:
    """RAM-2 totals: how many batches (and rows) were clean and how many fixed."""
    keys = list(batch_keys)
    batches = means if means is not None else batch_fare_means(fares, keys)
    return (batches.groupBy(batch_status(threshold).alias("status"))
            .agg(F.count(F.lit(1)).alias("batches"), F.sum("batch_rows").alias("rows"))
            .orderBy("status"))


def clean_fares(fares: DataFrame, low: float = 10, high: float = 5000) -> DataFrame:
    """FLT-3: fares strictly between ``low`` and ``high``."""
    return fares.where(c("ITIN_FARE").isNotNull() & (c("ITIN_FARE") > low)
                       & (c("ITIN_FARE") < high))


def fare_by_year(fares: DataFrame) -> DataFrame:
    """AGG-11."""
    return (fares.groupBy("YEAR")
            .agg(ravg("ITIN_FARE").alias("avg_fare_usd"),
                 F.round(F.min("ITIN_FARE"), 2).alias("min_fare_usd"),
                 F.round(F.max("ITIN_FARE"), 2).alias("max_fare_usd"),
                 F.count(F.lit(1)).alias("total_itineraries"))
            .orderBy("YEAR"))


def fare_by_quarter(fares: DataFrame) -> DataFrame:
    """AGG-12 with the PRJ-9 label."""
    return (fares.groupBy("QUARTER")
            .agg(ravg("ITIN_FARE").alias("avg_fare_usd"),
                 F.count(F.lit(1)).alias("total_itineraries"))
            .withColumn("quarter_label", quarter_label(c("QUARTER")))
            .orderBy("QUARTER"))


def _origin_fares(fares, min_itineraries):
    return (fares.groupBy("ORIGIN")
            .agg(ravg("ITIN_FARE").alias("avg_fare_usd"),
                 ravg("ITIN_YIELD", 4).alias("avg_yield_per_mile"),
                 F.count(F.lit(1)).alias("total_itineraries"))
            .where(c("total_itineraries") > min_itineraries))


def most_expensive_airports(fares: DataFrame, min_itineraries: int = 500) -> DataFrame:
    """AGG-13."""
    return _origin_fares(fares, min_itineraries).orderBy(F.desc("avg_fare_usd"),
                                                         F.asc_nulls_last("ORIGIN"))


def cheapest_airports(fares: DataFrame, min_itineraries: int = 500) -> DataFrame:
    """AGG-14."""
    return _origin_fares(fares, min_itineraries).orderBy("avg_fare_usd",
                                                         F.asc_nulls_last("ORIGIN"))


def price_trend(fares: DataFrame) -> DataFrame:
    """AGG-15."""
    return (fares.groupBy("YEAR", "QUARTER")
            .agg(ravg("ITIN_FARE").alias("avg_fare_usd"),
                 F.count(F.lit(1)).alias("total_itineraries"))
            .orderBy("YEAR", "QUARTER"))


def best_value_airports(fares: DataFrame, min_itineraries: int = 500) -> DataFrame:
    """AGG-16: cheapest yield per mile, over fares with a positive distance."""
    return (fares.where(c("DISTANCE").isNotNull() & (c("DISTANCE") > 0))
            .groupBy("ORIGIN")
            .agg(ravg("ITIN_FARE").alias("avg_fare_usd"),
                 ravg("DISTANCE", 0).alias("avg_distance_miles"),
                 ravg("ITIN_YIELD", 4).alias("avg_cents_per_mile"),
                 F.count(F.lit(1)).alias("total_itineraries"))
            .where(c("total_itineraries") > min_itineraries)
            .orderBy(F.asc_nulls_first("avg_cents_per_mile"), F.asc_nulls_last("ORIGIN")))


def fare_summary(fares: DataFrame) -> DataFrame:
    """AGG-17: one-row overall summary."""
    return fares.agg(
        ravg("ITIN_FARE").alias("overall_avg_fare"),
        F.round(F.min("ITIN_FARE"), 2).alias("overall_min_fare"),
        F.round(F.max("ITIN_FARE"), 2).alias("overall_max_fare"),
        F.count(F.lit(1)).alias("total_records"),
    )


def fare_by_origin(fares: DataFrame, low: float = 10, high: float = 5000) -> DataFrame:
    """AGG-25: historical fare and yield per origin (input for the recommendation)."""
    return (clean_fares(fares, low, high).where(c("ORIGIN").isNotNull())
            .groupBy("ORIGIN")
            .agg(ravg("ITIN_FARE").alias("hist_avg_fare"),
                 ravg("ITIN_YIELD", 4).alias("hist_avg_yield")))
