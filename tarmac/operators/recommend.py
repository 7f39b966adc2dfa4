"""Route statistics, the rule-based recommendation and the route report
(AGG-24, PRJ-10..13, JON-3, ML-13, RAM-7, RAM-8)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarmac.functions.defaults import THRESHOLDS
from tarmac.functions.exprs import c, ravg, tiered


def delay_risk(avg_delay):
    """PRJ-10: LOW / MEDIUM / HIGH on the rounded average delay."""
    return tiered(avg_delay, [(10, "LOW"), (25, "MEDIUM")], "HIGH")


def route_statistics(flights: DataFrame, min_flights: int = THRESHOLDS["route_statistics"]) -> DataFrame:
    """AGG-24: per-route historical delays and a risk label."""
    return (flights.where(c("ORIGIN").isNotNull() & c("DEST").isNotNull()
                          & c("DEP_DELAY").isNotNull())
            .groupBy("ORIGIN", "DEST")
            .agg(ravg("DEP_DELAY").alias("hist_avg_dep_delay"),
                 ravg("ARR_DELAY").alias("hist_avg_arr_delay"),
                 F.count(F.lit(1)).alias("total_flights"))
            .where(c("total_flights") > min_flights)
            .withColumn("delay_risk", delay_risk(c("hist_avg_dep_delay"))))


def scored_routes(route_stats: DataFrame, origin_fares: DataFrame,
                  delay_cuts=(10, 25), fare_cuts=(300, 500), volume_cuts=(1000, 300),
                  weights=(0.50, 0.35, 0.15), buy_at: float = 0.75,
                  hold_at: float = 0.45) -> DataFrame:
    """ML-13: weighted route score from delay, fare and volume tiers, in no order.

    A route whose origin has no fares scores fare 0.0 (a null falls to
    ``otherwise``). Both inputs are aggregates keyed by airport or route; the
    join is left to AQE, which broadcasts the fare side only when its
    measured size is under the broadcast threshold.
    """
    w_delay, w_fare, w_volume = weights
    joined = route_stats.join(origin_fares, on="ORIGIN", how="left")
    scored = joined.withColumns({
        "delay_score": tiered(c("hist_avg_dep_delay"),
                              [(delay_cuts[0], 1.0), (delay_cuts[1], 0.5)], 0.0),
        "fare_score": tiered(c("hist_avg_fare"), [(fare_cuts[0], 1.0), (fare_cuts[1], 0.5)], 0.0),
        "volume_score": tiered(c("total_flights"),
                               [(volume_cuts[0], 1.0), (volume_cuts[1], 0.75)], 0.5,
                               inclusive=True),
    })
    scored = scored.withColumn(
        "ensemble_score",
        F.round(c("delay_score") * w_delay + c("fare_score") * w_fare
                + c("volume_score") * w_volume, 4))
    return scored.withColumn(
        "recommendation",
        tiered(c("ensemble_score"), [(buy_at, "BUY"), (hold_at, "HOLD")], "AVOID",
               inclusive=True))


def route_recommendations(route_stats: DataFrame, origin_fares: DataFrame, **rules) -> DataFrame:
    """ML-13: ``scored_routes``, best first (its arguments are ``rules``)."""
    return scored_routes(route_stats, origin_fares, **rules).orderBy(
        F.desc("ensemble_score"), F.desc("total_flights"), F.asc_nulls_last("ORIGIN"), F.asc_nulls_last("DEST"))


def carrier_comparison(lookup: DataFrame, carriers: DataFrame) -> DataFrame:
    """RAM-8: carriers of each route side by side, with carrier names.

    ``rank_on_route`` orders the carriers of a route by average departure
    delay (then code). The caller brings the carrier table, so its join is left to AQE.
    """
    names = carriers.select(c("code").alias("OP_CARRIER"), c("name").alias("carrier_name"))
    w = Window.partitionBy("ORIGIN", "DEST").orderBy(F.asc_nulls_last("avg_dep_delay_min"),
                                                     F.asc_nulls_last("OP_CARRIER"))
    return (lookup.join(names, on="OP_CARRIER", how="left")
            .select("ORIGIN", "DEST", "OP_CARRIER", "carrier_name", "total_flights",
                    "avg_dep_delay_min", "avg_arr_delay_min", "pct_delayed_over_15min",
                    "cancellation_rate_pct",
                    F.row_number().over(w).alias("rank_on_route")))


def route_report(requests: DataFrame, recommendations: DataFrame, lookup: DataFrame,
                 weekday_delays: DataFrame) -> DataFrame:
    """RAM-7: answer route requests (ORIGIN, DEST, travel_date) in batch.

    Per request: weekday from the date, expected delay and fare, risk and
    advice from the recommendation table, the weekday's average delay, the
    number of carriers on the route and the carrier with the lowest
    average delay. Requests without history keep nulls.
    """
    best = (lookup.withColumn("_r", F.row_number().over(
                Window.partitionBy("ORIGIN", "DEST").orderBy(
                    F.asc_nulls_last("avg_dep_delay_min"), F.asc_nulls_last("OP_CARRIER"))))
            .groupBy("ORIGIN", "DEST")
            .agg(F.count(F.lit(1)).alias("carriers_on_route"),
                 F.min(F.when(c("_r") == 1, c("OP_CARRIER"))).alias("best_carrier")))
    rec = recommendations.select(
        "ORIGIN", "DEST", c("hist_avg_dep_delay").alias("expected_delay_min"),
        c("hist_avg_fare").alias("estimated_fare_usd"), "delay_risk", "ensemble_score",
        "recommendation")
    days = weekday_delays.select("day_of_week", c("avg_dep_delay").alias("weekday_avg_delay"))
    req = requests.withColumn("day_of_week", F.dayofweek("travel_date")).withColumn(
        "is_weekend", F.dayofweek("travel_date").isin(1, 7))
    return (req.join(rec, on=["ORIGIN", "DEST"], how="left")
            .join(best, on=["ORIGIN", "DEST"], how="left")
            .join(F.broadcast(days), on="day_of_week", how="left")
            .select("ORIGIN", "DEST", "travel_date", "day_of_week", "is_weekend",
                    "expected_delay_min", "estimated_fare_usd", "delay_risk", "ensemble_score",
                    "recommendation", "weekday_avg_delay", "carriers_on_route", "best_carrier"))


# The published description of the recommendation layer.
ENSEMBLE_WEIGHTS = {"delay_score": 0.50, "fare_score": 0.35, "volume_score": 0.15}
RECOMMENDATION_LOGIC = {"BUY": "ensemble_score >= 0.75",
                        "HOLD": "0.45 <= ensemble_score < 0.75",
                        "AVOID": "ensemble_score < 0.45"}
ENSEMBLE_INPUTS = ["hist_avg_dep_delay", "hist_avg_arr_delay", "hist_avg_fare",
                   "hist_avg_yield", "total_flights"]
# The thresholds record as published (it describes the rules
# loosely; the scoring above is what is applied).
THRESHOLDS_RECORD = {
    "hist_avg_delay_min": 9.0, "hist_avg_fare_usd": 400.0, "low_delay_threshold": 10.0,
    "high_delay_threshold": 25.0, "cheap_fare_threshold": 300.0,
    "expensive_fare_threshold": 500.0,
}
THRESHOLDS_LOGIC = {"BUY": "delay < 10 min AND fare below historical average",
                    "HOLD": "delay 10-25 min OR fare near historical average",
                    "AVOID": "delay > 25 min OR fare above $500"}


def ensemble_summary_record(spark):
    """SNK-2: one-row description of the ensemble layer (type, inputs, weights, logic)."""
    return spark.createDataFrame(
        [("weighted_route_recommendation_layer", ENSEMBLE_INPUTS, ENSEMBLE_WEIGHTS,
          RECOMMENDATION_LOGIC)],
        "ensemble_type string, inputs array<string>, weights map<string,double>, "
        "recommendation_logic map<string,string>")


def thresholds_record(spark):
    """SNK-2: one-row thresholds record, published verbatim."""
    cols = ", ".join(f"{k} double" for k in THRESHOLDS_RECORD)
    return spark.createDataFrame(
        [tuple(THRESHOLDS_RECORD.values()) + (THRESHOLDS_LOGIC,)],
        cols + ", recommendation_logic map<string,string>")
