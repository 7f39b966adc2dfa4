"""The reports' default thresholds, used by the operators, the summaries and the batch run."""

# The reference's thresholds.
THRESHOLDS = {
    "top_dep_delays": 10000, "top_arr_delays": 10000, "worst_weather_airports": 10000,
    "cancellation_rates": 50000, "route_statistics": 100, "route_lookup": 100,
    "weather_delays_by_airport": 100, "origin_fares": 500,
    "fare_cuts": (300, 500), "volume_cuts": (1000, 300),
    "over_minutes": 15, "severe_minutes": 30,
}
