"""Literal dimensions: airports (SRC-6) and carrier names (SRC-7).

These are fixed, tiny tables (25 and 16 rows); joining them by broadcast is
safe because their size does not grow with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tarmac.schemas import AIRPORT_SCHEMA, CARRIER_SCHEMA

# The airport dimension (code, name, state, lat, lon). IAD has
# no coordinates in the source lists; MDW appears only with coordinates.
AIRPORTS = [
    ("ATL", "Hartsfield-Jackson Atlanta International", "Georgia", 33.6407, -84.4277),
    ("ORD", "Chicago O'Hare International", "Illinois", 41.9742, -87.9073),
    ("DFW", "Dallas/Fort Worth International", "Texas", 32.8998, -97.0403),
    ("DEN", "Denver International Airport", "Colorado", 39.8561, -104.6737),
    ("LAX", "Los Angeles International", "California", 33.9425, -118.4081),
    ("CLT", "Charlotte Douglas International", "North Carolina", 35.2140, -80.9431),
    ("LAS", "Harry Reid International", "Nevada", 36.0840, -115.1537),
    ("PHX", "Phoenix Sky Harbor International", "Arizona", 33.4373, -112.0078),
    ("MCO", "Orlando International Airport", "Florida", 28.4294, -81.3089),
    ("SEA", "Seattle-Tacoma International", "Washington", 47.4502, -122.3088),
    ("MIA", "Miami International Airport", "Florida", 25.7959, -80.2870),
    ("JFK", "John F. Kennedy International", "New York", 40.6413, -73.7781),
    ("EWR", "Newark Liberty International", "New Jersey", 40.6895, -74.1745),
    ("SFO", "San Francisco International", "California", 37.6213, -122.3790),
    ("BOS", "Boston Logan International", "Massachusetts", 42.3656, -71.0096),
    ("MSP", "Minneapolis-Saint Paul International", "Minnesota", 44.8848, -93.2223),
    ("DTW", "Detroit Metropolitan Wayne County", "Michigan", 42.2162, -83.3554),
    ("PHL", "Philadelphia International", "Pennsylvania", 39.8721, -75.2411),
    ("BWI", "Baltimore Washington International", "Maryland", 39.1754, -76.6683),
    ("IAD", "Washington Dulles International", "Virginia", None, None),
    ("HOU", "William P. Hobby Airport", "Texas", 29.6454, -95.2789),
    ("IAH", "George Bush Intercontinental", "Texas", 29.9902, -95.3368),
    ("SLC", "Salt Lake City International", "Utah", 40.7884, -111.9778),
    ("BNA", "Nashville International Airport", "Tennessee", 36.1245, -86.6782),
    ("MDW", "Chicago Midway International", "Illinois", 41.7868, -87.7522),
]

# Carrier code -> carrier name.
CARRIERS = [
    ("AA", "American Airlines"), ("DL", "Delta Air Lines"),
    ("UA", "United Airlines"), ("WN", "Southwest Airlines"),
    ("B6", "JetBlue Airways"), ("AS", "Alaska Airlines"),
    ("NK", "Spirit Airlines"), ("F9", "Frontier Airlines"),
    ("G4", "Allegiant Air"), ("SY", "Sun Country Airlines"),
    ("HA", "Hawaiian Airlines"), ("OO", "SkyWest Airlines"),
    ("YX", "Republic Airways"), ("9E", "Endeavor Air"),
    ("MQ", "Envoy Air"), ("OH", "PSA Airlines"),
]


def airports(spark: SparkSession) -> DataFrame:
    """Airport dimension (code, name, state, lat, lon) with a fixed schema."""
    return spark.createDataFrame(AIRPORTS, schema=AIRPORT_SCHEMA)


def carriers(spark: SparkSession) -> DataFrame:
    """Carrier dimension (code, name)."""
    return spark.createDataFrame(CARRIERS, schema=CARRIER_SCHEMA)
