"""Explicit schemas for the three fact sources and the dimensions.

Explicit schemas replace ``inferSchema``: no extra pass over the files just to
guess types, and the same types every run.
"""

from pyspark.sql.types import (DateType, DoubleType, IntegerType, StringType, StructField,
                               StructType)


def _struct(*fields):
    return StructType([StructField(name, dtype, True) for name, dtype in fields])


# Column layout of the yearly on-time performance CSV files (2009-2018), in
# file order, including the trailing empty column left by a pandas export.
FLIGHT_CSV_SCHEMA = _struct(
    ("FL_DATE", DateType()), ("OP_CARRIER", StringType()), ("OP_CARRIER_FL_NUM", IntegerType()),
    ("ORIGIN", StringType()), ("DEST", StringType()), ("CRS_DEP_TIME", IntegerType()),
    ("DEP_TIME", DoubleType()), ("DEP_DELAY", DoubleType()), ("TAXI_OUT", DoubleType()),
    ("WHEELS_OFF", DoubleType()), ("WHEELS_ON", DoubleType()), ("TAXI_IN", DoubleType()),
    ("CRS_ARR_TIME", IntegerType()), ("ARR_TIME", DoubleType()), ("ARR_DELAY", DoubleType()),
    ("CANCELLED", DoubleType()), ("CANCELLATION_CODE", StringType()), ("DIVERTED", DoubleType()),
    ("CRS_ELAPSED_TIME", DoubleType()), ("ACTUAL_ELAPSED_TIME", DoubleType()),
    ("AIR_TIME", DoubleType()), ("DISTANCE", DoubleType()), ("CARRIER_DELAY", DoubleType()),
    ("WEATHER_DELAY", DoubleType()), ("NAS_DELAY", DoubleType()), ("SECURITY_DELAY", DoubleType()),
    ("LATE_AIRCRAFT_DELAY", DoubleType()), ("Unnamed: 27", StringType()),
)

# The flight columns any operator of ours reads.
FLIGHT_COLUMNS = [
    "FL_DATE", "OP_CARRIER", "ORIGIN", "DEST", "CRS_DEP_TIME", "DEP_DELAY", "ARR_DELAY",
    "CANCELLED", "CRS_ELAPSED_TIME", "DISTANCE", "CARRIER_DELAY", "WEATHER_DELAY",
    "NAS_DELAY", "SECURITY_DELAY", "LATE_AIRCRAFT_DELAY",
]

FLIGHT_SCHEMA = StructType([f for f in FLIGHT_CSV_SCHEMA.fields if f.name in FLIGHT_COLUMNS])

FARE_SCHEMA = _struct(
    ("YEAR", IntegerType()), ("QUARTER", IntegerType()), ("ORIGIN", StringType()),
    ("ORIGIN_STATE_ABR", StringType()), ("ITIN_FARE", DoubleType()),
    ("ITIN_YIELD", DoubleType()), ("PASSENGERS", DoubleType()), ("DISTANCE", DoubleType()),
)

FARE_COLUMNS = [f.name for f in FARE_SCHEMA.fields]

WEATHER_SCHEMA = _struct(
    ("STATION", StringType()), ("NAME", StringType()), ("DATE", DateType()),
    ("AWND", DoubleType()), ("PRCP", DoubleType()), ("SNOW", DoubleType()),
    ("SNWD", DoubleType()), ("TMAX", DoubleType()), ("TMIN", DoubleType()),
    ("TAVG", DoubleType()),
)

WEATHER_COLUMNS = [f.name for f in WEATHER_SCHEMA.fields]

AIRPORT_SCHEMA = _struct(
    ("code", StringType()), ("name", StringType()), ("state", StringType()),
    ("lat", DoubleType()), ("lon", DoubleType()),
)

CARRIER_SCHEMA = _struct(("code", StringType()), ("name", StringType()))

REQUEST_SCHEMA = _struct(("ORIGIN", StringType()), ("DEST", StringType()), ("travel_date", DateType()))
