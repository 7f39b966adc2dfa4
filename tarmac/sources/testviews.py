"""Fixture views over the driver's TPC-H-like parquet tables.

The flights, fares, weather and airports views are each one SQL text that
runs in Spark and in DuckDB; only the dialect placeholders differ. In Spark
the base tables are read straight from their parquet files, so a view built
for one scale folder never sees another's tables.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

FLIGHTS_SQL = """
WITH b AS (
 SELECT CASE WHEN l.l_linenumber=7 AND s.s_nationkey=0 THEN NULL ELSE ns.n_name END AS ORIGIN,
  nc.n_name AS DEST, p.p_brand AS OP_CARRIER, CAST(l.l_shipdate AS DATE) AS FL_DATE,
  CAST((l.l_partkey % 24)*100 + (l.l_orderkey % 60) AS INTEGER) AS CRS_DEP_TIME,
  CASE WHEN l.l_returnflag='R' AND l.l_linestatus='F' AND l.l_quantity<=10 THEN 1.0E0 ELSE 0.0E0 END AS CANCELLED,
  CAST({day_diff} % 300 AS DOUBLE) AS raw_delay,
  CAST(50*abs(s.s_nationkey-c.c_nationkey) AS DOUBLE) AS DISTANCE,
  CAST(p.p_size+30 AS DOUBLE) AS CRS_ELAPSED_TIME, l.l_linenumber AS ln, l.l_orderkey*8 + l.l_linenumber AS ROW_KEY, l.l_partkey % 5 AS cause
 FROM {lineitem} l JOIN {orders} o ON l.l_orderkey=o.o_orderkey JOIN {customer} c ON o.o_custkey=c.c_custkey
 JOIN {supplier} s ON l.l_suppkey=s.s_suppkey JOIN {part} p ON l.l_partkey=p.p_partkey
 JOIN {nation} ns ON s.s_nationkey=ns.n_nationkey JOIN {nation} nc ON c.c_nationkey=nc.n_nationkey)
SELECT ROW_KEY,ORIGIN,DEST,OP_CARRIER,FL_DATE,CRS_DEP_TIME,CANCELLED,DISTANCE,CRS_ELAPSED_TIME,
 CASE WHEN CANCELLED=1 THEN NULL ELSE raw_delay END AS DEP_DELAY,
 CASE WHEN CANCELLED=1 THEN NULL ELSE raw_delay+ln-4 END AS ARR_DELAY,
 CASE WHEN CANCELLED=0 AND raw_delay+ln-4>=15 THEN CASE WHEN cause=0 THEN raw_delay+ln-4 ELSE 0.0E0 END END AS WEATHER_DELAY,
 CASE WHEN CANCELLED=0 AND raw_delay+ln-4>=15 THEN CASE WHEN cause=1 THEN raw_delay+ln-4 ELSE 0.0E0 END END AS CARRIER_DELAY,
 CASE WHEN CANCELLED=0 AND raw_delay+ln-4>=15 THEN CASE WHEN cause=2 THEN raw_delay+ln-4 ELSE 0.0E0 END END AS NAS_DELAY,
 CASE WHEN CANCELLED=0 AND raw_delay+ln-4>=15 THEN CASE WHEN cause=3 THEN raw_delay+ln-4 ELSE 0.0E0 END END AS SECURITY_DELAY,
 CASE WHEN CANCELLED=0 AND raw_delay+ln-4>=15 THEN CASE WHEN cause=4 THEN raw_delay+ln-4 ELSE 0.0E0 END END AS LATE_AIRCRAFT_DELAY
FROM b
"""

FARES_SQL = """
WITH b AS (SELECT o.o_orderkey AS ROW_KEY, year(o.o_orderdate) AS YEAR, quarter(o.o_orderdate) AS QUARTER, n.n_name AS ORIGIN,
  (o.o_totalprice-1000)/98 AS f, CAST((o.o_custkey % 30)*100 AS DOUBLE) AS DISTANCE, o.o_orderpriority AS pr
 FROM {orders} o JOIN {customer} c ON o.o_custkey=c.c_custkey JOIN {nation} n ON c.c_nationkey=n.n_nationkey)
SELECT ROW_KEY, CAST(YEAR AS INTEGER) AS YEAR, CAST(QUARTER AS INTEGER) AS QUARTER, ORIGIN,DISTANCE, CASE WHEN YEAR=1997 THEN f/100 ELSE f END AS ITIN_FARE,
 CASE WHEN pr='5-LOW' OR DISTANCE=0 THEN NULL WHEN YEAR=1997 THEN f/DISTANCE/100 ELSE f/DISTANCE END AS ITIN_YIELD FROM b
"""

WEATHER_SQL = """
SELECT concat(event_type,'_',CAST(user_id % 10 AS VARCHAR(20))) AS NAME, {weather_date} AS DATE,
 value AS PRCP, CASE WHEN event_type='view' THEN value ELSE 0.0E0 END AS SNOW, CAST(40+event_id % 60 AS DOUBLE) AS TMAX,
 CAST(20+event_id % 50 AS DOUBLE) AS TMIN, CASE WHEN user_id % 4=0 THEN NULL ELSE CAST(event_id % 25 AS DOUBLE) END AS AWND FROM {events}
"""

AIRPORTS_SQL = """
SELECT n.n_name AS code, concat('Airport ', n.n_name) AS name, r.r_name AS state,
 CASE WHEN n.n_nationkey < 22 THEN CAST(25+n.n_nationkey AS DOUBLE) END AS lat,
 CASE WHEN n.n_nationkey < 22 THEN CAST(-70-2*n.n_nationkey AS DOUBLE) END AS lon
FROM {nation} n JOIN {region} r ON n.n_regionkey=r.r_regionkey WHERE n.n_nationkey <> 3
"""

# Most of the flights' carriers, not all: a join with it finds some names and misses others.
CARRIERS_SQL = """
SELECT DISTINCT p_brand AS code, concat('Carrier ', p_brand) AS name FROM {part}
WHERE CAST(right(p_brand, 1) AS INTEGER) <> 5
"""

# Stations of twenty airports; the others have none, and some stations have no airport.
STATION_MAP_SQL = """
SELECT DISTINCT concat(e.event_type,'_',CAST(e.user_id % 10 AS VARCHAR(20))) AS NAME, n.n_name AS airport
FROM {events} e JOIN {nation} n ON n.n_nationkey % 10 = e.user_id % 10
WHERE n.n_nationkey < 20 AND e.event_type <> 'purchase'
"""

VIEWS = {"flights": FLIGHTS_SQL, "fares": FARES_SQL, "weather": WEATHER_SQL,
         "airports": AIRPORTS_SQL, "brand_carriers": CARRIERS_SQL, "station_map": STATION_MAP_SQL}

BASE_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]

SPARK_DIALECT = {
    "day_diff": "datediff(l.l_shipdate,o.o_orderdate)",
    "weather_date": "date_add(DATE'2009-01-01', CAST(event_id % 3650 AS INT))",
}

DUCKDB_DIALECT = {
    "day_diff": "date_diff('day',CAST(o.o_orderdate AS DATE),CAST(l.l_shipdate AS DATE))",
    "weather_date": "DATE '2009-01-01' + CAST(event_id % 3650 AS INTEGER)",
}


def view_sql(name: str, dialect: str, sf_dir: str | None = None) -> str:
    """The SQL text of one view in ``spark`` or ``duckdb`` dialect."""
    if dialect == "spark":
        tables = {t: f"parquet.`{os.path.join(sf_dir, t + '.parquet')}`" for t in BASE_TABLES}
        subs = {**SPARK_DIALECT, **tables}
    else:
        subs = {**DUCKDB_DIALECT, **{t: t for t in BASE_TABLES}}
    return VIEWS[name].format(**subs)


# (application id, scale folder) -> folder holding materialized copies of the views.
_MATERIALIZED: dict[tuple[str, str], str] = {}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One fixture view as a Spark DataFrame (lazy).

    After ``materialize`` the view is read from its parquet copy, the way
    production reads flights and fares: a plain columnar scan with
    pushdown, no joins of the synthetic base tables.
    """
    stored = _MATERIALIZED.get((spark.sparkContext.applicationId, os.path.abspath(sf_dir)))
    if stored:
        return spark.read.parquet(os.path.join(stored, name))
    return spark.sql(view_sql(name, "spark", sf_dir))


def materialize(spark: SparkSession, sf_dir: str, out_dir: str) -> dict[str, int]:
    """Write the views of ``sf_dir`` as parquet under ``out_dir`` once and
    serve later ``view`` calls from there. Returns row counts per view."""
    counts = {}
    for name in VIEWS:
        df = spark.sql(view_sql(name, "spark", sf_dir))
        path = os.path.join(out_dir, name)
        df.write.mode("overwrite").parquet(path)
        counts[name] = spark.read.parquet(path).count()
    _MATERIALIZED[(spark.sparkContext.applicationId, os.path.abspath(sf_dir))] = out_dir
    return counts


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "flights")


def fares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "fares")


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "weather")


def airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "airports")


def brand_carriers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "brand_carriers")


def station_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "station_map")


def duckdb_with(*names: str) -> str:
    """``WITH`` prefix defining the named views for a DuckDB oracle query."""
    return "WITH " + ",\n".join(f"{n} AS ({view_sql(n, 'duckdb')})" for n in names) + "\n"
