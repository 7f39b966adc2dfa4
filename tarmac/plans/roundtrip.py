"""Queries that take the whole ingest route: CSV drops, conversion, readers, report.

Each writes a fixture view as CSV below the checkpoint folder in two drops whose columns
differ in order and case, converts them (or reads them as they are) and reports on
what the readers give back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.functions.exprs import ravg
from tarmac.operators import fares as fr
from tarmac.operators.joins import scratch_path
from tarmac.sources import testviews as tv
from tarmac.sources.convert import convert_csv
from tarmac.sources.files import (JUNK_COLUMN, SOURCE_FILE, read_fares, read_flights, read_quarantine,
                                  read_saved_report, read_weather)


def _folder(spark) -> str:
    return scratch_path(spark, "roundtrip")


def _drops(view: DataFrame, folder: str, second) -> list[str]:
    """Two drops: rows where ``second`` holds have reversed columns and lower-case names; the others
    the junk column that a pandas export leaves."""
    first = F.coalesce(~second, F.lit(True))
    view.where(first).withColumn(JUNK_COLUMN, F.lit("x")).write.option("header", True).csv(f"{folder}/first")
    view.where(~first).select([F.col(c).alias(c.lower()) for c in reversed(view.columns)]) \
        .write.option("header", True).csv(f"{folder}/second")
    return [f"{folder}/first", f"{folder}/second"]


def flights_roundtrip(spark, sf_dir: str) -> DataFrame:
    """Per year and origin, from converted flights."""
    folder = _folder(spark)
    drops = _drops(tv.flights(spark, sf_dir).drop("ROW_KEY"), folder, F.month("FL_DATE") > 6)
    convert_csv(spark, "flights", drops, f"{folder}/table")
    flights = read_flights(spark, f"{folder}/table", "parquet", years=(1993, 2100))
    return flights.groupBy(F.col("part_year").alias("year"), "ORIGIN").agg(
        F.count(F.lit(1)).alias("n"), F.sum("CANCELLED").alias("cancelled"),
        F.min("FL_DATE").alias("first_date"), F.max("DEP_DELAY").alias("max_dep_delay"),
        F.sum("ARR_DELAY").alias("arr_sum"), F.count("WEATHER_DELAY").alias("weather_n"),
        F.max("DEST").alias("last_dest"), F.min("CRS_DEP_TIME").alias("first_dep"))


def fares_roundtrip(spark, sf_dir: str) -> DataFrame:
    """Per quarter, from converted and repaired fares."""
    folder = _folder(spark)
    drops = _drops(tv.fares(spark, sf_dir).drop("ROW_KEY"), folder, F.col("QUARTER") > 2)
    convert_csv(spark, "fares", drops, f"{folder}/table")
    fares = fr.repair_fare_scale(read_fares(spark, f"{folder}/table", "parquet"))
    return fares.groupBy("YEAR", "QUARTER").agg(
        F.count(F.lit(1)).alias("n"), ravg("ITIN_FARE").alias("avg_fare"),
        F.count("ITIN_YIELD").alias("yield_n"), F.max("ORIGIN").alias("last_origin"))


def weather_roundtrip(spark, sf_dir: str) -> DataFrame:
    """Per station and year, from converted weather."""
    folder = _folder(spark)
    drops = _drops(tv.weather(spark, sf_dir), folder, F.month("DATE") > 6)
    convert_csv(spark, "weather", drops, f"{folder}/table")
    weather = read_weather(spark, f"{folder}/table", "parquet")
    return weather.groupBy("NAME", F.col("part_year").alias("year")).agg(
        F.count(F.lit(1)).alias("n"), F.count("AWND").alias("wind_n"), F.max("TMAX").alias("max_temp"),
        F.min("TMIN").alias("min_temp"), F.max("DATE").alias("last_date"))


def fare_file_audit(spark, sf_dir: str) -> DataFrame:
    """RAM-1/2 per source file: one folder of CSV for each batch, read with its path.

    Of a quarter's three files one is stored 100 times too small and one has no fares.
    """
    folder = _folder(spark)
    part = F.pmod(F.col("ROW_KEY"), F.lit(3))
    view = tv.fares(spark, sf_dir).withColumn("batch", F.concat_ws("_", "YEAR", "QUARTER", part))
    view = view.withColumn("ITIN_FARE", F.when(part == 1, F.col("ITIN_FARE") / 100)
                           .when(part == 0, F.col("ITIN_FARE")))
    view.drop("ROW_KEY").write.partitionBy("batch").option("header", True).csv(folder)
    fares = read_fares(spark, f"{folder}/*", with_file=True).withColumn(
        "batch", F.regexp_extract(SOURCE_FILE, "batch=([^/]+)", 1))
    return fr.fare_batch_audit(fares, batch_keys=("batch",))


def malformed_values(spark, sf_dir: str) -> DataFrame:
    """SRC-1 bad rows: flights with unreadable values, set aside by the conversion; and how many were kept."""
    folder = _folder(spark)
    view = tv.flights(spark, sf_dir)
    texts = view.select([F.col(c).cast("string").alias(c) for c in view.columns])
    spoiled = {"DEP_DELAY": (97, F.lit("n/a")), "FL_DATE": (101, F.lit("someday")),
               "DISTANCE": (103, F.concat("DISTANCE", F.lit(" mi")))}
    texts = texts.withColumns({name: F.when(F.col("ROW_KEY").cast("long") % every == 0, text).otherwise(F.col(name))
                               for name, (every, text) in spoiled.items()})
    texts.write.option("header", True).csv(f"{folder}/drop")
    report = convert_csv(spark, "flights", f"{folder}/drop", f"{folder}/table", quarantine=True)
    kept = read_flights(spark, f"{folder}/table", "parquet")
    assert report["kept"] + report["quarantined"] == report["rows"]
    return read_quarantine(spark, f"{folder}/table").select(
        F.get_json_object("row", "$.ROW_KEY").cast("long").alias("row_key"), F.col("column").alias("column_name"),
        "text", "reason").unionByName(kept.agg(F.count(F.lit(1)).cast("string").alias("text")).select(
            F.lit(None).cast("long").alias("row_key"), F.lit("kept").alias("column_name"), "text",
            F.lit(None).cast("string").alias("reason")))


def saved_reports(spark, sf_dir: str) -> DataFrame:
    """SNK-1, SNK-2, SRC-5, SRC-8: reports saved as CSV, parquet and JSON, and read back."""
    from tarmac.operators import delays, traffic, weather
    from tarmac.plans.sinks import save_record, save_table
    folder = _folder(spark)
    flights, station = tv.flights(spark, sf_dir), tv.weather(spark, sf_dir)
    causes, months = delays.delay_causes(flights), delays.monthly_delays(flights)
    departures, stations = traffic.most_departures(flights), weather.weather_by_station(station)
    save_table(departures, f"{folder}/departures", "csv")
    save_table(stations, f"{folder}/stations")
    save_record(causes, f"{folder}/causes")
    read = lambda name, fmt, schema, columns: read_saved_report(
        spark, f"{folder}/{name}", fmt, schema, columns)
    rows = [
        read("departures", "csv", departures.schema, ["ORIGIN", "total_departures", "gone"]).select(
            F.lit("departures").alias("report"), F.col("ORIGIN").alias("key"),
            F.col("total_departures").cast("double").alias("value")),
        read("stations", "parquet", stations.schema, ["NAME", "avg_wind_speed"]).select(
            F.lit("stations"), "NAME", "avg_wind_speed"),
        read("causes", "json", causes.schema, None).select(
            F.lit("causes"), F.lit(None).cast("string"), "avg_nas_delay_min"),
        read("never_saved", "parquet", months.schema, None).select(
            F.lit("never"), F.col("month").cast("string"), "avg_dep_delay")]
    out = rows[0]
    for more in rows[1:]:
        out = out.union(more)
    return out


def queries() -> dict:
    return {"flights_roundtrip": flights_roundtrip, "fares_roundtrip": fares_roundtrip,
            "weather_roundtrip": weather_roundtrip, "fare_file_audit": fare_file_audit,
            "malformed_values": malformed_values, "saved_reports": saved_reports}
