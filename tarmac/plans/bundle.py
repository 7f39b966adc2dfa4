"""The nested results bundle for the web page (RAM-6, SNK-4).

Each section is a bounded table (a top-k list or a small report keyed by
airport, month, year ...). The bundle is one row whose columns are scalar
subqueries over the sections, in the sections' own order; carriers are a
code -> name map. It is written as one JSON document; ``bundle_records`` takes a saved
one apart again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.sources.files import read_saved_report

# Bundle section names, in the order of the exported document.
SECTIONS = ["airports", "busiest_routes", "route_lookup", "carrier_names", "fare_by_year",
            "fare_by_quarter", "monthly_delays", "daily_delays", "delay_causes",
            "most_expensive", "cheapest", "best_value", "worst_weather", "top_dep_delays",
            "top_arr_delays"]


def section_counts(sections: dict[str, DataFrame]) -> DataFrame:
    """(section, row_count) for every section of the bundle."""
    out = None
    for name in SECTIONS:
        one = sections[name].agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("section"), "row_count")
        out = one if out is None else out.unionByName(one)
    return out


def _in_order(section: DataFrame):
    """The section's rows as one array, in its order.

    ``collect_list`` alone takes partitions as they arrive; ids increase along a sorted frame.
    """
    rows = section.select(F.struct("*").alias("row")).withColumn("at", F.monotonically_increasing_id())
    return rows.select(F.transform(F.array_sort(F.collect_list(F.struct("at", "row"))),
                                   lambda x: x["row"])).scalar()


def results_bundle(spark: SparkSession, sections: dict[str, DataFrame]) -> DataFrame:
    """One row: ``meta`` plus one array-of-struct column per section."""
    # Missing numbers read as 0 in the exported records, as in the reference.
    lists = {name: _in_order(sections[name].na.fill(0)) for name in SECTIONS if name != "carrier_names"}
    names = sections["carrier_names"].where("code is not null")
    lists["carrier_names"] = names.select(F.map_from_entries(
        F.array_sort(F.collect_set(F.struct("code", "name"))))).scalar()
    meta = F.struct(F.current_timestamp().alias("generated"),
                    F.size(lists["airports"]).alias("total_airports"),
                    F.size(lists["route_lookup"]).alias("total_routes")).alias("meta")
    return spark.range(1).select(meta, *[lists[name].alias(name) for name in SECTIONS])


def canonical_json(record: Column, fields: list[T.StructField]) -> Column:
    """The JSON text of a struct with one form per value: fields in order, fractional
    numbers with four digits, no blanks; strings escaped; null stays null."""
    def text(field: T.StructField) -> Column:
        value = record[field.name]
        if isinstance(field.dataType, T.StringType):
            value = F.concat(F.lit('"'), F.replace(F.replace(value, F.lit("\\"), F.lit("\\\\")), F.lit('"'),
                                                   F.lit('\\"')), F.lit('"'))
        elif isinstance(field.dataType, T.FractionalType):
            value = value.cast("decimal(28,4)").cast("string")
        else:
            value = value.cast("string")
        return F.concat(F.lit(f'"{field.name}":'), F.coalesce(value, F.lit("null")))

    return F.concat(F.lit("{"), F.concat_ws(",", *[text(f) for f in fields]), F.lit("}"))


def bundle_records(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """``section, position, record``: every record of the bundle saved at ``path``, in order.

    ``schema`` is the bundle's; a bundle that was never saved has no records. Carrier
    names stand by code, one record ``{code: name}`` each.
    """
    bundle = read_saved_report(spark, path, "json", schema)
    out = None
    for name in SECTIONS:
        if name == "carrier_names":
            pair = T.StructType.fromDDL("code string, name string")
            records = F.transform(F.array_sort(F.map_entries(name)), lambda e: F.struct(
                e["key"].alias("code"), e["value"].alias("name")))
            fields = pair.fields
        else:
            records, fields = F.col(name), schema[name].dataType.elementType.fields
        one = bundle.select(F.posexplode(records).alias("position", "record")).select(
            F.lit(name).alias("section"), (F.col("position") + 1).cast("long").alias("position"),
            canonical_json(F.col("record"), fields).alias("record"))
        out = one if out is None else out.unionByName(one)
    return out
