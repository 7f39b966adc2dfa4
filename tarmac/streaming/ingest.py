"""Incremental ingestion of new flight, fare and weather files with Structured Streaming.

The reference re-reads every file for each report. The tables only grow (new files each
month or quarter), so the summaries of ``tarmac.plans.summary`` can be maintained
incrementally instead: a file stream picks up new files, each micro-batch is reduced to
its partial summary (mergeable counts, sums, minima and maxima) and stored under its batch
id. Reports read the merged summary, which equals the summary of all files. Fares are
kept as cells in which the scale repair is still open, so a late file may turn its
batch from clean to fixed or back.

Exactly once: the partial summary of batch ``b`` is written to its own
folder with overwrite, so a retried batch replaces its own output. The stream's
checkpoint (files seen) lives beside the partial summaries in ``table_dir``, so
the next application goes on where the last one ended; it is not in
``spark.checkpoint.dir``, where every application has a folder of its own.
``compact`` folds the partial summaries of finished batches into one.
"""

from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tarmac.plans.summary import FARE_KEYS, FLIGHT_KEYS, fare_cells, flight_summary, merged, weather_summary
from tarmac.sources.files import SCHEMAS, path_exists, read_fares, read_flights, read_weather

#: Kind of table -> its batch reader, its summary, and the summary's keys.
KINDS = {"flights": (read_flights, flight_summary, [*FLIGHT_KEYS, "gid"]),
         "fares": (read_fares, fare_cells, FARE_KEYS),
         "weather": (read_weather, weather_summary, ["NAME", "month"])}
FILES = "path string, modificationTime timestamp, length long, content binary"


def file_stream(spark: SparkSession, source_dir: str, fmt: str = "parquet",
                max_files_per_trigger: int | None = None, kind: str = "flights") -> DataFrame:
    """Streaming DataFrame over the files of one kind landing in ``source_dir``.

    Parquet columns are found by name. A CSV stream gives the names of the new files
    only (``path``): each has a header of its own, which the batch reader follows. The
    files are not opened for that, as no column of their content is selected.
    """
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt == "csv":
        return reader.format("binaryFile").schema(FILES).load(source_dir).select("path")
    return reader.format(fmt).schema(SCHEMAS[kind]).load(source_dir)


def start_summary_stream(spark: SparkSession, source_dir: str, table_dir: str,
                         fmt: str = "parquet", available_now: bool = True,
                         processing_time: str | None = None,
                         max_files_per_trigger: int | None = None, kind: str = "flights") -> StreamingQuery:
    """Start the stream that keeps ``table_dir`` holding partial summaries.

    ``available_now`` processes every file present and stops (a scheduled
    batch run); otherwise ``processing_time`` (e.g. "10 minutes") keeps it
    running.
    """
    deltas = os.path.join(table_dir, "deltas")
    read, summarize, _ = KINDS[kind]

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        if fmt == "csv":
            paths = [r["path"] for r in batch.collect()]  # the files of one batch
            if not paths:
                return
            batch = read(spark, paths)
        summarize(batch).write.mode("overwrite").parquet(os.path.join(deltas, f"batch_id={batch_id}"))

    writer = file_stream(spark, source_dir, fmt, max_files_per_trigger, kind).writeStream \
        .foreachBatch(write_batch).option("checkpointLocation", os.path.join(table_dir, "_checkpoint"))
    writer = (writer.trigger(availableNow=True) if available_now
              else writer.trigger(processingTime=processing_time or "10 minutes"))
    return writer.start()


def _parts(spark: SparkSession, table_dir: str) -> tuple[DataFrame, int]:
    """The stored partial summaries, and the last batch folded into the compacted one."""
    upto, base = -1, None
    pointer = os.path.join(table_dir, "compacted")
    if path_exists(spark, pointer):
        # the newest pointer names the compacted table and its last batch
        newest = max((json.loads(r["value"]) for r in spark.read.text(pointer).collect()),
                     key=lambda x: x["upto"])
        upto, base = newest["upto"], newest["path"]
    deltas = spark.read.parquet(os.path.join(table_dir, "deltas")).where(F.col("batch_id") > upto) \
        .drop("batch_id")
    if base is not None:
        deltas = deltas.unionByName(spark.read.parquet(base))
    return deltas, upto


def merged_summary(spark: SparkSession, table_dir: str, kind: str = "flights") -> DataFrame:
    """Merge the stored partial summaries into one.

    Counts and sums add up, minima and maxima take theirs: the result equals the
    summary of all ingested files. Of fares these are the cells before the repair;
    ``tarmac.plans.summary.settled_fares`` decides it.
    """
    return merged(_parts(spark, table_dir)[0], KINDS[kind][2])


def compact(spark: SparkSession, table_dir: str, kind: str = "flights") -> int:
    """Fold every finished batch into one table; the last batch folded.

    The table is written first and the pointer to it after, so readers see either the old
    or the new state. Batch folders stay until the user removes those up to the last batch.
    """
    last = spark.read.parquet(os.path.join(table_dir, "deltas")).agg(F.max("batch_id")).first()[0]
    path = os.path.join(table_dir, f"folded-{uuid.uuid4().hex}")
    merged_summary(spark, table_dir, kind).write.parquet(path)
    spark.createDataFrame([(json.dumps({"upto": int(last), "path": path}),)], "value string") \
        .coalesce(1).write.mode("append").text(os.path.join(table_dir, "compacted"))
    return int(last)
