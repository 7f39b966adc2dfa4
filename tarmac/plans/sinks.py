"""Distributed writers (SNK-1..4). Nothing is collected to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame


def save_table(df: DataFrame, path: str, fmt: str = "parquet",
               partition_by: list[str] | None = None) -> None:
    """SNK-1: overwrite a report table (parquet by default, CSV with header)."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.format(fmt).save(path)


def save_record(df: DataFrame, path: str) -> None:
    """SNK-2 / SNK-4: a one-row record (summary, metrics, bundle) as JSON.

    The input is a single row, so one output file is written.
    """
    df.coalesce(1).write.mode("overwrite").json(path)


def save_model(model, path: str) -> None:
    """SNK-3: overwrite a fitted pipeline."""
    model.write().overwrite().save(path)
