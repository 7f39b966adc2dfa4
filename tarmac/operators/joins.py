"""Join helpers: broadcast only behind a measured size, shuffle join beyond it."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.session import ensure_checkpoint_dir

# Rows above which an aggregated side is joined by shuffle instead of
# broadcast. History and lookup rows are ~100 bytes, so this keeps a
# broadcast table below ~50 MB on every executor.
DEFAULT_MAX_BROADCAST_ROWS = 500_000


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder below the session's checkpoint folder, removed by ``remove_tables``."""
    return os.path.join(ensure_checkpoint_dir(spark), "tables", f"{name}-{uuid.uuid4().hex}")


def materialize(df: DataFrame, name: str = "table", partition_by: str | None = None,
                rows_per_file: int | None = None) -> DataFrame:
    """Write ``df`` as parquet under the session's checkpoint folder and read it back.

    The folder is ``spark.checkpoint.dir`` (a shared folder on a cluster), so
    the lineage is cut and a lost executor never forces a rescan of the
    upstream data. Unlike an eager ``checkpoint()`` the plan runs once (no
    second job to write the checkpoint), and the planner gets exact file
    sizes for the read-back table. ``partition_by`` gives each value of that column a folder.
    A reader cannot split a row group, so a task that writes many rows leaves one large
    task to each later pass; ``rows_per_file`` has it write several files instead.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.mode("overwrite")
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    if not partition_by:
        writer.parquet(path)
        return spark.read.parquet(path)
    writer.partitionBy(partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)  # an empty table has no file to tell its columns


def checked_broadcast(small: DataFrame, rows: int,
                      max_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Mark ``small`` for broadcast when its measured ``rows`` fit the limit.

    Beyond the limit the side is returned unhinted and Spark plans a
    shuffle (sort-merge) join, so a table that grew with the data is never
    pushed whole to every executor.
    """
    return F.broadcast(small) if rows <= max_rows else small
