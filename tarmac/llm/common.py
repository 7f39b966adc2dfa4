"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.operators.joins import materialize

#: Java and RE2 pattern of what stands between words.
GAP = r"[\x20\x09-\x0D]+"
GAPS = " \t\n\x0b\f\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once below ``spark.checkpoint.dir`` and read back: later jobs
    neither rerun its lineage nor see other values of its generated ids."""
    return materialize(df, name)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often ``body`` uses it.

    A column that a lambda mentions may be inlined into the lambda and be
    recomputed for every element; a lambda variable is not.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    """The words of ``text`` in order; null text has none."""
    return let(F.btrim(F.coalesce(text, F.lit("")), F.lit(GAPS)),
               lambda t: F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, GAP)))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` clashes (case ignored)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


#: A key with more than this part of all rows is joined by broadcast: at most as many keys.
HOT_KEYS = 1000


def join_counted(rows: DataFrame, small: DataFrame, key: str, total: int) -> DataFrame:
    """``rows`` left joined with ``small`` (``key``, ``n``: its rows, more) by ``key``.

    Keys with more than a ``HOT_KEYS``-th of all ``total`` rows, so at most that many,
    are joined by broadcast, where no task gets a key's rows together.
    """
    often = F.col("n") * HOT_KEYS > total
    hot, cold = F.broadcast(small.where(often)).drop("n"), small.where(~often).drop("n")
    return rows.join(hot, key).unionByName(
        rows.join(hot.select(key), key, "left_anti").join(cold, key, "left"))


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver found it."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", os.environ.get("PYTHONPATH", "")).split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])
