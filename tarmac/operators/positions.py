"""Row numbers of sorted frames without a window over all rows (SRT-1..3, LIM-1/2).

``row_number() over (order by ...)`` brings every row to one task. A sorted frame
already has its rows in order within and across its partitions, so a row's number is its
place in its partition plus the rows of the partitions before. The frame is written once
with both; what is summed up over partitions is one row each.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.functions.exprs import c
from tarmac.operators.joins import checked_broadcast, materialize

_PLACE = (1 << 33) - 1


def numbered(df: DataFrame, position: str = "position", by: str | None = None) -> DataFrame:
    """``df`` with ``position``: 1, 2, ... in the order in which ``df`` is sorted.

    With ``by``, numbers start again for each value of that column; rows of one partition
    and different values must then come from different frames (see ``positions``).
    """
    # partition number in the upper bits, place within the partition in the lower 33
    placed = materialize(df.withColumn("_at", F.monotonically_increasing_id()), "placed")
    keys = [by] if by else []
    part = F.shiftright("_at", 33).alias("_part")
    counts = placed.groupBy(*keys, part).agg(F.count(F.lit(1)).alias("_rows"))
    # one row per partition of the sorted frame
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = materialize(counts.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
                         .drop("_rows"), "starts")
    out = placed.withColumn("_part", F.shiftright("_at", 33)) \
        .join(checked_broadcast(starts, starts.count()), [*keys, "_part"])
    number = c("_before") + c("_at").bitwiseAND(F.lit(_PLACE)) + 1
    return out.select(*df.columns, number.alias(position))


def with_row_numbers(df: DataFrame, *order: Column, position: str = "position") -> DataFrame:
    """``df`` numbered by ``order``: one range sort, no window over all rows."""
    return numbered(df.orderBy(*order), position)


def positions(frames: Mapping[str, DataFrame], keys: Mapping[str, tuple[str, ...]]) -> DataFrame:
    """``report, position, key``: where each row stands in each sorted frame.

    ``keys`` names the columns that identify a row of a frame; ``key`` is their text,
    joined by ``|``, with ``null`` for null.
    """
    parts = None
    for name, columns in keys.items():
        text = F.concat_ws("|", *[F.coalesce(c(k).cast("string"), F.lit("null")) for k in columns])
        one = frames[name].select(F.lit(name).alias("report"), text.alias("key"))
        parts = one if parts is None else parts.unionByName(one)
    return numbered(parts, by="report").select("report", "position", "key")
