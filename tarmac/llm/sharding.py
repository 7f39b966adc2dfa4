"""Balanced label propagation: linked documents gather in shards of equal counts.

Documents with equal texts are linked. Every document starts in a shard drawn by
hash; in each round the documents of a group ask for the shard that holds most of their
group, those of a group above the quota for as many shards as it needs. A shard lets in
as many as it has room for (its quota less the linked documents in it) and as leave it in
the same round, so full shards exchange documents. Documents of one group in one shard are
exchangeable, so the rounds run on counts per (group, shard), at most one row for each shard
a group touches: joins and sums of pre-aggregated rows, never rows of one group in one
task. Every move adds pairs of linked documents within a shard; the rounds end when two
in a row add none. Unlinked documents fill up each shard to its quota, so counts differ by one at
most (law ``rows``), and positions follow from one global sort.

Defined results:

* null text: size 16, CRC 0, linked with nothing; empty texts are equal texts;
* repeated rows are rows of their own and, having equal texts, linked;
* null keys are kept; other columns of ``docs`` play no part;
* an empty table gives an empty result; a group larger than a quota fills
  shards and spreads its rest.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tarmac.llm.common import join_counted, stored

SHARDS = 40
_ROW_BITS = 33  # of monotonically_increasing_id: the row's place in its partition


def numbered(df: DataFrame, order: list, name: str) -> DataFrame:
    """``df`` in the given order, with its position from 0 as column ``at``.

    One range-partitioned sort is written out; positions are each partition's
    start (one number per partition) plus the place in the partition.
    """
    rows = stored(df.orderBy(*order).withColumn("_id", F.monotonically_increasing_id()), name)
    part = F.shiftright("_id", _ROW_BITS)
    sizes = rows.groupBy(part.alias("_part")).agg((F.max("_id") + 1).alias("_end"))
    count = F.col("_end") - F.shiftleft(F.col("_part"), _ROW_BITS)
    starts, start = {}, 0
    for p, n in sorted((r[0], r[1]) for r in sizes.select("_part", count).collect()):
        starts[p] = start
        start += n
    table = _literal(df, {"_part": "long", "_start": "long"}, list(starts.items()) or [(0, 0)])
    place = F.col("_id") - F.shiftleft(F.col("_p"), _ROW_BITS)
    return rows.withColumn("_p", part).join(F.broadcast(table), F.col("_p") == F.col("_part")) \
        .withColumn("at", place + F.col("_start")).drop("_id", "_p", "_part", "_start")


def _literal(df: DataFrame, columns: dict[str, str], rows: list[tuple]) -> DataFrame:
    """A small table as literals of the plan (no Python rows)."""
    kinds = list(columns.values())
    entries = [F.struct(*[F.lit(int(v)).cast(t).alias(c) for v, t, c in zip(row, kinds, columns, strict=True)])
               for row in rows]
    return df.sparkSession.range(1, numPartitions=1).select(F.inline(F.array(*entries)))


def running(df: DataFrame, value: str, by: list[str], order: list, name: str) -> DataFrame:
    """``df`` with ``upto``: the sum of ``value`` over the rows of its ``by`` up to and with each row.

    One range sort; sums run within a partition's rows of one ``by``, and the partitions
    before add theirs: at most one number for each partition and ``by``. So the work of one
    ``by`` spreads over as many tasks as it has rows for.
    """
    rows = stored(df.orderBy(*by, *order).withColumn("_part", F.spark_partition_id()), name)
    here = [*by, "_part"]
    local = Window.partitionBy(*here).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = rows.groupBy(*here).agg(F.sum(value).alias("_sum"))
    before = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = stored(sums.withColumn("_before", F.coalesce(F.sum("_sum").over(before), F.lit(0).cast("long")))
                    .drop("_sum"), f"{name}-starts")
    return rows.withColumn("_upto", F.sum(value).over(local)).join(F.broadcast(starts), here) \
        .withColumn("upto", F.col("_upto") + F.col("_before")).drop("_part", "_upto", "_before")


def _pick(values: list[int], at: Column) -> Column:
    return F.get(F.array(*[F.lit(int(v)).cast("long") for v in values]), at)


def _loads(held: DataFrame, shards: int) -> list[int]:
    got = {r["shard"]: r["n"] for r in held.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
    return [got.get(s, 0) for s in range(shards)]


def _together(held: DataFrame) -> int:
    """Sum of the squared counts: it grows as the cut falls."""
    return int(held.agg(F.sum((F.col("n") * F.col("n")).cast("decimal(38,0)"))).first()[0] or 0)


def _let_in(wanted: np.ndarray, rooms: list[int]) -> np.ndarray:
    """How many of the ``wanted`` moves (from, to) may be made: no shard takes in more than
    its room and what leaves it."""
    room, asked = np.array(rooms, float), np.maximum(wanted.sum(0), 1)
    share = np.ones(len(rooms))
    for _ in range(200):
        less = np.minimum(share, np.clip((room + wanted @ share) / asked, 0, 1))
        if np.allclose(less, share, rtol=0, atol=1e-9):
            break
        share = less
    flow = np.floor(wanted * share).astype(np.int64)
    slack = np.array(rooms, np.int64) - flow.sum(0) + flow.sum(1)
    while len(over := np.flatnonzero((slack < 0) & (flow.sum(0) > 0))):  # what rounding down cost
        for to in over:
            for source in np.argsort(-flow[:, to], kind="stable"):
                back = min(flow[source, to], max(0, -slack[to]))
                flow[source, to] -= back
                slack[to] += back
                slack[source] -= back
    added = True
    while added:  # single moves that still fit
        added = False
        for source, to in np.argwhere((flow < wanted) & (slack > 0)[None]):
            more = min(wanted[source, to] - flow[source, to], slack[to])
            if more > 0:
                flow[source, to] += more
                slack[to] -= more
                slack[source] += more
                added = True
    rest = wanted - flow
    both = np.minimum(rest, rest.T)  # plain exchanges, then longer rings
    flow, rest = flow + both, rest - both
    while True:
        while len(ends := np.flatnonzero((rest.sum(0) > 0) != (rest.sum(1) > 0))):
            rest[ends], rest[:, ends] = 0, 0
        if not rest.any():
            return flow
        ring = [int(rest.sum(1).argmax())]
        while (to := int(rest[ring[-1]].argmax())) not in ring:
            ring.append(to)
        ring = ring[ring.index(to):]
        steps = ring, [*ring[1:], ring[0]]
        flow[steps] += (more := rest[steps].min())
        rest[steps] -= more


def propagate(held: DataFrame, quotas: list[int], round_no: int) -> DataFrame:
    """One round over ``held`` (grp, shard, n): the new counts.

    In even rounds a group asks for the shards with most of its documents, full or not; in odd
    ones for shards that have room for it, if there are any.
    """
    shards = len(quotas)
    rooms = [q - n for q, n in zip(quotas, _loads(held, shards), strict=True)]
    room = _pick(quotas, F.col("shard")) - F.col("n") if round_no % 2 == 0 else _pick(rooms, F.col("shard"))
    group = Window.partitionBy("grp")
    best = group.orderBy(F.desc("fits"), F.desc("n"), "tie", "shard")
    ranked = held.withColumn("room", F.greatest(room, F.lit(0).cast("long"))) \
        .withColumn("size", F.sum("n").over(group)) \
        .withColumn("fits", F.col("n") + F.col("room") >= F.col("size")) \
        .withColumn("tie", F.xxhash64("grp", "shard", F.lit(round_no))) \
        .withColumn("place", F.row_number().over(best)) \
        .withColumn("before", F.sum(F.col("n") + F.col("room")).over(
            best.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n") - F.col("room")) \
        .withColumn("stays", F.col("before") < F.col("size"))
    # at most one entry per shard in a group's list
    listed = ranked.withColumn("targets", F.collect_list(F.when(
        F.col("stays") & (F.col("room") > 0), F.struct("shard", "n"))).over(group)) \
        .withColumn("staying", F.count_if("stays").over(group))
    turn = F.pmod(F.col("place") - F.col("staying") - 1, F.greatest(F.size("targets"), F.lit(1))).cast("int")
    asked = stored(listed.withColumn("target", F.when(~F.col("stays"), F.get("targets", turn)))
                   .select("grp", "shard", "n", "tie", F.col("target.shard").alias("to"),
                           F.col("target.n").alias("there")), "shard-asked")
    wanted = np.zeros((shards, shards), np.int64)
    for r in asked.where("to is not null").groupBy("shard", "to").agg(F.sum("n").alias("n")).collect():
        wanted[r["shard"], r["to"]] = r["n"]
    flow = _let_in(wanted, rooms)
    moves = [(int(s), int(t), int(flow[s, t])) for s, t in np.argwhere(flow > 0)]
    if not moves:
        return held
    allowed = _literal(held, {"shard": "int", "to": "int", "allowed": "long"}, moves)
    left = F.col("allowed") - (F.col("upto") - F.col("n"))
    queue = asked.where("to is not null").join(F.broadcast(allowed), ["shard", "to"])
    movers = running(queue, "n", ["shard", "to"], [F.desc("there"), F.asc("tie"), F.asc("grp")], "shard-queue") \
        .withColumn("m", F.least(F.col("n"), F.greatest(left, F.lit(0).cast("long")))) \
        .where(F.col("m") > F.greatest(F.col("n") - F.col("there"), F.lit(0)))  # else the cut would not fall
    pieces = held.select("grp", "shard", "n") \
        .unionByName(movers.select("grp", "shard", (-F.col("m")).alias("n"))) \
        .unionByName(movers.select("grp", F.col("to").alias("shard"), F.col("m").alias("n")))
    return stored(pieces.groupBy("grp", "shard").agg(F.sum("n").alias("n")).where("n > 0"), "shard-counts")


def shard_documents(docs: DataFrame, shards: int = SHARDS, rounds: int | None = None,
                    key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, size, text_crc32, law, shard, slot, grown_shard`` and ``start_shard`` of every row.

    ``start_shard`` is the shard a linked document was drawn into before the rounds
    (null for others); with ``linked`` (boolean) it shows what the rounds gained. ``rounds``
    limits the rounds; without it they go on until the cut no longer falls.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    base = docs.select(
        F.col(key).alias("key"), (F.octet_length(whole).cast("long") + 16).alias("size"),
        F.crc32(whole.cast("binary")).alias("text_crc32"),
        F.when(F.col(text).isNotNull(), F.unhex(F.sha2(F.col(text), 256))).alias("grp"))
    base = stored(base.withColumn("row", F.monotonically_increasing_id()), "shard-base")
    total = base.count()
    groups = stored(base.where("grp is not null").groupBy("grp").agg(F.count(F.lit(1)).alias("n"))
                    .where("n > 1").withColumn("linked", F.lit(True)), "shard-groups")
    flagged = join_counted(base, groups, "grp", total).withColumn("linked", F.col("linked").isNotNull())
    ranked = numbered(flagged, ["linked", "grp", "row"], "shard-ranked") \
        .withColumn("start_shard", F.when(F.col("linked"), F.pmod(
            F.xxhash64("row"), F.lit(shards)).cast("int")))

    quotas = [total // shards + (s < total % shards) for s in range(shards)]
    linked = ranked.where("linked")
    singles = total - linked.count()
    held = stored(linked.groupBy("grp", F.col("start_shard").alias("shard"))
                  .agg(F.count(F.lit(1)).alias("n")), "shard-counts")
    together, idle, r = _together(held), 0, 0
    while idle < 2 and (rounds is None or r < rounds):
        held = propagate(held, quotas, r)
        before, together = together, _together(held)
        idle, r = (0 if together > before else idle + 1), r + 1

    # Per shard: its groups' documents in order up to the quota; what exceeds it joins the pool.
    quota = _pick(quotas, F.col("shard"))
    placed = running(held, "n", ["shard"], [F.asc("grp")], "shard-held") \
        .withColumn("offset", F.col("upto") - F.col("n")) \
        .withColumn("stay", F.greatest(F.lit(0).cast("long"),
                                       F.least(F.col("upto"), quota) - F.col("offset")))
    placed = stored(placed.withColumn("out", F.col("n") - F.col("stay")), "shard-placed")
    kept = [min(q, n) for q, n in zip(quotas, _loads(held, shards), strict=True)]
    free = [q - k for q, k in zip(quotas, kept, strict=True)]
    free_upto = [sum(free[:s + 1]) for s in range(shards)]

    in_group = Window.partitionBy("grp").orderBy("shard").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    # Pool positions of what exceeds a quota follow those of the unlinked documents.
    out = placed.where("out > 0").select("grp", "shard", "out", F.lit(0).alias("all"))
    out = running(out, "out", ["all"], [F.asc("shard"), F.asc("grp")], "shard-out") \
        .withColumn("pool", F.col("upto") - F.col("out") + singles)
    pieces = placed.join(out.select("grp", "shard", "pool"), ["grp", "shard"], "left") \
        .withColumn("last", F.sum("n").over(in_group))
    # at most one entry per shard in a group's list
    lists = pieces.groupBy("grp").agg(F.collect_list(F.struct(
        (F.col("last") - F.col("n")).alias("first"), "last", "shard", "offset", "stay", "pool"))
        .alias("pieces"))
    firsts = linked.groupBy("grp").agg(F.min("at").alias("group_at"), F.count(F.lit(1)).alias("n"))

    def by_pool(at: Column) -> Column:
        ends = F.array(*[F.lit(x).cast("long") for x in free_upto])
        return F.size(F.filter(ends, lambda e: e <= at)).cast("int")

    def pool_slot(at: Column, shard: Column) -> Column:
        starts = [u - f for u, f in zip(free_upto, free, strict=True)]
        return at - _pick(starts, shard) + _pick(kept, shard)

    in_pool = ranked.where("not linked").withColumn("shard", by_pool(F.col("at"))) \
        .withColumn("slot", pool_slot(F.col("at"), F.col("shard")))
    nth = F.col("at") - F.col("group_at")
    placed_rows = join_counted(linked, stored(lists.join(firsts, "grp"), "shard-pieces"), "grp", total - singles) \
        .withColumn("nth", nth) \
        .withColumn("piece", F.get(F.filter("pieces", lambda p: (p["first"] <= F.col("nth"))
                                            & (F.col("nth") < p["last"])), F.lit(0))) \
        .withColumn("in_piece", F.col("nth") - F.col("piece.first")) \
        .withColumn("pool_at", F.when(F.col("in_piece") >= F.col("piece.stay"),
                                      F.col("piece.pool") + F.col("in_piece") - F.col("piece.stay"))) \
        .withColumn("shard", F.coalesce(by_pool(F.col("pool_at")) + F.lit(0) * F.col("pool_at").cast("int"),
                                        F.col("piece.shard"))) \
        .withColumn("slot", F.coalesce(pool_slot(F.col("pool_at"), F.col("shard")),
                                       F.col("piece.offset") + F.col("in_piece")))
    names = ["key", "size", "text_crc32", "shard", "slot", "linked", "start_shard"]
    both = in_pool.select(*names).unionByName(placed_rows.select(*names))
    return both.select(F.col("key").alias(key), "size", "text_crc32", F.lit("rows").alias("law"),
                       F.col("shard").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot"),
                       F.lit(None).cast("int").alias("grown_shard"), "linked", "start_shard")
