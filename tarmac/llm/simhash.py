"""Near copies: SimHash fingerprints linked by meet-in-the-middle ball hashing.

Two fingerprints differ in at most ``2 * HALF`` bits just if some word differs from either
in at most ``HALF`` bits. So every fingerprint emits all variants within ``HALF`` bits,
variants are shuffled, and fingerprints that meet in a variant are linked.

A 64-bit fingerprint has 2,081 variants within two bits. They are shuffled packed: a node
is the set of words with given lowest bits, and a fingerprint goes once to each node that
holds variants of it, with the flips still to be spent; the task of the node writes these
variants out, sorts them and finds the equal ones. With d lowest bits that is
1 + d + d(d-1)/2 rows a fingerprint in place of 2,081. The depth d follows from the
number of fingerprints, so that a node holds ``NODE`` variants on average. A node with
more than ``HOT`` is split by its next bits, again and again if need be; inside a task the
same split keeps ``PASS`` variants in memory at once. A node of all 64 bits is one variant,
so splitting ends.

Fingerprints that meet in one variant are all within ``2 * HALF`` bits of each other, so a
chain through them keeps every component; pairs of the chains are made distinct, verified
by counting bits, and cut to a spanning forest of the node before they leave the task.
A group of thousands of copies is one fingerprint and costs as much as any other.

Defined results:

* null text, empty text, text without words: fingerprint zero, linked like any other;
* fewer words than the shingle width: the whole sequence is the one shingle;
* null ids: members like others, never the smallest id unless all ids of a component are null;
* repeated rows each get their row; an empty table gives an empty result; other columns
  are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.llm.common import join_counted, ship_package, stored
from tarmac.llm.near_dups import components
from tarmac.operators.joins import checked_broadcast

WIDTH = 4
SEED = 42
BITS = 64
#: Links need at most twice as many differing bits.
HALF = 2
#: Variants of a node: on average, before it is split over tasks, and in memory at once.
NODE = 1 << 19
HOT = 1 << 27
PASS = 1 << 22
#: Bits by which a node is split.
STEP = 4


def fingerprint(text: str | None, width: int = WIDTH) -> int:
    """The fingerprint of one text, unsigned."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z alone are lowered
    if not words:
        return 0
    line = b" ".join(words)
    end = np.cumsum([len(w) + 1 for w in words]) - 1
    start = np.concatenate(([0], end[:-1] + 1))
    width = min(width, len(words))
    spans = list(zip(start[:len(words) - width + 1].tolist(), end[width - 1:].tolist(), strict=True))
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(spans), 1 << 16):
        h = np.array([xxhash.xxh64_intdigest(line[i:j], SEED) for i, j in spans[at:at + (1 << 16)]], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(spans), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """``id, print`` (signed long) of every row."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(t, width) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.array(prints, np.uint64).view(np.int64))], ["id", "print"])

    return rows.mapInArrow(run, T.StructType([rows.schema["id"], T.StructField("print", T.LongType())]))


def _flips(low: int, high: int, most: int) -> list[np.ndarray]:
    """For 0..most flips: the words with as many ones, all among bits ``low`` to ``high - 1``."""
    bits = np.uint64(1) << np.arange(low, high, dtype=np.uint64)
    out = [np.zeros(1, np.uint64), bits]
    for _ in range(2, most + 1):
        # a word with one bit more, above its highest one
        grown = [out[-1][out[-1] < b] | b for b in bits]
        out.append(np.concatenate(grown) if grown else bits)
    return out[:most + 1]


def variants(bits: int, flips: int = HALF) -> int:
    """Variants of a word within ``flips`` of its ``bits`` bits."""
    return sum(math.comb(bits, k) for k in range(flips + 1))


def _low(depth: int) -> np.uint64:
    return np.uint64((1 << depth) - 1)


def deepen(prints: np.ndarray, nodes: np.ndarray, depth: int, deeper: int) -> tuple[np.ndarray, np.ndarray]:
    """(print, node) of all nodes of ``deeper`` bits below the given ones that hold variants."""
    spent = np.bitwise_count((prints ^ nodes) & _low(depth))
    flips = _flips(depth, deeper, HALF)
    out_p, out_n = [], []
    for left in range(HALF + 1):
        p, n = prints[spent == HALF - left], nodes[spent == HALF - left]
        masks = np.concatenate(flips[:left + 1])
        p2 = np.repeat(p, len(masks))
        out_p.append(p2)
        out_n.append(np.repeat(n, len(masks)) | ((p2 ^ np.tile(masks, len(p))) & (_low(deeper) ^ _low(depth))))
    return np.concatenate(out_p), np.concatenate(out_n)


def _meetings(prints: np.ndarray, node: np.uint64, depth: int) -> np.ndarray:
    """Rows (a, b) of positions in ``prints`` that meet in a variant of one node, as chains."""
    spent = np.bitwise_count((prints ^ node) & _low(depth))
    flips = _flips(depth, BITS, HALF)
    words, owners = [], []
    for left in range(HALF + 1):
        at = np.flatnonzero(spent == HALF - left)
        masks = np.concatenate(flips[:left + 1])
        words.append(((prints[at] & ~_low(depth))[:, None] ^ masks[None, :]).ravel())
        owners.append(np.repeat(at, len(masks)))
    word, owner = np.concatenate(words), np.concatenate(owners)
    order = np.argsort(word, kind="stable")
    word, owner = word[order], owner[order]
    same = np.flatnonzero(word[1:] == word[:-1])
    pairs = np.sort(np.stack([owner[same], owner[same + 1]], 1), 1)
    return np.unique(pairs, axis=0)


def node_links(prints: np.ndarray, node: np.uint64, depth: int, most: int = PASS) -> list[tuple[int, int]]:
    """(print, print of its tree's root) of the fingerprints that a node links."""
    prints = np.unique(prints)
    parent = list(range(len(prints)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    stack = [(np.arange(len(prints)), node, depth)]
    while stack:
        at, here, d = stack.pop()
        spent = np.bitwise_count((prints[at] ^ here) & _low(d))
        weight = sum(int((spent == HALF - left).sum()) * variants(BITS - d, left) for left in range(HALF + 1))
        if weight > most and d < BITS:
            deeper = min(BITS, d + STEP)
            p, n = deepen(prints[at], np.full(len(at), here), d, deeper)
            order = np.argsort(n, kind="stable")
            cuts = np.flatnonzero(np.diff(n[order])) + 1
            stack += [(np.searchsorted(prints, p[part]), n[part[0]], deeper) for part in np.split(order, cuts)]
            continue
        pairs = at[_meetings(prints[at], here, d)]
        near = np.bitwise_count(prints[pairs[:, 0]] ^ prints[pairs[:, 1]]) <= 2 * HALF
        for a, b in pairs[near].tolist():
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    return [(int(prints[i]), int(prints[root(i)])) for i in range(len(prints)) if root(i) != i]


def _deepened(rows: DataFrame, deeper: int) -> DataFrame:
    """``depth, node, print`` rows, taken down to ``deeper`` bits (all rows have one depth)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            node, prints = (batch.column(i).to_numpy(zero_copy_only=False).view(np.uint64) for i in (1, 2))
            depth = batch.column(0)[0].as_py()
            for at in range(0, len(node), 2048):
                p, n = deepen(prints[at:at + 2048], node[at:at + 2048], depth, deeper)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(p), deeper, np.int32)), pa.array(n.view(np.int64)),
                     pa.array(p.view(np.int64))], ["depth", "node", "print"])

    return rows.select("depth", "node", "print").mapInArrow(run, "depth int, node long, print long")


def ball_links(prints: DataFrame, count: int, node: int = NODE, hot: int = HOT, most: int = PASS) -> DataFrame:
    """Links (a, b) that connect all of the ``count`` distinct ``print`` within ``2 * HALF`` bits."""
    depth = min(BITS, max(0, math.ceil(math.log2(max(1, count * variants(BITS) / node)))))
    rows = prints.select(F.lit(0).alias("depth"), F.lit(0).cast("long").alias("node"), "print")
    rows = stored(_deepened(rows, depth), "sim-nodes")

    def run(group: pd.DataFrame) -> pd.DataFrame:
        links = node_links(group["print"].to_numpy(np.int64).view(np.uint64),
                           np.array([group["node"].iloc[0]], np.int64).view(np.uint64)[0],
                           int(group["depth"].iloc[0]), most)
        pairs = np.array(links, np.uint64).reshape(-1, 2).view(np.int64)
        return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})

    ready = []
    while True:
        spent = F.bit_count((F.col("print").bitwiseXOR(F.col("node"))).bitwiseAND(
            F.lit(int(np.array([_low(depth)]).view(np.int64)[0]))))
        weight = F.element_at(F.array(*[F.lit(variants(BITS - depth, HALF - s)) for s in range(HALF + 1)]),
                              spent.cast("int") + 1)
        heavy = rows.groupBy("node").agg(F.sum(weight).alias("weight")).where(F.col("weight") > hot).select("node")
        heavy = stored(heavy, "sim-hot")
        n_heavy = heavy.count()
        if not n_heavy or depth >= BITS:
            ready.append(rows)
            break
        small = checked_broadcast(heavy, n_heavy)
        ready.append(rows.join(small, "node", "left_anti").select(rows.columns))
        deeper = min(BITS, depth + STEP)
        rows = stored(_deepened(rows.join(small, "node", "left_semi"), deeper), "sim-nodes")
        depth = deeper
    every = ready[0]
    for more in ready[1:]:
        every = every.unionByName(more)
    return every.groupBy("depth", "node").applyInPandas(run, "a long, b long")


def simhash_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH,
                   node: int = NODE, hot: int = HOT, most: int = PASS) -> DataFrame:
    """``key, print, component_id`` of every row: the smallest id reachable over links."""
    signed = stored(fingerprints(docs, key, text, width), "sim-signed")
    classes = stored(signed.groupBy("print").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n")),
                     "sim-classes")
    count, total = classes.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    links = stored(ball_links(classes.select("print"), count, node, hot, most), "sim-links")
    roots = stored(components(links).select(F.col("node").alias("print"), "root"), "sim-roots")
    rooted = stored(classes.join(roots, "print", "left")
                    .select("print", "n", "least", F.coalesce("root", "print").alias("root")), "sim-rooted")
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("n"))
    named = join_counted(rooted.select("print", "root", F.col("n").alias("rows")), stored(smallest, "sim-least"),
                    "root", count).select("print", F.col("rows").alias("n"), "component_id")
    return join_counted(signed, stored(named, "sim-named"), "print", total) \
        .select(F.col("id").alias(key), "print", "component_id")


def simhash_report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``fingerprint`` (16 hex digits) and ``component_id`` of every row."""
    return simhash_groups(docs, key, text).select(
        key, F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")
