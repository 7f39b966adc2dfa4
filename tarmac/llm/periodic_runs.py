"""Periodic runs of words by the dictionary of basic factors.

Level k of the dictionary names every factor of 2**k words: equal factors of one
document, and only these, share a name. A name of level k + 1 is the pair of the names
of its halves, so a level costs one sort. Positions whose factor occurs once are left
out of all higher levels, which ends the levels of ordinary prose after a few.

Occurrences of a factor whose successor starts within its own length (both then lie
within twice that length) form arithmetic progressions. Neighbouring positions with one
such distance d are one stretch of period d. Each stretch proposes a run, which is
extended to either side as long as words d apart are equal; runs proposed at several
levels are kept once.

Why that is whole and exact: take a run of smallest period q and at least 2q + 2**k
words, with q <= 2**k < 2q. Were a factor of 2**k words at i of the run found again at
i + d, d < q, then d and q would both be periods of these 2**k + d >= q + d words, so
gcd(d, q) would be one of the run. So the successor is q words on: every run of four
periods is proposed, and no proposal has a smaller period than its distance.

Defined results:

* null text, empty text, text without words: no runs, the empty collapsed text;
* repeated rows and null ids are rows like others;
* an empty table gives an empty table; further columns are carried along.

A document is worked on within one task, in memory linear in its length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tarmac.llm import hashing
from tarmac.llm.common import free_name, let, ship_package, words_of

MIN_WORDS = 6
MIN_EXPONENT = 4
RUNS = "array<struct<start:long,length:long,period:long>>"


def _stretches(names: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first position, last position, distance) of the stretches of one level.

    ``names`` of the factors at the ascending positions ``at``.
    """
    order = np.lexsort((at, names))
    succ = np.zeros(len(at), np.int64)
    here, there = order[:-1], order[1:]
    gap = at[there] - at[here]
    close = (names[there] == names[here]) & (gap <= size)
    succ[here[close]] = gap[close]
    use = np.flatnonzero(succ)
    if not len(use):
        return at[:0], at[:0], at[:0]
    p, d = at[use], succ[use]
    new = np.concatenate(([True], (np.diff(p) != 1) | (np.diff(d) != 0)))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(p)) - 1
    return p[first], p[last], d[first]


def _repeated(names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(dense names, whether each occurs more than once)."""
    _, dense, often = np.unique(names, return_inverse=True, return_counts=True)
    return dense, often[dense] > 1


def runs_of(codes: np.ndarray, doc: np.ndarray, min_words: int = MIN_WORDS,
            min_exponent: int = MIN_EXPONENT) -> np.ndarray:
    """Rows (first word, words, period) of the runs of several texts at once, sorted.

    ``codes``: equal for equal words; ``doc``: ascending number of each word's text.
    Positions count through all texts; no run crosses texts, as names tell texts apart.
    """
    n = len(codes)
    if n < min_words:
        return np.zeros((0, 3), np.int64)
    words, _ = _repeated(doc.astype(np.int64) * (int(codes.max()) + 1) + codes)
    names, twice = _repeated(words)
    at = np.flatnonzero(twice)
    names = names[at]
    size, found = 1, []
    while len(at):
        first, last, d = _stretches(names, at, size)
        found.append(np.stack([first, last + size + d, d], 1))
        # the next level: both halves repeat, and so may the whole
        half = np.searchsorted(at, at + size)
        whole = half < len(at)
        whole[whole] = at[half[whole]] == at[whole] + size
        pairs = names[whole] * (int(names.max()) + 1) + names[half[whole]]
        dense, twice = _repeated(pairs)
        at, names, size = at[whole][twice], dense[twice], size * 2
    start, end, period = np.concatenate(found).T if found else np.zeros((3, 0), np.int64)
    # extend, all proposals together, one word a step; done where words differ or the text ends
    for side in (-1, 1):
        live = np.arange(len(start))
        while len(live):
            if side < 0:
                i = start[live] - 1
                inside, j = i >= 0, i + period[live]
            else:
                j = end[live]
                inside, i = j < n, j - period[live]
            live, i, j = live[inside], i[inside], j[inside]
            same = words[i] == words[j]
            live = live[same]
            if side < 0:
                start[live] -= 1
            else:
                end[live] += 1
    length = end - start
    long = length >= np.maximum(min_words, min_exponent * period)
    return np.unique(np.stack([start, period, length], 1)[long], axis=0)[:, [0, 2, 1]]


def find_runs(docs: DataFrame, text: str = "text", min_words: int = MIN_WORDS,
              min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """The rows of ``docs`` with ``n_words``, ``runs`` and ``collapsed`` added.

    ``runs``: start (word number from 0), length and period in words, by start, then
    period. ``collapsed``: the text without the words that a run repeats, one blank
    between words. Columns of ``docs`` named like an added one are replaced by it.
    ``min_exponent`` must be 4 or more: fewer periods are not all proposed.
    """
    if min_exponent < MIN_EXPONENT:
        raise ValueError("runs of fewer than four periods are not all found")
    ship_package(docs.sparkSession)
    added = ("n_words", "runs", "collapsed")
    kept = [c for c in docs.columns if c.lower() not in added]
    source = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").alias(free_name(docs, "text")))
    fields = T.StructType.fromDDL(f"n_words long, runs {RUNS}, collapsed string").fields
    kinds = [to_arrow_type(f.dataType) for f in fields]

    def one(batch: list[str | None]) -> tuple[list, list, list]:
        split = [(t or "").encode("utf-8", "surrogatepass").split() for t in batch]
        sizes = np.array([len(w) for w in split], np.int64)
        first = np.cumsum(sizes) - sizes
        flat = np.empty(int(sizes.sum()), object)
        flat[:] = [w for ws in split for w in ws]
        codes = pd.factorize(flat)[0] if len(flat) else np.zeros(0, np.int64)
        found = runs_of(codes, np.repeat(np.arange(len(split)), sizes), min_words, min_exponent)
        gone = np.zeros(len(flat) + 1, np.int64)
        np.add.at(gone, found[:, 0] + found[:, 2], 1)
        np.add.at(gone, found[:, 0] + found[:, 1], -1)
        stays = np.cumsum(gone)[:-1] == 0
        owner = np.searchsorted(first + sizes, found[:, 0], side="right")
        cut = np.searchsorted(owner, np.arange(len(split) + 1))
        runs, texts = [], []
        for d, words in enumerate(split):
            own = found[cut[d]:cut[d + 1]]
            runs.append([{"start": int(s - first[d]), "length": int(n), "period": int(q)} for s, n, q in own])
            if len(own):
                words = flat[first[d]:first[d] + sizes[d]][stays[first[d]:first[d] + sizes[d]]]
            texts.append(b" ".join(words).decode("utf-8", "surrogatepass"))
        return [int(s) for s in sizes], runs, texts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            for lo, hi in hashing.batches_by_bytes([t or "" for t in texts]):
                new = [pa.array(values, kind) for values, kind in zip(one(texts[lo:hi]), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([*batch.slice(lo, hi - lo).columns[:-1], *new], [*kept, *added])

    return source.mapInArrow(run, T.StructType([*source.schema.fields[:-1], *fields]))


def planted(text: Column, key: Column) -> Column:
    """``text``, made periodic from a word on where a checksum of ``key`` asks for it.

    With h = crc32 of the decimal ``key`` and g = h // 10: where h % 10 = 0 and the text
    has n > 0 words, word i >= a becomes word a + (i - a) % p, with a = g % n and
    p = 1 + (n - a) // (3 + g % 8). A null ``key`` asks for nothing.
    """
    h = F.crc32(key.cast("string").cast("binary"))

    def periodic(words: Column) -> Column:
        n = F.size(words).cast("long")
        g = F.floor(h / 10).cast("long")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8)).cast("long")
        return F.when(n == 0, text).otherwise(let(F.struct(a.alias("a"), p.alias("p")), lambda x: F.array_join(
            F.transform(words, lambda w, i: F.when(i < x["a"], w).otherwise(
                F.get(words, (x["a"] + (i - x["a"]) % x["p"]).cast("int")))), " ")))

    return F.when(h % 10 == 0, let(words_of(text), periodic)).otherwise(text)


def run_report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: number of runs, the run of greatest exponent, digests of runs and collapsed text.

    Exponents are compared exactly, as products of whole numbers; ties go to the
    smallest start, then the smallest period.
    """
    rows = docs.select(F.col(key).alias("doc_id"), planted(F.col(text), F.col(key)).alias("text"))
    found = find_runs(rows)
    best = F.aggregate("runs", F.lit(None).cast("struct<start:long,length:long,period:long>"), lambda b, r: F.when(
        b.isNull() | (r["length"] * b["period"] > b["length"] * r["period"]), r).otherwise(b))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(
        ",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        F.col("doc_id").alias(key), F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length",
        "best.period", F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
