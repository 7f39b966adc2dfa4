"""Importance resampling: documents drawn by how much more the target would write them.

Words and word pairs are hashed into ``BUCKETS`` buckets. Two generative models, the
bucket frequencies of target text (documents labelled good: ``GOOD``) and of all text, give
every n-gram a log ratio. A document's log weight is the sum of its n-grams' log ratios, the
log of the ratio of its likelihoods. Adding Gumbel noise to the log weights and keeping the
``k`` largest draws ``k`` documents without replacement with chances in proportion to their
weights. Such weights grow with the text; ``effective``, off unless asked for, lets at most so
many n-grams count, at the document's mean log ratio.

All documents count towards the raw model and all labelled ones towards the target
model; bucket counts are added up in each task before the shuffle. The cut between
kept and rejected comes from histograms, so no task sees all keys.

Defined results:

* null or empty text, or text without words: no n-grams, null weight, never kept;
* labels repeated for one id: good if any of them is; null labels and ids label nothing;
* without a target the models are alike and the noise alone decides;
* repeated rows share key and noise; all rows whose key equals the last kept one are kept;
* an empty table gives an empty result; only the key and text columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm import hashing
from tarmac.llm.common import ship_package, stored
from tarmac.operators.joins import checked_broadcast

BUCKETS = 1 << 16
#: The labelled rows that the target model is made of, and whose share is kept.
GOOD = "quality = 1 AND coalesce(toxic, 0) = 0"
SEED = 20240311
#: Values of one histogram, and rows of the last bin that are looked at one by one.
BINS = 1024
LAST_BIN = 10_000


def gram_buckets(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, text index) of every word and pair of neighbouring words."""
    h, doc = hashing.words(texts, lower=True)
    pair = doc[1:] == doc[:-1]
    pairs = hashing.mix64(h[:-1] * np.uint64(0xD1342543DE82EF95) + h[1:])[pair]
    at = np.concatenate((h, pairs)) % np.uint64(BUCKETS)
    return at.astype(np.int64), np.concatenate((doc, doc[1:][pair]))


def _counted(rows: DataFrame) -> DataFrame:
    """``bucket, raw, target`` counts of rows (text, good)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            texts, good = list(batch["text"]), batch["good"].to_numpy(bool)
            for lo, hi in hashing.batches_by_bytes(texts):
                at, doc = gram_buckets(texts[lo:hi])
                raw += np.bincount(at, minlength=BUCKETS)
                target += np.bincount(at[good[lo:hi][doc]], minlength=BUCKETS)
        some = np.flatnonzero(raw)
        yield pd.DataFrame({"bucket": some, "raw": raw[some], "target": target[some]})

    return rows.mapInPandas(run, "bucket int, raw long, target long") \
        .groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))


def log_ratios(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
               good: str = GOOD) -> np.ndarray:
    """Log ratio of target to raw frequency of each bucket (add-one smoothing)."""
    ids = labels.where(good).where(F.col(key).isNotNull()).select(F.col(key).alias("_id")).distinct()
    marked = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text")) \
        .join(checked_broadcast(ids, ids.count()), F.col("id") == F.col("_id"), "left") \
        .select("text", F.col("_id").isNotNull().alias("good"))
    counts = np.zeros((2, BUCKETS))
    for r in _counted(marked).collect():  # one row for each of the BUCKETS buckets at most
        counts[:, r["bucket"]] = r["raw"], r["target"]
    if not counts[1].any():
        return np.zeros(BUCKETS)
    raw, target = (np.log((c + 1) / (c.sum() + BUCKETS)) for c in counts)
    return target - raw


def _scored(docs: DataFrame, ratios: np.ndarray, key: str, text: str, effective: int | None) -> DataFrame:
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = list(batch["text"])
            n, total = np.zeros(len(texts), np.int64), np.zeros(len(texts))
            for lo, hi in hashing.batches_by_bytes(texts):
                at, doc = gram_buckets(texts[lo:hi])
                n[lo:hi] = np.bincount(doc, minlength=hi - lo)
                total[lo:hi] = np.bincount(doc, weights=ratios[at], minlength=hi - lo)
            if effective is not None:
                total = total / np.maximum(n, 1) * np.minimum(n, effective)
            weight = pd.array(total, "Float64")
            weight[n == 0] = pd.NA
            yield pd.DataFrame({"key": batch["key"], "n_grams": n, "log_weight": weight})

    return rows.mapInPandas(run, f"key {kind}, n_grams long, log_weight double")


def gumbel(key: Column, seed: int) -> Column:
    """Gumbel noise of a key, from MD5 of seed and key."""
    u = (F.conv(F.substring(F.md5(F.concat_ws(
        "|", F.lit(str(seed)), F.coalesce(key.cast("string"), F.lit("null")))), 1, 13), 16, 10)
        .cast("double") + 0.5) / float(1 << 52)
    return -F.log(-F.log(u))


def kth_largest(df: DataFrame, column: str, k: int) -> float | None:
    """The ``k``-th largest non-null value of ``column``; the least if there are fewer; None if none."""
    values = df.where(F.col(column).isNotNull()).select(F.col(column).alias("v"))
    n, low, high = values.agg(F.count("v"), F.min("v"), F.max("v")).first()
    if not n or k < 1:
        return None
    k = min(k, n)
    while True:
        inside = values.where((F.col("v") >= low) & (F.col("v") <= high))
        if n <= LAST_BIN or low == high:
            if low == high:
                return low
            return sorted((r["v"] for r in inside.collect()), reverse=True)[k - 1]
        step = (high - low) / BINS
        at = F.least(F.lit(BINS - 1), F.floor((F.col("v") - low) / step)) if step > 0 else F.lit(0)
        bins = inside.groupBy(at.alias("at")).agg(
            F.count("v").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")).collect()
        for b in sorted(bins, key=lambda b: -b["at"]):
            if k <= b["n"]:
                n, low, high = b["n"], b["low"], b["high"]
                break
            k -= b["n"]


def resample(docs: DataFrame, labels: DataFrame, share: float | None = None, key: str = "doc_id",
             text: str = "text", seed: int = SEED, effective: int | None = None) -> DataFrame:
    """``key, n_grams, log_weight, gumbel_key, kept`` of every row.

    ``share`` of the rows is kept; by default the share of good documents among those with a
    quality label.
    """
    ship_package(docs.sparkSession)
    if share is None:
        by_id = labels.where("quality is not null").where(F.col(key).isNotNull()) \
            .groupBy(key).agg(F.max(F.expr(f"coalesce({GOOD}, false)")).alias("good"))
        share = by_id.agg(F.avg(F.col("good").cast("double"))).first()[0]
        share = 1.0 if share is None else share
    ratios = log_ratios(docs, labels, key, text)
    scored = _scored(docs, ratios, key, text, effective)
    drawn = stored(scored.withColumn("gumbel_key", F.col("log_weight") + gumbel(F.col("key"), seed)),
                   "importance-keys")
    last = kth_largest(drawn, "gumbel_key", math.ceil(share * drawn.count()))
    kept = F.coalesce(F.col("gumbel_key") >= F.lit(last).cast("double"), F.lit(False))
    return drawn.select(F.col("key").alias(key), "n_grams", "log_weight", "gumbel_key", kept.alias("kept"))
