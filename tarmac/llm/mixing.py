"""Mixing sources to target weights by Poisson replication.

A source with ``n`` of all ``N`` rows and target share ``w`` of the mix gets the
mean repetition rate ``rate * N * w / n``. Each document draws its number of
copies from the Poisson distribution of that mean: a uniform number taken from
MD5 of (seed, document key, part) is looked up in the distribution function.
Means over ``PART`` are split into equal parts drawn one by one and added, so
that no term underflows. Documents are then exploded by their number of copies and put
into a global random order. Only built-in functions run; the counts a source
needs are pre-aggregated, and the source table is broadcast only below a row bound.

Defined results:

* a null source is a source of its own; a null key draws as the text ``null``;
* repeated rows share key and source, so they draw the same number of copies;
* sources without a positive weight (or missing from ``weights``) are not drawn;
* an empty table gives an empty result; texts play no part, null or long;
* added columns get underscores before their name if ``docs`` already has it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import free_name, let, stored
from tarmac.operators.joins import checked_broadcast

#: Largest mean drawn at once, and the terms its distribution function gets.
PART = 16
TERMS = 80
SEED = 20240229
#: Target share of a source with n rows: proportional to n ** TEMPERATURE.
TEMPERATURE = 0.5


def _distribution(mean: Column) -> Column:
    """P(X <= k) for k = 0 .. TERMS - 1 of a Poisson variable, as an array."""
    logs = F.array(*[F.lit(math.lgamma(k + 1)) for k in range(TERMS)])
    terms = F.transform(F.sequence(F.lit(0), F.lit(TERMS - 1)),
                        lambda k: F.exp(k * F.log(mean) - mean - F.get(logs, k)))
    return let(terms, lambda t: F.transform(
        F.sequence(F.lit(1), F.lit(TERMS)),
        lambda k: F.aggregate(F.slice(t, 1, k), F.lit(0.0), lambda a, x: a + x)))


def source_rates(docs: DataFrame, source: str = "source", weights: DataFrame | None = None,
                 rate: float = 1.0, temperature: float = TEMPERATURE) -> DataFrame:
    """One row per source: ``source, n, mean`` (copies expected of each of its documents).

    ``weights`` (columns ``source, weight``) states the target shares; without
    it a source's share is proportional to ``n ** temperature``.
    """
    counts = stored(docs.groupBy(F.col(source).alias("source")).agg(F.count(F.lit(1)).alias("n")),
                    "mixing-counts")
    if weights is None:
        weighed = counts.withColumn("weight", F.pow(F.col("n").cast("double"), F.lit(temperature)))
    else:
        w = weights.select(F.col("source").alias("_s"), F.col("weight").cast("double").alias("weight"))
        weighed = counts.join(w, F.col("source").eqNullSafe(F.col("_s"))).drop("_s") \
            .where("weight > 0")
    rows = counts.agg(F.sum("n")).first()[0] or 0
    every = weighed.agg(F.sum("weight")).first()[0] or 1.0
    return weighed.select("source", "n", (
        F.lit(float(rate)) * F.lit(rows) * F.col("weight") / F.lit(every) / F.col("n")).alias("mean"))


def mix(docs: DataFrame, source: str = "source", key: str = "doc_id",
        weights: DataFrame | None = None, rate: float = 1.0, seed: int = SEED,
        temperature: float = TEMPERATURE) -> DataFrame:
    """Rows of ``docs``, each as often as drawn, in global random order.

    Adds ``n_copies`` (long), ``copy`` (int, from 1) and ``shuffle_key`` (string).
    """
    rates = source_rates(docs, source, weights, rate, temperature)
    table = rates.select(
        F.col("source").alias("_of"), F.ceil(F.col("mean") / PART).cast("int").alias("_parts"),
        _distribution(F.col("mean") / F.ceil(F.col("mean") / PART)).alias("_upto"))
    rows = docs.select(F.struct("*").alias("_row"), F.col(source).alias("_source"),
                       F.coalesce(F.col(key).cast("string"), F.lit("null")).alias("_key"))
    joined = rows.join(checked_broadcast(table, rates.count(), 100_000),
                       F.col("_source").eqNullSafe(F.col("_of")))
    uniform = lambda part: F.conv(F.substring(F.md5(F.concat_ws(
        "|", F.lit(str(seed)), F.col("_key"), part.cast("string"))), 1, 13), 16, 10) \
        .cast("double") / F.lit(float(1 << 52))
    draw = F.aggregate(
        F.sequence(F.lit(1), F.col("_parts")), F.lit(0),
        lambda a, part: a + let(uniform(part), lambda u: F.size(
            F.filter(F.col("_upto"), lambda c: c <= u))))
    n_copies, copy, order = (free_name(docs, c) for c in ("n_copies", "copy", "shuffle_key"))
    drawn = joined.select("_row", "_key", draw.cast("long").alias("_n")).where("_n > 0")
    dealt = drawn.select("_row", "_key", "_n",
                         F.explode(F.sequence(F.lit(1), F.col("_n").cast("int"))).alias("_copy")) \
        .select("_row", "_n", "_copy",
                F.md5(F.concat_ws("|", F.lit(f"order{seed}"), "_key", "_copy")).alias("_order"))
    # rows repeated under one key share the order key; the second key lets them spread
    return dealt.orderBy("_order", F.monotonically_increasing_id()).select(
        "_row.*", F.col("_n").alias(n_copies), F.col("_copy").alias(copy),
        F.col("_order").alias(order))
