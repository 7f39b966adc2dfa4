"""A training corpus from ``documents`` in five stages, each one operator of ``tarmac.llm``.

Every stage reads what its predecessor wrote. All but the last return the columns
of ``documents``; the last gives each kept copy's token ids and decoded text.

Null texts have no words, so the first stage drops them; empty tables pass through
as empty tables; further columns are carried along up to the last stage.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import public_tokenizers  # noqa: E402

from tarmac.llm import bpe, mixing, near_dups, pii, quality_rules  # noqa: E402
from tarmac.llm.common import stored, table  # noqa: E402

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality_rules.keep_quality(docs)


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8 or more)."""
    return near_dups.drop_near_duplicates(docs, percent=80)


def privacy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data masked; ``n_chars`` follows the text."""
    masked = pii.redact(docs)
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return masked


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target weight asks, in global random order."""
    return mixing.mix(docs).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids, decoded`` of every copy."""
    return bpe.encode_decode(docs, TOKENIZER)


STAGES = [("quality_rules", quality), ("near_dedup", dedup), ("pii", privacy), ("mixing", mix), ("bpe", encode)]

#: Near copies, disguised personal data and BPE are beyond SQL; tests hold the stages
#: against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
