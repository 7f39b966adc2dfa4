"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm import (bpe, importance, mixing, mtree, near_dups, periodic_runs, pii, quality_rules,
                        sharding, simhash, spelling, token_counts, warc)
from tarmac.llm.common import table


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per page: size and digest of its payload, and whether its record carries it or refers to another."""
    return warc.archive_report(table(spark, sf_dir, "pages"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: the counts behind the quality rules and their verdict."""
    return quality_rules.quality_projection(table(spark, sf_dir, "documents"), ["doc_id"]).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


def op3_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its log weight towards the labelled good ones, its draw, and whether it is kept."""
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_mtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per query vector: its 20 largest inner products with all others."""
    found = mtree.top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: bytes and tokens of the byte-level vocabulary."""
    counts = token_counts.token_counts(table(spark, sf_dir, "documents"),
                                       public_tokenizers.path("byte_bpe_50k.json"))
    return counts.select("doc_id", "n_bytes", "n_tokens",
                         (F.col("n_tokens") > token_counts.LIMIT).alias("over_limit"), "n_chunks")


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its shard and place, equal texts together as far as even counts allow."""
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op7_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its shingles, the smallest id among its near copies, and whether it stays."""
    return near_dups.near_duplicates(table(spark, sf_dir, "documents"), percent=85).select(
        "doc_id", "n_shingles", "component_id", "kept")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: counts and places of personal data, disguised ones included."""
    return pii.find_pii(table(spark, sf_dir, "documents"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every copy of every document drawn towards the sources' target weights, in shuffled order."""
    return mixing.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "source", "n_copies", "copy", "shuffle_key", "text")


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its number of tokens and digests of the ids and of the text they decode to."""
    return bpe.encode_decode(table(spark, sf_dir, "documents"),
                             public_tokenizers.path("word_bpe_49k.json"), full=False)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its runs of four or more periods, the densest one, and the text without repeats."""
    return periodic_runs.run_report(table(spark, sf_dir, "documents"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per word of the corpus: its more frequent form one letter away, and the last such form."""
    return spelling.variant_groups(spelling.word_counts(table(spark, sf_dir, "documents")))


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its fingerprint and the smallest id linked with it by close fingerprints."""
    return simhash.simhash_report(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": op1_warc,
    "op2_quality_rules": op2_quality_rules,
    "op3_importance": op3_importance,
    "op4_mtree": op4_mtree,
    "op5_token_counts": op5_token_counts,
    "op6_sharding": op6_sharding,
    "op7_near_dups": op7_near_dups,
    "op8_pii": op8_pii,
    "op9_mixing": op9_mixing,
    "op10_bpe": op10_bpe,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_spelling": op12_spelling,
    "op13_simhash": op13_simhash,
}


def _quality_sql() -> str:
    """The counts, ratios and rules of ``quality_rules`` in DuckDB SQL, from the same tables."""
    q = quality_rules
    stop = ", ".join(f"'{w}'" for w in q.STOP_WORDS)
    word = "[^\\x20\\x09-\\x0D]"
    trim = "trim(x, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
    ratio = lambda n, d: f"CASE WHEN {d} > 0 THEN {n} / {d} ELSE 0.0 END"
    ratios = {"mean_word_chars": ratio("word_chars", "n_words"),
              "symbol_ratio": ratio("n_symbols", "n_words"),
              "exclaim_ratio": ratio("n_exclaims", "n_words"),
              "stop_ratio": ratio("n_stop", "n_words"),
              "stutter_ratio": ratio("n_stutters", "n_words"),
              "letter_word_ratio": ratio("n_letter_words", "n_words"),
              "repeat_ratio": ratio("n_repeat_words", "n_words"),
              "dup_line_ratio": ratio("n_dup_lines", "n_lines"),
              "bullet_line_ratio": ratio("n_bullets", "n_lines"),
              "ellipsis_line_ratio": ratio("n_ellipses", "n_lines")}
    languages = ", ".join(f"'{x}'" for x in q.STOP_LANGUAGES)
    unlisted = f" OR coalesce(lower(lang), '') NOT IN ({languages})"
    rules = [f"(({ratios[r.measure]}) {op} {bound}{unlisted if r.measure == 'stop_ratio' else ''})" for r in q.RULES
             for op, bound in ((">=", r.low), ("<=", r.high)) if bound is not None]
    return f"""
WITH split AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '{word}+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{word}')) AS l
  FROM documents),
windows AS (
  SELECT rid, i, count(*) OVER (PARTITION BY rid, list_slice(w, i, i + {q.WINDOW - 1})) AS c
  FROM split, unnest(range(1, len(w) - {q.WINDOW - 2})) AS s(i)),
repeats AS (
  SELECT rid, count(DISTINCT i + j) AS n FROM windows, unnest(range(0, {q.WINDOW})) AS o(j)
  WHERE c > 1 GROUP BY rid),
counts AS (
  SELECT split.rid, doc_id, lang, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
    (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
    coalesce(repeats.n, 0)::BIGINT AS n_repeat_words, len(l) AS n_lines,
    len(regexp_extract_all(t, '!!')) AS n_exclaims,
    len(list_filter(w, lambda x: lower(x) IN ({stop}))) AS n_stop,
    len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) AS n_stutters,
    len(list_filter(w, lambda x: regexp_matches(x, '\\pL'))) AS n_letter_words,
    len(list_filter(l, lambda x: left({trim}, 1) IN ('-', '*', '•'))) AS n_bullets,
    len(list_filter(l, lambda x: {trim} LIKE '%...' OR {trim} LIKE '%…')) AS n_ellipses
  FROM split LEFT JOIN repeats ON split.rid = repeats.rid),
judged AS (
  SELECT *, n_words < {q.MIN_WORDS} OR 100 * n_repeat_words > {q.MAX_REPEAT_PERCENT} * n_words AS base_failed
  FROM counts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND {" AND ".join(rules)} AS kept
FROM judged"""


_WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (
  SELECT page_id, octet_length(encode(body)) AS payload_bytes, sha1(body) AS hex,
    max(page_id) OVER (PARTITION BY body) AS holder FROM p)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((('0x' || substr(hex, (i // 4) * 5 + 1, 5))::INT >> (15 - 5 * (i % 4))::INT) & 31), 1)), '')
    AS payload_digest,
  CASE WHEN holder IS NULL OR page_id = holder THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM holder THEN holder END AS refers_to
FROM d"""


_MIXING_SQL = f"""
WITH c AS (SELECT source, count(*) AS n, pow(count(*), {mixing.TEMPERATURE}) AS weight
           FROM documents GROUP BY source),
m AS (SELECT source, 1.0::DOUBLE * sum(n) OVER () * weight / sum(weight) OVER () / n AS mean FROM c),
s AS (SELECT source, ceil(mean / {mixing.PART})::INT AS parts,
        mean / ceil(mean / {mixing.PART}) AS part FROM m),
t AS (SELECT source, parts, list_transform(range({mixing.TERMS}),
        lambda k: exp(k * ln(part) - part - lgamma(k + 1))) AS terms FROM s),
u AS (SELECT source, parts, list_transform(range(1, {mixing.TERMS + 1}),
        lambda k: list_sum(list_slice(terms, 1, k))) AS upto FROM t),
n AS (SELECT doc_id, d.source, text, list_sum(list_transform(range(1, parts + 1), lambda j: len(
        list_filter(upto, lambda x: x <= ('0x' || substr(md5(concat_ws('|', '{mixing.SEED}',
          coalesce(doc_id::VARCHAR, 'null'), j)), 1, 13))::BIGINT / 4503599627370496.0))))::BIGINT AS n_copies
      FROM documents d JOIN u ON d.source IS NOT DISTINCT FROM u.source)
SELECT doc_id, source, n_copies, i::INT AS copy, md5(concat_ws('|', 'order{mixing.SEED}',
  coalesce(doc_id::VARCHAR, 'null'), i)) AS shuffle_key, text
FROM n, unnest(range(1, n_copies + 1)) AS x(i)"""


_TOP_K_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20"""


ORACLE_SQL: dict[str, str] = {
    "op1_warc": _WARC_SQL,
    "op2_quality_rules": _quality_sql(),
    "op4_mtree": _TOP_K_SQL,
    "op9_mixing": _MIXING_SQL,
}
