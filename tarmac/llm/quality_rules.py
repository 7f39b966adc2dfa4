"""Quality rules: a threshold table compiled into one Spark projection.

``RULES`` names a measure and the range a kept document's value lies in.
``quality_projection(docs, keys, rules)`` turns the table into one ``select``: the measures
are built-in functions over the words and lines of the whole text, each rule is
one comparison, and no shuffle, user function or second pass takes part.

Defined results:

* null or empty text: no words, every count 0, every ratio 0, ``base_failed`` true;
* ratios over no words or no lines are 0;
* the stop-word rule judges texts of ``STOP_LANGUAGES`` alone, by the language column: no list
  says anything about a text in Russian or of an unknown language; without that column (or
  with ``lang=None``) it judges all;
* repeated rows are judged alike, each on its own; only the text and the keys asked
  for are read, so other columns cannot clash; an empty table gives an empty result;
* very long texts: all steps are linear in the text, but for one sort of the
  word windows of texts in which a window recurs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import GAPS, let, words_of

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30


@dataclass(frozen=True)
class Rule:
    """Keep a document if ``low <= measure <= high`` (None: no bound)."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None


#: A word without any letter.
LETTERLESS = (r"(?<![^\x20\x09-\x0D])[^\p{L}\x20\x09-\x0D]+(?![^\x20\x09-\x0D])")

#: The threshold table of production. Measures are those of ``ratio_columns``.
RULES = (
    Rule("word_length", "mean_word_chars", 2.0, 12.0),
    Rule("symbols", "symbol_ratio", None, 0.10),
    Rule("shouted", "exclaim_ratio", None, 0.30),
    Rule("stop_words", "stop_ratio", 0.01, None),
    Rule("letters", "letter_word_ratio", 0.60, None),
    Rule("stutter", "stutter_ratio", None, 0.20),
    Rule("repeated_lines", "dup_line_ratio", None, 0.50),
    Rule("bullets", "bullet_line_ratio", None, 0.90),
    Rule("ellipses", "ellipsis_line_ratio", None, 0.30),
)

#: Languages that ``STOP_WORDS`` has a list for, as the language column names them.
STOP_LANGUAGES = ("en", "de", "fr", "es")
#: Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "a", "and", "are", "as", "at", "be", "for", "from", "in", "is", "it", "of", "on", "that",
    "the", "this", "to", "was", "with", "you",
    "das", "den", "der", "des", "die", "ein", "eine", "für", "im", "ist", "mit", "nicht", "und",
    "von", "zu",
    "dans", "de", "du", "en", "est", "et", "la", "le", "les", "par", "pas", "pour", "que", "qui",
    "un", "une",
    "con", "del", "el", "lo", "los", "no", "para", "por", "se", "su", "y",
)


def _repeat_words(words: Column) -> Column:
    """Words inside windows of ``WINDOW`` words that occur at least twice in ``words``."""
    def covered(windows: Column) -> Column:
        def walk(order: Column) -> Column:
            twin = lambda i: ((F.get(order, i - 1)["h"] == F.get(order, i)["h"])
                              | (F.get(order, i + 1)["h"] == F.get(order, i)["h"]))
            starts = F.sort_array(F.filter(
                F.transform(order, lambda w, i: F.when(F.coalesce(twin(i), F.lit(False)), w["at"])),
                lambda at: at.isNotNull()))
            return let(starts, lambda s: F.aggregate(
                F.transform(s, lambda at, i: F.least(
                    F.lit(WINDOW), F.coalesce(F.get(s, i + 1) - at, F.lit(WINDOW)))),
                F.lit(0), lambda a, x: a + x))
        return let(F.sort_array(F.transform(
            windows, lambda h, i: F.struct(h.alias("h"), i.alias("at")))), walk)

    def over(fours: Column) -> Column:
        # A window of eight can only recur where a run of four recurs. get() reads one
        # element; slice() would copy the whole array for every window.
        n = F.size(words) - (WINDOW - 1)
        eights = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.xxhash64(
            F.get(fours, i), F.get(fours, i + WINDOW // 2)))
        return F.when((n < 2) | (F.size(F.array_distinct(fours)) == F.size(fours)), F.lit(0)) \
            .otherwise(let(eights, lambda e: F.when(
                F.size(F.array_distinct(e)) == F.size(e), F.lit(0)).otherwise(covered(e))))

    fours = F.transform(words, lambda w, i: F.xxhash64(
        w, *[F.get(words, i + j) for j in range(1, WINDOW // 2)]))
    return let(fours, over).cast("long")


def _base(text: Column) -> Column:
    """Struct of the counts that the ratios are made of."""
    def of(words: Column, lines: Column) -> Column:
        bare = F.array_join(words, "")
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.char_length(bare).cast("long").alias("word_chars"),
            F.regexp_count(bare, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            _repeat_words(words).alias("n_repeat_words"),
            F.size(lines).cast("long").alias("n_lines"),
            F.regexp_count(whole, F.lit("!!")).cast("long").alias("n_exclaims"),
            F.size(F.filter(words, lambda w: F.lower(w).isin(*STOP_WORDS)))
            .cast("long").alias("n_stop"),
            F.size(F.filter(words, lambda w, i: w == F.get(words, i - 1)))
            .cast("long").alias("n_stutters"),
            (F.size(words) - F.regexp_count(whole, F.lit(LETTERLESS))).cast("long")
            .alias("n_letter_words"),
            F.size(F.filter(lines, lambda x: F.substring(F.btrim(x, F.lit(GAPS)), 1, 1).isin(*"-*•")))
            .cast("long").alias("n_bullets"),
            F.size(F.filter(lines, lambda x: F.btrim(x, F.lit(GAPS)).endswith("...")
                            | F.btrim(x, F.lit(GAPS)).endswith("…"))).cast("long").alias("n_ellipses"))

    whole = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return let(F.struct(words_of(text).alias("w"), lines.alias("l")),
               lambda x: of(x["w"], x["l"]))


def ratio_columns(c: Column) -> dict[str, Column]:
    """The measures that a rule can name, over the struct of ``_base``."""
    per = lambda n, d: F.when(c[d] > 0, c[n] / c[d]).otherwise(F.lit(0.0))
    return {
        "mean_word_chars": per("word_chars", "n_words"),
        "symbol_ratio": per("n_symbols", "n_words"),
        "exclaim_ratio": per("n_exclaims", "n_words"),
        "stop_ratio": per("n_stop", "n_words"),
        "stutter_ratio": per("n_stutters", "n_words"),
        "letter_word_ratio": per("n_letter_words", "n_words"),
        "repeat_ratio": per("n_repeat_words", "n_words"),
        "dup_line_ratio": per("n_dup_lines", "n_lines"),
        "bullet_line_ratio": per("n_bullets", "n_lines"),
        "ellipsis_line_ratio": per("n_ellipses", "n_lines"),
    }


def quality_struct(text: Column, rules: tuple[Rule, ...] = RULES, lang: Column | None = None) -> Column:
    """Counts, ratios, ``base_failed``, ``failed_rules`` and ``kept`` of one text, as a struct.

    ``lang``: the text's language, which decides whether stop words judge it.
    """
    listed = F.lit(True) if lang is None else F.coalesce(F.lower(lang).isin(*STOP_LANGUAGES), F.lit(False))

    def judge(c: Column) -> Column:
        ratios = ratio_columns(c)

        def breaks(rule: Rule) -> Column:
            value = ratios[rule.measure]
            low = F.lit(False) if rule.low is None else value < rule.low
            high = F.lit(False) if rule.high is None else value > rule.high
            applies = listed if rule.measure == "stop_ratio" else F.lit(True)
            return F.when(applies & (low | high), F.lit(rule.name))

        base_failed = ((c["n_words"] < MIN_WORDS)
                       | (100 * c["n_repeat_words"] > MAX_REPEAT_PERCENT * c["n_words"]))
        failed = F.array_compact(F.array(*[breaks(r) for r in rules])) if rules \
            else F.array().cast("array<string>")
        counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
        return F.struct(*[c[n].alias(n) for n in counts],
                        *[v.alias(k) for k, v in ratios.items()],
                        base_failed.alias("base_failed"), failed.alias("failed_rules"))

    def verdict(q: Column) -> Column:
        return q.withField("kept", ~q["base_failed"] & (F.size(q["failed_rules"]) == 0))

    return let(let(_base(text), judge), verdict)


def _language(docs: DataFrame, lang: str | None) -> Column | None:
    return F.col(lang).cast("string") if lang in docs.columns else None


def quality_projection(docs: DataFrame, keys: list[str], rules: tuple[Rule, ...] = RULES,
                       text: str = "text", lang: str | None = "lang") -> DataFrame:
    """``keys`` and the quality columns of every row."""
    judged = quality_struct(F.col(text), rules, _language(docs, lang))
    return docs.select(*keys, judged.alias("_quality")).select(*keys, "_quality.*")


def keep_quality(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text",
                 lang: str | None = "lang") -> DataFrame:
    """The rows of ``docs`` that no rule rejects, unchanged."""
    return docs.where(quality_struct(F.col(text), rules, _language(docs, lang))["kept"])
