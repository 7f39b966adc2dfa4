"""Spelling variants against brute force."""

import collections
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tarmac.llm import spelling
from tarmac.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def brute_counts(rows, every=97):
    counts = collections.Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if every and h % every == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def edits(word, letters):
    out = {word[:i] + word[i + 1:] for i in range(len(word))}
    for i in range(len(word) + 1):
        out |= {word[:i] + c + word[i:] for c in letters} | {word[:i] + c + word[i + 1:] for c in letters if i < len(word)}
    return out - {word}


def brute_groups(counts):
    letters = set("".join(counts))
    forms, out = {}, []
    for w, n in counts.items():
        near = [u for u in edits(w, letters) if u in counts]
        best = min(near, key=lambda u: (-counts[u], u), default=None)
        if best is not None and counts[best] >= 2 * n:
            forms[w] = best
        out.append([w, forms.get(w), n, len(near), counts.get(forms.get(w))])
    for row in out:
        root = row[0]
        while root in forms:
            root = forms[root]
        row.insert(2, root)
    return sorted((tuple(r) for r in out), key=str)


def test_near():
    rng = random.Random(1)
    letters = "abé"
    for _ in range(3000):
        a, b = ("".join(rng.choice(letters) for _ in range(rng.randrange(5))) for _ in range(2))
        assert spelling.near(a, b) == (b in edits(a, letters))


@pytest.mark.parametrize("page,visits", [(2000, 20_000), (3, 5), (40, 7)])
def test_groups_of_random_words(spark, page, visits):
    rng = random.Random(page)
    words = {"".join(rng.choice("abcd") for _ in range(rng.randrange(5, 9))) for _ in range(250)}
    words |= {"".join(rng.sample("stones", 6)) for _ in range(150)} | {"a" * n for n in range(5, 300, 2)}
    words |= {"".join(rng.choice("ab") for _ in range(14)) for _ in range(300)}
    counts = {w: int(3 * 2 ** rng.uniform(0, 9)) for w in words}
    table = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = spelling.variant_groups(table, page, visits).select("word", "form", "root", "n", "n_near", "form_n")
    assert sorted(map(tuple, got.collect()), key=str) == brute_groups(counts)


ROWS = [(1, None), (2, ""), (None, "harbour harbour HARBOUR harbor"), (3, "harbor harbor Harbours ÀBCDE"),
        (3, "harbor harbor Harbours ÀBCDE"), (4, "harbours " * 9 + "naïve " * 5 + "naive " * 3 + "×÷×÷×÷ " * 4),
        (5, "x" * 70_000), (6, ("y" * 3000 + " ") * 4 + ("y" * 2999 + " ") * 3), (7, "ab " * 99)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string").withColumn("word", F.lit("own")) \
        .withColumn("N", F.create_map(F.lit("a"), F.lit(1))).withColumn("node", F.lit(7))


@pytest.mark.parametrize("every", [97, 2, None])
def test_words_and_groups(docs, every):
    words = spelling.word_counts(docs, every=every)
    want = brute_counts(ROWS, every)
    assert {r.word: r.n for r in words.collect()} == want
    got = spelling.variant_groups(words).select("word", "form", "root", "n", "n_near", "form_n")
    assert sorted(map(tuple, got.collect()), key=str) == brute_groups(want)


def test_empty(docs):
    assert spelling.variant_groups(spelling.word_counts(docs.limit(0))).count() == 0


def test_query_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op12_spelling"](spark, SF).select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert sorted(map(tuple, got), key=str) == brute_groups(brute_counts(rows)) and len(got) > 100
