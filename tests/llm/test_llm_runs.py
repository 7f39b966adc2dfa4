"""Periodic runs against brute force."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarmac.llm import periodic_runs
from tarmac.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute_runs(ws):
    """(start, length, period) of maximal stretches whose smallest period fits four times."""
    found = {}
    for q in range(1, len(ws) // 4 + 1):
        i = 0
        while i + q < len(ws):
            if ws[i] != ws[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(ws) and ws[j] == ws[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q - i), q)  # the smallest period of this stretch comes first
            i = j
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def altered(key, ws):
    h = zlib.crc32(str(key).encode())
    n, g = len(ws), h // 10
    if key is None or h % 10 or not n:
        return ws
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else ws[a + (i - a) % p] for i, w in enumerate(ws)]


def expected(key, text):
    ws = altered(key, words(text))
    runs = brute_runs(ws)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (key, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
            sha(" ".join(w for i, w in enumerate(ws) if i not in gone)))


def test_runs_of_random_words():
    rng = random.Random(5)
    texts = [[rng.choice("ab") for _ in range(rng.randrange(60))] for _ in range(300)]
    texts += [[rng.choice("abc")] * rng.randrange(9) + list("abcab" * rng.randrange(9)) + list("aab" * rng.randrange(30))
              for _ in range(200)]
    texts += [list("ab" * 50) * 2, ["x"] * 2000, list("abaab" * 100) + list("ab" * 100)]
    flat = [ord(w) for ws in texts for w in ws]
    doc = np.repeat(np.arange(len(texts)), [len(ws) for ws in texts])
    got = periodic_runs.runs_of(np.array(flat), doc)
    first = np.cumsum([0] + [len(ws) for ws in texts])
    want = [(s + first[d], n, q) for d, ws in enumerate(texts) for s, n, q in brute_runs(ws)]
    assert [tuple(map(int, r)) for r in got] == [tuple(map(int, r)) for r in want]


ROWS = [(1, None), (2, ""), (3, " \n "), (None, "a b " * 9), (4, "a b " * 9), (4, "a b " * 9), (5, "x " * 5),
        (6, "x " * 6), (7, "x X " * 4 + "x" * 70_000), (8, "é é " * 8 + "  " * 9),
        (9, " ".join(["one two three"] * 12 + ["one one"] * 5)), (10, "w " * 3_000),
        *[(k, f"alpha beta gamma delta epsilon zeta eta theta {k} iota kappa") for k in range(11, 90)]]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string").withColumn("RUNS", F.lit("own")) \
        .withColumn("_text", F.create_map(F.lit("a"), F.lit(1))).withColumn("start", F.lit(7))


def test_report(docs):
    got = sorted(map(tuple, periodic_runs.run_report(docs).collect()), key=str)
    assert got == sorted((expected(k, t) for k, t in ROWS), key=str)


def test_texts_and_columns(spark, docs):
    out = periodic_runs.find_runs(docs)
    assert out.columns == ["doc_id", "text", "_text", "start", "n_words", "runs", "collapsed"]
    row = out.where("doc_id = 9").first()
    assert row.text == ROWS[10][1] and row._text == {"a": 1}
    assert row.collapsed == "one two three" and [tuple(r) for r in row.runs] == brute_runs(words(row.text))
    assert periodic_runs.find_runs(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        periodic_runs.find_runs(docs, min_exponent=2)


def test_query_against_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {tuple(r) for r in QUERIES["op11_periodic_runs"](spark, SF).collect()}
    assert got == {expected(r.doc_id, r.text) for r in rows}
