"""SimHash groups against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tarmac.llm import simhash
from tarmac.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
PROSE = ("the old ship lay in the harbour and all of the sailors had gone to the town for the night "
         "so that nobody was on deck when the storm came in from the sea with wind and rain")


def brute_print(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    ws = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(ws[i:i + 4]) for i in range(len(ws) - 3)] or ([" ".join(ws)] if ws else [])
    hs = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_roots(prints):
    """Smallest position reachable over links of four bits or fewer."""
    x = np.array(prints, np.uint64)
    root = list(range(len(x)))
    for i in range(len(x)):
        for j in np.flatnonzero(np.bitwise_count(x ^ x[i]) <= 4):
            lo, hi = sorted((root[i], root[j]))
            if lo != hi:
                root = [lo if r == hi else r for r in root]
    return root


def brute(rows):
    prints = [brute_print(t) for _, t in rows]
    distinct = sorted(set(prints))
    root = dict(zip(distinct, brute_roots(distinct), strict=True))
    least = {}
    for (k, _), p in zip(rows, prints, strict=True):
        if k is not None:
            least[root[p]] = min(k, least.get(root[p], k))
    return sorted(((k, f"{p:016x}", least.get(root[p])) for (k, _), p in zip(rows, prints, strict=True)), key=str)


def clustered(rng, centers=40, each=12):
    out = set()
    for _ in range(centers):
        word = rng.getrandbits(64)
        for _ in range(each):
            out.add(word)
            for b in rng.sample(range(64), rng.randrange(1, 7)):
                word ^= 1 << b
    return sorted(out)


@pytest.mark.parametrize("most", [1 << 22, 5000])
def test_one_node_links_all(most):
    prints = clustered(random.Random(most))
    links = simhash.node_links(np.array(prints, np.uint64), np.uint64(0), 0, most)
    assert all((a ^ b).bit_count() <= 64 for a, b in links)
    assert same_groups(prints, links)


def same_groups(prints, links):
    at = {p: i for i, p in enumerate(prints)}
    root = list(range(len(prints)))
    for a, b in links:
        lo, hi = sorted((root[at[a]], root[at[b]]))
        root = [lo if r == hi else r for r in root]
    return root == brute_roots(prints)


@pytest.mark.parametrize("node,hot", [(1 << 19, 1 << 27), (20_000, 30_000)])
def test_links_over_nodes(spark, node, hot):
    prints = clustered(random.Random(3), 25, 10) + list(range(64))
    signed = np.array(sorted(set(prints)), np.uint64)
    rows = spark.createDataFrame([(int(x),) for x in signed.view(np.int64)], "print long")
    links = simhash.ball_links(rows, len(signed), node, hot, 20_000).collect()
    assert same_groups(signed.tolist(), [(r.a % 2**64, r.b % 2**64) for r in links])


def test_deepened_nodes_hold_all_variants():
    rng = random.Random(8)
    prints = np.array([rng.getrandbits(64) for _ in range(20)], np.uint64)
    p, n = simhash.deepen(prints, np.zeros(20, np.uint64), 0, 7)
    p, n = simhash.deepen(p, n, 7, 12)
    want = {(int(x), int((x ^ m) & np.uint64(4095))) for x in prints for k in simhash._flips(0, 64, 2) for m in k}
    assert set(zip(p.tolist(), n.tolist(), strict=True)) == want and len(p) == len(want)


ROWS = [(1, PROSE), (1, PROSE), (2, PROSE.upper()), (None, PROSE), (3, PROSE.replace("wind", "hail")),
        (9, None), (8, ""), (10, " \n "), (None, None), (4, "one two"), (5, "one  TWO"), (6, "Ünï ÜNÏ ünï x Y"),
        (7, " ".join(f"w{i % 997}x{i % 13}" for i in range(60_000))), (None, "nothing like it at all here")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string").withColumn("print", F.lit("own")) \
        .withColumn("NODE", F.create_map(F.lit("a"), F.lit(1))).withColumn("id", F.lit(7))


def test_report(docs):
    assert sorted(map(tuple, simhash.simhash_report(docs).collect()), key=str) == brute(ROWS)


def test_empty_and_single(docs):
    assert simhash.simhash_report(docs.limit(0)).count() == 0
    assert simhash.simhash_report(docs.where("doc_id = 4")).first().component_id == 4


def test_query_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, QUERIES["op13_simhash"](spark, SF).collect()), key=str) == brute(rows)
