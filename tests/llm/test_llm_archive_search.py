"""WARC archive, M-tree search and the pipeline against brute force on small fixtures."""

import base64
import hashlib
import math
import os
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tarmac.llm import bpe, importance, mixing, mtree, near_dups, pii, quality_rules, sharding, warc

PAGES = [
    (1, "http://a/1", "<p>one</p>"), (2, "http://a/2", "<p>one</p>"), (3, None, "<p>one</p>"),
    (4, "http://a/4\r\nWARC-Type: fake", None), (5, "http://a/5", ""), (None, "http://a/6", "<p>one</p>"),
    (7, "http://a/7", "WARC/1.1\r\nWARC-Type: revisit\r\n\r\né"), (8, "http://a/8", "x" * 300_000),
    (8, "http://a/8", "x" * 300_000), (None, None, "only here"), (9, "http://a/9", "x" * 300_000),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(PAGES, "page_id long, url string, html string") \
        .withColumn("sha256", F.lit("clash")).withColumn("holder", F.lit(1))


@pytest.fixture(scope="module")
def archive(spark, pages, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("archive") / "records")
    warc.write_archive(pages, path)
    return path


def test_archive_report(spark, pages):
    got = warc.archive_report(pages).collect()
    assert len(got) == len(PAGES)
    holder = {}
    for key, _, html in PAGES:
        if key is not None:
            holder[html or ""] = max(holder.get(html or "", key), key)
    want = []
    for key, _, html in PAGES:
        body = (html or "").encode()
        first = holder.get(html or "")
        revisit = first is not None and key != first
        want.append((key, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(),
                     "revisit" if revisit else "response", first if revisit else None))
    order = lambda r: tuple((x is None, x or 0) if not isinstance(x, str) else (False, x) for x in r)
    assert sorted(map(tuple, got), key=order) == sorted(want, key=order)


def test_records_are_whole(spark, archive):
    """Each record parses as WARC: headers, declared length, digest of the payload."""
    for r in warc.read_archive(spark, archive).collect():
        head, rest = bytes(r["record"]).split(b"\r\n\r\n", 1)
        fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        assert head.startswith(b"WARC/1.1\r\n") and rest.endswith(b"\r\n\r\n")
        assert int(fields["Content-Length"]) == len(rest) - 4
        body = rest[:-4].split(b"\r\n\r\n", 1)[1]
        assert body == (bytes(r["payload"]) if fields["WARC-Type"] == "response" else b"")
        sha1 = base64.b32encode(hashlib.sha1(bytes(r["payload"])).digest()).decode()
        assert fields["WARC-Payload-Digest"] == "sha1:" + sha1 == "sha1:" + r["stated_digest"]


def test_urls_cannot_add_fields(spark):
    """Every control character and line end in a URL is kept, encoded, and ends no line."""
    odd = [chr(c) for c in (*range(0x20), *range(0x7F, 0xA0), 0x2028, 0x2029)]
    urls = [f"http://a/{c}WARC-Refers-To: <urn:page:99>{c}WARC-Payload-Digest: sha1:FORGED" for c in odd] + ["http://a/\tb\rc"]
    rows = spark.createDataFrame([(i, u, f"page {i}") for i, u in enumerate(urls)], "page_id long, url string, html string")
    path = warc.archive_folder(spark)
    warc.write_archive(rows, path)
    got = {r.page_id: r for r in warc.read_archive(spark, path).collect()}
    for i, u in enumerate(urls):
        want = "".join("".join(f"%{b:02X}" for b in c.encode()) if c in odd else c for c in u)
        assert got[i].url == want and got[i].refers_to is None and got[i].record_type == "response"
        sha1 = base64.b32encode(hashlib.sha1(f"page {i}".encode()).digest()).decode()
        assert got[i].stated_digest == sha1
    assert got[len(odd)].url == "http://a/%09b%0Dc"


def test_payloads_are_stored_once(spark, archive):
    payloads = spark.read.parquet(f"{archive}/payloads")
    assert payloads.count() == payloads.select("sha256").distinct().count() == len({h or "" for *_, h in PAGES})
    assert "payload" not in spark.read.parquet(f"{archive}/headers").columns


def test_damaged_payload_is_noticed(spark, archive, tmp_path):
    spark.read.parquet(f"{archive}/headers").write.parquet(str(tmp_path / "headers"))
    spark.read.parquet(f"{archive}/payloads").withColumn("payload", F.lit(b"damaged")) \
        .write.parquet(str(tmp_path / "payloads"))
    with pytest.raises(Exception, match="does not match its digest"):
        warc.read_archive(spark, str(tmp_path)).collect()


def test_empty_archive(spark):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.archive_report(empty).count() == 0


def brute_top(rows, queries, k):
    out = []
    for q, v in queries:
        scores = sorted(((-int(np.dot(v, x)), i) for i, x in rows if i != q))[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores)]
    return sorted(out)


@pytest.mark.parametrize("routers, page, leaf, block", [(256, 4096, 64, 1024), (5, 40, 6, 13), (1, 1000, 8, 7)])
def test_top_k(spark, routers, page, leaf, block):
    rng = np.random.default_rng(routers)
    vectors = rng.normal(size=(300, 12)) * rng.uniform(0.2, 3, size=(300, 1))
    vectors[40:140] = vectors[40]  # a hot vector: ties are decided by id
    rows = [(i, [float(x) for x in v], 0) for i, v in enumerate(vectors.astype(np.float32))]
    odd = [(1000, None, 0), (1001, [], 0), (1002, [1.0, None], 0), (1003, [float("nan")], 0),
           (1004, [float("inf")] * 12, 0), (None, [1.0] * 12, 0), (1005, [3e38] * 12, 0), rows[17], rows[20]]
    frame = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, page int") \
        .withColumn("router", F.lit("x"))
    got = mtree.top_k(frame, F.col("id") % 20 == 0, 20, routers=routers, page_rows=page, leaf_rows=leaf,
                      query_block=block).collect()
    ints = [(i, [math.floor(64 * x) for x in v]) for i, v, _ in rows]
    assert sorted(map(tuple, got)) == brute_top(ints, [r for r in ints if r[0] % 20 == 0], 20)


def exact_top(rows, k, every):
    """(query id, score) lists of the k best other rows, by Python integers."""
    out = {}
    for at, (q, v) in enumerate(rows):
        if q % every == 0:
            scores = sorted(((-sum(a * b for a, b in zip(v, x, strict=False)), i) for j, (i, x) in enumerate(rows) if j != at))
            out.setdefault(q, []).append([(i, -s) for s, i in scores[:k]])
    return out


@pytest.mark.parametrize("dims, size", [(2000, 62_000.0), (3, 2.0e7), (40, 900_000.0)])
def test_scores_of_large_components_are_exact(spark, dims, size):
    rng = np.random.default_rng(dims)
    rows = [(i, [float(x) for x in rng.uniform(-size, size, dims)]) for i in range(50)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    ints = [(i, [math.floor(64 * x) for x in v]) for i, v in rows]
    got = {}
    for r in mtree.top_k(frame, F.col("id") % 10 == 0, 7, routers=5, page_rows=10, leaf_rows=3).orderBy("rank").collect():
        got.setdefault(r.query_id, []).append((r.id, r.score))
    assert got == {q: lists[0] for q, lists in exact_top(ints, 7, 10).items()}


def test_rows_of_one_id_are_candidates_each(spark):
    rows = [(1, [1.0, 0.0]), (3, [2.0, 0.0]), (3, [9.0, 0.0]), (4, [70000.0, 0.0]), (5, [1.0, 1.0]), (5, [1.0, 1.0])]
    got = [tuple(r) for r in mtree.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"),
                                         F.col("id") == 1).orderBy("rank").collect()]
    assert got == [(1, 1, 4, 64 * 64 * 70000), (1, 2, 3, 64 * 64 * 9), (1, 3, 3, 64 * 64 * 2), (1, 4, 5, 64 * 64)]


def test_a_hot_vector_is_searched_once(spark):
    """A vector that half of all rows share: every row of it gets its own answers, itself left out."""
    rng = np.random.default_rng(9)
    v = [float(x) for x in np.round(rng.normal(size=6), 2)]
    rows = [(i, v if i % 2 else [float(x) for x in np.round(rng.normal(size=6), 2)]) for i in range(400)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    ints = [(i, [math.floor(64 * x) for x in x_]) for i, x_ in rows]
    got = {}
    for r in mtree.top_k(frame, F.col("id") % 5 == 0, 10, routers=9, page_rows=20, leaf_rows=4, query_block=3) \
            .orderBy("rank").collect():
        got.setdefault(r.query_id, []).append((r.id, r.score))
    assert got == {q: lists[0] for q, lists in exact_top(ints, 10, 5).items()}


def test_top_k_small_tables(spark):
    schema = "vec_id long, embedding array<float>"
    empty = spark.createDataFrame([], schema)
    assert mtree.top_k(empty, F.col("id") % 20 == 0).count() == 0
    few = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0]), (2, [0.0, 0.5])], schema)
    got = [tuple(r) for r in mtree.top_k(few, F.col("id") == 0).orderBy("rank").collect()]
    assert got == [(0, 1, 1, 4096), (0, 2, 2, 4096)]


def test_search_skips_far_leaves():
    """Bounds keep most distances of well separated clusters from being computed."""
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(20, 8)) * 400
    x = np.rint(np.concatenate([c + rng.normal(size=(50, 8)) for c in centres]))
    longest = float((x * x).sum(1).max())
    rows, lift = [], mtree._lift(x, longest)
    for leaf in range(20):
        at = np.arange(leaf * 50, leaf * 50 + 50)
        d = mtree._apart(x[at], x[at[:1]], lift[at], lift[at[:1]])[:, 0]
        to_router = mtree._apart(x[at[:1]], x[:1], lift[at[:1]], lift[:1])[0, 0]
        rows.append((leaf, None, x[at[0]].astype("<i4").tobytes(), to_router, d.max()))
        rows += [(leaf, int(i), x[i].astype("<i4").tobytes(), dist, 0.0) for i, dist in zip(at, d, strict=True)]
    tree = pd.DataFrame(rows, columns=["leaf", "id", "vec", "parent", "radius"])
    tree["id"] = tree["id"].astype("Int64")
    query = x[[0]]
    floor = np.array([np.sort(query @ x.T, 1)[0, -10]])
    best, done = mtree.search_page(query, np.array([-1]), floor, tree, x[0], longest, 10)
    assert sorted(best.score[0].tolist()) == np.sort(query @ x.T, 1)[0, -10:].tolist()
    assert done < 400  # of 1000 entries and 20 centres


WORDS = ("the of and to in is with for was on that by at from harbour sailor storm night lantern "
         "captain island weather letter garden window river market bridge winter summer").split()


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(8)
    text = lambda n: " ".join(rng.choice(WORDS) for _ in range(n))
    rows = [(i, text(rng.randint(60, 200)), "en", f"s{i % 3}", 0) for i in range(60)]
    rows += [(100 + i, rows[i][1] + " end", "en", "s0", 0) for i in range(10)]
    rows += [(200, "junk### " * 50, "en", "s1", 0), (201, None, None, None, None), (202, "", "en", "s1", 0),
             (203, text(80) + " write to jo@ex.org or ann [at] ex [dot] com", "en", None, 0), rows[3]]
    folder = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long") \
        .write.parquet(os.path.join(folder, "documents.parquet"))
    return folder, rows


def test_pipeline_stages(spark, corpus):
    folder, rows = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, folder)
        if i < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns, name
            docs = spark.createDataFrame(out.collect(), docs.schema)
            kept.append({r["doc_id"]: r for r in docs.collect()})
    after_rules, after_dedup, after_pii, after_mix = kept
    assert set(after_rules) == {r[0] for r in rows} - {200, 201, 202}
    assert set(after_dedup) == set(range(60)) | {203}
    assert after_pii[203]["text"].endswith("write to <EMAIL> or <EMAIL>")
    assert after_pii[203]["n_chars"] == len(after_pii[203]["text"])
    assert all(after_pii[i]["text"] == after_dedup[i]["text"] for i in range(60))
    drawn = {r["doc_id"]: r["n_copies"] for r in mixing.mix(
        spark.createDataFrame(list(after_pii.values()), docs.schema)).collect()}
    assert set(after_mix) == set(drawn)
    final = corpus_pipeline.run(spark, folder)
    assert final.count() == sum(drawn.values())
    coder = bpe.codec(corpus_pipeline.TOKENIZER)
    for r in final.collect():
        ids, decoded = coder.encode([after_pii[r["doc_id"]]["text"]])[0]
        assert bytes(r["ids"]) == ids and r["decoded"] == decoded and r["n_tokens"] == len(ids) // 4


def test_pipeline_of_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long") \
        .write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_no_python_in_native_operators(spark, corpus):
    docs = spark.read.parquet(f"{corpus[0]}/documents.parquet")
    for frame in (quality_rules.quality_projection(docs, ["doc_id"]), mixing.mix(docs), sharding.shard_documents(docs)):
        plan = frame._jdf.queryExecution().toString()
        assert "Pandas" not in plan and "Python" not in plan and "Arrow" not in plan


def test_small_operators_read_only_their_columns(spark):
    """Columns whose names the operators use inside do not disturb them."""
    docs = spark.createDataFrame([(i, f"{' '.join(WORDS[i:i + 12])}") for i in range(10)], "doc_id long, text string")
    for name in ("key", "id", "mark", "row", "cid", "token", "_row", "page", "text_", "n_tokens"):
        docs = docs.withColumn(name, F.lit(1))
    assert near_dups.near_duplicates(docs).count() == 10
    assert pii.find_pii(docs).count() == 10
    assert near_dups.drop_near_duplicates(docs).columns == docs.columns
    labels = spark.createDataFrame([(0, 1, 0)], "doc_id long, quality int, toxic int")
    assert importance.resample(docs, labels).count() == 10
