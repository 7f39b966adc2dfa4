"""Near copies: an inverted join over MinHash signature coordinates.

1. One pass over the texts gives each document its set of distinct word shingles,
   a 128-bit fingerprint of the set and a signature of ``COORDINATES`` minima.
   Documents with equal sets form a class; only classes go on.
2. Each class is posted under its (coordinate, value) pairs. Pairs that one class
   alone has cannot collide and go. Two classes whose similarity reaches the
   threshold agree in at least ``matches`` coordinates but for a chance below 1e-6, so
   they share a pair among the ``COORDINATES - matches + 1`` rarest of either
   (prefix); the others are skipped, and so are classes with too few shared pairs.
3. Each posting list's most central class is compared with the others of the list.
   Then, for lists that still hold several components, the lists with the same
   largest component are taken together: each class outside that component meets all
   classes of these lists, both sides in blocks. A task counts the collisions of
   whole signatures, compares full sets where there are enough of them, best partners
   first, and stops at the first link to a component. So classes that are already
   connected are never compared, a group of thousands of near copies costs its
   members a few comparisons each, what leaves a task is links alone, and no link
   between components is left out.
4. Every link is confirmed on the full shingle sets. Components come from
   alternating star contraction; a document's component is the smallest id in it.

Defined results:

* null text, empty text or text without words: empty set, a component of its own;
* fewer words than the shingle width: the whole sequence is the one shingle;
* null ids: members like others, never the smallest id unless all ids are null;
  ``kept`` is ``id = component_id``, with null equal to null; ``drop_near_duplicates``
  keeps one row of each group, whether or not ids are null or shared;
* repeated rows are members of one class and share their verdict;
* an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm import hashing
from tarmac.llm.common import free_name, join_counted, ship_package, stored
from tarmac.operators.joins import checked_broadcast

WIDTH = 5
THRESHOLD_PERCENT = 80
COORDINATES = 64
#: A pair at the threshold has fewer matches than counted on with at most this chance.
MISS = 1e-6
#: Classes of either side that meet in one task; smaller gatherings share tasks.
BLOCK = 512
BLOCK_SHINGLES = 2_000_000
_SEEDS = hashing.mix64(np.arange(1, 2 * COORDINATES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_XOR, _MUL = _SEEDS[:COORDINATES], _SEEDS[COORDINATES:] | np.uint64(1)


def needed_matches(percent: int, miss: float = MISS) -> int:
    """Most coordinates of which a pair at the threshold has as many but for a chance ``miss``."""
    p, below, t = percent / 100, 0.0, 0
    while True:
        below += math.comb(COORDINATES, t) * p ** t * (1 - p) ** (COORDINATES - t)
        if below > miss:
            return max(t, 1)
        t += 1


def signatures(texts: list[str], width: int) -> tuple[np.ndarray, list, list]:
    """(set sizes, fingerprints, signatures as little-endian bytes) of non-null texts."""
    size = np.zeros(len(texts), np.int64)
    prints: list = [None] * len(texts)
    signs: list = [None] * len(texts)
    for lo, hi in hashing.batches_by_bytes(texts):
        s, doc = hashing.shingles(texts[lo:hi], width)
        if not len(s):
            continue
        docs, first = np.unique(doc, return_index=True)
        size[lo + docs] = np.diff(np.append(first, len(s)))
        sums = [np.add.reduceat(hashing.mix64(s ^ np.uint64(k)), first) for k in (0x5851F42D, 0x14057B7E)]
        minima = np.empty((len(docs), COORDINATES), np.uint32)
        for k in range(COORDINATES):
            low = np.minimum.reduceat((s ^ _XOR[k]) * _MUL[k], first)
            minima[:, k] = hashing.mix64(low) >> np.uint64(32)
        for i, d in enumerate(docs):
            prints[lo + d] = int(sums[0][i]).to_bytes(8, "little") + int(sums[1][i]).to_bytes(8, "little")
            signs[lo + d] = minima[i].tobytes()
    return size, prints, signs


def _sign(docs: DataFrame, key: str, text: str, width: int, row: str | None = None) -> DataFrame:
    """``id, row, mark (MD5 of the text), size, print, sign`` of every row; ``row``: a column that
    numbers the rows."""
    rows = docs.select(F.col(key).alias("id"), (F.col(row) if row else F.lit(0)).cast("long").alias("row"),
                       F.md5(F.col(text)).alias("mark"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            size, prints, signs = signatures(list(batch["text"]), width)
            yield pd.DataFrame({"id": batch["id"], "row": batch["row"], "mark": batch["mark"], "size": size,
                                "print": prints, "sign": signs})

    return rows.mapInPandas(run, f"id {kind}, row long, mark string, size long, print binary, sign binary")


def _prefix_postings(classes: DataFrame, matches: int) -> DataFrame:
    """``token, cid, weight``: the rarest shared coordinate-value pairs of each class."""
    values = F.transform(F.sequence(F.lit(0), F.lit(COORDINATES - 1)), lambda k: F.xxhash64(
        k, F.substring(F.col("sign"), k * 4 + 1, F.lit(4))))
    tokens = classes.select("cid", F.explode(values).alias("token"))
    shared = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("often")).where("often > 1")
    posted = tokens.join(shared, "token")
    # at most COORDINATES entries in a class's list
    lists = posted.groupBy("cid").agg(F.sort_array(F.collect_list(F.struct("often", "token"))).alias("t"),
                                      F.sum("often").alias("weight"))
    spare = F.size("t") - matches + 1
    return lists.where(spare > 0).select(
        "cid", "weight", F.explode(F.slice("t", F.lit(1), spare)).alias("x")) \
        .select(F.col("x.token").alias("token"), "cid", "weight")


def _shingle_sets(docs: DataFrame, wanted: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """``cid, size, shingles`` (sorted longs) of the classes in ``wanted`` (cid, id, mark)."""
    few = checked_broadcast(wanted.select("cid", F.col("id").alias("_id"), F.col("mark").alias("_mark")),
                            wanted.count())
    rows = docs.select(F.col(key).alias("id"), F.md5(F.col(text)).alias("mark"), F.col(text).alias("text"))
    texts = rows.join(few, (F.col("mark") == F.col("_mark")) & F.col("id").eqNullSafe(F.col("_id"))) \
        .select("cid", "text")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            some = list(batch["text"])
            for lo, hi in hashing.batches_by_bytes(some):
                s, doc = hashing.shingles(some[lo:hi], width)
                cut = np.searchsorted(doc, np.arange(1, hi - lo))
                yield pd.DataFrame({"cid": batch["cid"].iloc[lo:hi].values,
                                    "shingles": [x.view(np.int64) for x in np.split(s, cut)]})

    sets = texts.mapInPandas(run, "cid long, shingles array<long>")
    # repeated rows give one class's set several times
    return sets.groupBy("cid").agg(F.first("shingles").alias("shingles")) \
        .withColumn("size", F.size("shingles").cast("long"))


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold."""
    left = sets.select(F.col("cid").alias("a"), F.col("shingles").alias("sa"), F.col("size").alias("na"))
    right = sets.select(F.col("cid").alias("b"), F.col("shingles").alias("sb"), F.col("size").alias("nb"))
    both = pairs.join(left, "a").join(right, "b")
    common = F.size(F.array_intersect("sa", "sb"))
    sized = (100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
    return both.where(sized).withColumn("c", common) \
        .where(100 * F.col("c") >= percent * (F.col("na") + F.col("nb") - F.col("c"))).select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """``node, root`` of every node of ``links`` (a, b): the smallest node it is connected with.

    Alternating star contraction: neighbours are hung on their node's smallest
    neighbour until every component is a star; each step is a pre-aggregated minimum and
    one join, written out to cut the lineage.
    """
    edges = stored(links.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
                   .where("hi <> lo").distinct(), "cc-edges")
    seen = None
    while True:
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(
            edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")) \
            .distinct()
        lowest = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(lowest, "hi").select(
            F.explode(F.array(F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")),
                              F.struct(F.col("hi").alias("hi"), F.col("m").alias("lo")))).alias("e")) \
            .select("e.*").where("hi <> lo").distinct()
        edges = stored(small, "cc-edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    stars = edges.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
    return stars.union(stars.select(F.col("root").alias("node"), "root").distinct())


def _matches_of(a: pd.Series | list, b: pd.Series | list) -> np.ndarray:
    x = np.frombuffer(b"".join(a), "<u4").reshape(-1, COORDINATES)
    y = np.frombuffer(b"".join(b), "<u4").reshape(-1, COORDINATES)
    return (x == y).sum(1)


def _first_pairs(postings: DataFrame, signs: DataFrame, matches: int) -> DataFrame:
    """Pairs of each class with the most central class of its lists, if they collide enough."""
    heads = postings.groupBy("token").agg(F.max(F.struct("weight", -F.col("cid"))).alias("h"),
                                          F.count(F.lit(1)).alias("n")).where("n > 1") \
        .select("token", (-F.col("h.col2")).alias("b"))
    pairs = postings.select("token", F.col("cid").alias("a")).join(heads, "token").where("a <> b") \
        .select("a", "b").distinct()
    return _colliding(pairs, signs, matches)


def _colliding(pairs: DataFrame, signs: DataFrame, matches: int) -> DataFrame:
    left = signs.select(F.col("cid").alias("a"), F.col("sign").alias("x"))
    right = signs.select(F.col("cid").alias("b"), F.col("sign").alias("y"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield batch.loc[_matches_of(batch["x"], batch["y"]) >= matches, ["a", "b"]]

    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y") \
        .mapInPandas(run, "a long, b long")


def _linked_blocks(asked: tuple, listed: tuple, matches: int, percent: int) -> list[tuple[int, int]]:
    """Links from classes to classes of other components, at most one for each two components.

    Either side is (ids, roots, signatures, sets).
    """
    joined: dict[int, int] = {}

    def top(root: int) -> int:
        while joined.get(root, root) != root:
            root = joined[root]
        return root

    ids, roots, signs, sets = listed
    sizes = np.array([len(x) for x in sets])
    links = []
    for cid, root, sign, own in zip(*asked, strict=True):
        same = (signs == sign).sum(1)
        n = len(own)
        at = np.flatnonzero((same >= matches) & (roots != root)
                            & (100 * np.minimum(sizes, n) >= percent * np.maximum(sizes, n)))
        at = at[np.argsort(-same[at], kind="stable")]
        while len(at):
            at = at[[top(roots[i]) != top(root) for i in at[:32]] + [True] * max(0, len(at) - 32)]
            some, at = at[:32], at[32:]
            if not len(some):
                continue
            parts = [sets[i] for i in some]
            every = np.concatenate(parts)
            place = np.minimum(np.searchsorted(own, every), n - 1)
            first = np.cumsum([0] + [len(x) for x in parts[:-1]])
            common = np.add.reduceat((own[place] == every).astype(np.int64), first)
            for i, c in zip(some, common, strict=True):
                if 100 * c >= percent * (n + sizes[i] - c) and top(roots[i]) != top(root):
                    joined[top(roots[i])] = top(root)
                    links.append((cid, ids[i]))
    return links


def _residual_links(postings: DataFrame, signs: DataFrame, sets: DataFrame, roots: DataFrame,
                    matches: int, percent: int, block: int) -> DataFrame:
    """Links between different components whose classes share a list."""
    rooted = postings.select("token", "cid").join(roots, F.col("cid") == F.col("node"), "left") \
        .select("token", "cid", F.coalesce("root", "cid").alias("root"))
    sizes = rooted.groupBy("token", "root").agg(F.count(F.lit(1)).alias("n"))
    lists = sizes.groupBy("token").agg(F.count(F.lit(1)).alias("roots"),
                                       F.max(F.struct("n", "root")).alias("top")).where("roots > 1") \
        .select("token", F.col("top.root").alias("main"))
    # a gathering: the classes of all lists with one largest component, each once
    gathered = rooted.join(lists, "token").select("main", "cid", "root").distinct()
    facts = signs.join(sets.select(F.col("cid").alias("_c"), "shingles", "size"), F.col("cid") == F.col("_c")) \
        .select(F.col("cid").alias("_cid"), "sign", "shingles", "size")
    full = stored(gathered.join(facts, F.col("cid") == F.col("_cid")).drop("_cid"), "nd-gathered")

    def parts(when: Column) -> Column:
        """Blocks that hold so many classes and so many shingles at most, on average."""
        return F.greatest(F.ceil(F.count_if(when) / block),
                          F.ceil(F.sum(F.when(when, F.col("size"))) / BLOCK_SHINGLES)).cast("int")

    counts = stored(full.groupBy("main").agg(
        F.count(F.lit(1)).alias("n"), parts(F.lit(True)).alias("mb"),
        parts(F.col("root") != F.col("main")).alias("ab")), "nd-counts")
    total, packs = full.agg(F.count(F.lit(1)), parts(F.lit(True))).first()
    packs = max(1, packs or 1)
    pack = F.when(F.col("mb") == 1, F.pmod(F.xxhash64("main"), F.lit(packs))).otherwise(F.col("main") + packs)
    known = join_counted(full, counts, "main", total).withColumn("pack", pack)
    span = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    own = lambda c: F.pmod(F.xxhash64("cid"), F.col(c).cast("long")).cast("int")
    members = known.withColumn("m", own("mb")).withColumn("a", span("ab"))
    asking = known.where("root <> main").withColumn("a", own("ab")).withColumn("m", span("mb"))

    def side(rows: pd.DataFrame, prefix: str) -> dict:
        """main -> (ids, roots, signatures, sets)."""
        if not len(rows):
            return {}
        sign = np.frombuffer(b"".join(rows[f"{prefix}sign"]), "<u4").reshape(-1, COORDINATES)
        ids, root, main = (rows[f"{prefix}{c}"].to_numpy() for c in ("cid", "root", "main"))
        shingles = [np.asarray(x).view(np.uint64) for x in rows[f"{prefix}shingles"]]
        order = np.argsort(main, kind="stable")
        out = {}
        for at in np.split(order, np.flatnonzero(np.diff(main[order])) + 1):
            out[main[at[0]]] = (ids[at], root[at], sign[at], [shingles[i] for i in at])
        return out

    def meet(asked: pd.DataFrame, listed: pd.DataFrame) -> pd.DataFrame:
        members_of = side(listed, "m_")
        links = [link for main, own_side in side(asked, "").items() if main in members_of
                 for link in _linked_blocks(own_side, members_of[main], matches, percent)]
        return pd.DataFrame({"a": np.array([a for a, _ in links], np.int64),
                             "b": np.array([b for _, b in links], np.int64)})

    columns = ["pack", "a", "m", "main", "cid", "root", "sign", "shingles"]
    renamed = [F.col(c).alias(f"m_{c}") for c in columns]
    return asking.select(*columns).groupBy("pack", "a", "m").cogroup(
        members.select(*renamed).groupBy("m_pack", "m_a", "m_m")).applyInPandas(meet, "a long, b long")


def _grouped(docs: DataFrame, percent: int, key: str, text: str, width: int, block: int,
             row: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Every row's ``id, row, mark, size, print``; and ``print, n`` (its rows), ``root, component_id``
    of every distinct set."""
    ship_package(docs.sparkSession)
    matches = needed_matches(percent)
    signed = stored(_sign(docs, key, text, width, row), "nd-signed")
    classes = signed.where("size > 0").groupBy("print").agg(
        F.min("id").alias("least"), F.min(F.struct("id", "mark")).alias("one"), F.first("sign").alias("sign"),
        F.count(F.lit(1)).alias("n"))
    classes = stored(classes.withColumn("cid", F.monotonically_increasing_id()), "nd-classes")
    postings = stored(_prefix_postings(classes, matches), "nd-postings")
    posted = postings.select("cid").distinct()
    live = stored(classes.join(posted, "cid").select("cid", "sign", "one"), "nd-live")
    signs = live.select("cid", "sign")
    sets = stored(_shingle_sets(docs, live.select("cid", "one.id", "one.mark"), key, text, width), "nd-sets")

    ordered = lambda p: p.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    first = ordered(_first_pairs(postings, signs, matches))
    links = stored(_confirmed(first, sets, percent), "nd-links")
    roots = components(links)
    more = stored(_residual_links(postings, signs, sets, roots, matches, percent, block), "nd-links")
    if not more.isEmpty():
        roots = components(links.union(more))

    rooted = classes.join(roots, F.col("cid") == F.col("node"), "left") \
        .select("print", "least", "n", F.coalesce("root", "cid").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return signed, stored(rooted.join(smallest, "root").select("print", "n", "root", "component_id"), "nd-named")


def near_duplicates(docs: DataFrame, percent: int = THRESHOLD_PERCENT, key: str = "doc_id",
                    text: str = "text", width: int = WIDTH, block: int = BLOCK) -> DataFrame:
    """``key, mark, n_shingles, component_id, kept`` of every row (``mark``: MD5 of the text)."""
    signed, named = _grouped(docs, percent, key, text, width, block)
    total = named.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    out = join_counted(signed.select("id", "mark", "size", "print"), named.drop("root"), "print", total)
    component = F.when(F.col("print").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(F.col("id").alias(key), "mark", F.col("size").alias("n_shingles"),
                      component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))


def drop_near_duplicates(docs: DataFrame, percent: int = THRESHOLD_PERCENT, key: str = "doc_id",
                         text: str = "text", width: int = WIDTH) -> DataFrame:
    """The rows of ``docs`` that stay: one of each group of near copies, that of the least id.

    Ties between rows of one id, or without any, go to the least MD5 of the text, then to the first
    row. Of rows without shingles, those equal in id and text are one group. Survivors are
    chosen by row number alone; texts and further columns of any type move once, at the end.
    """
    row = free_name(docs, "row")
    rows = stored(docs.withColumn(row, F.monotonically_increasing_id()), "nd-rows")
    signed, named = _grouped(rows, percent, key, text, width, BLOCK, row)
    total = named.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    order = F.struct(F.col("id").isNull().alias("none"), "id", "mark", "row")
    some = join_counted(signed.where("print is not null").select("id", "mark", "row", "print"),
                        named.select("print", "n", "root"), "print", total)
    firsts = some.groupBy("root").agg(F.min(order).alias("first")).select("first.row")
    bare = signed.where("print is null").groupBy("id", "mark").agg(F.min("row").alias("row")).select("row")
    kept = firsts.unionByName(bare).withColumnRenamed("row", row)
    return rows.join(kept, row, "left_semi").select(*docs.columns)
