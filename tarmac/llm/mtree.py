"""Exact top-k by inner product over a paged M-tree.

Vectors are lifted to one length: ``x`` gets the extra component
``sqrt(M - |x|^2)`` (``M`` the largest squared length), a query gets 0. Then
``d(q, x)^2 = |q|^2 + M - 2 <q, x>``: the largest inner products are the
smallest metric distances, and triangle inequalities hold.

Index: routing objects come from a bounded sample, one for each ``PAGE`` rows between
``ROUTERS`` and ``MOST_ROUTERS``; a square root of them are the tops that the others hang from. Each
vector goes down to the nearest top and on to the nearest routing object below it; rows of a
routing object over ``PAGE`` are dealt to several pages by hash, so a vector
that a third of all rows share fills many pages. Within its page a task divides the
vectors into leaves, and stores for each leaf its centre, its covering radius and its
distance to the page's routing object, and for each entry its distance to the
centre. Every vector is in the index, which is written out as a table.

Equal vectors score alike, so of each vector only the rows with the ``k + 1`` least ids can be
an answer; these are indexed, and each vector asked for is searched once, for ``k + 1``
answers, of which every row that asks leaves itself out.

Search, best first: a query starts with its ``k + 1``-th best score over the routing
objects, which are vectors themselves, and visits its home page, where its own vector
lies. With the bound found there it goes to the pages whose balls still reach it, and only
to these. Within a page the leaves wait in a queue, the most promising first; for each query
a leaf is passed over without computing a distance if ``|d(q, router) - d(router, centre)| -
radius`` is over the distance its ``k``-th score stands for, then if ``d(q, centre) - radius``
is, and so are the entries for which ``|d(q, centre) - d(centre, entry)|`` is; tops and routing
objects are passed over by the same bounds. Queries are joined to pages by page; a page is
copied only where more than ``QUERY_BLOCK`` queries reach it. Bounds allow for rounding;
scores are exact integers: sums below 2**53 as doubles, larger ones as 64-bit integers.

Defined results:

* vectors that are null or empty or hold a null or non-finite component, and rows without an
  id, take no part; nor do vectors of a (scaled) squared length of ``LARGEST`` or more, whose
  scores may not fit a long;
* rows equal in id and vector are one candidate; rows of one id and different vectors are
  candidates each, also for each other, and ties between them are decided at will;
* shorter vectors count as filled with zeros; a query is never its own answer;
* queries with fewer than ``k`` candidates get all; an empty table gives an empty result;
* other columns are not read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tarmac.llm.common import join_counted, ship_package, stored
from tarmac.operators.joins import checked_broadcast

SCALE = 64
ROUTERS = 256
MOST_ROUTERS = 8192
PAGE = 4096
LEAF = 64
QUERY_BLOCK = 1024
#: Squared lengths below it keep scores within a long, and components within 32 bits.
LARGEST = float(1 << 62)
#: Sums of products below it are exact in a double.
EXACT = float(1 << 53)
NONE = np.iinfo(np.int64).min


def scaled_vectors(rows: DataFrame, key: str, vector: str, scale: int = SCALE) -> DataFrame:
    """``id, v`` (array of integers as doubles) of the rows that take part, each once."""
    v = F.transform(F.col(vector), lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("double"))
    # floor() of a double is a long: a component must be far within it before it is scaled
    small = F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x.cast("double"))
                     & (F.abs(x.cast("double")) < float(1 << 31)))
    good = F.col(key).isNotNull() & F.col(vector).isNotNull() & (F.size(vector) > 0) & small
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    return rows.where(good).select(F.col(key).cast("long").alias("id"), v.alias("v")) \
        .where(square < LARGEST).distinct()


def _matrix(vectors, dims: int) -> np.ndarray:
    out = np.zeros((len(vectors), dims))
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def _lift(x: np.ndarray, longest: float) -> np.ndarray:
    return np.sqrt(np.maximum(longest - (x * x).sum(1), 0.0))


def _apart(a: np.ndarray, b: np.ndarray, lift_a: np.ndarray, lift_b: np.ndarray) -> np.ndarray:
    """Lifted distances of the rows of ``a`` to those of ``b``."""
    square = ((a * a).sum(1) + lift_a ** 2)[:, None] + ((b * b).sum(1) + lift_b ** 2)[None, :] \
        - 2 * (a @ b.T + lift_a[:, None] * lift_b[None, :])
    return np.sqrt(np.maximum(square, 0.0))


def _scores(q: np.ndarray, x: np.ndarray, longest: float) -> np.ndarray:
    """Exact inner products of integer vectors: no sum is larger than ``longest``."""
    if longest < EXACT:
        return q @ x.T
    return q.astype(np.int64) @ x.astype(np.int64).T


def _slack(longest: float, square: np.ndarray, dims: int) -> np.ndarray:
    """What rounding may add to a distance, which comes from the root of a difference."""
    return (1e-6 + 4 * math.sqrt(dims * 2.0 ** -52)) * (1 + np.sqrt(longest) + np.sqrt(square))


def _reach(floor: np.ndarray, square: np.ndarray, longest: float, dims: int) -> np.ndarray:
    """The distance beyond which nothing can match a score of ``floor``."""
    return np.sqrt(np.maximum(square + longest - 2 * floor.astype(float), 0.0)) + _slack(longest, square, dims)


def _routers(vectors: DataFrame, n: int) -> list:
    """A bounded sample: the ``n`` rows whose ids hash lowest."""
    return vectors.orderBy(F.xxhash64("id"), "id", "row").limit(n).select("row", "v").collect()


@dataclass
class Root:
    """The upper levels: tops, the routing objects below them, and what they cover."""

    routers: np.ndarray
    lifts: np.ndarray
    top_of: np.ndarray     # for each routing object the top it hangs from
    to_top: np.ndarray     # and its distance to it
    tops: np.ndarray       # numbers of the routing objects that are tops
    pages: np.ndarray      # pages of each routing object
    radius: np.ndarray     # covering radius of each routing object, of each top
    top_radius: np.ndarray

    def home(self, x: np.ndarray, lift: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(routing object, distance to it, distance to its top) of each vector on its way down."""
        to_tops = _apart(x, self.routers[self.tops], lift, self.lifts[self.tops])
        top = to_tops.argmin(1)
        router, far = np.zeros(len(x), int), np.zeros(len(x))
        for t in np.unique(top):
            at, below = np.flatnonzero(top == t), np.flatnonzero(self.top_of == t)
            d = _apart(x[at], self.routers[below], lift[at], self.lifts[below])
            router[at], far[at] = below[d.argmin(1)], d.min(1)
        return router, far, to_tops[np.arange(len(x)), top]

    def reached(self, q: np.ndarray, reach: np.ndarray) -> list[np.ndarray]:
        """For each query the routing objects whose balls reach into its own."""
        to_tops = _apart(q, self.routers[self.tops], np.zeros(len(q)), self.lifts[self.tops])
        out = []
        for i in range(len(q)):
            open_ = to_tops[i] - self.top_radius <= reach[i]
            # what is stored first: no distance to the routing object is computed for it
            stored_bound = np.abs(to_tops[i][self.top_of] - self.to_top) - self.radius
            some = np.flatnonzero(open_[self.top_of] & (stored_bound <= reach[i]) & (self.pages > 0))
            d = _apart(q[i:i + 1], self.routers[some], np.zeros(1), self.lifts[some])[0]
            out.append(some[d - self.radius[some] <= reach[i]])
        return out


def plan_root(centres: np.ndarray, longest: float) -> Root:
    """Routing objects hung from the nearest of their first few."""
    lifts = _lift(centres, longest)
    tops = np.arange(max(1, math.isqrt(len(centres))))
    d = _apart(centres, centres[tops], lifts, lifts[tops])
    d[tops, tops] = -1.0  # a top hangs from itself, also among equal ones
    top_of = d.argmin(1)
    none = np.zeros(len(centres))
    return Root(centres, lifts, top_of, np.maximum(d[np.arange(len(centres)), top_of], 0.0), tops,
                none.astype(int), none - 1, np.zeros(len(tops)) - 1)


def build_index(vectors: DataFrame, dims: int, longest: float, root: Root,
                page_rows: int = PAGE, leaf_rows: int = LEAF) -> DataFrame:
    """The tree as a table ``router, page, leaf, row, id, vec, parent, radius``; fills ``root``.

    ``id`` and ``row`` are null on leaf rows: ``vec`` is the leaf's centre, ``parent`` its
    distance to the page's routing object and ``radius`` its covering radius. On entries
    ``parent`` is the distance to the leaf's centre.
    """
    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = _matrix(batch["v"], dims)
            if len(x):
                router, far, top_far = root.home(x, _lift(x, longest))
                yield pd.DataFrame({"router": router, "row": batch["row"], "id": batch["id"], "far": far,
                                    "top_far": top_far, "vec": [r.tobytes() for r in x.astype("<i4")]})

    routed = stored(vectors.select("row", "id", "v").mapInPandas(
        route, "router int, row long, id long, far double, top_far double, vec binary"), "mtree-routed")
    for r in routed.groupBy("router").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("far"),
                                          F.max("top_far").alias("top")).collect():  # a row per routing object
        root.pages[r["router"]], root.radius[r["router"]] = -(-r["n"] // page_rows), r["far"]
        top = root.top_of[r["router"]]
        root.top_radius[top] = max(root.top_radius[top], r["top"])
    routers, lifts = root.routers, root.lifts

    def divide(page: pd.DataFrame) -> pd.DataFrame:
        x = np.frombuffer(b"".join(page["vec"]), "<i4").reshape(-1, dims).astype(float)
        lift, router = _lift(x, longest), int(page["router"].iloc[0])
        order = np.argsort(page["row"].to_numpy(), kind="stable")
        centres = order[np.linspace(0, len(x) - 1, max(1, len(x) // leaf_rows)).astype(int)]
        centres = np.unique(centres)
        d = _apart(x, x[centres], lift, lift[centres])
        leaf = d.argmin(1)
        own = d[np.arange(len(x)), leaf]
        used = np.unique(leaf)
        to_router = _apart(x[centres], routers[router:router + 1], lift[centres], lifts[router:router + 1])[:, 0]
        none = pd.array([None] * len(used), "Int64")
        nodes = pd.DataFrame({"leaf": used, "row": none, "id": none,
                              "vec": [page["vec"].iloc[centres[u]] for u in used],
                              "parent": to_router[used],
                              "radius": [own[leaf == u].max() for u in used]})
        entries = pd.DataFrame({"leaf": leaf, "row": pd.array(page["row"], "Int64"), "id": pd.array(page["id"], "Int64"),
                                "vec": page["vec"].values, "parent": own, "radius": 0.0})
        out = pd.concat([nodes, entries])
        out["router"], out["page"] = router, page["page"].iloc[0]
        return out[["router", "page", "leaf", "row", "id", "vec", "parent", "radius"]]

    tree = routed.withColumn("page", _page_of(root, "row")).groupBy("router", "page").applyInPandas(
        divide, "router int, page long, leaf int, row long, id long, vec binary, parent double, radius double")
    return stored(tree, "mtree-index")


def _page_of(root: Root, number: str) -> Column:
    """The page of a row or query by its ``number`` among those of its ``router``."""
    parts = F.get(F.array(*[F.lit(int(max(1, n))) for n in root.pages]), F.col("router"))
    return F.pmod(F.xxhash64(number, F.lit(7)), parts)


class Best:
    """The ``k`` best (score, id, row) of each query of a block, and the bound they set."""

    def __init__(self, k: int, floor: np.ndarray):
        self.k, self.floor = k, floor.copy()  # scores below it are beaten already
        self.score = [np.zeros(0, floor.dtype) for _ in floor]
        self.id = [np.zeros(0, np.int64) for _ in floor]
        self.row = [np.zeros(0, np.int64) for _ in floor]

    def add(self, q: int, score: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        parts = [np.concatenate(x) for x in ((self.score[q], score), (self.id[q], ids), (self.row[q], rows))]
        score = parts[0]
        if len(score) > self.k:
            top = np.lexsort((parts[1], -score))[:self.k]
            parts = [x[top] for x in parts]
        self.score[q], self.id[q], self.row[q] = parts
        if len(parts[0]) == self.k:
            self.floor[q] = max(self.floor[q], parts[0].min())


def search_page(queries: np.ndarray, own: np.ndarray, floor: np.ndarray, tree: pd.DataFrame,
                router: np.ndarray, longest: float, k: int) -> tuple[Best, int]:
    """Best-first search of one page for a block of queries; (their best, distances computed).

    ``own``: the row that each query is, told apart by the column ``row`` (else ``id``).
    """
    dims = queries.shape[1]
    nodes, entries = tree[tree["id"].isna()], tree[~tree["id"].isna()].sort_values(["leaf", "parent"])
    centres = np.frombuffer(b"".join(nodes["vec"]), "<i4").reshape(-1, dims).astype(float)
    leaves, radius, parent = (nodes[c].to_numpy() for c in ("leaf", "radius", "parent"))
    x = np.frombuffer(b"".join(entries["vec"]), "<i4").reshape(-1, dims).astype(float)
    of, to_centre = (entries[c].to_numpy() for c in ("leaf", "parent"))
    ids = entries["id"].to_numpy().astype(np.int64)
    rows = entries["row"].to_numpy().astype(np.int64) if "row" in entries else ids
    floor = floor.astype(float if longest < EXACT else np.int64)
    best, square = Best(k, floor), (queries * queries).sum(1)
    none = np.zeros(len(queries))

    def reach(q) -> np.ndarray:
        return _reach(best.floor[q], square[q], longest, dims)

    to_router = _apart(queries, router[None], none, _lift(router[None], longest))[:, 0]
    # least distance by what is stored: no distance to the centre is needed for it
    stored_bound = np.abs(to_router[:, None] - parent[None]) - radius[None]
    queue = [(b, i) for i, b in enumerate(stored_bound.min(0))]
    heapq.heapify(queue)
    done = 0
    while queue:
        _, i = heapq.heappop(queue)
        every = np.arange(len(queries))
        some = every[stored_bound[:, i] <= reach(every)]
        if not len(some):
            continue
        d = _apart(queries[some], centres[i:i + 1], none[some], _lift(centres[i:i + 1], longest))[:, 0]
        done += len(some)
        limit = reach(some)
        open_ = d - radius[i] <= limit
        some, d, limit = some[open_], d[open_], limit[open_]
        if not len(some):
            continue
        lo, hi = np.searchsorted(of, [leaves[i], leaves[i] + 1])
        # entries are in order of their stored distance: bounds of all queries cut a range
        first = lo + np.searchsorted(to_centre[lo:hi], (d - limit).min(), "left")
        last = lo + np.searchsorted(to_centre[lo:hi], (d + limit).max(), "right")
        score = _scores(queries[some], x[first:last], longest)
        done += score.size
        good = (score >= best.floor[some][:, None]) & (rows[first:last][None] != own[some][:, None])
        for j in np.flatnonzero(good.any(1)):
            best.add(some[j], score[j, good[j]], ids[first:last][good[j]], rows[first:last][good[j]])
    return best, done


def _visited(sent: DataFrame, index: DataFrame, root: Root, dims: int, longest: float, k: int,
             query_block: int) -> DataFrame:
    """``query, row, id, score``: at most ``k`` answers of each query on each page it is sent to.

    ``sent``: ``router, page, query, floor, qvec``, stored.
    """
    asked = sent.groupBy("router", "page").agg(F.ceil(F.count(F.lit(1)) / query_block).cast("int").alias("blocks"))
    asked = stored(asked, "mtree-asked")
    blocks = checked_broadcast(asked, asked.count())
    tree = index.join(blocks, ["router", "page"]) \
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
    queries = sent.join(blocks, ["router", "page"]) \
        .withColumn("block", F.pmod(F.xxhash64("query"), F.col("blocks")).cast("int")).drop("blocks")
    routers = root.routers

    def meet(asking: pd.DataFrame, page: pd.DataFrame) -> pd.DataFrame:
        if not len(asking) or not len(page):
            return pd.DataFrame({c: np.zeros(0, np.int64) for c in ("query", "row", "id", "score")})
        q = np.frombuffer(b"".join(asking["qvec"]), "<i4").reshape(-1, dims).astype(float)
        best, _ = search_page(q, np.full(len(q), -1), asking["floor"].to_numpy(), page,
                              routers[int(page["router"].iloc[0])], longest, k)
        return pd.DataFrame({"query": np.repeat(asking["query"].to_numpy(), [len(s) for s in best.score]),
                             "row": np.concatenate(best.row), "id": np.concatenate(best.id),
                             "score": np.concatenate(best.score).astype(np.int64)})

    place = ["router", "page", "block"]
    return queries.groupBy(*place).cogroup(tree.groupBy(*place)).applyInPandas(
        meet, "query long, row long, id long, score long")


def _searched(asked: DataFrame, vectors: DataFrame, k: int, routers: int, page_rows: int, leaf_rows: int,
              query_block: int) -> DataFrame:
    """``query, row, id, score``: the ``k`` best of ``vectors`` (``row, id, v``) and maybe more for
    each of ``asked`` (``query, v``)."""
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    n, dims, longest = vectors.agg(F.count("id"), F.max(F.size("v")), F.max(square)).first()
    sample = _routers(vectors, min(MOST_ROUTERS, max(routers, n // page_rows)))
    root = plan_root(_matrix([r["v"] for r in sample], dims), longest)
    index = build_index(vectors, dims, longest, root, page_rows, leaf_rows)

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Each query's first bound, and the routing object of its home page."""
        for batch in batches:
            q = _matrix(batch["v"], dims)
            if not len(q):
                continue
            score = _scores(q, root.routers, longest).astype(np.int64)
            floor = np.sort(score, 1)[:, -k] if score.shape[1] >= k else np.full(len(q), NONE)
            yield pd.DataFrame({"query": batch["query"], "floor": floor, "router": root.home(q, _lift(q, longest))[0],
                                "qvec": [r.tobytes() for r in q.astype("<i4")]})

    first = asked.select("query", "v").mapInPandas(ask, "query long, floor long, router int, qvec binary")
    page = _page_of(root, "query")
    home = stored(first.withColumn("page", page), "mtree-home")
    at_home = stored(_visited(home, index, root, dims, longest, k, query_block), "mtree-found")

    # the k-th score at home, where there are as many, is the bound to leave with
    bound = at_home.groupBy("query").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least")) \
        .where(F.col("n") == k).select(F.col("query").alias("_query"), "least")
    leaving = home.join(bound, F.col("query") == F.col("_query"), "left").withColumn(
        "floor", F.greatest("floor", "least")).drop("least", "_query")

    def follow(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The routing objects whose balls reach into the query's."""
        for batch in batches:
            if not len(batch):
                continue
            q = np.frombuffer(b"".join(batch["qvec"]), "<i4").reshape(-1, dims).astype(float)
            batch["routers"] = root.reached(q, _reach(batch["floor"].to_numpy(), (q * q).sum(1), longest, dims))
            yield batch[["query", "floor", "qvec", "home", "home_page", "routers"]]

    pages = F.get(F.array(*[F.lit(int(m)) for m in root.pages]), F.col("router"))
    sent = leaving.select("query", "floor", "qvec", F.col("router").alias("home"),
                          F.col("page").alias("home_page")).mapInPandas(
        follow, "query long, floor long, qvec binary, home int, home_page long, routers array<int>") \
        .withColumn("router", F.explode("routers")).drop("routers") \
        .withColumn("page", F.explode(F.sequence(F.lit(0).cast("long"), pages.cast("long") - 1))) \
        .where((F.col("router") != F.col("home")) | (F.col("page") != F.col("home_page"))).drop("home", "home_page")
    away = _visited(stored(sent, "mtree-sent"), index, root, dims, longest, k, query_block)
    return at_home.unionByName(away)


def top_k(rows: DataFrame, queries: Column, k: int = 20, key: str = "vec_id", vector: str = "embedding",
          scale: int = SCALE, routers: int = ROUTERS, page_rows: int = PAGE, leaf_rows: int = LEAF,
          query_block: int = QUERY_BLOCK) -> DataFrame:
    """``query_id, rank, id, score`` of the ``k`` largest inner products of each query row.

    ``queries`` is a condition over the column ``id``.
    """
    spark = rows.sparkSession
    ship_package(spark)
    vectors = stored(scaled_vectors(rows, key, vector, scale).withColumn("row", F.monotonically_increasing_id()),
                     "mtree-vectors")
    # Spark cuts such a window to k + 1 rows in each task before the shuffle
    equal = Window.partitionBy("v").orderBy("id", "row")
    some = stored(vectors.withColumn("at", F.row_number().over(equal)).where(F.col("at") <= k + 1).drop("at"),
                  "mtree-candidates")
    asking = vectors.where(queries)
    asked = stored(asking.groupBy("v").agg(F.count(F.lit(1)).alias("n"))
                   .withColumn("query", F.monotonically_increasing_id()), "mtree-asked")
    total = asked.agg(F.sum("n")).first()[0]
    if not total:
        return spark.createDataFrame([], "query_id long, rank int, id long, score long")
    found = _searched(asked, some, k + 1, routers, page_rows, leaf_rows, query_block)
    order = Window.partitionBy("query").orderBy(F.desc("score"), "id", "row")
    best = found.withColumn("at", F.row_number().over(order)).where(F.col("at") <= k + 1) \
        .groupBy("query").agg(F.array_sort(F.collect_list(F.struct("at", "id", "row", "score"))).alias("best"))
    answers = stored(asked.join(best, "query").select("v", "n", "best"), "mtree-answers")
    others = F.slice(F.filter("best", lambda x: x["row"] != F.col("row")), 1, k)
    return join_counted(asking, answers, "v", total) \
        .select(F.col("id").alias("query_id"), F.posexplode(others).alias("rank", "x")) \
        .select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), "x.id", "x.score")
