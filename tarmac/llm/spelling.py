"""Spelling variants: words one edit apart, found in a trie of letter-group counts.

Every letter belongs to one of ``GROUPS`` groups; a word's vector counts its letters per
group. Words are arranged in a trie by these counts, one group a level. One inserted,
deleted or replaced letter changes the vector by a surplus of at most one in one group
and a deficit of at most one in another, so a depth-first search that may spend one of
each meets all words one edit away; the words of the leaves it reaches are verified.

The trie is spread over tasks. A node of the first ``RUNGS[0]`` levels with at most
``PAGE`` words is a page; larger ones are split by the next levels, and whole vectors
with still more words by half words (of two words one edit apart, one half of the
shorter stands in both at the same end). Each word is sent to the nodes within the budget that
exist, only to those that come after its own, so a pair is met once. A page's trie
is built in one task, as sorted rows in which a node is a range; the searches of many
words go down it together, a level at a time. The visitors of a page are dealt over
tasks by their number. No group of words is paired with itself beyond the leaves.

A word's form is its near word of largest count if that is at least ``RATIO`` times its
own. Counts grow along forms, so following them ends; roots are found by pointer doubling.

Defined results:

* null and empty texts have no words; a null id counts as the empty string in the checksum;
* repeated rows count as often as they stand; ties between forms go to the smaller word
  in code-point order;
* an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import ship_package, stored
from tarmac.operators.joins import checked_broadcast

LETTER_RUN = "([a-zÀ-ÿ]+)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_CHARS = 5
MIN_COUNT = 3
RATIO = 2
#: The levels: each letter of the alphabet one, frequent ones first, and six for all other letters.
LETTERS = "eainrtosldcumgphbvfkzwyjxq"
GROUPS = 32
#: Levels of the trie after which nodes are counted, and split if too large.
RUNGS = (4, 8, GROUPS)
#: Words of a page, and visitors of a page in one task.
PAGE = 20_000
VISITS = 100_000
#: A trie node with as few words is a leaf.
LEAF = 16
#: Words that search together, and pairs that are verified together.
TOGETHER = 10_000
PAIRS = 500_000
#: Longer words are verified one by one.
WIDE = 48
#: Rows of nodes or words that are broadcast at most, about 10 MB.
MAX_BROADCAST = 100_000
#: One in so many runs loses a letter in the deterministic misspelling.
EVERY = 97


def word_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS,
                min_count: int = MIN_COUNT, every: int | None = EVERY) -> DataFrame:
    """``word, n``: the words of all texts with enough letters and occurrences.

    A run of letters, A-Z lowered, is a word; where ``every`` divides the checksum h of
    ``<id>:<run>``, its letter h % length is deleted first (``None``: never).
    """
    lowered = F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, LOWER)
    runs = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("id"),
                       F.explode(F.regexp_extract_all(lowered, F.lit(LETTER_RUN), F.lit(1))).alias("run")) \
        .where(F.char_length("run") >= min_chars)
    word: Column = F.col("run")
    if every:
        h = F.crc32(F.concat(F.col("id"), F.lit(":"), F.col("run")).cast("binary"))
        at = (h % F.char_length("run")).cast("int")
        word = F.when(h % every == 0, F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(
            F.col("run"), at + 2, F.char_length("run")))).otherwise(F.col("run"))
    return runs.select(word.alias("word")).where(F.char_length("word") >= min_chars) \
        .groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


_LEVEL = np.full(0x100, -1)
_LEVEL[[ord(c) for c in LETTERS]] = np.arange(len(LETTERS))


def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(code points of all words, one after another, length of each word)."""
    lengths = np.array([len(w) for w in words], np.int64)
    return np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64), lengths


def vectors(words: list[str]) -> np.ndarray:
    """Letters of each word per group, in the order of the levels."""
    codes, lengths = _codes(words)
    level = np.where(codes < len(_LEVEL), _LEVEL[np.minimum(codes, len(_LEVEL) - 1)], -1)
    level = np.where(level < 0, len(LETTERS) + codes % (GROUPS - len(LETTERS)), level)
    at = np.repeat(np.arange(len(words)), lengths) * GROUPS + level
    return np.bincount(at, minlength=len(words) * GROUPS).reshape(len(words), GROUPS)


def _changes(levels: int) -> np.ndarray:
    """All changes of ``levels`` counts by a surplus and a deficit of one at most."""
    eye = np.eye(levels, dtype=np.int64)
    both = [eye[i] - eye[j] for i in range(levels) for j in range(levels) if i != j]
    return np.array([np.zeros(levels, np.int64), *eye, *-eye, *both])


def budgets(own: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(surplus, deficit) that the counts ``other`` leave of one each, row by row, seen from ``own``."""
    diff = other - own
    return 1 - np.maximum(diff, 0).sum(1), 1 + np.minimum(diff, 0).sum(1)


def near(a: str, b: str) -> bool:
    """Whether one inserted, deleted or replaced letter tells the words apart."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = next((i for i, c in enumerate(a) if c != b[i]), len(a))
    return a[i + 1:] == b[i + 1:] if len(a) == len(b) else a[i:] == b[i + 1:]


class Letters:
    """Words with their letters as rows of a matrix, for verification in numbers."""

    def __init__(self, words: list[str]):
        self.words = words
        codes, self.lengths = _codes(words)
        self.rows = np.zeros((len(words), WIDE + 1), np.uint16)
        kept = np.minimum(self.lengths, WIDE)
        first = np.cumsum(self.lengths) - self.lengths
        place = np.arange(kept.sum()) - np.repeat(np.cumsum(kept) - kept, kept)
        self.rows[np.repeat(np.arange(len(words)), kept), place] = codes[np.repeat(first, kept) + place]

    def near(self, at: np.ndarray, other: Letters, to: np.ndarray) -> np.ndarray:
        """Whether the words ``at`` are one edit from the words ``to`` of ``other``."""
        out = np.zeros(len(at), bool)
        la, lb = self.lengths[at], other.lengths[to]
        long = (np.maximum(la, lb) > WIDE) & (np.abs(la - lb) <= 1)
        for i in np.flatnonzero(long):
            out[i] = near(self.words[at[i]], other.words[to[i]])
        for step in (-1, 0, 1):
            some = np.flatnonzero((lb - la == step) & ~long)
            x, y = self.rows[at[some]], other.rows[to[some]]
            if step == 0:
                out[some] = (x != y).sum(1) == 1
                continue
            short, tall = (x, y) if step > 0 else (y, x)
            first = (short != tall).argmax(1)  # the tall word has a letter more, so they differ
            rest = (short[:, :-1] != tall[:, 1:]) & (np.arange(WIDE)[None] >= first[:, None])
            out[some] = ~rest.any(1)
        return out


class Trie:
    """Words below one node of ``depth`` levels: sorted count vectors, in which each node is a range."""

    def __init__(self, words: list[str], depth: int):
        counts = vectors(words)
        order = np.lexsort(counts[:, ::-1].T) if len(words) else np.zeros(0, np.int64)
        self.words = Letters([words[i] for i in order])
        self.counts, self.depth = counts[order], depth
        self.base = int(self.counts.max(initial=0)) + 3
        node = np.zeros(len(words), np.int64)
        self.levels = []  # of each level below: codes of (parent, count), ascending; first row and size of each node
        for level in range(depth, GROUPS):
            codes, first, node, size = np.unique(node * self.base + self.counts[:, level], return_index=True,
                                                 return_inverse=True, return_counts=True)
            self.levels.append((codes, first, size))
            if size.max(initial=0) <= LEAF:
                break

    def _leaves(self, query: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, row) of all words of the ranges."""
        start = np.cumsum(size) - size
        return np.repeat(query, size), np.arange(size.sum()) - np.repeat(start, size) + np.repeat(first, size)

    def search(self, asked: Letters, counts: np.ndarray, up: np.ndarray, down: np.ndarray,
               ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(asked, found) numbers of words one edit apart, within the budgets that are left.

        All searches go down a level together: a node's children with the same count, one more
        and one less are looked up, as far as the budget goes.
        """
        n = len(self.words.words)
        for lo in range(0, len(counts) if n else 0, TOGETHER):
            query = np.arange(lo, min(lo + TOGETHER, len(counts)))
            node, u, d = np.zeros(len(query), np.int64), up[query] > 0, down[query] > 0
            for i, (codes, first, size) in enumerate(self.levels):
                found = []
                for change, may in ((0, None), (1, u), (-1, d)):
                    at = np.arange(len(query)) if may is None else np.flatnonzero(may)
                    want = node[at] * self.base + counts[query[at], self.depth + i] + change
                    # a count beyond the base belongs to no node
                    fits = (want >= node[at] * self.base) & (want < (node[at] + 1) * self.base)
                    place = np.minimum(np.searchsorted(codes, want), len(codes) - 1)
                    hit = fits & (codes[place] == want)
                    found.append((query[at[hit]], place[hit], u[at[hit]] & (change != 1), d[at[hit]] & (change != -1)))
                query, node, u, d = (np.concatenate(x) for x in zip(*found, strict=True))
                leaf = (size[node] <= LEAF) | (i == len(self.levels) - 1)
                yield from self._verified(asked, query[leaf], first[node[leaf]], size[node[leaf]])
                query, node, u, d = query[~leaf], node[~leaf], u[~leaf], d[~leaf]
            if not self.levels:
                yield from self._verified(asked, query, np.zeros(len(query), np.int64), np.full(len(query), n))

    def _verified(self, asked: Letters, query: np.ndarray, first: np.ndarray, size: np.ndarray):
        cuts = np.searchsorted(np.cumsum(size), np.arange(PAIRS, int(size.sum()), PAIRS))
        for part in np.split(np.arange(len(query)), cuts):
            q, row = self._leaves(query[part], first[part], size[part])
            ok = asked.near(q, self.words, row)
            yield q[ok], row[ok]


def _names(counts: np.ndarray) -> list[bytes]:
    """A node's name: the counts that lead to it."""
    width = 4 * counts.shape[1]
    data = np.ascontiguousarray(counts, "<u4").tobytes()
    return [data[i:i + width] for i in range(0, len(data), width)] if width else [b""] * len(counts)


def _lead(node: bytes, levels: int) -> np.ndarray:
    """The counts in a node's name (what follows them belongs to half words)."""
    return np.frombuffer(node[:4 * levels], "<u4").astype(np.int64)


def halves(word: str) -> set[bytes]:
    """The ends of ``word`` that a word one edit away may have in common with it."""
    ends = set()
    for shorter in (len(word) - 1, len(word)):
        half = shorter // 2
        ends |= {f"{shorter}<{word[:half]}".encode(), f"{shorter}>{word[len(word) - half:]}".encode()}
    return ends


def sent_down(words: list[str], nodes: list[bytes], home: np.ndarray, depth: int, deeper: int
              ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of the word, counts of the node, whether it is its own) of the nodes of ``deeper`` levels
    below ``nodes`` that the words are sent to."""
    counts = vectors(words)
    lead = np.array([_lead(n, depth) for n in nodes]).reshape(len(nodes), depth)
    up, down = budgets(counts[:, :depth], lead)
    own = counts[:, depth:deeper]
    at, targets, homes = [], [], []
    for change in _changes(deeper - depth):
        ahead = not change.any() or change[np.flatnonzero(change)[0]] > 0  # not before the word's own node
        may = (up >= (change > 0).sum()) & (down >= (change < 0).sum()) & (own + change >= 0).all(1) & (~home | ahead)
        some = np.flatnonzero(may)
        at.append(some)
        targets.append(np.concatenate((lead[some], own[some] + change), 1))
        homes.append(home[some] & (not change.any()))
    return np.concatenate(at), np.concatenate(targets), np.concatenate(homes)


def _sent(rows: DataFrame, depth: int, deeper: int | None) -> DataFrame:
    """``node, word, n, home`` rows of ``depth`` levels taken down the trie, or to half words (``None``)."""
    names = ["node", "word", "n", "home"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, words = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            if deeper is None:
                ends = [(i, node + end) for i, (node, word) in enumerate(zip(nodes, words, strict=True))
                        for end in halves(word)]
                at, targets = [i for i, _ in ends], [e for _, e in ends]
                homes = np.array(batch.column(3).to_pylist(), bool)[at] if at else np.zeros(0, bool)
            else:
                home = np.array(batch.column(3).to_pylist(), bool)
                at, counts, homes = sent_down(words, nodes, home, depth, deeper)
                targets = _names(counts)
            take = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(targets, pa.binary()), batch.column(1).take(take), batch.column(2).take(take),
                 pa.array(homes, pa.bool_())], names)

    return rows.select(*names).mapInArrow(run, "node binary, word string, n long, home boolean")


def _page_pairs(group: pd.DataFrame) -> pd.DataFrame:
    """Near pairs between a page's words, and between them and their visitors."""
    out = []
    for (node, part, depth), rows in group.groupby(["node", "part", "depth"], sort=False):
        homes, visitors = rows[rows["home"]], rows[~rows["home"]]
        trie, lead = Trie(list(homes["word"]), depth), _lead(node, depth)
        n_home = dict(zip(homes["word"], homes["n"], strict=True))
        found_n = np.array([n_home[w] for w in trie.words.words], np.int64)
        for asking, own in ((visitors, False), (homes if part == 0 else homes[:0], True)):
            asked = trie.words if own else Letters(list(asking["word"]))
            if not len(asking):
                continue
            asked_n = found_n if own else asking["n"].to_numpy()
            counts = trie.counts if own else vectors(asked.words)
            up, down = budgets(counts[:, :depth], np.broadcast_to(lead, (len(counts), depth)))
            a, b = np.array(asked.words, object), np.array(trie.words.words, object)
            for q, row in trie.search(asked, counts, up, down):
                if own:  # each pair is met from both sides
                    q, row = q[q < row], row[q < row]
                out.append(pd.DataFrame({"a": a[q], "na": asked_n[q], "b": b[row], "nb": found_n[row]}))
    return pd.concat(out) if out else pd.DataFrame({"a": [], "na": [], "b": [], "nb": []}, dtype=object)


def near_pairs(words: DataFrame, page: int = PAGE, visits: int = VISITS) -> DataFrame:
    """``a, na, b, nb``: each two words (``word, n``, distinct) one edit apart, once."""
    ship_package(words.sparkSession)
    rows = words.select(F.lit(b"").alias("node"), "word", "n", F.lit(True).alias("home"))
    pages, depth = [], 0
    for rung in (*RUNGS, None):
        rows = stored(_sent(rows, depth, rung), "spell-nodes")
        depth = rung or depth
        sizes = rows.groupBy("node").agg(F.count_if("home").alias("words"), F.count_if(~F.col("home")).alias("v"))
        sizes = stored(sizes.where("words > 0 and words + v > 1")
                       .withColumn("parts", F.greatest(F.ceil(F.col("v") / visits), F.lit(1)).cast("int")),
                       "spell-sizes")
        known = rows.join(checked_broadcast(sizes.drop("v"), sizes.count(), MAX_BROADCAST), "node")
        small = F.lit(True) if rung is None else F.col("words") <= page
        pages.append(known.where(small).withColumn("depth", F.lit(depth)))
        rows = known.where(~small)
        if rung is None or sizes.where(~small).isEmpty():
            break
    every = pages[0]
    for more in pages[1:]:
        every = every.unionByName(more)
    parts = F.when(F.col("home"), F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(
        F.array(F.pmod(F.xxhash64("word"), F.col("parts").cast("long")).cast("int")))
    dealt = stored(every.select("node", "depth", "word", "n", "home", F.explode(parts).alias("part")), "spell-pages")
    packs = max(1, -(-dealt.count() // visits))
    return dealt.withColumn("pack", F.pmod(F.xxhash64("node", "part"), F.lit(packs))).groupBy("pack") \
        .applyInPandas(_page_pairs, "a string, na long, b string, nb long").distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of the words with a ``form``, by pointer doubling."""
    at = stored(forms.select("word", F.col("form").alias("root")), "spell-roots")
    while True:
        step = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stored(at.join(checked_broadcast(step, step.count(), MAX_BROADCAST), "root", "left"), "spell-roots")
        if moved.where("next is not null").isEmpty():
            return at
        at = stored(moved.select("word", F.coalesce("next", "root").alias("root")), "spell-roots")


def variant_groups(words: DataFrame, page: int = PAGE, visits: int = VISITS, ratio: int = RATIO) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of each of ``words`` (``word, n``, distinct)."""
    words = stored(words, "spell-words")
    pairs = stored(near_pairs(words, page, visits), "spell-pairs")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("nb").alias("m")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("other"), F.col("na").alias("m")))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"),
                                    F.min(F.struct((-F.col("m")).alias("m"), "other")).alias("best"))
    strong = -F.col("best.m") >= ratio * F.col("n")
    out = stored(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(strong, F.col("best.other")).alias("form"), F.when(strong, -F.col("best.m")).alias("form_n")),
        "spell-forms")
    roots = _roots(out.where("form is not null"))
    return out.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
