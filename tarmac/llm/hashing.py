"""Vectorised word and shingle hashes over a batch of texts (numpy, no per-word Python).

Words are maximal runs of bytes outside ``[\\x20\\x09-\\x0D]``; A-Z is lowered
on request. A word's hash is the sum of its bytes, each times a random odd number of its
place in the word, modulo 2**64: two different words agree with a chance of about 2**-56
over the choice of the numbers, whatever their pattern (powers of one base would not do:
some patterns cancel out for every base). A whole batch is hashed without a Python loop
over words.
"""

from __future__ import annotations

import numpy as np

_MIX1 = np.uint64(0xFF51AFD7ED558CCD)
_MIX2 = np.uint64(0xC4CEB9FE1A85EC53)
_SPAN = 1 << 20
_PLACES: list[np.ndarray] = []


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser that spreads every input bit over the word."""
    x = (x ^ (x >> np.uint64(33))) * _MIX1
    x = (x ^ (x >> np.uint64(33))) * _MIX2
    return x ^ (x >> np.uint64(33))


def _places(place: np.ndarray, most: int) -> np.ndarray:
    """The factor of each place below ``most``: one table, and beyond its span a second factor a span."""
    if not _PLACES:
        at = np.arange(_SPAN, dtype=np.uint64)
        _PLACES.append(mix64(mix64(at + np.uint64(0x9E3779B97F4A7C55)) * _MIX2 + at) | np.uint64(1))
    if most <= _SPAN:
        return _PLACES[0][place]
    return _PLACES[0][place % _SPAN] * (mix64(place.astype(np.uint64) // np.uint64(_SPAN) * _MIX1) | np.uint64(1))


def words(texts: list[str], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, index of its text), in text order. Texts must not be null."""
    raw = [t.encode("utf-8", "replace") for t in texts]
    sizes = np.array([len(r) + 1 for r in raw], np.int64)
    b = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
    if lower:
        b = np.where((b >= 65) & (b <= 90), b + np.uint8(32), b)
    gap = (b == 32) | ((b >= 9) & (b <= 13))
    edge = np.flatnonzero(np.diff(np.concatenate(([True], gap)).astype(np.int8)))
    start, end = edge[0::2], edge[1::2]
    if not len(start):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    size = end - start
    first = np.cumsum(size) - size
    inside = b[~gap].astype(np.uint64) + np.uint64(1)  # the bytes of all words, one after another
    place = np.arange(len(inside)) - np.repeat(first, size)
    h = mix64(np.add.reduceat(inside * _places(place, int(size.max())), first))
    return h, np.searchsorted(np.cumsum(sizes), start, side="right")


def shingles(texts: list[str], width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``width``-word shingles of each text: (hash, text index), sorted by both.

    A text with fewer words has its whole word sequence as its one shingle;
    a text without words has none.
    """
    h, doc = words(texts, lower=True)
    n = len(h)
    count = np.bincount(doc, minlength=len(texts))
    factor = mix64(np.arange(1, width + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)
    if n >= width:
        s = np.zeros(n - width + 1, np.uint64)
        for j in range(width):
            s += h[j:n - width + 1 + j] * factor[j]
        whole = doc[:n - width + 1] == doc[width - 1:]
        s, sdoc = mix64(s[whole]), doc[:n - width + 1][whole]
    else:
        s, sdoc = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    short = np.flatnonzero((count > 0) & (count < width))
    if len(short):
        first = np.cumsum(count) - count
        sums = np.array([(h[first[d]:first[d] + count[d]] * factor[:count[d]]).sum(dtype=np.uint64)
                         for d in short], np.uint64)
        own = mix64(sums + count[short].astype(np.uint64) * _MIX2)
        s, sdoc = np.concatenate((s, own)), np.concatenate((sdoc, short))
    order = np.lexsort((s, sdoc))
    s, sdoc = s[order], sdoc[order]
    if len(s):
        new = np.concatenate(([True], (s[1:] != s[:-1]) | (sdoc[1:] != sdoc[:-1])))
        s, sdoc = s[new], sdoc[new]
    return s, sdoc


def batches_by_bytes(texts: list[str], limit: int = 1 << 21):
    """Slices (lo, hi) of ``texts`` of about ``limit`` characters each; a longer text stands alone."""
    lo, size = 0, 0
    for i, t in enumerate(texts):
        if i > lo and size + len(t) > limit:
            yield lo, i
            lo, size = i, 0
        size += len(t)
    if lo < len(texts):
        yield lo, len(texts)
