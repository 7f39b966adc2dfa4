"""Token counts of whole texts; huge texts by overlapping chunks that resynchronise.

A text longer than ``chunk`` characters is encoded in chunks that overlap. Two
neighbouring chunks are spliced at a position of their overlap where

* a character that is not white space is followed by one that is: no match of the
  byte-level pattern spans such a position and no special token holds white space,
  so what stands before and after it is encoded alike with or without the rest;
* both chunks' offsets show a token boundary there.

If the overlap holds no such position it is widened, again and again, up to the
rest of the text. Only two chunks' tokens are held at a time.

The byte-level vocabulary and merge order are read from a ``tokenizers`` JSON file;
counts equal that library's, special strings in texts included.

Defined results: null text counts as empty (0 bytes, 0 tokens); keys may be null or
repeated, each row is counted on its own; an empty table gives an empty result;
only the key and text columns are read, so other columns cannot clash.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import ship_package

CHUNK = 32_768
OVERLAP = 512
#: Chunks widened beyond this go to the tokenizers library, whose pattern needs no backtracking bound.
WIDEST = 500_000
LIMIT = 1024

_WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_SEAM = re.compile(f"(?<=[^{_WHITE}])(?=[{_WHITE}])")
_ENCODERS: dict = {}


def byte_symbols() -> dict[str, int]:
    """The printable character that byte-level vocabularies write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """A byte-level BPE file, as token ids and the number of bytes of each token."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec["pre_tokenizer"] or {}
        if spec["normalizer"] or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") \
                or not pre.get("use_regex", True):
            raise ValueError(f"{path}: not a plain byte-level vocabulary")
        symbols = byte_symbols()
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(symbols[c] for c in token): i
                 for token, i in spec["model"]["vocab"].items() if token not in special}
        self.path = path
        self.core = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN,
                                      mergeable_ranks=ranks, special_tokens=special)
        self.sizes = np.zeros(max([*ranks.values(), *special.values()]) + 1, np.int64)
        for token, i in [*ranks.items(), *((s.encode(), i) for s, i in special.items())]:
            self.sizes[i] = len(token)
        self._library = None

    def ids(self, text: str) -> list[int]:
        if len(text) <= WIDEST:
            return self.core.encode(text, allowed_special="all", disallowed_special=())
        if self._library is None:
            from tokenizers import Tokenizer
            self._library = Tokenizer.from_file(self.path)
        return self._library.encode(text, add_special_tokens=False).ids

    def ends(self, text: str) -> np.ndarray:
        """Byte offset of each token's end."""
        return np.cumsum(self.sizes[self.ids(text)])


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def count_tokens(text: str, enc, chunk: int = CHUNK, overlap: int = OVERLAP) -> tuple[int, int]:
    """(tokens of the whole text, chunks encoded for it)."""
    if len(text) <= chunk:
        return len(enc.ids(text)), 1
    at = lambda start, p: len(text[start:p].encode())
    total, chunks = 0, 1
    start, end, done = 0, chunk, 0  # `done`: bytes of the chunk that are already counted
    ends = enc.ends(text[start:end])
    while end < len(text):
        width = overlap
        seam = None
        while seam is None:
            nxt = max(start + 1, end - width)
            nxt_end = min(len(text), max(nxt + chunk, end + 1))
            right = enc.ends(text[nxt:nxt_end])
            chunks += 1
            for m in _SEAM.finditer(text, nxt + 1, end - 1):
                p = m.start()
                left_at, right_at = at(start, p), at(nxt, p)
                if left_at >= done and _has(ends, left_at) and _has(right, right_at):
                    seam = (left_at, right_at)
                    break
            if seam is None:  # widen: this chunk reaches further, the overlap grows with it
                width *= 2
                end = min(len(text), end + width)
                ends = enc.ends(text[start:end])
                chunks += 1
                if end == len(text):
                    break
        if seam is None:
            break
        total += int(np.searchsorted(ends, seam[0], side="right")
                     - np.searchsorted(ends, done, side="right"))
        start, end, ends, done = nxt, nxt_end, right, seam[1]
    return total + int(len(ends) - np.searchsorted(ends, done, side="right")), chunks


def _has(ends: np.ndarray, at: int) -> bool:
    i = int(np.searchsorted(ends, at))
    return i < len(ends) and ends[i] == at


def token_counts(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text",
                 chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``key, n_bytes, n_tokens, n_chunks`` of every row."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(path)
        for batch in batches:
            found = [count_tokens(t, enc, chunk, overlap) for t in batch["text"]]
            yield pd.DataFrame({
                "key": batch["key"], "n_tokens": [n for n, _ in found],
                "n_chunks": [c for _, c in found],
                "n_bytes": [len(t.encode()) for t in batch["text"]]})

    out = rows.mapInPandas(run, f"key {kind}, n_tokens long, n_chunks long, n_bytes long")
    return out.select(F.col("key").alias(key), "n_bytes", "n_tokens", "n_chunks")
