"""BPE encoding and decoding by a depth-first walk of a prefix trie.

A BPE encoding is the one sequence of tokens whose neighbours are all *stable*: left
alone, no merge would have joined across their border before each was complete. So
the last token of a prefix is the one suffix token that is stable after the last
token of what precedes it, and an encoding is read off last tokens backwards.

A batch's distinct words form a trie; it is walked depth first (in sorted order,
keeping the path shared with the word before), and the last token of each prefix is
computed once, however many words share it. Words seen before are kept per
worker up to a bound and never walked again.

Text is normalised and split as the vocabulary's JSON file says (NFC, white space,
lower case; letters, single digits, other runs); special strings are cut out first.

Defined results: null text encodes as empty (0 tokens, decoded to the empty text);
rows with null or repeated keys are encoded each on its own; a word of any length is
one path of the trie; an empty table gives an empty result; only the key and text
columns are read.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import ship_package
from tarmac.llm.token_counts import byte_symbols

#: Words (and stable pairs) a worker keeps; beyond it starts anew.
KEPT_WORDS = 400_000
_CODECS: dict = {}
#: Characters whose classes, case and normal form all Unicode versions of use agree on.
_COMMON = re.compile(r"[^\x00-ɏ‐-‧‰-⁞]")
_SPACE = re.compile(r"[\t-\r \x85\xa0]+")


class Codec:
    """One vocabulary: encodes words by last-token states, decodes by table."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Regex, Tokenizer, normalizers, pre_tokenizers

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"]["pretokenizers"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.vocab = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = {i: t for t, i in [*self.vocab.items(), *self.special.items()]}
        pattern = pre[0]["pattern"]["Regex"]
        self.find = regex.compile(pattern).findall
        # the library's own steps, for texts with rarer characters
        self.normalize = Tokenizer.from_file(path).normalizer.normalize_str
        self.split = pre_tokenizers.Split(Regex(pattern), "removed", invert=True).pre_tokenize_str
        assert [n["type"] for n in spec["normalizer"]["normalizers"]] == ["NFC", "Replace", "Lowercase"]
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")").split \
            if self.special else lambda t: [t]
        self.symbol = {b: c for c, b in byte_symbols().items()}
        self.table = {b: ord(c) for b, c in self.symbol.items()}
        self.merge: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        for a, b in model["merges"]:
            whole = self.vocab[a + b]
            pair = (self.vocab[a], self.vocab[b])
            self.merge[pair] = whole
            self.parts[whole] = pair
        # a later merge has the larger id; tokens that their own merges never reach are left out
        ids = [self.vocab[a + b] for a, b in model["merges"]]
        assert all(x < y for x, y in zip(ids, ids[1:], strict=False)), "ids must follow the merges"
        reached = {t: i for t, i in self.vocab.items()
                   if i not in self.parts or self.stable(*self.parts[i], i)}
        self.inner = {t: i for t, i in reached.items() if not (self.suffix and t.endswith(self.suffix))}
        self.final = {t[:len(t) - len(self.suffix)]: i for t, i in reached.items()
                      if t.endswith(self.suffix)} if self.suffix else self.inner
        self.longest_inner, self.longest_final = (max(map(len, t)) for t in (self.inner, self.final))
        self.length = {i: len(t) for t, i in self.inner.items()} | {i: len(t) for t, i in self.final.items()}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.words: dict[str, tuple[bytes, str]] = {}

    def stable(self, left: int, right: int, before: int = 1 << 62) -> bool:
        """Whether no merge earlier than ``before`` joins ``left`` and ``right`` across their border.

        Undoes the merges of both sides from the latest to the earliest and looks at
        the two pieces that meet at the border between each two of them.
        """
        merge, parts = self.merge, self.parts
        while True:
            joined = merge.get((left, right))
            if joined is not None and joined < before:
                return False
            left_made, right_made = left in parts, right in parts
            if left_made and (left > right or not right_made):
                before, left = left, parts[left][1]
            elif right_made:  # of one merge's places the leftmost comes first
                before, right = right + 1, parts[right][0]
            else:
                return True

    def encode_words(self, words: set[str]) -> dict[str, list[int]]:
        """Token ids of each word (written in byte symbols), by one walk of their trie.

        ``last[i]`` is the last token of the path's first ``i`` symbols.
        """
        found, path, last = {}, "", [0]
        inner, final, pairs, length = self.inner, self.final, self.pairs, self.length
        if len(pairs) > KEPT_WORDS:
            pairs.clear()
        for word in sorted(words):
            n, shared = len(word), 0
            most = min(len(path), n - 1)
            while shared < most and path[shared] == word[shared]:
                shared += 1
            del last[shared + 1:]
            for end in range(shared + 1, n + 1):
                tokens, longest = (inner, self.longest_inner) if end < n else (final, self.longest_final)
                for i in range(end - longest if end > longest else 0, end):
                    token = tokens.get(word[i:end])
                    if token is not None:
                        if not i:
                            break
                        pair = (last[i], token)
                        known = pairs.get(pair)
                        if known is None:
                            known = pairs[pair] = self.stable(*pair)
                        if known:
                            break
                else:
                    raise ValueError(f"no encoding of {word!r}")
                if end < n:
                    last.append(token)
            path = word[:-1]
            ids, end = [token], n - length[token]
            while end:
                ids.append(last[end])
                end -= length[last[end]]
            found[word] = ids[::-1]
        return found

    def pieces(self, text: str) -> list[str]:
        """The words of ``text``, special strings among them as they are."""
        out = []
        for part in self.cut(text) if "<|" in text else [text]:
            if part in self.special:
                out.append(part)
            elif part:
                if _COMMON.search(part):
                    out += [w for w, _ in self.split(self.normalize(part))]
                else:
                    out += self.find(_SPACE.sub(" ", unicodedata.normalize("NFC", part)).lower())
        return out

    def learn(self, words: set[str]) -> None:
        """Add to the kept words; ids and decoded form of each."""
        if len(self.words) + len(words) > KEPT_WORDS:
            self.words.clear()
        raw = {w: w.encode().decode("latin-1").translate(self.table) for w in words
               if w not in self.special}
        encoded = self.encode_words(set(raw.values()))
        for w in words:
            ids = [self.special[w]] if w in self.special else encoded[raw[w]]
            self.words[w] = (struct.pack(f"<{len(ids)}I", *ids), self.decode(ids))

    def decode(self, ids: list[int]) -> str:
        """Token strings joined by blanks: the file names no decoder."""
        return " ".join(self.names[i] for i in ids)

    def encode(self, texts: list[str]) -> list[tuple[bytes, str]]:
        """(ids as little-endian unsigned 32-bit integers, decoded text) of each text."""
        split = [self.pieces(t) for t in texts]
        if len(self.words) > KEPT_WORDS:
            self.words.clear()
        new = {w for words in split for w in words}.difference(self.words)
        known = self.words
        if new:
            if len(known) + len(new) > KEPT_WORDS:
                new = {w for words in split for w in words}
            self.learn(new)
        out = []
        for words in split:
            got = [known[w] for w in words]
            out.append((b"".join([g[0] for g in got]), " ".join([g[1] for g in got])))
        return out


def codec(path: str) -> Codec:
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def _slices(texts: list[str], limit: int = 1 << 21) -> Iterator[list[str]]:
    """Texts of about ``limit`` characters together; a longer one stands alone."""
    some, size = [], 0
    for t in texts:
        if some and size + len(t) > limit:
            yield some
            some, size = [], 0
        some.append(t)
        size += len(t)
    if some:
        yield some


def encode_decode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text",
                  full: bool = True) -> DataFrame:
    """``key, n_tokens, ids (binary), decoded`` of every row; ``full=False`` gives their
    SHA-256 (``ids_sha256, decoded_sha256``) instead of ids and decoded text."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    names = "ids binary, decoded string" if full else "ids_sha256 string, decoded_sha256 string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = codec(path)
        sha = lambda b: hashlib.sha256(b).hexdigest()
        for batch in batches:
            at = 0
            for texts in _slices(list(batch["text"])):
                got = coder.encode(texts)
                keys = batch["key"].iloc[at:at + len(texts)]
                at += len(texts)
                cols = {"ids": [i for i, _ in got], "decoded": [d for _, d in got]} if full else {
                    "ids_sha256": [sha(i) for i, _ in got],
                    "decoded_sha256": [sha(d.encode()) for _, d in got]}
                yield pd.DataFrame({"key": keys.values, "n_tokens": [len(i) // 4 for i, _ in got], **cols})

    out = rows.mapInPandas(run, f"key {kind}, n_tokens long, {names}")
    return out.withColumnRenamed("key", key)
