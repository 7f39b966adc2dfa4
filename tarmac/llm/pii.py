"""Personal data in plain sight and in disguise, as spans of the original text.

Four kinds are found: ``email``, ``ip``, ``card``, ``phone``. The base finders read the text
as it is. Then transducers rewrite disguises:

* character references (``&#64;``, ``&period;``) and percent codes (``%40``) of the signs;
* homoglyphs: full-width, accented and look-alike letters, digits and signs, by compatibility forms
  and Unicode names, Greek and Cyrillic ones by shape; invisible and combining characters go;
* ``name [at] host (dot) com``, ``name at host dot com``, ``10[.]0[.]0[.]1``, ``10 dot 0 dot 0 dot 1``,
  ``name _at_ host -dot- com``, ``name @ host . com``, in words of four languages (``arroba``,
  ``punkt``, ``point`` ...), each mark on its own: ``name@host dot com``, ``name at host [dot] it``.
  Bracketed marks come first; a bare ``at`` counts only where a disguised dot follows;
* digits spelled out in English, German, French or Spanish, six or more in a row, first with
  single numerals among them only, then with neighbouring numerals of any length.

Each transducer keeps the list of its edits, so a span found in its output is
mapped back through all of them to the characters it was made of. The base
finders run again on the rewritten text; what they find there and not before
is added to the base spans.

All finders are linear in the text: runs are matched whole and never retried.

Defined results: null text has no spans; rows with null or repeated keys are
searched each on its own; an empty table gives an empty result; other columns are
not read (``redact`` passes them on). Spans are in code points, end exclusive.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import ship_package

KINDS = ("email", "ip", "card", "phone")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

# ---- fixed values: look-alikes, invisible characters, digit words, top-level domains ----
LOOK_ALIKES = {
    "а": "a", "с": "c", "е": "e", "һ": "h", "і": "i", "ј": "j", "ӏ": "l", "о": "o", "р": "p",
    "ѕ": "s", "х": "x", "у": "y", "А": "A", "В": "B", "С": "C", "Е": "E", "Н": "H", "К": "K",
    "М": "M", "О": "O", "Р": "P", "Т": "T", "Х": "X", "α": "a", "ο": "o", "ρ": "p", "ν": "v",
    "Α": "A", "Β": "B", "Ε": "E", "Ο": "O", "Ρ": "P", "Τ": "T", "Χ": "X", "ı": "i", "ɡ": "g",
    "﹫": "@", "․": ".", "。": ".", "﹒": ".", "‐": "-", "‑": "-", "‒": "-", "–": "-", "−": "-",
    " ": " ", " ": " ", " ": " ",
    "к": "k", "м": "m", "т": "t", "в": "b", "н": "h", "г": "r", "п": "n", "ѵ": "v", "ԁ": "d", "ԛ": "q", "ԝ": "w",
    "Ѕ": "S", "І": "I", "Ј": "J", "У": "Y", "Ԛ": "Q", "Ԝ": "W",
    "ι": "i", "κ": "k", "τ": "t", "υ": "u", "γ": "y", "χ": "x", "η": "n", "ω": "w", "ε": "e", "ϲ": "c", "ϳ": "j",
    "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Υ": "Y", "Ζ": "Z", "Η": "H", "ɑ": "a",
}
INVISIBLE = "­​‌‍⁠﻿"
DIGIT_WORDS = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5",
    "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "zwei": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6",
    "sieben": "7", "acht": "8", "neun": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7",
    "huit": "8", "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6",
    "siete": "7", "ocho": "8", "nueve": "9",
}
#: Words for the two marks; "at" and "point" are words of prose too.
AT_WORDS = ("arroba", "arobase", "arobas", "klammeraffe")
DOT_WORDS = ("dot", "punkt", "punto")
ENTITIES = {"commat": "@", "period": ".", "plus": "+", "hyphen": "-", "dash": "-", "lowbar": "_", "percnt": "%"}
DOMAINS = ("com", "org", "net", "edu", "gov", "info", "io", "de", "fr", "es", "uk", "eu", "us")
# ---- end of fixed values ----

_LATIN = re.compile(r"LATIN (?:(SMALL|CAPITAL) LETTER|LETTER SMALL CAPITAL) ([A-Z])(?: WITH .+)?")


def _latin(c: str) -> str | None:
    """The plain letter that a Latin letter is a form of, by its Unicode name."""
    m = _LATIN.fullmatch(unicodedata.name(c, ""))
    return m and (m[2] if m[1] == "CAPITAL" else m[2].lower())


# compatibility forms (full-width, mathematical, circled ...) of one ASCII character, decimal digits, accented and
# other forms of Latin letters, look-alikes
_FLAT = {c: flat for c in range(0xA0, 0x20000)
         if len(flat := unicodedata.normalize("NFKC", chr(c))) == 1 and flat.isascii() and flat != chr(c)} \
    | {c: str(digit) for c in range(0xA0, 0x20000) if (digit := unicodedata.decimal(chr(c), None)) is not None} \
    | {c: flat for c in range(0xA0, 0xAC00) if (flat := _latin(chr(c)))} \
    | {ord(a): b for a, b in LOOK_ALIKES.items()}
DIGIT_WORDS |= {"".join(_FLAT.get(ord(c), c) for c in w): d for w, d in DIGIT_WORDS.items()}
_FLAT_CHARS = frozenset(map(chr, _FLAT))
_INVISIBLE = re.compile(f"[{INVISIBLE}\u0300-\u036f]+")
_CODED = re.compile(r"&#0*([0-9]{1,7});|&#[xX]0*([0-9a-fA-F]{1,6});|&(" + "|".join(ENTITIES) + r");|%(40|2[eE])")
_AT, _DOT = "|".join(AT_WORDS), "|".join(DOT_WORDS)
_BRACKETED = re.compile(rf"[\[({{<]\s*(?:(at|{_AT}|@)|{_DOT}|point|\.)\s*[\])}}>]\s*"
                        rf"|(?<=\s)([_-])(?:(at|{_AT})|{_DOT}|point)\2\s\s*", re.I)
_HOST = r"[A-Za-z0-9-]+(?:{0}[A-Za-z0-9-]+)*{0}[A-Za-z]{{2,}}(?![A-Za-z0-9-])"
_SPACED = r"[ \t]+\.[ \t]+"
# "point" is too common after "at" in prose
_WEAK_HOST = _HOST.format(rf"(?:\.|[ \t]+(?:{_DOT})[ \t]+|{_SPACED})")
_SURE_HOST = _HOST.format(rf"(?:\.|[ \t]+(?:{_DOT}|point)[ \t]+|{_SPACED})")
_BARE = re.compile(rf"(?<=[A-Za-z0-9._%+-])(?:([ \t]+at[ \t]+)({_WEAK_HOST})"
                   rf"|([ \t]+(?:{_AT})[ \t]+|[ \t]+@[ \t]*|@[ \t]+)({_SURE_HOST})|@({_SURE_HOST}))", re.I)
_LOCAL_DOT = re.compile(rf"(?<=[A-Za-z0-9._%+-])[ \t]+(?:{_DOT})[ \t]+(?=[A-Za-z0-9._%+-])", re.I)
_NUMBER_DOT = re.compile(rf"(?<=[0-9])[ \t]+(?:{_DOT}|point|\.)[ \t]+(?=[0-9])", re.I)
#: A host after a bare "at" is none of these, unless the domain ends in one of DOMAINS.
_NO_HOST = frozenset("a an any each every his her its my no one our that the their this which your".split())
_BARE_DOT = re.compile(rf"[ \t]+(?:{_DOT}|point|\.)[ \t]+", re.I)
_BARE_MARKS = re.compile(rf"[ \t](?:{_DOT}|point|{_AT}|[.@][ \t])|[ \t]@|@[ \t]", re.I)
_WORD = "|".join(sorted(DIGIT_WORDS, key=len, reverse=True))
_SPELLED = re.compile(rf"(?:plus[\s,-]+)?(?:{_WORD}|[0-9])(?:[\s,-]+(?:{_WORD}|[0-9]|{_DOT}|point)){{5,}}(?![^\W_])",
                      re.I)
_NUMERAL = r"[0-9]++(?:\.[0-9]++)*+"
_JOINED = re.compile(rf"(?<![^\W_])(?<![0-9]\.)(?:(?:plus|\+)[\s,()-]*)?(?:{_WORD}|{_NUMERAL})"
                     rf"(?:[\s,()-]+(?:{_WORD}|{_NUMERAL}|{_DOT}|point))+(?![^\W_])", re.I)
_SPELLED_PART = re.compile(rf"{_WORD}|[0-9]|{_DOT}|point|plus|[.+]", re.I)
_TWO_WORDS = re.compile(rf"(?:{_WORD})[\s,-]+(?:{_WORD}|[0-9]|{_DOT}|point)")

Span = tuple[int, int, int]  # start, kind, end


def _emails(text: str) -> Iterator[Span]:
    free = 0  # the last match ends here
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            free = domain.end()
            yield start, 0, free
        at = text.find("@", max(at + 1, free))


def _ips(text: str) -> Iterator[Span]:
    for run in _DOTTED.finditer(text):
        parts = run.group().split(".")
        start = run.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i:i + 4]
            end = start + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                yield start, 1, end
            start = end + 1


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _cards(text: str) -> Iterator[Span]:
    for m in _CARD.finditer(text):
        if m.end() - m.start() <= 37:  # 19 digits and what stands between them
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                yield m.start(), 2, m.end()


def _phones(text: str) -> Iterator[Span]:
    for m in _PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
            yield m.start(), 3, m.end()


def base_spans(text: str) -> list[Span]:
    """Spans in plain sight, by start and kind."""
    return sorted([*_emails(text), *_ips(text), *_cards(text), *_phones(text)])


class Rewrite:
    """A rewritten text with the edits that made it; ``back`` maps spans of it to its source."""

    def __init__(self, text: str, edits: list[tuple[int, int, str]]):
        self.shift: list[tuple[int, int, int, int]] = []  # output start, end, source start, end
        out, at, size = [], 0, 0
        for start, end, new in edits:
            out += [text[at:start], new]
            size += start - at
            self.shift.append((size, size + len(new), start, end))
            size += len(new)
            at = end
        out.append(text[at:])
        self.text = "".join(out)
        self.starts = [s[0] for s in self.shift]

    def back(self, start: int, end: int) -> tuple[int, int]:
        return self._place(start, False), self._place(end, True)

    def _place(self, at: int, is_end: bool) -> int:
        # an end is placed by the character before it
        i = bisect_right(self.starts, at - 1 if is_end else at) - 1
        while not is_end and i >= 0 and self.shift[i][0] == self.shift[i][1] == at and i:
            i -= 1  # nothing is left of this edit: the character after it counts
        if i < 0:
            return at
        first, last, source, source_end = self.shift[i]
        if at - is_end < last:
            return source_end if is_end else source
        return source_end + at - last


def _look_alike_edits(text: str) -> list[tuple[int, int, str]]:
    if _FLAT_CHARS.isdisjoint(text):
        return []
    return [(i, i + 1, _FLAT[ord(c)]) for i, c in enumerate(text) if c in _FLAT_CHARS]


def _left_of_blanks(text: str, at: int) -> int:
    while at and text[at - 1].isspace():
        at -= 1
    return at


def _bracket_edits(text: str) -> list[tuple[int, int, str]]:
    return [(_left_of_blanks(text, m.start()),
             m.end(), "@" if m.group(1) or m.group(3) else ".") for m in _BRACKETED.finditer(text)]


def _coded_edits(text: str) -> list[tuple[int, int, str]]:
    """Character references and percent codes of printable ASCII."""
    edits = []
    for m in _CODED.finditer(text):
        code = int(m[1]) if m[1] else int(m[2] or m[4] or "0", 16)
        if m[3] or 0x20 < code < 0x7F:
            edits.append((m.start(), m.end(), ENTITIES[m[3]] if m[3] else chr(code)))
    return edits


def _last_label(host: str) -> str:
    """What follows the last dot, plain or bare; empty without one."""
    return labels[-1].lower() if len(labels := re.split(r"\.|\s+", host)) > 1 else ""


def _bare_edits(text: str, dots: frozenset[int] = frozenset()) -> list[tuple[int, int, str]]:
    """Bare marks; ``dots`` are the places of dots that were written in brackets."""
    if not dots and not _BARE_MARKS.search(text):
        return []
    edits = [(m.start(), m.end(), ".") for m in _NUMBER_DOT.finditer(text)]
    joins = {m.end(): m.start() for m in _LOCAL_DOT.finditer(text)}
    free = 0  # the last match ends here
    for m in _BARE.finditer(text):
        part = 2 if m.group(1) else 4 if m.group(3) else 5
        bare = [d.span() for d in _BARE_DOT.finditer(text, m.start(part), m.end(part))]
        last = _last_label(m.group(part))
        if last not in DOMAINS and re.search(_SPACED, m.group(part)):
            continue  # a full stop between blanks may end a sentence
        if m.group(1):
            if not bare and not any(m.start(part) <= d < m.end(part) for d in dots):
                continue
            if m.group(part).lower().split()[0] in _NO_HOST and last not in DOMAINS:
                continue
            edits.append((m.start(1), m.end(1), "@"))
        elif m.group(3):
            edits.append((m.start(3), m.end(3), "@"))
        elif bare and last not in DOMAINS and _last_label(text[m.start(part):bare[0][0]]) in DOMAINS:
            bare = []  # a whole address before a word of the sentence
        edits += [(*span, ".") for span in bare]
        start = m.start()
        while True:
            while start > free and text[start - 1] in _LOCAL:
                start -= 1
            if joins.get(start, -1) < free:
                break
            edits.append((joins[start], start, "."))
            start = joins[start]
        free = m.end()
    return sorted(set(edits))


def _spelled_edits(text: str, joined: bool = False) -> list[tuple[int, int, str]]:
    edits = []
    low = text.lower()
    if not DIGIT_WORDS.keys().isdisjoint(re.sub("[,()-]", " ", low).split()) and _TWO_WORDS.search(low):
        for m in (_JOINED if joined else _SPELLED).finditer(text):
            if m.start() and text[m.start() - 1].isalpha():
                continue
            parts = [p.group().lower() for p in _SPELLED_PART.finditer(m.group())]
            if len(parts) >= 6 and any(p in DIGIT_WORDS for p in parts):
                edits.append((m.start(), m.end(), "".join(
                    "+" if p in ("plus", "+") else "." if p in (*DOT_WORDS, "point", ".") else DIGIT_WORDS.get(p, p)
                    for p in parts)))
    return edits


def _apart(edits: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Edits in order; of two that overlap the first stays."""
    out, free = [], 0
    for e in sorted(edits):
        if e[0] >= free:
            out.append(e)
            free = e[1]
    return out


def deobfuscate(text: str) -> list[list[Rewrite]]:
    """Chains of rewrites that change ``text``, each rewrite of the one before; none if there is no disguise.

    Chains differ in the reading of numerals beside spelled digits.
    """
    steps: list[Rewrite] = []
    now = text

    def step(edits: list[tuple[int, int, str]]) -> bool:
        nonlocal now
        if edits := _apart(edits):
            steps.append(Rewrite(now, edits))
            now = steps[-1].text
        return bool(edits)

    if "&" in text or "%" in text:
        step(_coded_edits(now))
    if not now.isascii():
        step([(m.start(), m.end(), "") for m in _INVISIBLE.finditer(now)])
        step(_look_alike_edits(now))
    dots = frozenset()
    if step(_bracket_edits(now)):
        dots = frozenset(s for s, e, _, _ in steps[-1].shift if steps[-1].text[s:e] == ".")
    step(_bare_edits(now, dots))
    chains = [steps] if steps else []
    spelled = [_apart(_spelled_edits(now, joined)) for joined in (False, True)]
    if spelled[0] or spelled[1]:
        chains = [[*steps, Rewrite(now, e)] for i, e in enumerate(spelled) if e and e not in spelled[:i]]
    return chains


def all_spans(text: str) -> tuple[list[Span], list[Span]]:
    """(base spans, all spans); both by start and kind."""
    base = base_spans(text)
    whole, kept = set(base), []
    found = set(base)
    for steps in deobfuscate(text):
        for start, kind, end in base_spans(steps[-1].text):
            for step in reversed(steps):
                start, end = step.back(start, end)
            found.add((start, kind, end))
    ends = dict.fromkeys(range(len(KINDS)), -1)
    for span in sorted(found, key=lambda x: (x[0], -x[2], x not in whole)):
        start, kind, end = span
        if span in whole or end > ends[kind]:  # not within another of its kind
            kept.append(span)
        ends[kind] = max(ends[kind], end)
    return base, sorted(kept)


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def redacted(text: str) -> str:
    """``text`` with each span (overlapping ones as one) replaced by its kind in angle brackets."""
    out, at = [], 0
    for start, kind, end in all_spans(text)[1]:
        if start >= at:
            out += [text[at:start], f"<{KINDS[kind].upper()}>"]
        at = max(at, end)
    return "".join([*out, text[at:]]) if out else text


def find_pii(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_email, n_ip, n_card, n_phone`` (of the base), ``base_sha256, spans, n_added``."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    names = [f"n_{k}" for k in KINDS]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [all_spans(t) for t in batch["text"]]
            base = [b for b, _ in found]
            cols = {n: [sum(k == i for _, k, _ in b) for b in base] for i, n in enumerate(names)}
            yield pd.DataFrame({
                "key": batch["key"], **cols,
                "base_sha256": [hashlib.sha256(written(b).encode()).hexdigest() for b in base],
                "spans": [written(s) for _, s in found],
                "n_added": [len(s) - len(b) for b, s in found]})

    counts = ", ".join(f"{n} long" for n in names)
    out = rows.mapInPandas(run, f"key {kind}, {counts}, base_sha256 string, spans string, n_added long")
    return out.withColumnRenamed("key", key)


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with personal data in ``text`` masked; null stays null."""
    ship_package(docs.sparkSession)

    @F.pandas_udf("string")
    def mask(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: t if t is None else redacted(t))

    return docs.withColumn(text, mask(F.col(text)))
