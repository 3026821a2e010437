"""Secret scans: fixed patterns, and credential values judged by what it would cost to guess them.

The fixed kinds are ``assign``, ``access`` and ``hex``. Credential contexts (the same and other key words, alone or in
longer names, authorization headers, user names in urls) give candidate values; a value becomes a span of kind ``guess`` if no cheap explanation exists: dynamic programming
finds the cheapest cut of the value into dictionary words, dates, repeats, keyboard walks and brute-force stretches.
The cost of every value found, also of the fixed ``assign`` kind, is part of the result. Dictionary words are a short list of weak
passwords and the ``LISTED`` commonest words of the documents themselves, of all languages together. A ``guess`` goes
to the end of its value and may overlap a fixed span that ends earlier; one inside a fixed ``assign`` span is left out.
What stands inside a value is judged with it, but for a key word at its end, which may have a value of its own. The
commonest words come from all documents given, so a value made of words is judged by the company the document is in.

Defined results: a null text counts as empty and has no spans; positions are code points, ends exclusive; spans are
sorted by start, then kind; equal spans of one kind cannot occur; repeated rows are scanned each; an empty table stays
empty; redaction replaces overlapping spans by one mark and leaves all other text as it is.
"""

from __future__ import annotations

import bisect
import math
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kairoline.llm.common import col, fresh, settled

KINDS = ("assign", "access", "hex", "guess")
#: The three base patterns and their least lengths.
ASSIGN = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # runs are maximal, so this equals dropping short runs
LEAST = {"assign": 6, "access": 20, "hex": 24}
_VALUE = re.compile(r"""(?:"([^\s"]+)|'([^\s']+)|((?:[^\s"'<>]|[<>"'](?=[^\s<>"'/,;:)\]}]))+))""", re.A)
#: A run of name characters before a colon or an equals sign, taken whole so that no text is read twice for one run.
_NAMED = re.compile(r"""(?<![A-Za-z0-9_-])([A-Za-z0-9_-]++)["']?\s*+[:=]\s*+""", re.A)
#: Key words within such a run, also the base ones. Short ones that begin or end other words must stand apart: after no
#: letter or digit, or as a capitalised part.
_KEY = re.compile(r"""password|passwd|pwd|passphrase|passcode|secret|token|credential|api[_-]?key|private[_-]?key|access[_-]?key|client[_-]?id|(?:(?<![A-Za-z0-9])(?:pass|auth|login|bearer)|(?<=[a-z0-9])(?-i:Pass|Auth|Login))(?:[0-9_-]|\Z)""", re.I | re.A)
_HEADER = re.compile(r"""(?:\bbearer\x20++|\bauthorization["']?\s*+[:=]\s*+["']?(?:(?:basic|bearer|token|digest)\x20++)?)""", re.I | re.A)
#: What stands between a scheme, of which only the last character is looked at here, and the host.
_LOGIN = re.compile(r"""(?<=[A-Za-z0-9+.-])://[^\s/:@]++:([^\s/@]++)@""")
_NAME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_-")
_SCHEME = _NAME - {"_"} | set("+.")
#: Substrings without which a lower-cased text cannot match; only there to skip the slower patterns.
_ASSIGN_HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_KEY_HINTS = ("pwd", "pass", "secret", "token", "credential", "auth", "bearer", "login", "key", "client")
_HEADER_HINTS = ("bearer", "authorization")
#: A value is a secret if guessing takes at least 10^this tries.
STRONG = 10.0
#: Common words of weak passwords, most common first.
WORDS = tuple("password admin welcome login letmein monkey dragon master hello secret shadow sunshine princess football "
              "baseball superman batman trustno summer winter spring autumn test guest user root default changeme example "
              "qwerty abc iloveyou love money freedom whatever ninja computer internet service server backup office "
              "company home house family friend happy lucky flower cookie orange banana apple pepper silver golden blue "
              "green black white red star tiger eagle hunter ranger soccer hockey killer pass word token key api".split())
_ROWS = ("`1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")
_LEET = str.maketrans("4@30$51!7", "aaeossilt")
_SEGMENT = math.log10(2)  # each further segment doubles the work


def _neighbours() -> dict[str, frozenset[str]]:
    """Keys next to each other; every row is shifted by half a key."""
    at = {c: (x, y) for y, row in enumerate(_ROWS) for x, c in enumerate(row)}
    return {a: frozenset(b for b, (u, v) in at.items() if (v == y and abs(u - x) == 1)
                         or (v == y + 1 and u - x in (-1, 0)) or (v == y - 1 and u - x in (0, 1)))
            for a, (x, y) in at.items()}


_NEXT = _neighbours()
_STEP = math.log10(2)  # each further key of a keyboard walk
_WALK = math.log10(47 * 5) + 2 * _STEP  # its first three
_STEM = 3  # least length of listed words
#: Words of the documents that count as guessable: so many at most, each in so many documents at least.
LISTED = 100_000
LISTED_DOCS = 3


class Ranks(dict):
    """Word to rank, from 1; hashed by identity, so costs found with it can be kept."""

    __hash__ = object.__hash__
    __eq__ = object.__eq__

    def __init__(self, words: Iterable[str] = ()) -> None:
        super().__init__()
        for known in (WORDS, words):
            for i, w in enumerate(known):
                self[w] = min(i + 1, self.get(w, i + 1))
        self._stems()

    def _stems(self) -> None:
        """Longest word by its first letters; what begins no word needs no look-up of longer parts."""
        self.stems: dict[str, int] = {}
        for w in self:
            self.stems[w[:_STEM]] = max(len(w), self.stems.get(w[:_STEM], 0))

    def __reduce__(self):
        return _ranks, (dict(self),)


def _ranks(known: dict[str, int]) -> Ranks:
    out = Ranks()
    out.update(known)
    out._stems()
    return out


_RANK = Ranks()
_DATE = re.compile(r"(?:19|20)\d\d(?:[-/.]?(?:0[1-9]|1[0-2])(?:[-/.]?(?:0[1-9]|[12]\d|3[01]))?)?"
                   r"|(?:0[1-9]|[12]\d|3[01])[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:19|20)?\d\d")


def _char_cost(c: str) -> float:
    return math.log10(10 if c.isdigit() else 26 if c.isalpha() else 33)


def guess_cost(value: str, ranks: Ranks = _RANK) -> float:
    """Decimal logarithm of the guesses of the cheapest segmentation; linear in the length of the value.

    Words, dates, walks and brute force may begin anywhere, a repeat only where it cannot begin earlier.
    """
    return _short_cost(value, ranks) if len(value) <= 64 else _cost(value, ranks)


def _cost(value: str, ranks: Ranks) -> float:
    n = len(value)
    if not n:
        return 0.0
    lower = value.lower()
    plain = lower.translate(_LEET)
    of_char = {c: _char_cost(c) for c in set(value)}
    ends: defaultdict[int, list[tuple[int, float]]] = defaultdict(list)  # segments by end: (start, cost)
    for i in range(n):
        reach = max(ranks.stems.get(lower[i:i + _STEM], 0), ranks.stems.get(plain[i:i + _STEM], 0))
        for j in range(i + _STEM, min(n, i + reach) + 1):
            rank, extra = ranks.get(lower[i:j]), 1
            if rank is None and (rank := ranks.get(plain[i:j])) is not None:
                extra = 4
            if rank is not None:
                ends[j].append((i, math.log10(rank * extra * (1 if value[i:j] == lower[i:j] else 2))))
        if value[i].isdigit() and (m := _DATE.match(value, i)):
            ends[m.end()].append((i, math.log10(365 * 100 if m.end() - i > 4 else 100)))
    codes = np.frombuffer(value.encode("utf-32-le", "surrogatepass"), "<u4")
    for period in range(1, min(9, n)):
        edges = np.flatnonzero(np.diff(codes[period:] == codes[:-period], prepend=False, append=False))
        for start, last in edges.reshape(-1, 2).tolist():  # a stretch of equal units, the first one at start
            unit = sum(of_char[c] for c in value[start:start + period])
            for j in range(start + max(2 * period, 3), last + period + 1):
                ends[j].append((start, unit + math.log10((j - start) / period)))
    best, brute, walk, keys = [0.0] + [math.inf] * n, math.inf, math.inf, 0  # brute, walk: the last segment is one
    for j in range(1, n + 1):
        brute = min(brute, best[j - 1] + _SEGMENT) + of_char[value[j - 1]]
        if j > 1 and lower[j - 1] in _NEXT.get(lower[j - 2], ()):
            keys += 1
            walk = min(walk + _STEP, best[j - 3] + _WALK + _SEGMENT) if keys >= 3 else math.inf
        else:
            walk, keys = math.inf, 1
        best[j] = min(brute, walk, min(best[i] + c for i, c in ends.pop(j)) + _SEGMENT) if j in ends else min(brute, walk)
    return best[n] - _SEGMENT


_short_cost = lru_cache(maxsize=20_000)(_cost)


def _follows(text: str, m: re.Match) -> tuple[int, int, int] | None:
    """Start and end of the value after a context, and where to look on: at the last name in it, which may be a key."""
    value = _VALUE.match(text, m.end())
    if value is None:
        return None
    start, end = value.span(value.lastindex)
    last = end
    while last > start and text[last - 1] not in _NAME:
        last -= 1
    while last > start and text[last - 1] in _NAME:
        last -= 1
    return start, end, last


def contexts(text: str) -> Iterator[tuple[int, int]]:
    """Start and end of every value in a credential context; linear in the length of the text."""
    lower = text.lower()
    if any(k in lower for k in _KEY_HINTS):
        at = 0
        while m := _NAMED.search(text, at):
            at = m.end()
            if _KEY.search(text, m.start(1), m.end(1)) and (found := _follows(text, m)):
                yield found[:2]
                at = found[2]
    if any(k in lower for k in _HEADER_HINTS):
        at = 0
        while m := _HEADER.search(text, at):
            at = m.end()
            if found := _follows(text, m):
                yield found[:2]
                at = found[2]
    for m in _LOGIN.finditer(text) if "://" in text else ():
        at = m.start()
        while at and (c := text[at - 1]) in _SCHEME and not c.isalpha():
            at -= 1
        if at and text[at - 1] in _SCHEME:  # a scheme begins with a letter
            yield m.span(1)


def find(text: str | None, strong: float = STRONG, ranks: Ranks = _RANK) -> list[tuple[str, int, int, float | None]]:
    """Spans of a text: kind, start, end, cost of the value (null for kinds without one)."""
    if not text:
        return []
    out: list[tuple[str, int, int, float | None]] = []
    lower = text.lower()
    for m in ASSIGN.finditer(text) if any(k in lower for k in _ASSIGN_HINTS) else ():
        if len(m[2]) >= LEAST["assign"]:
            out.append(("assign", m.start(), m.end(), guess_cost(m[2], ranks)))
    if "AKIA" in text:
        out += [("access", m.start(), m.end(), None) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    out += [("hex", m.start(), m.end(), None) for m in HEX.finditer(text)]
    fixed = {a: b for kind, a, b, _ in out if kind == "assign"}
    begins = sorted(fixed)  # of one kind, so they do not overlap
    taken: set[tuple[int, int]] = set()
    for start, end in contexts(text):
        value = text[start:end].rstrip(".,;:!?)")
        span = (start, start + len(value))
        before = bisect.bisect_right(begins, start)
        inside = before and span[1] <= fixed[begins[before - 1]]
        if len(value) >= LEAST["assign"] and not inside and span not in taken and (cost := guess_cost(value, ranks)) >= strong:
            taken.add(span)
            out.append(("guess", *span, cost))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


_SPANS = "array<struct<kind:string,start:int,end:int,cost:double>>"


def listed(docs: DataFrame, text: str = "text") -> Ranks:
    """The commonest words of the documents, by how many hold them; what follows a colon or an equals sign is no evidence."""
    plain = F.regexp_replace(F.lower(col(text)), r"[:=]\s*\S+", " ")
    found = F.array_distinct(F.filter(F.split(plain, r"[^\p{L}\p{N}_]+"), lambda w: w.rlike(r"^\p{L}{3,24}$")))
    counts = settled(docs.select(F.explode(found).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(
        F.col("n") >= LISTED_DOCS))
    least, total = None, 0  # words as common as the first one that no longer fits are left out
    for n, size in sorted(((r[0], r[1]) for r in counts.groupBy("n").count().toLocalIterator()), reverse=True):
        if (total := total + size) > LISTED:
            break
        least = n
    if least is None:
        return Ranks()
    return Ranks(r[0] for r in sorted(counts.filter(F.col("n") >= least).collect(), key=lambda r: (-r[1], r[0])))


def scan(docs: DataFrame, text: str = "text", into: str = "spans", strong: float = STRONG,
         ranks: Ranks | None = None) -> DataFrame:
    """``docs`` with the spans of their whole texts; only the counts of words for ``listed`` are shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast(listed(docs, text) if ranks is None else ranks)

    @F.pandas_udf(_SPANS)
    def spans(texts: pd.Series) -> pd.Series:
        ranks = shared.value
        return texts.map(lambda t: [dict(zip(("kind", "start", "end", "cost"), s, strict=True)) for s in find(t, strong, ranks)])

    return docs.withColumn(into, spans(col(text)))


def written(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, text: str = "text", size: str | None = "n_chars", mark: str = "[secret]",
           ranks: Ranks | None = None) -> DataFrame:
    """``docs`` with every span of the text replaced by ``mark`` and the length column brought up to date."""
    shared = docs.sparkSession.sparkContext.broadcast(listed(docs, text) if ranks is None else ranks)

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        def one(t):
            spans = find(t, ranks=shared.value)
            if not spans:
                return t
            out, at = [], 0
            for _, start, end, _ in spans:
                if start >= at:
                    out += [t[at:start], mark]
                at = max(at, end)
            return "".join([*out, t[at:]])
        return texts.map(one)

    (done,) = fresh(docs, "clean_text")
    cleaned = docs.withColumn(done, clean(col(text)))
    changed = ~col(done).eqNullSafe(col(text))
    columns = []
    for c in docs.columns:
        if c == text:
            columns.append(col(done).alias(c))
        elif c == size:
            columns.append(F.when(changed, F.char_length(col(done))).otherwise(col(c)).cast(docs.schema[c].dataType).alias(c))
        else:
            columns.append(col(c))
    return cleaned.select(*columns)
