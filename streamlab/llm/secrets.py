"""Secret scan: fixed patterns, and a guess-cost model for values in a credential context.

The model cuts a value into words, dates, repeats, keyboard walks and brute-force characters so
that the sum of their guess costs (log10) is smallest: dynamic programming over the end of the
last part. A value an attacker would need more than ``10 ** MIN_COST`` guesses for is reported as
kind ``guess``; a value made of common parts is not a secret worth reporting.

Words come with their ranks from a table that the caller can replace (``guess_cost``); the one
here lists the commonest parts of passwords. Repeats and walks are looked at in all lengths.

Handling of odd input: NULL and empty texts have no spans; equal texts, also of repeated rows, have
equal spans; spans that start together are ordered by kind; other columns are passed on, an existing
column of the output's name is replaced; an empty table gives none. Whole texts are read, however
long: the work grows with their length.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Mapping
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamlab.llm.session import with_python

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "guess")
MIN_COST = 8.0

# ASCII: only A-Z count as the other case of a-z
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_CONTEXT = re.compile(
    r"""(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|credentials?|bearer|(?:api|access|private|secret|auth)[_-]?key)"""
    r"""["']?\x20*(?:[:=]{1,2}>?|\x20is\x20)\x20*["'`]?([^\x00-\x20"'`<>,;]{6,})""",
    re.A | re.I,
)
_ASSIGN_HINTS = ("passw", "secret", "token", "api")
_CONTEXT_HINTS = ("pass", "pwd", "secret", "token", "credential", "bearer", "key")

# Common parts of passwords, most common first: a word's place is its guess count.
WORDS = (
    "password pass admin user login root test guest secret token default welcome master hello love "
    "monkey dragon letmein changeme example sample demo temp public private server system manager "
    "service access key value string none null true false user name mail home house summer winter "
    "spring autumn monday friday sunday january march april june july august october november "
    "december football baseball soccer hockey shadow sunshine princess flower star blue green red "
    "black white orange silver gold tiger lion eagle angel devil super hunter ranger killer king "
    "queen cheese coffee pepper cookie banana apple computer internet google windows linux data "
    "base cloud code dev prod stage local world money lucky happy magic freedom trust the and for "
    "you with this that from your here there what when which one two three four five six seven"
).split()
_RANK = {w: i + 1 for i, w in reversed(list(enumerate(WORDS)))}
_LEET = str.maketrans("4@831!05$7", "aabeiiosst")
_ROWS = ("1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./", "abcdefghijklmnopqrstuvwxyz")
_YEAR_PART, _MONTH_PART, _DAY_PART, _GAP = r"(?:19|20)\d\d", r"(?:0[1-9]|1[0-2])", r"(?:0[1-9]|[12]\d|3[01])", r"[-/._]?"
# one pattern for each order and length, so that all of them count at each start
_DATES = tuple(
    re.compile(f"(?=({one}({_GAP}){_MONTH_PART}\\2{two}))")
    for one, two in ((_YEAR_PART, _DAY_PART), (_DAY_PART, _YEAR_PART), (_DAY_PART, r"\d\d"))
)
_YEAR = re.compile(rf"(?=({_YEAR_PART}))")
_FURTHER = 0.3  # for each part after the first
_TURN = 0.3  # for each change of direction in a walk
_PERIODS = (1, 2, 3, 4)
_LEAST = 3  # characters of a repeat or a walk


@lru_cache(maxsize=1)
def _steps() -> dict[tuple[str, str], frozenset]:
    """Neighbours on the keyboard or in the alphabet, with the directions that lead from one to the other."""
    found: dict[tuple[str, str], set] = {}

    def add(x: str, y: str, row: str, across: int, down: int) -> None:
        found.setdefault((x, y), set()).add((row, across, down))
        found.setdefault((y, x), set()).add((row, -across, -down))

    for k, row in enumerate(_ROWS):
        for x, y in zip(row, row[1:]):
            add(x, y, "abc" if k == 4 else "keys", 1, 0)
    for upper, lower in zip(_ROWS, _ROWS[1:4]):
        for x, y in zip(upper, lower):
            add(x, y, "keys", 0, 1)
        for x, y in zip(upper[1:], lower):
            add(x, y, "keys", -1, 1)
    return {pair: frozenset(ways) for pair, ways in found.items()}


def _alphabet(value: str) -> float:
    """Size of the character set a brute-force attack on the value needs."""
    size = 0
    size += 26 if any("a" <= c <= "z" for c in value) else 0
    size += 26 if any("A" <= c <= "Z" for c in value) else 0
    size += 10 if any("0" <= c <= "9" for c in value) else 0
    size += 33 if any(c < "\x80" and not c.isalnum() for c in value) else 0
    size += 100 if any(c >= "\x80" for c in value) else 0
    return max(size, 2)


def _lowered(value: str) -> str:
    low = value.lower()
    return low if len(low) == len(value) else value  # a letter whose small form is longer


def listed_parts(value: str, ranks: Mapping[str, int]) -> Iterator[tuple[int, int, float]]:
    """Words, dates and years in the value: (start, end, log10 guesses). As many as it has characters, but for a factor."""
    n, low = len(value), _lowered(value)
    plain, longest = low.translate(_LEET), max(map(len, ranks), default=0)
    for i in range(n):
        for j in range(i + 3, min(n, i + longest) + 1):
            rank = ranks.get(plain[i:j])
            if rank:
                cost = math.log10(rank)
                cost += 0.5 if value[i:j] != low[i:j] else 0.0
                cost += 0.7 if plain[i:j] != low[i:j] else 0.0
                yield i, j, cost
    for date in _DATES:
        for m in date.finditer(value):
            yield m.start(), m.end(1), math.log10(365 * 120) + (0.6 if m[2] else 0.0)
    for m in _YEAR.finditer(value):
        yield m.start(), m.end(1), math.log10(120)


class _Starts:
    """Starts of parts that cost what came before them plus the logarithm of their length.

    A start is dropped once another one is cheaper for this end and all later ones: the logarithms
    of two lengths only come closer. A handful is left however long the value is.
    """

    def __init__(self) -> None:
        self.held: list[tuple[int, float]] = []

    def add(self, start: int, cost: float, end: int) -> None:
        self.held = [(i, c) for i, c in self.held if c < cost]
        if all(c + math.log10(end - i) > cost + math.log10(end - start) for i, c in self.held):
            self.held.append((start, cost))

    def cheapest(self, end: int, unit: int) -> float:
        return min((c + math.log10((end - i) / unit) for i, c in self.held), default=math.inf)


def guess_cost(value: str, ranks: Mapping[str, int] = _RANK) -> float:
    """log10 of the guesses of the cheapest of all segmentations.

    Parts are single characters (brute force), words of ``ranks`` (their guess count), dates and
    years, and every repeat of up to four characters and every walk over neighbouring keys of three
    characters or more, whole or cut; 0.3 for each part after the first that is no single character.
    """
    n, brute, low, steps = len(value), math.log10(_alphabet(value)), _lowered(value), _steps()
    ending: dict[int, list[tuple[int, float]]] = {}
    for i, j, cost in listed_parts(value, ranks):
        ending.setdefault(j, []).append((i, cost))
    best = [0.0] * (n + 1)  # cheapest way to guess the first j characters

    def before(i: int) -> float:
        return best[i] + (_FURTHER if i else 0.0)

    repeats = {p: [_Starts() for _ in range(p)] for p in _PERIODS}
    since = dict.fromkeys(_PERIODS, 0)  # where the stretch of that period began
    walk, walk_since, turns = _Starts(), 0, [0, 0, 0]  # turns[j]: of all steps to characters before j
    for j in range(1, n + 1):
        best[j] = best[j - 1] + brute
        for i, cost in ending.get(j, ()):
            best[j] = min(best[j], before(i) + cost)
        for p in _PERIODS:
            if j > p and value[j - 1] != value[j - 1 - p]:
                since[p] = j - p
                repeats[p] = [_Starts() for _ in range(p)]
            start = j - max(2 * p, _LEAST)
            if start >= since[p]:
                same = repeats[p][j % p]
                same.add(start, before(start), j)
                best[j] = min(best[j], p * brute + same.cheapest(j, p))
        if j > 1 and (low[j - 2], low[j - 1]) not in steps:
            walk, walk_since = _Starts(), j - 1
        if j > 2:
            ways = [steps.get((low[k - 1], low[k]), frozenset()) for k in (j - 2, j - 1)]
            turns.append(turns[j - 1] + (not ways[0] & ways[1]))
        start = j - _LEAST
        if start >= walk_since:
            # a walk's turns begin with its third character
            walk.add(start, before(start) - _TURN * turns[start + 2], j)
            best[j] = min(best[j], math.log10(94) + _TURN * turns[j] + walk.cheapest(j, 1))
    return best[n]


def find_secrets(text: str, min_cost: float = MIN_COST) -> list[tuple[str, int, int, float | None]]:
    """Spans (kind, start, end, cost) by start, then kind; positions are code points."""
    out = []
    low = text.lower()
    if any(h in low for h in _ASSIGN_HINTS):
        for m in _ASSIGN.finditer(text):
            if len(m[2]) >= 6:
                out.append(("assign", m.start(), m.end(), guess_cost(m[2])))
    if "AKIA" in text:
        out += [("access", m.start(), m.end(), None) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [("hex", m.start(), m.end(), None) for m in _HEX.finditer(text)]
    if any(h in low for h in _CONTEXT_HINTS):
        for m in _CONTEXT.finditer(text):
            cost = guess_cost(m[1])
            if cost >= min_cost:
                out.append(("guess", m.start(1), m.end(1), cost))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


_SPANS = T.ArrayType(
    T.StructType(
        [
            T.StructField("kind", T.StringType()),
            T.StructField("start", T.LongType()),
            T.StructField("end", T.LongType()),
            T.StructField("cost", T.DoubleType()),
        ]
    )
)
_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("cost", pa.float64())])


def _scan(texts: pa.Array) -> pa.Array:
    names = ("kind", "start", "end", "cost")
    found = [[dict(zip(names, s)) for s in find_secrets(t or "")] for t in texts.to_pylist()]
    return pa.array(found, pa.list_(_SPAN))


def masked(text: str | None, spans: list[dict]) -> str | None:
    """The text with each run of overlapping spans replaced by ``[SECRET]``."""
    if not spans:
        return text
    parts, at = [], 0
    for s in spans:
        if s["end"] > at:
            parts += [text[at : max(s["start"], at)], "" if s["start"] < at else "[SECRET]"]
            at = s["end"]
    return "".join([*parts, text[at:]])


def _redact(texts: pa.Array) -> list[pa.Array]:
    spans = _scan(texts)
    out = [masked(t, s) for t, s in zip(texts.to_pylist(), spans.to_pylist())]
    return [pa.array(out, pa.string()), spans]


def scan(docs: DataFrame, text: str = "text", spans: str = "spans") -> DataFrame:
    """``docs`` with the found spans (kind, start, end, cost) as an array column."""
    return with_python(docs, [text], {spans: _SPANS}, lambda texts: [_scan(texts)])


def redact(docs: DataFrame, text: str = "text", spans: str = "spans") -> DataFrame:
    """``docs`` with secrets masked in the text, and the spans of the text as it was; one pass."""
    return with_python(docs, [text], {text: T.StringType(), spans: _SPANS}, _redact)


def joined(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
