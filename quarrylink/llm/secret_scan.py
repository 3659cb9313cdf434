"""Secret scans: fixed patterns, and guess costs of values in credential contexts.

Three base kinds are found by pattern (``assign``, ``access``, ``hex``). The method judges every value that
stands where a credential stands (``pwd: …``, ``Authorization: Bearer …``, ``scheme://user:…@host``), those of
base spans too: its cost is that of the cheapest segmentation into words, dates, repeats, keyboard walks and
brute-force characters, found by dynamic programming over log10 guesses. Placeholders (``changeme``,
``xxxxxxxx``, ``qwerty123``) and plain words are cheap. A dear value that no base span touches is a span of the
kind ``guess``. Costs over ``CAP`` are ``CAP``, so the programme visits the places of a value that cost less.

Words and their ranks come from a tokenizer's vocabulary, whose pieces are in the order of their frequency; its
path is a parameter.

Defined results: a null text is an empty one (no spans); very long texts and values are scanned whole, in time
that grows with their length; of ties between segmentations the one with the longest last segment counts;
repeated rows are scanned each by itself; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import small_batches
from .piece_transducer import MARK, MODEL, pieces_of

ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "guess")

#: Where a credential's value stands; the named group is the value. A key word may end a longer name (DB_PASSWORD, dbPwd).
CONTEXTS = re.compile(
    r"""(?ai:(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|client[_-]?secret|credentials?|auth)"""
    r"""["']?[\x20\t]*(?::=|=>|[:=])[\x20\t]*)(?:"(?P<double>[^"\n]+)"|'(?P<single>[^'\n]+)'|(?P<bare>[^\s"'<>|,;)}\]]+))"""
    r"""|(?ai:\bbearer[\x20\t]+)(?P<bearer>[A-Za-z0-9+/_.=~-]+)|://[^\s/:@]+:(?P<url>[^\s/@]+)@"""
)

#: Words tried first by guessers, most usual first; a word's rank is its guesses.
COMMON_WORDS = (
    "password", "123456", "admin", "letmein", "welcome", "monkey", "dragon", "master", "login", "secret", "token", "test", "changeme",
    "default", "example", "sample", "placeholder", "your", "user", "root", "guest", "pass", "key", "api", "value", "none", "null", "true",
    "false", "undefined", "todo", "hello", "world", "love", "summer", "winter", "spring", "autumn", "football", "baseball", "sunshine",
    "princess", "shadow", "iloveyou", "trustno", "server", "database", "config", "public", "private", "access", "auth", "bearer", "string",
)
#: Rows of a keyboard.
KEYBOARD = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm")
LEET = str.maketrans("4301$5@7", "aeolssat")
DATE = re.compile(r"(?:19|20)\d\d[-/.]?(?:0?[1-9]|1[0-2])[-/.]?(?:0?[1-9]|[12]\d|3[01])|(?:0?[1-9]|[12]\d|3[01])[-/.]?(?:0?[1-9]|1[0-2])[-/.]?(?:19|20)\d\d|(?:19|20)\d\d")
LONGEST, LONGEST_UNIT = 16, 4
#: log10 guesses beyond which costs are not told apart.
CAP = 24.0
#: Segments: words, dates, keyboard walks, repeats, single characters.
WORD, DATES, WALK, REPEAT, ANY = "wdkrb"

_NEXT = {(a, b) for row in KEYBOARD for x, y in zip(row, row[1:], strict=False) for a, b in ((x, y), (y, x))}


def _char_cost(c: str) -> float:
    return math.log10(10 if c.isdigit() else 26 if c.islower() or c.isupper() else 33)


class _Repeats:
    """How far a value goes on repeating its characters at a distance of 1 to LONGEST_UNIT."""

    def __init__(self, value: str):
        self.n = len(value)
        codes = np.frombuffer(value.encode("utf-32-le", "surrogatepass"), np.uint32)
        self.breaks = [np.flatnonzero(codes[u:] != codes[:-u]).tolist() for u in range(1, LONGEST_UNIT + 1)]

    def end(self, i: int, unit: int) -> int:
        """The end of the longest repeat of the ``unit`` characters from ``i``, in whole units."""
        if i + unit > self.n:
            return i
        breaks = self.breaks[unit - 1]
        k = bisect_left(breaks, i)
        same = (breaks[k] if k < len(breaks) else self.n - unit) - i
        return i + unit * (1 + max(same, 0) // unit)


def segments_from(value: str, i: int, words: dict[str, int], repeats: _Repeats) -> Iterator[tuple[int, float, str]]:
    """(end, log10 guesses, kind) of every segment of ``value`` that starts at ``i``.

    Of a long repeat, the ends within LONGEST of its start or its end are segments: a word behind it reaches no further back.
    """
    n = len(value)
    yield i + 1, _char_cost(value[i]), ANY
    for j in range(i + 3, min(n, i + LONGEST) + 1):  # a rank, doubled for capitals and for look-alikes
        part = value[i:j]
        low = part.lower()
        rank = words.get(low) or 2 * words.get(low.translate(LEET), 0)
        if rank:
            yield j, math.log10((rank + 1) * (1 if part == low else 2)), WORD
    if m := DATE.match(value, i):
        yield m.end(), math.log10(365 * 120 if m.end() - i > 4 else 120), DATES
    j = i + 1
    while j < n and j - i < LONGEST and (value[j - 1].lower(), value[j].lower()) in _NEXT:
        j += 1
        if j - i >= 3:  # a first key, a direction, a length
            yield j, math.log10(36 * 2 * (j - i)), WALK
    for unit in range(1, LONGEST_UNIT + 1):  # one unit by brute force, and a count
        last = repeats.end(i, unit)
        if last - i >= max(3, 2 * unit):
            cost = sum(map(_char_cost, value[i : i + unit]))
            ends = range(i + 2 * unit, last + 1, unit)
            near = LONGEST // unit
            for j in ends if len(ends) <= 2 * near else [*ends[:near], *ends[-near:]]:
                if j - i >= 3:
                    yield j, cost + math.log10((j - i) // unit), REPEAT


def segmented(value: str, words: dict[str, int]) -> tuple[float, str]:
    """log10 of the guesses of the cheapest segmentation, CAP at most, and its segments' kinds and lengths (none at CAP)."""
    n, repeats = len(value), _Repeats(value)
    best: dict[int, tuple[float, int, str]] = {0: (0.0, 0, "")}
    todo = [0]
    while todo:
        i = heapq.heappop(todo)
        if i == n:
            break
        so_far = best[i][0]
        for j, cost, kind in segments_from(value, i, words, repeats):
            total = so_far + cost
            if total < CAP and (j not in best or total < best[j][0]):
                if j not in best:
                    heapq.heappush(todo, j)
                best[j] = (total, i, kind)
    if n not in best:
        return CAP, ""
    out, at = [], n
    while at:
        _, start, kind = best[at]
        out.append(f"{kind}{at - start}")
        at = start
    return best[n][0], "".join(out[::-1])


def guess_cost(value: str, words: dict[str, int]) -> float:
    """log10 of the guesses that the cheapest segmentation needs, CAP at most."""
    return segmented(value, words)[0]


@cache
def ranked_words(model: bytes) -> dict[str, int]:
    """Ranks of words: the usual first, then a vocabulary's pieces of three letters or more that begin a word, in its order."""
    own = [p[1:].lower() for p in pieces_of(model) if p.startswith(MARK) and p[1:].isalpha() and len(p) > 3]
    return {w: k + 1 for k, w in enumerate(dict.fromkeys([*COMMON_WORDS, *own]))}


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind's place, end) of the three base kinds, leftmost and not overlapping per kind."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def contexts(text: str, words: dict[str, int]) -> list[tuple[int, int, int, int, float, str]]:
    """(start, end, value's start, value's end, cost, segments) of each value of six characters or more where a credential stands."""
    out = []
    for m in CONTEXTS.finditer(text):
        start, end = m.span(m.lastgroup)
        if end - start >= 6:
            out.append((m.start(), m.end(), start, end, *segmented(text[start:end], words)))
    return out


def guess_spans(found: list[tuple[int, int, int, int, float, str]], least: float, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans of dear values in credential contexts that no base span touches."""
    return [(c[0], 3, c[1]) for c in found if c[4] >= least and not any(s < c[1] and c[0] < e for s, _, e in base)]


def joined(spans: Iterable[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_guess long, n_contexts long, n_dear long, contexts string"


def scan(docs: DataFrame, least_log10: float = 8.0, vocabulary_path: str = MODEL) -> DataFrame:
    """One row per document with its counts and spans; whole texts, one narrow pass.

    contexts has value's start:end:log10 guesses:segments of every credential context, base spans' included; the
    segments are kinds (w word, d date, k walk, r repeat, b brute force) with lengths, no text. n_dear counts the
    contexts whose value costs ``least_log10`` or more.
    """
    with open(vocabulary_path, "rb") as file:
        sent = docs.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = ranked_words(sent.value)
        for batch in batches:
            rows = []
            for key, cell in zip(batch.column(0), batch.column(1), strict=True):
                text = cell.as_py() or ""
                base, found = base_spans(text), contexts(text, ranks)
                more = guess_spans(found, least_log10, base)
                kinds = [k for _, k, _ in base]
                digest = hashlib.sha256(joined(base).encode()).hexdigest()
                told = ",".join(f"{c[2]}:{c[3]}:{c[4]:.2f}:{c[5]}" for c in found)
                dear = sum(c[4] >= least_log10 for c in found)
                rows.append((key.as_py(), kinds.count(0), kinds.count(1), kinds.count(2), digest, joined(sorted(base + more)), len(more), len(found), dear, told))
            kinds_of = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()] * 3 + [pa.string()]
            names = [x.split()[0] for x in SCHEMA.split(", ")]
            columns = list(zip(*rows, strict=True)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds_of, strict=True)], names)

    small_batches(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


def op2_secret_scan(spark, sf_dir: str) -> DataFrame:
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
