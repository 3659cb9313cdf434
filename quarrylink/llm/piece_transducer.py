"""SentencePiece encoding and decoding as a weighted finite-state transducer.

``compile_model`` turns a model file into the parts of a transducer: the normaliser (white space to the
mark ``▁``, a mark in front), an arc for every piece, and, for characters that are no piece, arcs for
their UTF-8 bytes. Composing it with a text gives a lattice; the encoding is its shortest path in the
tropical semiring.

The weights make that path right for the model's kind. In a unigram model an arc weighs minus its
piece's score. In a merge (BPE) model no sum of scores gives the pieces that merging leaves, but these
are known by pairs: a sequence of pieces is what merging gives exactly if each two neighbours are what
merging their own text gives. So a state is a piece, an arc between two pieces weighs 0 if they may
stand together and infinity if not, and of all paths one is finite. At each place of the text then one
state is within reach, and the forward pass is linear in the text.

No piece has a mark behind another character, so texts fall into parts at marks; parts are encoded once
each and remembered, up to a bound. Defined results: a null text is an empty one; an empty text has no
pieces; a text that holds the mark itself decodes to a space there, and its round trip counts as failed;
repeated rows are encoded each by itself; an empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

import math
import re
import struct
from collections.abc import Iterator
from itertools import chain, pairwise

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import small_batches

MARK = "▁"
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Fixed values of the model file's format: kinds of models and of pieces.
UNIGRAM, MERGES = 1, 2
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: Parts and pairs remembered by a worker.
REMEMBERED = 1_000_000
#: The state behind a character that is no piece; it stands beside any other.
OTHER = -1


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a protocol buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = number()
        if key & 7 == 0:
            yield key >> 3, number()
            continue
        size = {1: 8, 5: 4}.get(key & 7) or number()
        yield key >> 3, data[at : at + size]
        at += size


def pieces_of(model: bytes) -> list[str]:
    """The pieces of a model file, in its order."""
    return [dict(_fields(value))[1].decode() for field, value in _fields(model) if field == 1]


class Transducer:
    """A compiled model."""

    def __init__(self, model: bytes):
        self.pieces: list[str] = []
        self.scores: list[float] = []
        kinds: list[int] = []
        trainer: dict = {}
        rules: dict = {}
        for field, value in _fields(model):
            if field == 1:
                own = dict(_fields(value))
                self.pieces.append(own[1].decode())
                self.scores.append(struct.unpack("<f", own[2])[0] if 2 in own else 0.0)
                kinds.append(own.get(3, NORMAL))
            elif field == 2:
                trainer = dict(_fields(value))
            elif field == 3:
                rules = dict(_fields(value))
        if rules.get(2):
            raise ValueError("models with a character map are not supported")
        self.merges = trainer.get(3, UNIGRAM) == MERGES
        self.prefix, self.squeeze = bool(rules.get(3, 1)), bool(rules.get(4, 1))
        usable = [i for i, k in enumerate(kinds) if k in (NORMAL, USER)]
        self.ids = {self.pieces[i]: i for i in usable}
        self.longest = max(map(len, self.ids), default=1)
        self.bytes = {int(self.pieces[i][1:-1], 16): i for i, k in enumerate(kinds) if k == BYTE}
        self.unknown = next((i for i, k in enumerate(kinds) if k == UNKNOWN), 0)
        self.worst = min((self.scores[i] for i in usable), default=0.0) - 10
        self.whole = all(MARK not in p[1:] or not p.strip(MARK) for p in self.ids)
        special = {CONTROL: lambda p: b"", UNKNOWN: lambda p: " \u2047 ".encode(), BYTE: lambda p: bytes([int(p[1:-1], 16)])}
        plain = lambda p: p.replace(MARK, " ").encode()
        self.output = [special.get(k, plain)(p) for p, k in zip(self.pieces, kinds, strict=True)]
        self._score = {p: self.scores[i] for p, i in self.ids.items()}
        self._pairs: dict[int, bool] = {}
        self._parts: dict[str, tuple[int, ...]] = {}
        self._arcs = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            if not self.merges or self.merged(piece) == [piece]:
                self._arcs.add_word(piece, (i, len(piece)))
        self._arcs.make_automaton()

    # The normaliser.
    def normalised(self, text: str) -> str:
        if self.squeeze:
            text = re.sub(" +", " ", text).strip(" ")
        text = text.replace(" ", MARK)
        return MARK + text if self.prefix and text else text

    # Weights of a merge model.
    def merged(self, text: str) -> list[str]:
        """What merging leaves of a text: again and again the best pair, the leftmost of equals."""
        parts, score, none = list(text), self._score.get, -math.inf
        pairs = [score(a + b, none) for a, b in pairwise(parts)]
        while pairs and (best := max(pairs)) != none:
            k = pairs.index(best)
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
            del pairs[k]
            if k:
                pairs[k - 1] = score(parts[k - 1] + parts[k], none)
            if k < len(pairs):
                pairs[k] = score(parts[k] + parts[k + 1], none)
        return parts

    def together(self, a: int, b: int) -> bool:
        """Whether the arc from piece ``a`` to piece ``b`` has a finite weight."""
        if a == OTHER:
            return True
        key = a << 24 | b
        known = self._pairs.get(key)
        if known is None:
            if len(self._pairs) >= REMEMBERED:
                self._pairs.clear()
            left, right = self.pieces[a], self.pieces[b]
            known = self._pairs[key] = self.merged(left + right) == [left, right]
        return known

    # Composition and shortest paths.
    def _path_of_merges(self, text: str) -> list[int | str]:
        """Ids of the pieces on the finite path; characters that are no piece as they are.

        The automaton finds the arcs that end at each place, the longest first.
        """
        states, sizes, pairs = [OTHER] * (len(text) + 1), [1] * (len(text) + 1), self._pairs
        for last, (piece, size) in self._arcs.iter(text):
            end = last + 1
            if states[end] == OTHER:
                before = states[end - size]
                if size == end or before == OTHER or ((fine := pairs.get(before << 24 | piece)) is None and self.together(before, piece)) or fine:
                    states[end], sizes[end] = piece, size
        path, end = [], len(text)
        while end:
            path.append(states[end] if states[end] != OTHER else text[end - 1])
            end -= sizes[end]
        return path[::-1]

    def _path_of_scores(self, text: str) -> list[int | str]:
        best = [(0.0, 0)] + [(math.inf, 0)] * len(text)
        for start in range(len(text)):
            for end in range(start + 1, min(len(text), start + self.longest) + 1):
                i = self.ids.get(text[start:end])
                weight = -self.scores[i] if i is not None else -self.worst if end == start + 1 else math.inf
                if best[start][0] + weight < best[end][0]:
                    best[end] = (best[start][0] + weight, start)
        path, end = [], len(text)
        while end:
            part = text[best[end][1] : end]
            path.append(self.ids.get(part, part))
            end = best[end][1]
        return path[::-1]

    def shortest(self, text: str) -> tuple[int, ...]:
        """The ids on the shortest path through the composition with a normalised text."""
        out: list[int] = []
        for piece in self._path_of_merges(text) if self.merges else self._path_of_scores(text):
            if isinstance(piece, int):
                out.append(piece)
            elif self.bytes:
                out += [self.bytes[b] for b in piece.encode("utf-8", "surrogatepass")]
            else:
                out.append(self.unknown)
        return tuple(out)

    def _part(self, part: str) -> tuple[int, ...]:
        known = self._parts.get(part)
        if known is None:
            if len(self._parts) >= REMEMBERED:
                self._parts.clear()
            known = self.shortest(part)
            if len(part) <= 64:
                self._parts[part] = known
        return known

    def encode(self, text: str) -> list[int]:
        whole = self.normalised(text)
        parts = re.findall(f"{MARK}*[^{MARK}]+|{MARK}+", whole) if self.whole and self.merges else [whole]
        return list(chain.from_iterable(map(self._part, parts)))

    def decode(self, ids: list[int]) -> str:
        text = b"".join(map(self.output.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.prefix and text.startswith(" ") else text


_COMPILED: dict[bytes, Transducer] = {}


def compile_model(model: bytes) -> Transducer:
    """The transducer of a model file's content, compiled once in each process."""
    if model not in _COMPILED:
        _COMPILED[model] = Transducer(model)
    return _COMPILED[model]


def encode(docs: DataFrame, model_path: str = MODEL) -> DataFrame:
    """doc_id, n_tokens, n_byte_tokens, round_trip (decoding gives the text again) and ids of every document."""
    with open(model_path, "rb") as file:
        sent = docs.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        transducer = compile_model(sent.value)
        byte_ids = np.array(sorted(transducer.bytes.values()), np.int32)
        for batch in batches:
            every, sizes, falls, trips = [], [0], [], []
            for cell in batch.column("text"):
                text = cell.as_py() or ""
                ids = transducer.encode(text)
                trips.append(transducer.decode(ids) == text)
                ids = np.array(ids, np.int32)
                falls.append(int(np.isin(ids, byte_ids).sum()))
                every.append(ids)
                sizes.append(sizes[-1] + len(ids))
            lists = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(np.concatenate(every) if every else np.zeros(0, np.int32)))
            columns = [batch.column("doc_id"), pa.array(np.diff(sizes), pa.int64()), pa.array(falls, pa.int64()), pa.array(trips, pa.bool_()), lists]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "n_byte_tokens", "round_trip", "ids"])

    small_batches(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, n_byte_tokens long, round_trip boolean, ids array<int>")


def op9_piece_transducer(spark, sf_dir: str) -> DataFrame:
    return encode(spark.read.parquet(f"{sf_dir}/documents.parquet"))
