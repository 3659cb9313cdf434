"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad. A line's potential comes from its own features and those of the lines
before and after it; neighbouring labels are coupled by a transition matrix. Lines have no labels of their own,
so these are latent: the field is fitted on a bounded sample of labelled documents, first as if all lines had the
document's label, then again on the lines' own marginals, shifted only where a document's mean contradicts its
label (``AGREE``). So a good document may hold bad lines, and transitions learn where quality changes. A
document's score is the mean of its lines' forward-backward marginals, weighted by length.

Defined results: a null text is an empty one, and an empty text is scored as one empty line; blank
lines have no weight and are left out where there are others; labels that are null or not 0 or 1, and
labels of unknown documents, are not used; without labels of both kinds every score is the prior 0.5;
very long texts are scored whole; ties at the threshold are good; repeated rows are scored each by itself; an empty
table gives an empty result; other columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_batches

#: Labelled documents the field is fitted on, at most; those whose ids hash least.
TRAIN_DOCUMENTS = 2500
#: In fitting, documents are cut into chains of this many lines.
CHAIN = 48
STEPS, RATE, RIDGE = 250, 0.08, 1e-3
GOOD = 0.7
#: Rounds of fitting on latent labels, the mean that a labelled document's lines must reach for its label, and the lines of a document fitted on.
ROUNDS, AGREE, TRAIN_LINES = 2, 0.6, 400

_CLASSES = 8


def _byte_classes() -> np.ndarray:
    table = np.zeros(256, np.int64)
    for k, members in enumerate((b" \t\r\x0b\f", bytes(range(65, 91)), bytes(range(97, 123)), b"0123456789", b".,;:?'\"-()", b"!", b"#*$%&<>@^_=+~{}[]\\/", b"|")):
        table[list(members)] = k + 1
    return table


_TABLE = _byte_classes()


def line_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all lines of all texts, the lines' lengths, and how many lines each text has."""
    lines: list[str] = []
    counts = []
    for text in texts:
        own = [x for x in text.split("\n") if x.strip()] or [""]
        counts.append(len(own))
        lines += own
    raw = [x.encode("utf-8", "replace") for x in lines]
    sizes = np.array([len(x) for x in raw], np.int64)
    stops = np.cumsum(sizes)
    kinds = _TABLE[np.frombuffer(b"".join(raw), np.uint8)]
    edges = np.concatenate([[0], stops])
    share = np.zeros((len(lines), _CLASSES))
    for k in range(_CLASSES):
        sums = np.concatenate([[0], np.cumsum(kinds == k + 1)])
        share[:, k] = sums[edges[1:]] - sums[edges[:-1]]
    words, different, again, longest = (np.zeros(len(lines)) for _ in range(4))
    seen_before = np.zeros(len(lines))
    at = 0
    for n in counts:
        seen: set[str] = set()
        for i in range(at, at + n):
            w = lines[i].split()
            words[i] = len(w)
            different[i] = len(set(w))
            again[i] = sum(map(eq, w, w[1:]))
            longest[i] = len(max(w, key=len)) if w else 0
            seen_before[i] = lines[i] in seen
            seen.add(lines[i])
        at += n
    size, n = np.maximum(sizes, 1), np.maximum(words, 1)
    letters = np.maximum(share[:, 1] + share[:, 2], 1)
    own = np.column_stack([
        np.log1p(sizes), np.log1p(words), sizes / n, np.minimum(longest, 60), different / n, again / n, seen_before,
        share[:, 0] / size, share[:, 1] / letters, share[:, 3] / size, share[:, 4] / n, share[:, 5] / n, share[:, 6] / n, share[:, 7] / n,
        (share[:, 7] > 0), (again > 2), words < 4, words == 0,
    ])
    first = np.zeros(len(lines), bool)
    first[np.cumsum([0, *counts[:-1]])] = True
    before = np.where(first[:, None], 0, np.roll(own, 1, axis=0))
    last = np.roll(first, -1)
    after = np.where(last[:, None], 0, np.roll(own, -1, axis=0))
    return np.column_stack([own, before, after, first, last]), np.maximum(sizes, 1), np.array(counts)


@dataclass
class Field:
    """Weights of the good label's potential, and the log transition potentials [from, to]."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    transition: np.ndarray

    def potentials(self, features: np.ndarray) -> np.ndarray:
        return np.clip((features - self.mean) / self.scale, -6, 6) @ self.weights + self.bias


def marginals(potentials: np.ndarray, transition: np.ndarray) -> np.ndarray:
    """P(good) of each line of a chain, by forward-backward on the odds of good against bad."""
    (bb, bg), (gb, gg) = np.exp(transition - transition.max()).tolist()
    unary = np.exp(np.clip(potentials, -30, 30)).tolist()
    clip = lambda x: 1e-30 if x < 1e-30 else 1e30 if x > 1e30 else x
    forward, odds = [], None
    for u in unary:
        odds = u if odds is None else clip(u * (bg + odds * gg) / (bb + odds * gb))
        forward.append(odds)
    out, back = [0.0] * len(unary), 1.0
    for i in range(len(unary) - 1, -1, -1):
        both = forward[i] * back
        out[i] = both / (1 + both)
        ahead = unary[i] * back
        back = clip((gb + ahead * gg) / (bb + ahead * bg))
    return np.array(out)


def fit(features: np.ndarray, counts: np.ndarray, labels: np.ndarray, sizes: np.ndarray | None = None, rounds: int = ROUNDS) -> Field:
    """The field fitted on documents' labels, with the labels of lines latent."""
    sizes = np.ones(len(features)) if sizes is None else sizes
    goal = np.repeat(labels.astype(float), counts)
    field = _fit(features, counts, goal)
    for k in range(rounds):
        # Under one label for each document no transition was ever seen, so that first lines are judged by themselves.
        goal = latent(field if k else replace(field, transition=np.zeros((2, 2))), features, counts, labels, sizes)
        field = _fit(features, counts, goal)
    return field


def latent(field: Field, features: np.ndarray, counts: np.ndarray, labels: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Each line's probability of being good, given its document's label.

    A document whose length-weighted mean is on its label's side by AGREE keeps the field's marginals; in others all
    log odds are shifted alike until it is, so that the order of its lines stays.
    """
    potentials, out, at = field.potentials(features), [], 0
    for n, y in zip(counts.tolist(), labels.tolist(), strict=True):
        p = np.clip(marginals(potentials[at : at + n], field.transition), 1e-6, 1 - 1e-6)
        weight, logit = sizes[at : at + n] / sizes[at : at + n].sum(), np.log(p / (1 - p))
        side = 1 if y else -1
        if (weight @ p if y else 1 - weight @ p) < AGREE:
            low, high = 0.0, 40.0
            for _ in range(40):
                mid = (low + high) / 2
                moved = 1 / (1 + np.exp(-(logit + side * mid)))
                low, high = (low, mid) if (weight @ moved if y else 1 - weight @ moved) >= AGREE else (mid, high)
            p = 1 / (1 + np.exp(-(logit + side * high)))
        out.append(p)
        at += n
    return np.concatenate(out)


def _fit(features: np.ndarray, counts: np.ndarray, goal: np.ndarray) -> Field:
    """Maximum expected likelihood by Adam, given each line's probability of being good; every document weighs the same."""
    mean, scale = features.mean(axis=0), features.std(axis=0) + 1e-6
    x = np.clip((features - mean) / scale, -6, 6)
    chains, weight = [], []
    at = 0
    for n in counts.tolist():
        for k in range(0, n, CHAIN):
            chains.append((at + k, min(CHAIN, n - k)))
            weight.append(1 / n)
        at += n
    start = np.array([c[0] for c in chains])
    size = np.array([c[1] for c in chains])
    weight = np.array(weight) / len(counts)
    steps = np.arange(size.max())
    real = steps[None, :] < size[:, None]
    place = np.where(real, start[:, None] + steps[None, :], 0)
    theta = np.zeros(x.shape[1] + 1 + 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    wanted = np.where(real, goal[place], 0.0)
    by_goal = np.bincount(place[real], (weight[:, None] * wanted)[real], len(x))
    left, right, both = wanted[:, :-1], wanted[:, 1:], real[:, 1:]
    pairs = [(weight[:, None] * np.where(both, a * b, 0)).sum() for a in (1 - left, left) for b in (1 - right, right)]
    target = np.concatenate([x.T @ by_goal, [by_goal.sum()], pairs])
    for step in range(1, STEPS + 1):
        w, bias, t = theta[: x.shape[1]], theta[x.shape[1]], theta[-4:].reshape(2, 2)
        unary = (x @ w + bias)[place]
        expected, expected_pairs = _expectations(unary, real, t)
        by_line = np.bincount(place[real], (weight[:, None] * expected)[real], len(x))
        gradient = target - np.concatenate([x.T @ by_line, [by_line.sum()], np.tensordot(weight, expected_pairs, 1).ravel()]) - RIDGE * theta
        m, v = 0.9 * m + 0.1 * gradient, 0.99 * v + 0.01 * gradient**2
        theta += RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
    return Field(mean, scale, theta[: x.shape[1]], float(theta[x.shape[1]]), theta[-4:].reshape(2, 2))


def _expectations(unary: np.ndarray, real: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of good, and expected transition counts, of many chains at once (log space)."""
    n, length = unary.shape
    phi = np.stack([np.zeros_like(unary), unary], axis=2)
    alpha, beta = np.zeros((length, n, 2)), np.zeros((length, n, 2))
    alpha[0] = phi[:, 0]
    for k in range(1, length):
        new = np.logaddexp(alpha[k - 1, :, :1] + t[0], alpha[k - 1, :, 1:] + t[1]) + phi[:, k]
        alpha[k] = np.where(real[:, k, None], new, alpha[k - 1])
    for k in range(length - 2, -1, -1):
        ahead = beta[k + 1] + phi[:, k + 1]
        new = np.logaddexp(ahead[:, :1] + t[:, 0], ahead[:, 1:] + t[:, 1])
        beta[k] = np.where(real[:, k + 1, None], new, 0)
    total = np.logaddexp(alpha[-1, :, 0], alpha[-1, :, 1])
    good = np.where(real, np.exp(alpha[:, :, 1].T + beta[:, :, 1].T - total[:, None]), 0)
    pairs = np.zeros((n, 2, 2))
    for k in range(1, length):
        both = alpha[k - 1][:, :, None] + t[None] + (phi[:, k] + beta[k])[:, None, :] - total[:, None, None]
        pairs += np.where(real[:, k, None, None], np.exp(both), 0)
    return good, pairs


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, most: int = TRAIN_DOCUMENTS) -> Field | None:
    """The field fitted on up to ``most`` labelled documents that are not held out, by up to TRAIN_LINES lines of each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [x.as_py() or "" for x in batch.column("text")]
            features, sizes, counts = line_features(texts)
            rows = np.column_stack([sizes, features]).astype(np.float32)
            starts = np.cumsum(counts) - counts
            kept = np.minimum(counts, TRAIN_LINES)
            cells = [rows[s : s + n].tobytes() for n, s in zip(kept, starts, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("quality"), pa.array(kept, pa.int64()), pa.array(cells, pa.binary())], ["doc_id", "quality", "n", "features"])

    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.min("quality").cast("long").alias("quality"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most ``most`` rows are sent
    table = texts.select("doc_id", "quality", "text").mapInArrow(run, "doc_id long, quality long, n long, features binary").toArrow()
    rows = sorted(zip(*(table.column(c).to_pylist() for c in table.column_names), strict=True))
    if len({r[1] for r in rows}) < 2:
        return None
    width = line_features([""])[0].shape[1] + 1
    every = np.concatenate([np.frombuffer(r[3], np.float32).reshape(-1, width) for r in rows]).astype(float)
    return fit(every[:, 1:], np.array([r[2] for r in rows]), np.array([r[1] for r in rows]), every[:, 0])


def score_texts(field: Field | None, texts: list[str]) -> np.ndarray:
    if field is None or not texts:
        return np.full(len(texts), 0.5)
    features, sizes, counts = line_features(texts)
    potentials, ends = field.potentials(features), np.cumsum(counts)
    return np.array([np.average(marginals(potentials[e - n : e], field.transition), weights=sizes[e - n : e]) for n, e in zip(counts, ends, strict=True)])


def score(docs: DataFrame, field: Field | None) -> DataFrame:
    """doc_id, held_out, score and predicted of every document; only its text is read for the score."""
    sent = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = np.clip(score_texts(sent.value, [x.as_py() or "" for x in batch.column("text")]), 0, 1)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(scores, pa.float64()), pa.array((scores >= GOOD).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    small_batches(docs.sparkSession)
    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text").mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def op10_crf_quality(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    small_batches(spark)
    return score(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
