"""Exact top-k inner products by distributed histogram selection.

Queries are answered in blocks of bounded size. For a block, every task scores all its vectors against
all queries and counts the scores in ``BINS`` bins of each query's interval; summed over the tasks, the
counts tell the bin that holds the k-th highest score, which is the interval of the next pass. Once an
interval holds a single score, a last pass returns what scores more, and the smallest ids among ties.
A task hands on at most BINS counts, or 2k rows, for a query, whatever it has read.

Components become floor(256 * x), so that scores are integers and sums are exact; a score beyond
what a long holds is the nearest long. Defined results: rows without an id, and vectors that are null or hold a null or a non-finite component, take no part;
vectors of different lengths have no score; a query's own id is no candidate; a row that repeats a
query is the same query, a row that repeats a candidate is a further candidate; fewer candidates than
k are all returned; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import settle, small_batches

BIN_BITS = 6
BINS = 1 << BIN_BITS
LARGEST = 2**63 - 1
#: Queries answered at a time; their vectors and intervals are what the driver sends to each task.
QUERY_BLOCK = 8192
_CHUNK = 1024


@dataclass
class _Queries:
    ids: np.ndarray
    matrix: np.ndarray
    low: np.ndarray
    #: The interval of each query has 2**bits scores from low on.
    bits: int


def _usable(vectors: DataFrame) -> DataFrame:
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.coalesce(fine, F.lit(False))).select("vec_id", "embedding")


def _read(batch: pa.RecordBatch, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and integer vectors of the rows whose vectors have that length."""
    cells = batch.column(1)
    at = cells.offsets.to_numpy()
    rows = np.nonzero(np.diff(at) == size)[0]
    flat = cells.values.to_numpy(zero_copy_only=False).astype(np.float64)
    picked = flat[at[rows][:, None] + np.arange(size)] if len(rows) else np.zeros((0, size))
    with np.errstate(over="ignore"):
        return batch.column(0).to_numpy()[rows], np.where(np.abs(picked) < 2.0**53, np.floor(256 * picked), 256.0 * picked)


def _whole(vector: np.ndarray) -> np.ndarray:
    """Python's integers of a vector; 256 * x of the greatest doubles is infinite, so it is taken as 2**1024."""
    return np.array([int(x) if np.isfinite(x) else int(math.copysign(1, x)) * 2**1024 for x in vector.tolist()], object)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The exact inner products of two stacks of integer vectors, as longs; beyond these, the nearest long."""
    high_a, high_b = (np.abs(x).max(axis=1, initial=0) for x in (a, b))
    n, most = a.shape[1], lambda x: float(x.max(initial=0))
    with np.errstate(over="ignore"):
        if most(high_a) * most(high_b) * n < 2.0**53:
            return (a @ b.T).astype(np.int64)
    # Large components are rare: rows that have them are multiplied by themselves.
    large_a, large_b = high_a >= 2.0**23, high_b >= 2.0**23
    out = (np.where(large_a[:, None], 0, a) @ np.where(large_b[:, None], 0, b).T).astype(np.int64)
    every_a, every_b = [_whole(x) for x in a], [_whole(x) for x in b]
    clip = lambda x: max(-LARGEST, min(LARGEST, int(x)))
    for i in np.flatnonzero(large_a):
        out[i] = [clip(every_a[i].dot(y)) for y in every_b]
    for j in np.flatnonzero(large_b):
        out[~large_a, j] = [clip(every_a[i].dot(every_b[j])) for i in np.flatnonzero(~large_a)]
    return out


def _scores(q: _Queries, part: slice, ids: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Scores of a chunk of queries by rows, and where they count."""
    return _products(q.matrix[part], vectors), q.ids[part, None] != ids[None, :]


def _counts(q: _Queries, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((len(q.ids), BINS), np.int64)
    for batch in batches:
        ids, vectors = _read(batch, q.matrix.shape[1])
        for at in range(0, len(q.ids) if len(ids) else 0, _CHUNK):
            part = slice(at, at + _CHUNK)
            score, counts = _scores(q, part, ids, vectors)
            low = q.low[part, None]
            place = score.astype(np.uint64) - low.astype(np.uint64)  # wraps round, so it is right beyond a long's range
            bin_ = place >> np.uint64(q.bits - BIN_BITS)
            row, col = np.nonzero(counts & (score >= low) & (bin_ < BINS))
            total[part] += np.bincount(row * BINS + bin_[row, col].astype(np.int64), minlength=len(score) * BINS).reshape(-1, BINS)
    i, j = np.nonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total[i, j])], ["q", "bin", "n"])


def _winners(q: _Queries, k: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kept = [np.zeros((0, 3), np.int64)]
    for batch in batches:
        ids, vectors = _read(batch, q.matrix.shape[1])
        for at in range(0, len(q.ids) if len(ids) else 0, _CHUNK):
            score, counts = _scores(q, slice(at, at + _CHUNK), ids, vectors)
            row, col = np.nonzero(counts & (score >= q.low[at : at + _CHUNK, None]))
            kept.append(np.column_stack([row + at, -score[row, col], ids[col]]))
        if sum(map(len, kept)) > 4 * k * len(q.ids):
            kept = [_best(np.concatenate(kept), k)]
    best = _best(np.concatenate(kept), k)
    columns = [best[:, 0], q.ids[best[:, 0]], best[:, 2], -best[:, 1]]
    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["q", "query_id", "vec_id", "score"])


def _best(rows: np.ndarray, k: int) -> np.ndarray:
    """Of each query's (query, -score, id) rows the first k."""
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    first = np.searchsorted(rows[:, 0], rows[:, 0])
    return rows[np.arange(len(rows)) - first < k]


def _answer(vectors: DataFrame, ids: np.ndarray, matrix: np.ndarray, bound: int, k: int) -> DataFrame:
    spark = vectors.sparkSession
    bits = BIN_BITS * math.ceil((2 * bound + 1).bit_length() / BIN_BITS)
    q = _Queries(ids, matrix, np.full(len(ids), -bound, np.int64), bits)
    above = np.zeros(len(ids), np.int64)
    while q.bits:
        sent = spark.sparkContext.broadcast(q)
        counted = vectors.mapInArrow(lambda b, sent=sent: _counts(sent.value, b), "q long, bin long, n long")
        found = counted.groupBy("q", "bin").agg(F.sum("n").alias("n"))
        later = Window.partitionBy("q").orderBy(F.desc("bin"))
        found = found.withColumn("upto", F.sum("n").over(later))
        # Only the highest bins matter, down to the one where the count reaches k.
        start = spark.createDataFrame([(int(i), int(k - a)) for i, a in enumerate(above)], "q long, need long")
        hit = found.join(start, "q").where("upto - n < need").groupBy("q").agg(F.min("bin").alias("bin"), F.max("upto").alias("upto"), F.min_by("n", "bin").alias("n"), F.first("need").alias("need"))
        step = 1 << (q.bits - BIN_BITS)
        low = q.low.copy()
        for i, place, upto, n, need in hit.collect():
            low[i] = int(low[i]) + place * step
            above[i] += upto - n if upto >= need else 0
        q = _Queries(ids, matrix, low, q.bits - BIN_BITS)
    sent = spark.sparkContext.broadcast(q)
    rows = vectors.mapInArrow(lambda b: _winners(sent.value, k, b), "q long, query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "vec_id"))
    return settle(rows.withColumn("rank", rank).where(F.col("rank") <= k).drop("q"))


def search(vectors: DataFrame, is_query, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of all rows for every row that ``is_query`` holds for."""
    spark = vectors.sparkSession
    small_batches(spark)
    usable = _usable(vectors)
    queries = settle(usable.where(is_query).distinct())
    longest = usable.agg(F.max(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + F.pow(256 * F.abs(x.cast("double")) + 1, F.lit(2))))).first()[0]
    sizes = [(r[0], -(-r[1] // QUERY_BLOCK)) for r in queries.groupBy(F.size("embedding")).count().collect()]
    out = spark.createDataFrame([], "query_id long, vec_id long, score long, rank int")
    for size, blocks in sorted(sizes):
        for block in range(blocks):
            own = queries.where((F.size("embedding") == size) & (F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == block)).toArrow()
            if own.num_rows:
                parts = [_read(b, size) for b in own.to_batches()]
                ids, matrix = (np.concatenate(x) for x in zip(*parts, strict=True))
                out = out.unionByName(_answer(usable, ids, matrix, min(LARGEST, int(min(longest * (1 + 1e-9), 2.0**63)) + 1), k))
    return out.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op6_topk_search(spark, sf_dir: str) -> DataFrame:
    return search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 50 == 0)


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e::DOUBLE[], c.e::DOUBLE[])::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0
)
SELECT query_id, (row_number() OVER w)::INTEGER AS rank, vec_id, score FROM s
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 5
"""
