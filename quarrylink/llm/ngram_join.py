"""Near duplicates by word 5-grams: a self-join on Jaccard similarity with Bayesian pruning.

1. Each text becomes the set of its word shingles. Texts with the same set are one class, so copies
   cost one row from here on.
2. Classes meet under MinHash bands. Each pair under a key is a candidate: as a row under keys of up to ``SMALL``
   classes, in blocks of bounded size under larger ones. Pairs are compared by their MinHash values, ``STEP`` at a
   time, and dropped as soon as the posterior probability that they reach the threshold falls below the
   tolerance. Union-find over what is left gives groups that hold all links the bands and pruning leave.
3. Within a group all pairs of classes are compared, in blocks of bounded size: Bayesian pruning
   again, then the exact similarity of the whole sets. A task returns a row for each of its classes,
   with its number of links and the least class it is connected to, so no group's pairs are ever rows.
4. Union-find over those gives the final groups.

Defined results: a null text is an empty one; texts without words are in no class but their own and
link to nothing; fewer than five words are one shingle; a null doc_id stays null and its class's id
is the least other; repeated rows are copies; very long texts are one set of shingles, whatever their size; ties
for a group's document go to the least doc_id; an empty table gives an empty result; other columns, whatever
their names, are left as they are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import cache
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bit_table, components, in_table, settle, small_batches

WIDTH, SIMILAR, TOLERANCE = 5, 0.8, 1e-5
BANDS, ROWS, STEP = 25, 5, 25
SMALL = 12
#: Of a group's classes, a block holds about this many, and about this many shingles.
BLOCK_CLASSES, BLOCK_SHINGLES = 512, 1_000_000
#: Where more pairs are left than this, one matrix product counts what they share.
MANY = 1500

_SEED = np.random.default_rng(20240229)
_MULTIPLY = (_SEED.integers(1, 1 << 32, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
_ADD = _SEED.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint64).astype(np.uint32)


class _Words(dict):
    """Word hashes; emptied when large, so that it stays bounded."""

    def __missing__(self, word: str) -> int:
        if len(self) > 500_000:
            self.clear()
        self[word] = found = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return found


def shingle_set(text: str | None, words: _Words, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word shingles."""
    ids = np.fromiter(map(words.__getitem__, (text or "").split()), np.uint64)
    if not len(ids):
        return ids
    n = max(1, len(ids) - width + 1)
    h = np.zeros(n, np.uint64)
    for k in range(min(width, len(ids))):
        h = (h ^ ids[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return np.unique(h)


def minhash(shingles: np.ndarray) -> np.ndarray:
    """The MinHash values of a shingle set."""
    x = (shingles >> np.uint64(32)).astype(np.uint32) ^ shingles.astype(np.uint32)
    best = np.full(BANDS * ROWS, np.uint32(0xFFFFFFFF))
    for at in range(0, len(x), 2048):
        np.minimum(best, (x[at : at + 2048, None] * _MULTIPLY + _ADD).min(axis=0), out=best)
    return best


@cache
def least_matches(similar: float = SIMILAR, tolerance: float = TOLERANCE, step: int = STEP) -> tuple[int, ...]:
    """After step, 2 step, … compared values: the fewest matches with which a pair goes on.

    With a uniform prior and m of n values equal, the similarity's posterior is Beta(m+1, n-m+1), and
    it reaches t with the probability that a Binomial(n+1, t) is at most m.
    """
    out = []
    for n in range(step, BANDS * ROWS + 1, step):
        total, m = 0.0, 0
        while True:
            total += comb(n + 1, m) * similar**m * (1 - similar) ** (n + 1 - m)
            if total >= tolerance:
                break
            m += 1
        out.append(m)
    return tuple(out)


def survivors(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of the pairs of two stacks of signatures that Bayesian pruning leaves."""
    cuts = least_matches()
    matches = np.zeros((len(a), len(b)), np.int16)
    for k in range(STEP):
        matches += a[:, k, None] == b[None, :, k]
    i, j = np.nonzero(matches >= cuts[0])
    counts = matches[i, j]
    for step, cut in enumerate(cuts[1:], 1):
        for at in range(0, len(i), 65536):
            part = slice(at, at + 65536)
            cols = slice(step * STEP, (step + 1) * STEP)
            counts[part] += (a[i[part], cols] == b[j[part], cols]).sum(axis=1, dtype=np.int16)
        on = counts >= cut
        i, j, counts = i[on], j[on], counts[on]
    return i, j


def shared(sets_a: list[np.ndarray], sets_b: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How many shingles each pair (i, j) of sets has in common, exactly."""
    if len(i) <= MANY:
        return np.array([np.intersect1d(sets_a[x], sets_b[y], assume_unique=True).size for x, y in zip(i, j, strict=True)], np.int64)
    both = np.intersect1d(np.unique(np.concatenate(sets_a)), np.unique(np.concatenate(sets_b)), assume_unique=True)
    out = np.zeros((len(sets_a), len(sets_b)), np.float32)
    for at in range(0, len(both), 4096):
        part = both[at : at + 4096]

        def dense(sets: list[np.ndarray], part: np.ndarray = part) -> np.ndarray:
            m = np.zeros((len(sets), len(part)), np.float32)
            for row, s in enumerate(sets):
                s = s[np.searchsorted(s, part[0]) : np.searchsorted(s, part[-1], "right")]
                place = np.searchsorted(part, s)
                m[row, place[part[place] == s]] = 1
            return m

        out += dense(sets_a) @ dense(sets_b).T
    return np.rint(out[i, j]).astype(np.int64)


def linked_pairs(sets_a, sigs_a, sets_b, sigs_b, same: bool, similar: float = SIMILAR) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of similar pairs between two blocks, or, for the same block twice, within one (i < j)."""
    i, j = survivors(sigs_a, sigs_b)
    if same:
        i, j = i[i < j], j[i < j]
    n = shared(sets_a, sets_b, i, j)
    size_a, size_b = np.array([len(s) for s in sets_a], np.int64), np.array([len(s) for s in sets_b], np.int64)
    ok = n >= similar * (size_a[i] + size_b[j] - n) - 1e-9
    return i[ok], j[ok]


def roots(n: int, i: np.ndarray, j: np.ndarray) -> list[int]:
    """Union-find over n places: each one's least connected place."""
    up = list(range(n))

    def find(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for x, y in zip(i.tolist(), j.tolist(), strict=True):
        x, y = find(x), find(y)
        up[max(x, y)] = min(x, y)
    return [find(x) for x in range(n)]


def _signed(batches: Iterator[pa.RecordBatch], sets: bool) -> Iterator[pa.RecordBatch]:
    words = _Words()
    for batch in batches:
        keys, sizes, sigs, raw = [], [], [], []
        for cell in batch.column(batch.num_columns - 1):
            s = shingle_set(cell.as_py(), words)
            keys.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
            sizes.append(len(s))
            sigs.append(minhash(s).tobytes() if len(s) else None)
            if sets:
                raw.append(s.tobytes())
        names = [*batch.schema.names[:-1], "node", "n", "sig"] + ["shingles"] * sets
        columns = [*batch.columns[:-1], pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()), pa.array(sigs, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns + [pa.array(raw, pa.binary())] * sets, names)


def signed(docs: DataFrame) -> DataFrame:
    """(doc_id, row, node, n, sig) of each document: its class, its number of shingles, its MinHash values."""
    small_batches(docs.sparkSession)
    kind = dict(docs.dtypes)["doc_id"]
    rows = docs.select("doc_id", F.xxhash64("text").alias("row"), "text")
    return rows.mapInArrow(lambda b: _signed(b, False), f"doc_id {kind}, row long, node binary, n long, sig binary")


def _band_keys(sig: Column) -> Column:
    return F.array(*(F.xxhash64(F.lit(k), F.substring(sig, F.lit(k * ROWS * 4 + 1), F.lit(ROWS * 4))) for k in range(BANDS)))


def _pruned(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (u, v) that the comparison of their MinHash values leaves."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts = least_matches()
        for batch in batches:
            read = lambda c, b=batch: np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint32).reshape(b.num_rows, -1)
            a, b, live = read("sig_u"), read("sig_v"), np.arange(batch.num_rows)
            got = np.zeros(batch.num_rows, np.int64)
            for step, cut in enumerate(cuts):
                cols = slice(step * STEP, (step + 1) * STEP)
                got[live] += (a[live, cols] == b[live, cols]).sum(axis=1)
                live = live[got[live] >= cut]
            yield batch.select(["u", "v"]).take(pa.array(live))

    at = lambda x: classes.select(F.col("node").alias(x), F.col("sig").alias(f"sig_{x}"))
    return pairs.join(at("u"), "u").join(at("v"), "v").select("u", "v", "sig_u", "sig_v").mapInArrow(run, "u binary, v binary")


def candidate_groups(classes: DataFrame) -> DataFrame:
    """(node, component): groups of classes that hold all links, by bands, Bayesian pruning and union-find."""
    keyed = classes.select("node", F.explode(_band_keys(F.col("sig"))).alias("key"))
    hot = settle(keyed.withColumn("m", F.count("*").over(Window.partitionBy("key"))).where("m > 1"))  # a key has a class once
    few, many = hot.where(F.col("m") <= SMALL), hot.where(F.col("m") > SMALL)
    each = few.select("key", F.col("node").alias("u")).join(few.select("key", F.col("node").alias("v")), "key").where("u < v").select("u", "v")
    sizes = many.groupBy("key").agg(F.ceil(F.max("m") / BLOCK_CLASSES).cast("int").alias("blocks"))
    return components(_pruned(each.distinct(), classes).unionByName(_crowded(many, sizes, classes)))


def _crowded(many: DataFrame, sizes: DataFrame, classes: DataFrame) -> DataFrame:
    """(u, v): links enough to connect all classes under one key whose MinHash values agree, from all pairs of blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in in_tasks(batches):
            rows = [r for r in rows if r[1]] + [r for r in rows if not r[1]]
            sigs = np.frombuffer(b"".join(r[3] for r in rows), np.uint32).reshape(len(rows), -1)
            yield links_of(connected(sigs, sum(r[1] for r in rows), lambda i, j: True), [r[2] for r in rows])

    placed = many.join(sizes, "key").join(classes, "node")
    return in_blocks(placed, F.col("key").cast("string"), "node", "sig").mapInArrow(run, "u binary, v binary")


def in_blocks(rows: DataFrame, group: Column, *carried: str) -> DataFrame:
    """(task, first, carried): all pairs of a group's blocks, each a task whose rows follow one another; rows has node and blocks."""
    placed = rows.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    pairs = placed.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    name = F.concat_ws(":", group, F.least("block", "other"), F.greatest("block", "other"))
    return pairs.select(name.alias("task"), (F.col("block") <= F.col("other")).alias("first"), *carried).repartition("task").sortWithinPartitions("task")


def in_tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """The rows of each task, of rows sorted by task."""
    at, rows = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[0] != at and rows:
                yield rows
                rows = []
            at = row[0]
            rows.append(row)
    if rows:
        yield rows


def agreeing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Places of the rows of b whose values agree often enough with a (or its row there), after each ``STEP`` values."""
    live, got = np.arange(len(b)), np.zeros(len(b), np.int64)
    for step, cut in enumerate(least_matches()[: b.shape[1] // STEP]):
        cols = slice(step * STEP, (step + 1) * STEP)
        got[live] += ((a[cols] if a.ndim == 1 else a[live, cols]) == b[live, cols]).sum(axis=1)
        live = live[got[live] >= cut]
    return live


def connected(values: np.ndarray, n: int, similar: Callable[[int, int], bool]) -> np.ndarray:
    """Labels of components: the first n rows against the others, or, if they are all, against each other.

    Pairs that others connect already are not compared any further.
    """
    label = np.arange(len(values))
    for i in range(n):
        start = n if n < len(values) else i + 1
        near = agreeing(values[i], values[start:]) + start
        near = near[label[near] != label[i]]
        while len(near):
            j = near[0]
            if similar(i, j):
                label[label == label[j]] = label[i]
                near = near[label[near] != label[i]]
            else:
                near = near[1:]
    return label


def links_of(label: np.ndarray, nodes: list[bytes]) -> pa.RecordBatch:
    own = np.flatnonzero(label != np.arange(len(nodes)))
    return pa.RecordBatch.from_arrays([pa.array([nodes[i] for i in own], pa.binary()), pa.array([nodes[label[i]] for i in own], pa.binary())], ["u", "v"])


def _block_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rows sorted by task: each task's classes with their links in it."""
    def done(rows: list[tuple]) -> pa.RecordBatch:
        first, second = [r for r in rows if r[1]], [r for r in rows if not r[1]]
        same = not second
        read = lambda own: ([np.frombuffer(r[4], np.uint64) for r in own], np.frombuffer(b"".join(r[3] for r in own), np.uint32).reshape(len(own), -1))
        i, j = linked_pairs(*read(first), *read(first if same else second), same) if first else (np.zeros(0, int),) * 2
        j = j if same else j + len(first)
        every = first + second
        links = np.bincount(i, minlength=len(every)) + np.bincount(j, minlength=len(every))
        root = roots(len(every), i, j)
        return pa.RecordBatch.from_arrays(
            [pa.array([r[2] for r in every], pa.binary()), pa.array(links, pa.int64()), pa.array([every[x][2] for x in root], pa.binary())], ["node", "links", "root"]
        )

    yield from map(done, in_tasks(batches))


def verified(docs: DataFrame, base: DataFrame, groups: DataFrame) -> DataFrame:
    """(node, links, root) rows from all tasks over the groups' blocks; a node may come from several."""
    one = base.where("node is not null").join(groups, "node").groupBy("node", "component").agg(F.min(F.struct("doc_id", "row")).alias("rep"), F.first("n").alias("n"))
    one = settle(one.select("node", "component", "n", "rep.doc_id", "rep.row"))
    sizes = one.groupBy("component").agg(F.greatest(F.ceil(F.count("*") / BLOCK_CLASSES), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    placed = one.join(sizes, "component")
    at = F.xxhash64("doc_id", "row")
    sent = docs.sparkSession.sparkContext.broadcast(bit_table(one.select(at.alias("at")), "at"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = in_table(sent.value, batch.column("at").to_numpy())
            yield from _signed(iter([batch.filter(pa.array(hit)).select(["text"])]), True)

    texts = docs.select("doc_id", F.xxhash64("text").alias("row"), "text").select(at.alias("at"), "text")
    texts = texts.mapInArrow(read, "node binary, n long, sig binary, shingles binary").drop("n").join(placed.select("node", "component", "blocks"), "node")
    texts = texts.dropDuplicates(["node"])
    return in_blocks(texts, F.hex("component"), "node", "sig", "shingles").mapInArrow(_block_links, "node binary, links long, root binary")


def join(docs: DataFrame) -> DataFrame:
    """(doc_id, row, class_id, n_links, group_id) for every document.

    class_id is the least doc_id with the same shingle set, n_links the number of other classes that
    are similar to its own, group_id the least doc_id of all that links connect.
    """
    base = settle(signed(docs))
    classes = base.where("node is not null").groupBy("node").agg(F.first("sig").alias("sig"))
    found = settle(verified(docs, base, candidate_groups(classes)))
    links = found.groupBy("node").agg(F.sum("links").alias("n_links"))
    parts = components(found.select(F.col("node").alias("u"), F.col("root").alias("v")))
    ids = base.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("class_id"))
    ids = ids.join(links, "node", "left").join(parts, "node", "left").select("node", "class_id", "n_links", F.coalesce("component", "node").alias("part"))
    least = ids.where("n_links > 0").groupBy("part").agg(F.min("class_id").alias("group_id"))
    ids = ids.join(least, "part", "left").drop("part")
    return base.join(ids, "node", "left").select(
        "doc_id", "row", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("group_id", "class_id", "doc_id").alias("group_id")
    )


def dedup(docs: DataFrame) -> DataFrame:
    """The documents with one of each group: that of the group's least doc_id; of repeated rows one."""
    keep = join(docs).where("doc_id <=> group_id").select(F.col("doc_id").alias("_d"), F.col("row").alias("_r")).groupBy("_d", "_r").agg(F.count("*").alias("_n"))
    own = docs.select(F.struct("*").alias("rec"), F.col("doc_id").alias("_doc"), F.xxhash64("text").alias("_row"))
    keep = settle(keep)
    out = own.join(keep, own["_doc"].eqNullSafe(keep["_d"]) & (own["_row"] == keep["_r"]))
    if not keep.where("_n > 1").isEmpty():
        out = out.where("_n = 1").select("rec", "_doc", "_row").unionByName(out.where("_n > 1").dropDuplicates(["_doc", "_row"]).select("rec", "_doc", "_row"))
    return out.select("rec.*")


def op3_ngram_join(spark, sf_dir: str) -> DataFrame:
    """doc_id, class_id (the least doc_id of all that links connect), n_links, copy_id (that of equal sets) of every document."""
    found = join(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return found.select("doc_id", F.col("group_id").alias("class_id"), "n_links", F.col("class_id").alias("copy_id"))
