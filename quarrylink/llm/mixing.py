"""Mixing sources to target weights by iterative proportional fitting, in DataFrame operations only.

Tokens are summed by cell: source, language and topic. Sweeps rescale the cells' weights to each of the
three target marginals in turn until all agree (raking). A cell's probability is its share of the token
budget over its tokens, at most 1; a common factor, found by fixed-point steps, makes the expected
tokens of the sample equal the budget though some cells are taken whole. A document is in the sample
if the hash of its id falls below its cell's probability.

Without given targets a marginal's target is its token share to the power ``TEMPER``, normalised: large
sources count for less than their size. Unless a topic column is given, topics are learnt: k-means over hashed
word counts of all documents with words; each document gets the nearest centre's. Counts are stored once, some
bytes for each different word of a document, and read by every pass of k-means. Raking
ends when the marginals agree; if they cannot, it warns, and ``marginal_gap`` tells by how much they miss.

Defined results: a null source, language or topic is a level of its own, named ``(none)``; a null text
is an empty one, and its topic ``(none)``; very long texts are counted whole; documents without tokens add to no weight and get their cell's probability, 0 if no
document of the cell has tokens; a level without a target has weight 0; targets for absent levels are
left out and the others share theirs; rows that repeat a doc_id stay or go together (a null doc_id goes
by its text); ties in the hash go by it alone; an empty table gives an empty result; other columns, whatever
their names, are left as they are.
"""

from __future__ import annotations

import warnings
from collections.abc import Mapping

from pyspark import StorageLevel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import HashingTF, Normalizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import settle

DIMENSIONS = ("source", "lang", "topic")
TEMPER, BUDGET, SEED = 0.5, 0.5, 20240229
SWEEPS, CLOSE = 40, 1e-6
TOPICS, FEATURES = 8, 256
#: Cells up to this number are sent to every executor; beyond it they are joined by shuffle.
BROADCAST_CELLS = 10_000
NONE = "(none)"


def words_of(text: Column) -> Column:
    inner = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\f\r"))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, r"[\x20\x09-\x0D]+"))


def _counted(rows: DataFrame) -> DataFrame:
    """Adds _counts: the hashed counts of _words, as a vector."""
    return HashingTF(inputCol="_words", outputCol="_counts", numFeatures=FEATURES).transform(rows)


def _unit(rows: DataFrame) -> DataFrame:
    """Adds _unit: _counts as a vector of length 1 (of 0 without words)."""
    return Normalizer(inputCol="_counts", outputCol="_unit").transform(rows)


def learn_topics(docs: DataFrame, seed: int = SEED) -> KMeansModel | None:
    """Centres of the word counts of all documents with words; none where all are the same."""
    words = docs.select(words_of(F.col("text")).alias("_words"))
    return _fitted(settle(_counted(words).select("_counts", F.size("_words").alias("tokens"))), seed)


def _fitted(counted: DataFrame, seed: int) -> KMeansModel | None:
    """The centres of stored rows of (_counts, tokens)."""
    points = _unit(counted.where("tokens > 0")).select("_unit")
    different = points.select(F.xxhash64("_unit").alias("h")).distinct().limit(4 * TOPICS).count()
    if different < 2:
        return None
    few = different < 4 * TOPICS  # k-means|| may find fewer centres than asked for in few points
    points = (settle(points.distinct()) if few else points).persist(StorageLevel.DISK_ONLY)  # or k-means holds all of them in memory
    try:
        return KMeans(featuresCol="_unit", predictionCol="_topic", k=min(TOPICS, different), initMode="random" if few else "k-means||", maxIter=10, seed=seed).fit(points)
    finally:
        points.unpersist()


def _measured(docs: DataFrame, topic: Column | None) -> DataFrame:
    """(rec, id, source, lang, tokens, and _own or _counts): each document as a struct, so that no column of its own can clash."""
    level = lambda c: F.coalesce(F.col(f"rec.{c}").cast("string"), F.lit(NONE)).alias(c)
    extra = docs.select(F.struct("*").alias("rec"), (topic if topic is not None else F.lit(None)).cast("string").alias("_own"))
    rows = extra.select("rec", "_own", F.coalesce("rec.doc_id", F.xxhash64("rec.text")).alias("id"), level("source"), level("lang"), words_of(F.col("rec.text")).alias("_words"))
    rows = rows.drop("_own").transform(_counted) if topic is None else rows
    return rows.withColumn("tokens", F.size("_words").cast("long")).drop("_words")


def _with_topic(rows: DataFrame, model: KMeansModel | None) -> DataFrame:
    """Measured rows with their topic instead of _own or _counts."""
    if "_own" in rows.columns:
        return rows.withColumn("topic", F.coalesce("_own", F.lit(NONE))).drop("_own")
    rows = rows.withColumn("_topic", F.lit(0)) if model is None else model.transform(_unit(rows)).drop("_unit")
    kind = F.when(F.col("tokens") == 0, NONE).otherwise(F.concat(F.lit("t"), F.col("_topic").cast("string")))
    return rows.withColumn("topic", kind).drop("_counts", "_topic")


def _targets(cells: DataFrame, dim: str, given: Mapping[str, float] | None) -> DataFrame:
    """(level, target) of one dimension; the targets of the levels present sum to 1."""
    sums = cells.groupBy(dim).agg(F.sum("tokens").alias("_t")).where("_t > 0")
    if given is None:
        raw = sums.select(dim, F.pow("_t", F.lit(TEMPER)).alias("_w"))
    else:
        rows = cells.sparkSession.createDataFrame(sorted(given.items()) or [("", 0.0)], f"{dim} string, _w double")
        raw = sums.join(rows, dim).select(dim, "_w").where("_w > 0")
    total = raw.agg(F.sum("_w")).first()[0] or 1.0
    return raw.select(dim, (F.col("_w") / total).alias(f"target_{dim}"))


def rake(cells: DataFrame, targets: Mapping[str, Mapping[str, float]] | None = None) -> DataFrame:
    """The cells with ``weight``: shares that meet the targets of each dimension, as near as they can."""
    now = cells
    for dim in DIMENSIONS:
        now = now.join(_targets(cells, dim, (targets or {}).get(dim)), dim, "left").fillna(0.0, [f"target_{dim}"])
    now = settle(now.withColumn("weight", F.when(F.least(*(f"target_{d}" for d in DIMENSIONS)) > 0, F.col("tokens").cast("double")).otherwise(0.0)))
    gap = 0.0
    for _ in range(SWEEPS):
        for dim in DIMENSIONS:  # by windows: joins with the sums would broadcast three tables a sweep, which the driver holds
            now = now.withColumn(f"_s_{dim}", F.sum("weight").over(Window.partitionBy(dim)))
            share = F.col("weight") * F.col(f"target_{dim}") / F.col(f"_s_{dim}")
            now = now.withColumn("weight", F.when(F.col(f"_s_{dim}") > 0, share).otherwise(0.0))
        now = settle(now)
        worst = now.agg(*(F.max(F.when(F.col(f"_s_{d}") > 0, F.abs(F.col(f"_s_{d}") - F.col(f"target_{d}"))).otherwise(0.0)) for d in DIMENSIONS)).first()
        now = now.drop(*(f"_s_{d}" for d in DIMENSIONS))
        gap = max((x or 0.0) for x in worst)
        if gap < CLOSE:
            break
    else:
        warnings.warn(f"the marginals disagree: after {SWEEPS} sweeps one misses its target by {gap:.2g}", stacklevel=2)
    return now.withColumn("marginal_gap", F.lit(gap))


def probabilities(cells: DataFrame, budget: float = BUDGET) -> DataFrame:
    """Raked cells with ``probability``, calibrated so that the expected tokens are the budget's share of all."""
    full = cells.agg(F.sum("tokens"), F.sum("weight"), F.sum(F.when(F.col("weight") > 0, F.col("tokens")))).first()
    tokens, weight, reachable = (float(x or 0) for x in full)
    goal = min(budget * tokens, reachable)
    factor, wanted = 1.0, goal * F.col("weight") / (weight or 1.0)
    for _ in range(100):
        whole = wanted * factor >= F.col("tokens") * (1 - 1e-12)
        taken, rest = cells.agg(F.sum(F.when(whole & (F.col("weight") > 0), F.col("tokens"))), F.sum(F.when(~whole, wanted))).first()
        if not rest:
            break
        new = max(goal - float(taken or 0), 0.0) / float(rest)
        if abs(new - factor) <= 1e-12 * factor:
            break
        factor = new
    share = F.when((F.col("tokens") > 0) & (F.col("weight") > 0), F.least(F.lit(1.0), wanted * factor / F.col("tokens"))).otherwise(0.0)
    return cells.withColumn("probability", share)


def _odds(rows: DataFrame, targets, budget: float) -> DataFrame:
    """The cells of measured rows, with weights and probabilities."""
    cells = settle(rows.groupBy(*DIMENSIONS).agg(F.sum("tokens").alias("tokens")))
    return settle(probabilities(rake(cells, targets), budget).select(*DIMENSIONS, "weight", "probability", "marginal_gap"))


def _kept(rows: DataFrame, odds: DataFrame, seed: int) -> DataFrame:
    if odds.limit(BROADCAST_CELLS + 1).count() <= BROADCAST_CELLS:
        odds = F.broadcast(odds)
    place = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "id"), 11) / float(1 << 53)
    return rows.join(odds, list(DIMENSIONS)).withColumn("kept", place < F.col("probability"))


def mix(docs: DataFrame, targets: Mapping[str, Mapping[str, float]] | None = None, budget: float = BUDGET, topic: Column | None = None, seed: int = SEED) -> DataFrame:
    """The documents of the sample, with their own columns."""
    rows = _measured(docs, topic)
    counted = settle(rows.drop("rec", "id"))
    model = _fitted(counted, seed) if topic is None else None
    odds = _odds(_with_topic(counted, model), targets, budget)
    return _kept(_with_topic(rows, model), odds, seed).where("kept").select("rec.*")


def report(docs: DataFrame, targets=None, budget: float = BUDGET, topic: Column | None = None, seed: int = SEED) -> DataFrame:
    """doc_id, source, lang, topic, n_tokens, cell_weight, probability, kept and marginal_gap of every document; one pass over the texts measures them."""
    rows = _measured(docs, topic)
    rows = settle(rows.select(F.col("rec.doc_id").alias("doc_id"), *rows.drop("rec").columns))
    rows = _with_topic(rows, _fitted(rows, seed) if topic is None else None)
    rows = _kept(rows, _odds(rows, targets, budget), seed)
    return rows.select("doc_id", *DIMENSIONS, F.col("tokens").alias("n_tokens"), F.col("weight").alias("cell_weight"), "probability", "kept", "marginal_gap")


def op7_source_mixing(spark, sf_dir: str) -> DataFrame:
    return report(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source"))
