"""Quality rules as a short-circuit cascade, in DataFrame operations only.

Each rule rejects a document by statistics of its whole text. On a seeded sample over all partitions the
operator measures what a rule costs (its time beyond that of a job without a rule) and how much it rejects of
what the rules before it leave. Rules are ordered by rejection per cost and evaluated as one CASE, so that a
rejected document pays for no later rule. The verdict does not depend on the order; the order is only a matter
of speed. ``report`` returns all statistics of every document, so there only ``keep`` saves time.

Defined results: a null text is an empty one (no words, so it is rejected); very long texts are judged whole;
repeated rows are judged each by itself; rules of the same rejection per cost stay in the order given; an empty
table gives an empty result; other columns, whatever their names, are left as they are.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, settle

WS = " \t\n\x0b\f\r"
SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]+"
#: Documents that the cost and the selectivity of rules are measured on, on average, and how often each is timed.
SAMPLE_ROWS, SEED, RUNS = 1000, 20240229, 2
#: Bits that hold a window's position in a packed long; the others hold its hash.
POSITION = (1 << 30) - 1


def words_of(text: Column) -> Column:
    """The words of a text: runs of anything but ASCII white space."""
    inner = F.btrim(text, F.lit(WS))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, SPACES))


def dup_lines_of(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    full = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(WS)) != "")
    return let(full, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def _again(pairs: Column, key, position) -> Column:
    """Positions, ascending, of the entries of a sorted array whose key an entry beside them has."""
    same = lambda a, b: F.coalesce(key(a) == key(b), F.lit(False))
    hit = let(pairs, lambda s: F.filter(s, lambda x, j: same(x, F.get(s, j + 1)) | ((j > 0) & same(x, F.get(s, F.greatest(j - 1, F.lit(0)))))))
    return F.sort_array(F.transform(hit, position))


def repeat_words_of(words: Column) -> Column:
    """Words inside 3-word windows that the text has twice or more, the first included.

    Where all hashes differ, none repeats. Else hashes with positions, sorted as longs, find the
    windows that may repeat; their words decide.
    """
    def count(w: Column) -> Column:
        hashes = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
        none = F.lit(0).cast("long")
        return let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), none).otherwise(covered(w, h)))

    def covered(w: Column, h: Column) -> Column:
        packed = F.transform(h, lambda x, i: x.bitwiseAND(F.lit(~POSITION)).bitwiseOR(i.cast("long")))
        maybe = _again(F.sort_array(packed), lambda x: F.shiftrightunsigned(x, 30), lambda x: x.bitwiseAND(F.lit(POSITION)).cast("int"))

        def sure(p: Column) -> Column:
            spelt = F.transform(p, lambda i: F.struct(F.concat_ws(" ", F.slice(w, i + 1, 3)).alias("k"), i.alias("p")))
            return _again(F.sort_array(spelt), lambda x: x["k"], lambda x: x["p"])

        exact = let(maybe, lambda p: F.when(F.size(p) == 0, F.array().cast("array<int>")).otherwise(sure(p)))
        gaps = F.aggregate(
            exact,
            F.struct(F.lit(0).cast("long").alias("n"), F.lit(-9).alias("at")),
            lambda a, p: F.struct((a["n"] + F.least(F.lit(3), p - a["at"])).cast("long").alias("n"), p.alias("at")),
        )
        return gaps["n"]

    return let(words, lambda w: F.when(F.size(w) < 4, F.lit(0).cast("long")).otherwise(count(w)))


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words (longs)."""
    t = F.coalesce(F.col(text), F.lit(""))
    return docs.withColumn("_words", words_of(t)).withColumns({
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.char_length(F.array_join("_words", "")).cast("long"),
        "n_symbols": (F.char_length(t) - F.char_length(F.regexp_replace(t, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": dup_lines_of(t),
        "n_repeat_words": repeat_words_of(F.col("_words")),
    }).drop("_words")


@dataclass(frozen=True)
class Rule:
    """A name and the condition under which a document goes; it must never be null."""

    name: str
    rejects: Column


def rules(text: Column, n_words: Column, word_chars: Column, n_symbols: Column, n_dup_lines: Column, n_repeat_words: Column) -> list[Rule]:
    """The production rules over the five statistics and the text.

    The thresholds are far from what prose has: a table of a few lines or a shouted heading stays.
    """
    letters = F.char_length(F.regexp_replace(text, r"[^\p{L}]+", ""))
    capitals = F.char_length(F.regexp_replace(text, r"[^\p{Lu}]+", ""))
    return [
        Rule("few_words", n_words < 50),
        Rule("repeats", 100 * n_repeat_words > 50 * n_words),
        Rule("symbols", 100 * n_symbols > 6 * word_chars),
        Rule("same_lines", 100 * n_dup_lines > 60 * F.size(F.split(text, "\n"))),
        Rule("long_words", (word_chars > 20 * n_words)),
        Rule("capitals", 100 * capitals > 60 * letters),
    ]


@dataclass(frozen=True)
class Measured:
    """A rule's seconds for a sampled document, and what it rejects of the documents that the rules before it leave."""

    rule: Rule
    cost: float
    rejects: float


def cascade(docs: DataFrame, named: Sequence[Rule], sample_rows: int = SAMPLE_ROWS) -> list[Measured]:
    """The rules in their order, with the measures it comes from.

    The sample serves the estimate only; no verdict depends on it. An empty sample keeps the order.
    """
    total = docs.count()
    sample = settle(docs.select("text").sample(min(1.0, sample_rows / max(total, 1)), SEED).repartition(1))
    n = sample.count()

    def seconds(condition: Column) -> float:
        taken = []
        for _ in range(RUNS):
            began = time.perf_counter()
            sample.agg(F.count_if(condition)).first()
            taken.append(time.perf_counter() - began)
        return min(taken)

    if not n:
        return [Measured(r, 0.0, 0.0) for r in named]
    nothing = seconds(F.char_length("text") < 0)
    cost = {r.name: max(seconds(r.rejects) - nothing, 0.02 * nothing) / n for r in named}
    left = [tuple(x) for x in sample.select(*(r.rejects for r in named)).collect()]  # a row for each sampled document
    todo, out = list(enumerate(named)), []
    while todo:
        share = {k: sum(x[k] for x in left) / max(len(left), 1) for k, _ in todo}
        best = max(todo, key=lambda x: (share[x[0]] / cost[x[1].name], -x[0]))
        todo.remove(best)
        out.append(Measured(best[1], cost[best[1].name], share[best[0]]))
        left = [x for x in left if not x[best[0]]]
    return out


def cascade_order(docs: DataFrame, named: Sequence[Rule], sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """The rules by rejected share of what is left per second."""
    return [m.rule for m in cascade(docs, named, sample_rows)]


def _for_columns() -> list[Rule]:
    t = F.coalesce(F.col("text"), F.lit(""))
    return rules(t, *(F.col(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")))


def _of_words(t: Column, words: Column) -> list[Rule]:
    symbols = (F.char_length(t) - F.char_length(F.regexp_replace(t, SYMBOLS, ""))).cast("long")
    return rules(t, F.size(words).cast("long"), F.char_length(F.array_join(words, "")).cast("long"), symbols, dup_lines_of(t), repeat_words_of(words))


def _for_text(text: str = "text") -> list[Rule]:
    t = F.coalesce(F.col(text), F.lit(""))
    return _of_words(t, words_of(t))


def first_rejection(ordered: Sequence[Rule]) -> Column:
    """The name of the first rule that rejects, null if none does; later rules are not evaluated."""
    chain = F.when(ordered[0].rejects, ordered[0].name)
    for rule in ordered[1:]:
        chain = chain.when(rule.rejects, rule.name)
    return chain


def keep(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The documents that no rule rejects; each rule is evaluated only where none before it rejects.

    The words are split once and bound, as a filter would else hold a copy for every rule.
    """
    t = F.coalesce(F.col("text"), F.lit(""))
    order = [r.name for r in cascade_order(docs, _for_text(), sample_rows)]
    chain = lambda words: first_rejection(sorted(_of_words(t, words), key=lambda r: order.index(r.name)))
    return docs.where(let(words_of(t), chain).isNull())


def report(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, the statistics, base_failed, kept and rejected_by for every document."""
    stats = statistics(docs.select("doc_id", "text"))
    named = _for_columns()
    order = [r.name for r in cascade_order(docs, _for_text(), sample_rows)]
    ordered = sorted(named, key=lambda r: order.index(r.name))
    base = [r.rejects for r in named if r.name in ("few_words", "repeats")]
    out = stats.withColumns({"base_failed": base[0] | base[1], "rejected_by": first_rejection(ordered)})
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", F.col("rejected_by").isNull().alias("kept"))


def op4_quality_rules(spark, sf_dir: str) -> DataFrame:
    return report(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS k FROM documents),
w AS (SELECT k, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM d),
p AS (SELECT k, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3),
g AS (SELECT k, i, count(*) OVER (PARTITION BY k, ws[i], ws[i + 1], ws[i + 2]) AS n FROM p),
c AS (SELECT DISTINCT k, i + unnest([0, 1, 2]) AS at FROM g WHERE n > 1),
r AS (SELECT k, count(*) AS n FROM c GROUP BY k),
l AS (SELECT k, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
s AS (
  SELECT d.k, d.doc_id, d.t, len(w.ws)::BIGINT AS n_words, length(array_to_string(w.ws, ''))::BIGINT AS word_chars,
    (length(d.t) - length(regexp_replace(d.t, '[#*$%&|<>]+', '', 'g')))::BIGINT AS n_symbols,
    (len(l.ls) - len(list_distinct(l.ls)))::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words
  FROM d JOIN w USING (k) JOIN l USING (k) LEFT JOIN r USING (k)
),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 100 * n_symbols > 6 * word_chars OR 100 * n_dup_lines > 60 * len(string_split(t, chr(10))) OR word_chars > 20 * n_words
    OR 100 * length(regexp_replace(t, '[^\p{Lu}]+', '', 'g')) > 60 * length(regexp_replace(t, '[^\p{L}]+', '', 'g'))) AS kept
FROM b
"""
