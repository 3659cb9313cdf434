"""URL filters: given host and path rules first, mined association rules for the rest.

URLs that a given rule fits are the labels. Spark's FP-growth mines combinations of URL tokens (host
labels, words of path segments, file endings, query keys) that go with a verdict; rules below the
support or confidence asked for are pruned, and so are rules with a part that is as sure by itself.
Other URLs are matched against the rules through an inverted index from token to rule: a rule matches
when as many of its items are found as it has. DataFrame and Spark ML operations only.

Mining is bounded before it begins. Tokens below the support are no part of a rule and go. Tokens that labelled
URLs always have together are one item, as they have the same support and confidence in every combination; a URL
has the item if it has any of its tokens, which is what rules of each of them would say. So copies of a long URL
add one item. Spark's FP-growth makes combinations of any length, which double with each item of a URL, so it mines
tables of which no labelled URL has more than ``WIDEST`` items. Others are mined whole by growth over conditional
pattern bases to the length asked for (``grown``): all items of all URLs, and the same rules.

Defined results: a null url, or one without ``://``, has an empty host and path, no rule and no
tokens, and the default verdict; very long URLs are parsed whole; repeated rows are judged each by itself;
ties between mined rules go by confidence, then support, then block before allow, then the rule's name; an empty
table, or one without labels, gives no mined rules; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import math
import string
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import settle

ALLOW, BLOCK = "allow", "block"
#: Items of a URL up to which Spark's FP-growth mines; each further one doubles its combinations.
WIDEST = 14


@dataclass(frozen=True)
class UrlRule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (UrlRule(BLOCK, "net", "/"), UrlRule(ALLOW, "example.net", "/en/"), UrlRule(BLOCK, "example.com", "/de/"), UrlRule(ALLOW, "org", "/fr/"))


def host_of(url: Column) -> Column:
    raw = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(raw, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def query_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^?#]*\?([^#]*)", 1)


def given(host: Column, path: Column, rules: Sequence[UrlRule]) -> Column:
    """Struct of the longest given rule that fits, and its verdict; null if none does."""
    chain = None
    for r in sorted(rules, key=lambda r: -len(r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        value = F.struct(F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict"))
        chain = F.when(fits, value) if chain is None else chain.when(fits, value)
    return chain


def tokens_of(host: Column, path: Column, query: Column) -> Column:
    """The sorted distinct tokens of a URL; numbers are no tokens, they name single pages."""
    def parts(text: Column, split: str, mark: str) -> Column:
        return F.transform(F.filter(F.split(text, split), lambda x: (x != "") & ~x.rlike(r"^[0-9]+$")), lambda x: F.concat(F.lit(mark), x))

    keys = F.regexp_replace(query, r"=[^&]*", "")
    return F.array_sort(F.array_distinct(F.concat(parts(host, r"\.", "host:"), parts(path, r"[/._-]", "path:"), parts(keys, "&", "key:"))))


def items_of(labelled: DataFrame, min_support: float) -> DataFrame:
    """(token, item, n) of the tokens that reach the support; tokens of the same labelled rows share the item, their least token."""
    least = max(1, math.ceil(min_support * labelled.count() - 1e-9))
    sets = labelled.groupBy("tokens").agg(F.count("*").alias("n"))
    rows = sets.select(F.explode("tokens").alias("token"), "n", *(F.shiftright(F.xxhash64(F.lit(k), "tokens"), 24).alias(f"h{k}") for k in (1, 2)))
    seen = rows.groupBy("token").agg(F.sum("n").alias("n"), F.sum("h1").alias("h1"), F.sum("h2").alias("h2")).where(F.col("n") >= least)
    items = seen.groupBy("n", "h1", "h2").agg(F.min("token").alias("item"))
    return settle(seen.join(items, ["n", "h1", "h2"]).select("token", "item", "n"))


def by_fp_growth(rows: DataFrame, min_support: float, min_confidence: float, longest: int) -> DataFrame:
    """(antecedent, verdict, confidence, support) of the rules in rows of (own, verdict, n), by Spark's FP-growth."""
    each = rows.select(F.concat("own", F.array(F.concat(F.lit("verdict:"), "verdict"))).alias("items"), F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(settle(each.select("items")))
    return (
        model.associationRules.where(F.col("consequent")[0].startswith("verdict:") & (F.size("antecedent") <= longest))
        .where(~F.exists("antecedent", lambda x: x.startswith("verdict:")))
        .select(F.array_sort("antecedent").alias("antecedent"), F.substring_index(F.col("consequent")[0], ":", -1).alias("verdict"), "confidence", "support")
    )


def grown(rows: DataFrame, min_support: float, min_confidence: float, longest: int) -> DataFrame:
    """The same rules, by pattern growth: each set found is extended by what follows it in its rows, its conditional pattern base.

    A set all of whose rows have one verdict, or that has the rows of one of its parts, is extended no further: what
    holds it is as sure without one of its items, so the pruning of ``mine`` would take it away.
    """
    counts = F.sum("n").alias("n"), F.sum(F.when(F.col("verdict") == BLOCK, F.col("n")).otherwise(0)).alias("b")
    total = rows.agg(F.sum("n")).first()[0]
    least = max(1, math.ceil(min_support * total))
    base = rows.groupBy("own").agg(*counts)
    # Rows of (part, rest): a set found before, and the items that follow it; items are in one order everywhere.
    state, parts, rules = base.select(F.array().cast("array<string>").alias("part"), F.array_sort("own").alias("rest"), "n", "b"), None, None
    for size in range(1, longest + 1):
        at = state.select("part", "n", "b", "rest", F.posexplode("rest").alias("k", "item"))
        longer = at.select(F.concat("part", F.array("item")).alias("part"), F.expr("slice(rest, k + 2, size(rest))").alias("rest"), "n", "b")
        longer = settle(longer.groupBy("part", "rest").agg(F.sum("n").alias("n"), F.sum("b").alias("b")))
        found = longer.groupBy("part").agg(F.sum("n").alias("n"), F.sum("b").alias("b")).where((F.col("b") >= least) | (F.col("n") - F.col("b") >= least))
        if parts is None:
            found = found.withColumn("fewest", F.lit(total))
        else:  # only sets all of whose parts live
            own = found.select("part", "n", "b", F.explode(F.transform("part", lambda x: F.array_except("part", F.array(x)))).alias("_less"))
            known = parts.select(F.col("part").alias("_less"), F.col("n").alias("_n"))
            own = own.join(known, "_less").groupBy("part", "n", "b").agg(F.count("*").alias("_parts"), F.min("_n").alias("fewest"))
            found = own.where(F.col("_parts") == size).drop("_parts")
        found = settle(found)
        one = found.select("part", "n", F.explode(F.array(F.struct(F.lit(BLOCK).alias("verdict"), F.col("b").alias("c")), F.struct(F.lit(ALLOW).alias("verdict"), (F.col("n") - F.col("b")).alias("c")))).alias("v"))
        one = one.select(F.array_sort("part").alias("antecedent"), "v.verdict", (F.col("v.c") / F.col("n")).alias("confidence"), (F.col("v.c") / F.lit(float(total))).alias("support"), "v.c")
        one = one.where((F.col("c") >= least) & (F.col("confidence") >= min_confidence)).drop("c")
        rules = one if rules is None else rules.unionByName(one)
        parts = found.where("b > 0 and b < n and n < fewest")
        state = longer.join(parts.select("part"), "part", "left_semi")
        if size == 1:  # items that do not live are in no longer set
            alive = parts.select(F.col("part")[0].alias("item"))
            kept = state.select("part", "n", "b", F.monotonically_increasing_id().alias("_row"), "rest")
            kept = settle(kept)
            rest = kept.select("_row", F.explode("rest").alias("item")).join(alive, "item").groupBy("_row").agg(F.array_sort(F.collect_list("item")).alias("rest"))
            state = kept.drop("rest").join(rest, "_row").groupBy("part", "rest").agg(F.sum("n").alias("n"), F.sum("b").alias("b"))
        state = settle(state.where("size(rest) > 0"))
        if state.isEmpty():
            break
    return rules


def mine(labelled: DataFrame, min_support: float, min_confidence: float, longest: int, items: DataFrame) -> DataFrame:
    """(rule_id, antecedent, verdict, confidence, support) from rows of (tokens, verdict); antecedents are items."""
    sets = labelled.groupBy("tokens", "verdict").agg(F.count("*").alias("_n"))
    own = sets.select("tokens", F.explode("tokens").alias("token")).distinct().join(items, "token").select("tokens", "item").distinct()
    own = own.groupBy("tokens").agg(F.collect_set("item").alias("own"))
    rows = settle(sets.join(own, "tokens", "left").select(F.coalesce("own", F.array().cast("array<string>")).alias("own"), "verdict", F.col("_n").alias("n")))
    widest = rows.agg(F.max(F.size("own"))).first()[0] or 0
    found = (by_fp_growth if widest <= WIDEST else grown)(rows, min_support, min_confidence, longest)
    found = settle(found.withColumn("rule_id", F.concat_ws("\x00", F.concat(F.array("verdict"), "antecedent"))))
    # A rule goes if one of its parts with one token less is as sure of the same verdict.
    part = found.select(F.col("rule_id").alias("_part"), F.col("confidence").alias("_sure"))
    shorter = found.where(F.size("antecedent") > 1).select(
        "rule_id", "confidence",
        F.explode(F.transform("antecedent", lambda x: F.concat_ws("\x00", F.concat(F.array("verdict"), F.array_except("antecedent", F.array(x)))))).alias("_part"),
    )
    beaten = shorter.join(part, "_part").where("_sure >= confidence").select("rule_id").distinct()
    return settle(found.join(beaten, "rule_id", "left_anti"))


def matched(sets: DataFrame, rules: DataFrame, items: DataFrame) -> DataFrame:
    """(tokens, verdict, confidence, antecedent) of the best rule for each token set that has one."""
    index = rules.select(F.explode("antecedent").alias("item"), "rule_id", F.size("antecedent").alias("_size"), "verdict", "confidence", "support")
    own = sets.select("tokens", F.explode("tokens").alias("token")).join(items.select("token", "item"), "token").select("tokens", "item").distinct()
    whole = own.join(index, "item").groupBy("tokens", "rule_id", "_size", "verdict", "confidence", "support").agg(F.count("*").alias("_found")).where("_found = _size")
    order = F.struct("confidence", "support", F.when(F.col("verdict") == BLOCK, 1).otherwise(0).alias("b"), "rule_id")
    return whole.groupBy("tokens").agg(F.max_by(F.struct("verdict", "confidence"), order).alias("_best"))


def held_out_quality(pages: DataFrame, rules: Sequence[UrlRule] | None = None, min_support: float = 0.002, min_confidence: float = 0.8, longest: int = 4) -> dict[str, float]:
    """Of the labelled URLs, a quarter by hash is judged by rules mined from the others: how many a rule matches, and how often it is right."""
    rows = _parsed(pages, RULES if rules is None else rules).where("_given is not null and size(tokens) > 0")
    rows = rows.select("tokens", F.col("_given.verdict").alias("verdict"), (F.pmod(F.xxhash64("page_id"), F.lit(4)) == 0).alias("out"))
    known, out = rows.where("not out").drop("out"), rows.where("out").drop("out")
    items = items_of(known, min_support)
    best = matched(out.select("tokens").distinct(), mine(known, min_support, min_confidence, longest, items), items)
    n, hit, right = out.join(best, "tokens", "left").agg(F.count("*"), F.count("_best"), F.count_if(F.col("_best.verdict") == F.col("verdict"))).first()
    return {"labelled": n, "matched": hit / max(n, 1), "precision": right / max(hit, 1), "recall": right / max(n, 1)}


def _parsed(pages: DataFrame, rules: Sequence[UrlRule]) -> DataFrame:
    url = F.col("url")
    parsed = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), query_of(url).alias("_query"))
    return parsed.withColumn("_given", given(F.col("host"), F.col("path"), rules)).withColumn("tokens", tokens_of(F.col("host"), F.col("path"), F.col("_query")))


def judge(pages: DataFrame, rules: Sequence[UrlRule] = RULES, min_support: float = 0.002, min_confidence: float = 0.8, longest: int = 4, default: str = ALLOW) -> DataFrame:
    """page_id, host, path, rule, verdict and confidence (of the mined rule; null without one) of every page."""
    parsed = _parsed(pages, rules)
    labelled = parsed.where("_given is not null and size(tokens) > 0").select("tokens", F.col("_given.verdict").alias("verdict"))
    out = ("page_id", "host", "path", F.col("_given.rule").alias("rule"))
    if labelled.isEmpty():
        return parsed.select(*out, F.coalesce("_given.verdict", F.lit(default)).alias("verdict"), F.lit(None).cast("double").alias("confidence"))
    items = items_of(labelled, min_support)
    best = matched(parsed.where("_given is null and size(tokens) > 0").select("tokens").distinct(), mine(labelled, min_support, min_confidence, longest, items), items)
    ruled = parsed.where("_given is not null").select(*out, F.col("_given.verdict").alias("verdict"), F.lit(None).cast("double").alias("confidence"))
    rest = parsed.where("_given is null").join(best, "tokens", "left").select(*out, F.coalesce("_best.verdict", F.lit(default)).alias("verdict"), F.col("_best.confidence").alias("confidence"))
    return ruled.unionByName(rest)


def op8_url_filter(spark, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet"))
