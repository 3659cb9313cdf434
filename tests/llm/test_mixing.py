import warnings

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from quarrylink.llm import mixing as q


def documents(spark, n=3000):
    r = np.random.default_rng(3)
    rows = []
    for i in range(n):
        source = ["big", "mid", "small", None][r.choice(4, p=[0.7, 0.2, 0.06, 0.04])]
        rows.append((i, " ".join(["w"] * int(r.integers(0, 300))), ["en", "de"][r.choice(2, p=[0.8, 0.2])], source, "x", "y"))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, tokens string, rec string")


def test_raking_and_calibration_equal_brute_force(spark):
    docs = documents(spark)
    out = q.report(docs).toPandas()
    assert len(out) == docs.count()
    cells = out.groupby(["source", "lang", "topic"]).agg(t=("n_tokens", "sum"), p=("probability", "first"), w=("cell_weight", "first")).reset_index()
    cells = cells[cells.t > 0]
    goal = {d: (lambda s: s**0.5 / (s**0.5).sum())(cells.groupby(d).t.sum()) for d in q.DIMENSIONS}
    w = cells.t.to_numpy(float)
    for _ in range(200):
        for d in q.DIMENSIONS:
            w = w * cells[d].map(goal[d] / pd.Series(w, cells.index).groupby(cells[d]).sum()).to_numpy()
    assert np.allclose(w, cells.w, atol=1e-5)
    budget, low, high = 0.5 * cells.t.sum(), 0.0, 1e6
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if np.minimum(cells.t, mid * budget * w).sum() < budget else (low, mid)
    assert np.allclose(np.minimum(1, low * budget * w / cells.t), cells.p, atol=1e-4)
    assert abs((out.n_tokens * out.probability).sum() - budget) < 1e-4 * budget
    assert abs((out.n_tokens * out.kept).sum() - budget) < 0.1 * budget


def test_given_targets_and_whole_budget(spark):
    docs = documents(spark, 600)
    out = q.report(docs, {"source": {"big": 1.0, "mid": 1.0, "absent": 3.0}}, budget=0.1).toPandas()
    share = out.drop_duplicates(["source", "lang", "topic"]).groupby("source").cell_weight.sum()
    assert np.allclose([share["big"], share["mid"], share["small"], share["(none)"]], [0.5, 0.5, 0, 0], atol=1e-4)
    assert not out[out.source == "small"].kept.any()
    assert q.mix(docs, budget=1.0).where(F.length("text") > 0).count() == docs.where(F.length("text") > 0).count()


def test_columns_repeats_and_odd_rows(spark):
    rows = [(1, "a b", "en", "s", "x", "y"), (1, "a b", "en", "s", "x", "y"), (None, None, None, None, None, None), (2, "", "en", "s", "x", "y"), (3, "z", None, "s", "x", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, tokens string, rec string")
    assert q.mix(docs).columns == docs.columns
    out = q.report(docs).collect()
    assert len(out) == 5 and len({r.kept for r in out if r.doc_id == 1}) == 1
    assert {r.lang for r in out} == {"en", "(none)"}
    assert q.report(docs.limit(0)).collect() == []


def test_topic_column(spark):
    docs = documents(spark, 100).withColumn("topic", F.col("doc_id") % 2)
    assert {r.topic for r in q.report(docs, topic=F.col("topic")).select("topic").distinct().collect()} == {"0", "1"}


def test_topics_follow_the_words(spark):
    themes = [[f"{t}{k}" for k in range(30)] for t in ("sea", "law", "art", "math")]
    r = np.random.default_rng(1)
    docs = spark.createDataFrame([(i, " ".join(r.choice(themes[i % 4], 60)), "en", "s") for i in range(200)], "doc_id long, text string, lang string, source string")
    got = {}
    for row in q.report(docs).collect():
        got.setdefault(row.topic, set()).add(row.doc_id % 4)
    assert len(got) >= 4 and all(len(x) == 1 for x in got.values())


def test_marginals_that_disagree_are_told(spark, monkeypatch):
    monkeypatch.setattr(q, "SWEEPS", 4)
    docs = spark.createDataFrame([(0, "a b", "en", "x"), (1, "a b", "de", "y")], "doc_id long, text string, lang string, source string")
    with warnings.catch_warnings(record=True) as seen:
        warnings.simplefilter("always")
        out = q.report(docs, {"source": {"x": 0.9, "y": 0.1}, "lang": {"en": 0.1, "de": 0.9}}, topic=F.lit("t")).collect()
    assert any("disagree" in str(w.message) for w in seen) and all(r.marginal_gap > 0.5 for r in out)


def test_very_long_text(spark):
    docs = spark.createDataFrame([(0, "word " * 400_000, "en", "x"), (1, "other words", "en", "x")], "doc_id long, text string, lang string, source string")
    assert {r.doc_id: r.n_tokens for r in q.report(docs).collect()} == {0: 400_000, 1: 2}


def test_topics_are_learnt_from_all_documents(spark):
    """Three documents of 30,000 with words of their own: most samples miss them."""
    docs = spark.range(30_000).selectExpr("id as doc_id", "if(id in (7, 15000, 29999), 'quartz', 'common') as text", "'en' as lang", "'s' as source")
    got = {r.topic: r.n for r in q.report(docs).groupBy("topic").agg(F.count("*").alias("n")).collect()}
    assert sorted(got.values()) == [3, 29_997]
    assert len(q.learn_topics(docs).clusterCenters()) == 2
    kept = q.mix(docs, budget=1.0).groupBy("text").count().collect()
    assert {r.text: r["count"] for r in kept} == {"quartz": 3, "common": 29_997}


def test_sweeps_join_and_broadcast_nothing(spark, monkeypatch):
    """Three broadcasts in each of 40 sweeps were what the driver's memory held most of in the pipeline."""
    plans, settle = [], q.settle
    monkeypatch.setattr(q, "settle", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or settle(df))
    cells = spark.createDataFrame([(s, x, t, 10 + i) for i, (s, x, t) in enumerate((s, x, t) for s in "abc" for x in "de" for t in "fgh")], "source string, lang string, topic string, tokens long")
    out = q.rake(cells)
    assert len(plans) > 2 and not any("Join" in p or "Broadcast" in p for p in plans[1:])
    assert abs(out.agg(F.sum("weight")).first()[0] - 1) < 1e-9
