import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarrylink.operators import batching, relational, resolve, retrieval, sampling


def quotas(spark, counts, limit):
    df = spark.createDataFrame([(k, v) for k, v in counts.items()], "k string, n long")
    return {r.k: r.quota for r in sampling.proportional_quotas(df, limit, ["k"]).collect()}


@pytest.mark.parametrize(("counts", "limit", "want"), [
    ({"a": 60, "b": 30, "c": 10}, 10, {"a": 6, "b": 3, "c": 1}), ({"a": 1000, "b": 1, "c": 1}, 3, {"a": 2, "b": 1, "c": 1}),
    ({"a": 5, "b": 0}, 2, {"a": 2, "b": 0}), ({"a": 3, "b": 4}, 10, {"a": 3, "b": 4}),
])
def test_quota_cases(spark, counts, limit, want):
    assert quotas(spark, counts, limit) == want


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(0, 50), min_size=1, max_size=6), st.integers(1, 120))
def test_quota_properties(spark, sizes, limit):
    counts = {f"k{i}": n for i, n in enumerate(sizes)}
    got = quotas(spark, counts, limit)
    full, groups = sum(sizes), sum(n > 0 for n in sizes)
    assert all(0 <= got[k] <= counts[k] for k in counts)
    assert sum(got.values()) >= min(limit, full) and sum(got.values()) <= max(min(limit, full), min(limit, full) + groups)
    if limit >= groups:
        assert all(got[k] for k in counts if counts[k])


def test_seeded_sample_is_repeatable_and_reused(spark):
    df = spark.range(100).select(F.when(F.col("id") < 70, "a").otherwise("b").alias("k"), "id")
    first = sampling.reuse_or_sample(df, None, 20, ["k"], "id").collect()
    assert sorted(first) == sorted(sampling.reuse_or_sample(df, None, 20, ["k"], "id").collect()) and len(first) == 20
    saved = df.where("id % 5 = 0")
    assert sampling.sample_fits(saved, sampling.proportional_quotas(sampling.group_counts(df, ["k"]), 20, ["k"]), ["k"])
    assert {r.id for r in sampling.reuse_or_sample(df, saved, 20, ["k"], "id").collect()} == set(range(0, 100, 5))


def test_packing(spark):
    rows = [("g", i, n) for i, n in enumerate([5, 5, 5, 9, 1, 11])]
    got = batching.pack(spark.createDataFrame(rows, "g string, i long, bytes long"), "g", "i", most=10).orderBy("i").collect()
    assert [r.chunk for r in got] == [0, 0, 1, 2, 2, None]


def test_next_limit():
    assert [batching.next_limit(800, True), batching.next_limit(1000, True), batching.next_limit(1200, False), batching.next_limit(100, False)] == [1000, 1200, 600, 100]


def test_adaptive_run_ends(spark):
    pending = spark.range(1000)
    spark.sparkContext.setCheckpointDir("/tmp/quarrylink-tests")
    done, seen = batching.run_adaptive(pending, "id", lambda t: t.where("id % 2 = 0"), ["id"], rounds=3)
    assert seen.sent == [800, 400 if math.floor(800 * 0.5) == 400 else 0, 200] and done.count() + seen.left == 1000
    done, seen = batching.run_adaptive(pending, "id", lambda t: t.limit(0), ["id"])
    assert done.count() == 0 and seen.sent[-1] == 100


def test_wait():
    states = iter(["queued", "running", "canceled"])
    slept = []
    assert batching.wait(lambda: next(states), slept.append, 3) == "canceled" and slept == [3, 3]


def test_versions_refresh_and_upsert(spark):
    v = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 1), (None, "d", 5)], "k long, TextHash string, t long")
    last = relational.latest_per_key(v, ["k"], relational.newest_first("t"))
    assert {(r.k, r.TextHash) for r in last.collect()} == {(1, "b"), (2, "c"), (None, "d")}
    new = spark.createDataFrame([(1, "b", 9), (2, "x", 9), (None, "d", 9), (3, "n", 9)], "k long, TextHash string, t long")
    assert {r.k for r in relational.to_refresh(new, last, ["k"]).collect()} == {2, 3}
    assert relational.to_refresh(new, last, ["k"], force=True).count() == 4
    once = relational.upsert(last, new, ["k"])
    assert sorted(map(str, once.collect())) == sorted(map(str, relational.upsert(once, new, ["k"]).collect())) and once.count() == 4


def test_replace_scope_and_missing(spark):
    old = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "k long, v string")
    out = relational.replace_scope(old, old.where("k < 3"), old.where("k = 1").withColumn("v", F.lit("new")), ["k"])
    assert {tuple(r) for r in out.collect()} == {(1, "new"), (3, "z")}
    filled = relational.fill_missing(old.select("k"), old.where("k = 2"), ["k"], {"v": "none"})
    assert {tuple(r) for r in filled.collect()} == {(1, "none"), (2, "y"), (3, "none")}


def _vectors(spark, n, dim, name, seed):
    r = np.random.default_rng(seed)
    rows = [(f"b{i % 3}", i, [float(x) for x in r.integers(-3, 4, dim)]) for i in range(n)]
    return rows, spark.createDataFrame(rows, f"block string, {name} long, vector array<float>")


def test_topk_equals_brute_force_in_both_forms(spark, monkeypatch):
    monkeypatch.setattr(retrieval, "CANDIDATE_CHUNK", 16)
    monkeypatch.setattr(retrieval, "QUERY_CHUNK", 8)
    q_rows, q = _vectors(spark, 30, 4, "query", 1)
    c_rows, c = _vectors(spark, 100, 4, "candidate", 2)
    want = set()
    for block, i, v in q_rows:
        scored = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), j) for other, j, w in c_rows if other == block)
        want |= {(block, i, j, -s, k) for k, (s, j) in enumerate(scored[:7], 1)}
    for form in (retrieval.topk_by_blocks, retrieval.topk_by_expression):
        assert {tuple(r) for r in form(q, c, "block", 7).select("block", "query", "candidate", "similarity", "rank").collect()} == want


def test_topk_refuses_other_sizes(spark):
    q = spark.createDataFrame([("b", 1, [1.0, 0.0])], "block string, query long, vector array<float>")
    c = spark.createDataFrame([("b", 1, [1.0])], "block string, candidate long, vector array<float>")
    for form in (retrieval.topk_by_blocks, retrieval.topk_by_expression):
        with pytest.raises(Exception, match="vector sizes differ"):
            form(q, c, "block", 1).collect()


def test_topk_plan_limits_groups_below_the_shuffle(spark):
    _, q = _vectors(spark, 30, 4, "query", 1)
    _, c = _vectors(spark, 100, 4, "candidate", 2)
    plan = retrieval.topk_by_expression(q, c, "block", 3)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Python" not in plan


@pytest.mark.parametrize(("reply", "status", "links", "counts"), [
    ('{"links":[]}', "ok", {}, (0, 0, 0, 0)), ("{}", "ok", {}, (0, 0, 0, 0)), ('{"links":null}', "invalid_json", {}, (0, 0, 0, 0)), ("[1]", "invalid_json", {}, (0, 0, 0, 0)),
    ("nonsense {", "invalid_json", {}, (0, 0, 0, 0)), (None, "llm_error", {}, (0, 0, 0, 0)),
    ('{"links":[{"candidate_id":1,"confidence":0.9},7,{"candidate_id":9}]}', "ok", {1: 0.9}, (3, 1, 2, 0)),
    ('{"links":[{"candidate_id":"2","confidence":"0.8"},{"candidate_id":2,"confidence":0.95}]}', "ok", {2: 0.95}, (2, 1, 0, 1)),
    ('{"links":[{"candidate_id":3.7,"confidence":85},{"candidate_id":"3.0"}]}', "ok", {3: 1.0}, (2, 1, 1, 0)),
    ('```json\n{"links":[{"candidate_id":1,"confidence":"80%"}]}\n```', "ok", {1: 0.0}, (1, 1, 0, 0)),
])
def test_validated_replies(spark, reply, status, links, counts):
    df = spark.createDataFrame([(reply, [1, 2, 3])], "r string, o array<int>")
    r = df.select(resolve.validated(F.col("r"), F.col("o")).alias("x")).first().x
    assert r.status == status and {x.candidate_id: x.confidence for x in r.links} == links
    assert (r.raw_links_count, r.valid_links_count, r.dropped_invalid_count, r.duplicate_candidate_count) == counts


def test_chosen_links_and_diagnostics(spark):
    reply = '{"links":[{"candidate_id":1,"confidence":0.75},{"candidate_id":2,"confidence":0.9},{"candidate_id":3,"confidence":0.9,"reason_short":"%s"},{"candidate_id":4,"confidence":0.74}]}' % ("x" * 400)
    top = spark.createDataFrame([("t", 1, i, s) for i, s in ((1, 0.9), (2, 0.5), (3, 0.6), (4, 0.4))], "TimelineName string, TaskRowId long, RetrievalRank int, Similarity double")
    resolved = spark.createDataFrame([("t", 1, reply, [1, 2, 3, 4])], "TimelineName string, TaskRowId long, r string, o array<int>").select("TimelineName", "TaskRowId", resolve.validated(F.col("r"), F.col("o")).alias("result"))
    rows = resolve.chosen(resolved, top, most=2).orderBy("LinkRank").collect()
    assert [(r.RetrievalRank, r.LinkRank) for r in rows] == [(3, 1), (2, 2)] and len(rows[0].LinkReason) == 300
    note = resolve.diagnostics(resolved, most=2).first()
    assert (note.RawLinkCount, note.ValidLinkCount, note.SavedLinkCount, note.DroppedByThreshold) == (4, 4, 2, 1)
    assert resolve.status_counts(resolved).first().asDict() == {"ok": 1, "llm_error": 0, "invalid_json": 0}


def test_batch_replies_last_wins(spark):
    ok = '{"custom_id":"a","response":{"body":{"choices":[{"message":{"content":"%s"}}]}}}'
    rows = [(ok % "1", 0), ("", 1), ("{", 2), ('{"response":{}}', 3), (ok % "2", 4)]
    got = batching.replies(spark.createDataFrame(rows, "value string, pos long")).collect()
    assert [tuple(r) for r in got] == [("a", "2")]


def test_observed_counts_rows(spark):
    df, seen = relational.observed(spark.range(7), "seven")
    df.write.format("noop").mode("overwrite").save()
    assert seen.get["rows"] == 7
