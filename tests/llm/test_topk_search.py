import math
import random

from pyspark.sql import functions as F

from quarrylink.llm import topk_search as q


def test_equals_brute_force_with_ties_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(q, "QUERY_BLOCK", 3)
    r = random.Random(4)
    rows = [(i, [r.choice([-0.5, 0.0, 0.25, 1 / 3]) for _ in range(4)]) for i in range(400)]
    rows += [(50, rows[50][1]), (1000, None), (1050, [1.0, None, 0.0, 0.0]), (1100, [math.nan] * 4), (1150, [math.inf] * 4), (1200, [1.0, 2.0]), (1201, [3.0, 4.0]), (1250, []), (None, [1.0] * 4)]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, score string").repartition(7)
    got = {}
    for row in q.search(df, F.col("vec_id") % 50 == 0).collect():
        got.setdefault(row.query_id, []).append((row["rank"], row.vec_id, row.score))
    good = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    for i, v in good:
        if i % 50 == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), j) for j, w in good if j != i and len(w) == len(v))[:5]
            assert sorted(got.get(i, [])) == [(k, j, -s) for k, (s, j) in enumerate(best, 1)]
    assert set(got) <= {i for i, _ in good if i % 50 == 0}


def test_empty_table(spark):
    assert q.search(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.col("vec_id") % 50 == 0).collect() == []


def test_large_finite_components_are_exact_or_the_nearest_long(spark):
    r = random.Random(9)
    rows = [(i, [r.uniform(-1, 1) for _ in range(3)]) for i in range(120)]
    rows += [(200, [1e6, 2.0, -1.0]), (201, [1e12, 0.5, 0.25]), (250, [1e20, 1.0, 0.0]), (251, [-1e20, 1.0, 0.0]), (252, [1.7e308, 0.0, 0.0]), (300, [0.0, 1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = {}
    for row in q.search(df, F.col("vec_id") % 50 == 0).collect():
        got.setdefault(row.query_id, []).append((row["rank"], row.vec_id, row.score))
    whole = lambda x: 256 * int(x) if abs(x) >= 2**53 else math.floor(256 * x)
    clip = lambda x: max(-(2**63) + 1, min(2**63 - 1, x))
    good = [(i, [whole(x) for x in v]) for i, v in rows]
    for i, v in good:
        if i % 50 == 0:
            best = sorted((-clip(sum(a * b for a, b in zip(v, w, strict=True))), j) for j, w in good if j != i)[:5]
            assert sorted(got[i]) == [(k, j, -s) for k, (s, j) in enumerate(best, 1)]
