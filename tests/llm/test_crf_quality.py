import itertools
import zlib

import numpy as np

from quarrylink.llm import crf_quality as q


def test_marginals_equal_enumeration():
    r = np.random.default_rng(1)
    for n in (1, 2, 5):
        u, t = r.normal(size=n), r.normal(size=(2, 2))
        weight, total = np.zeros(n), 0.0
        for y in itertools.product((0, 1), repeat=n):
            w = np.exp(sum(u[i] * y[i] for i in range(n)) + sum(t[a, b] for a, b in itertools.pairwise(y)))
            total += w
            weight += w * np.array(y)
        assert np.allclose(q.marginals(u, t), weight / total)
        good, _ = q._expectations(np.pad(u, (0, 2))[None, :], (np.arange(n + 2) < n)[None, :], t)
        assert np.allclose(good[0, :n], weight / total) and not good[0, n:].any()


def texts():
    good = [f"Some plain words stand here in line {i}.\nAnd more of them follow, as they do {i}." for i in range(80)]
    bad = [f"BUY!! NOW!! {i}\nx | x | x | x\n$$$ ### $$$ {i}" for i in range(80)]
    return good + bad


def test_learns_and_scores_held_out_documents(spark, make):
    rows = texts()
    docs = make([*rows, "", None, rows[0]], extra=True)
    labels = spark.createDataFrame([(i, int(i < 80), 0) for i in range(160)] + [(5, None, 0), (None, 1, 0), (999, 1, 0)], "doc_id long, quality int, toxic int")
    out = {r.doc_id: r for r in q.score(docs, q.train(docs, labels)).collect()}
    assert len(out) == 163 and all(0 <= r.score <= 1 for r in out.values())
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in out.items())
    held = [r for i, r in out.items() if i < 160 and r.held_out]
    assert np.mean([r.predicted == int(r.doc_id < 80) for r in held]) > 0.95
    assert out[160].score == out[161].score and out[162].score == out[0].score


def test_without_labels(spark, make):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = make(["a"])
    assert [(r.score, r.predicted) for r in q.score(docs, q.train(docs, none)).collect()] == [(0.5, 0)]
    assert q.score(make([]), None).collect() == []


def test_lines_of_one_document_are_told_apart():
    """Documents are labelled, lines are not; some documents hold a run of lines of the other kind."""
    r = np.random.default_rng(2)
    good = lambda: " ".join(r.choice(["plain", "words", "stand", "here", "and", "follow", "them"], 14)) + "."
    bad = lambda: " ".join(r.choice(["BUY!!", "$$$", "x |", "###", "NOW!!", "100%"], 9))
    docs, truth, labels = [], [], []
    for k in range(240):
        kind = int(k % 2)
        own = [kind] * 8
        if k % 3 == 0:
            own[3:5] = [1 - kind] * 2
        docs.append("\n".join(good() if y else bad() for y in own))
        truth.append(own)
        labels.append(kind)
    features, sizes, counts = q.line_features(docs)
    field = q.fit(features, counts, np.array(labels), sizes)
    potentials, hits, mixed = field.potentials(features), [], []
    for k, own in enumerate(truth):
        got = q.marginals(potentials[8 * k : 8 * k + 8], field.transition) > 0.5
        hits.append(np.mean(got == np.array(own, bool)))
        if k % 3 == 0:
            mixed.append(hits[-1])
    assert np.mean(hits) > 0.95 and np.mean(mixed) > 0.9
    assert [int(x >= 0.5) for x in q.score_texts(field, docs)] == labels


def test_gradient_is_that_of_the_expected_likelihood():
    r = np.random.default_rng(3)
    x, goal, counts = r.normal(size=(6, 2)), r.uniform(size=6), np.array([4, 2])
    field = q._fit(x, counts, goal)

    def likelihood(weights, bias, t):
        f = q.Field(field.mean, field.scale, weights, bias, t)
        u, total, at = f.potentials(x), 0.0, 0
        for n in counts:
            own, g = u[at : at + n], goal[at : at + n]
            z = np.log(sum(np.exp(sum(own[i] * y[i] for i in range(n)) + sum(t[a, b] for a, b in itertools.pairwise(y))) for y in itertools.product((0, 1), repeat=n)))
            pairs = sum(t[a, b] * (g[i] if a else 1 - g[i]) * (g[i + 1] if b else 1 - g[i + 1]) for i in range(n - 1) for a in (0, 1) for b in (0, 1))
            total += ((own @ g) + pairs - z) / n / len(counts)
            at += n
        return total - q.RIDGE / 2 * ((weights**2).sum() + bias**2 + (t**2).sum())

    best = likelihood(field.weights, field.bias, field.transition)
    for k in range(2):
        for d in (-0.2, 0.2):
            assert likelihood(field.weights + d * np.eye(2)[k], field.bias, field.transition) < best
    for d in (-0.2, 0.2):
        assert likelihood(field.weights, field.bias + d, field.transition) < best
        assert likelihood(field.weights, field.bias, field.transition + d * np.eye(2)) < best


def test_very_long_text():
    text = "a plain line of words\n" * 20_000
    assert 0 <= q.score_texts(None, [text])[0] <= 1 and q.line_features([text])[2][0] == 20_000
