import random

import numpy as np

from quarrylink.llm import ngram_join as q


def words_set(text):
    w = (text or "").split()
    return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else None


def similar(a, b):
    n = len(a & b)
    return n >= 0.8 * (len(a) + len(b) - n)


def texts():
    r = random.Random(11)
    vocabulary = [f"w{i}" for i in range(400)]
    base = [[r.choice(vocabulary) for _ in range(r.randrange(3, 160))] for _ in range(25)]
    out = []
    for i in range(120):
        w = list(r.choice(base))
        for _ in range(r.randrange(3)):
            w[r.randrange(len(w))] = r.choice(vocabulary)
        out.append((i, " ".join(w)))
    return out + [(200, ""), (201, None), (202, "  "), (203, "one two"), (204, "one  two\n"), (0, out[0][1])]


def test_classes_links_and_groups_equal_brute_force(make):
    rows = texts()
    got = {(r.doc_id): r for r in q.join(make(rows, extra=True)).collect()}
    classes = {}
    for i, t in rows:
        classes.setdefault(words_set(t) or ("empty", i), set()).add(i)
    sets = [s for s in classes if isinstance(s, frozenset)]
    links = {s: [o for o in sets if o is not s and similar(s, o)] for s in sets}
    for s in sets:
        group, todo = {s}, [s]
        while todo:
            new = [o for o in links[todo.pop()] if o not in group]
            group |= set(new)
            todo += new
        least = min(min(classes[o]) for o in group)
        for i in classes[s]:
            assert (got[i].class_id, got[i].n_links, got[i].group_id) == (min(classes[s]), len(links[s]), least)
    assert all((got[i].class_id, got[i].n_links) == (i, 0) for i in (200, 201, 202))
    assert got[204].class_id == 203


def test_group_larger_than_a_block(make, monkeypatch):
    monkeypatch.setattr(q, "BLOCK_CLASSES", 16)
    base = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join([*base, f"end{i}"])) for i in range(70)]
    got = q.join(make(rows)).collect()
    assert {(r.n_links, r.group_id) for r in got} == {(69, 0)}


def test_matrix_and_pairwise_counts_agree():
    r = np.random.default_rng(1)
    sets = [np.unique(r.integers(0, 9000, 300, dtype=np.uint64)) for _ in range(60)]
    i, j = np.nonzero(np.ones((60, 60)))
    want = [np.intersect1d(sets[a], sets[b]).size for a, b in zip(i, j, strict=True)]
    assert q.shared(sets, sets, i, j).tolist() == want and len(i) > q.MANY


def test_pruning_never_drops_what_a_posterior_supports():
    cuts = q.least_matches()
    assert len(cuts) == 5 and all(a < b for a, b in zip(cuts, cuts[1:], strict=False)) and cuts[-1] < 0.8 * 125


def test_dedup_keeps_one_of_each_group_and_all_columns(make):
    base = " ".join(f"w{i}" for i in range(50))
    docs = make([(5, base), (3, base + " x"), (3, base + " x"), (9, "other text altogether, kept"), (10, ""), (11, None)], extra=True)
    out = q.dedup(docs)
    assert out.columns == docs.columns
    assert sorted(r.doc_id for r in out.collect()) == [3, 9, 10, 11]


def test_empty_table(make):
    assert q.join(make([])).collect() == [] and q.dedup(make([])).collect() == []
