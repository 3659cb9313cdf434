import random
import re

from pyspark.sql import functions as F

from quarrylink.llm import quality_rules as q


def brute(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    twice = {w for w in windows if windows.count(w) > 1}
    inside = {i + k for i, w in enumerate(windows) if w in twice for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside)


def test_statistics_equal_brute_force(make):
    r = random.Random(3)
    texts = ["", None, " \n\t ", "a", "a b", "a b c", "a b c a b c", "x\n\n x\nx", "# a | é b\x0bz"]
    texts += [" ".join(r.choice(["a", "b", "é", "#x", "|", "dd\n", "a\n"]) for _ in range(r.randrange(80))) for _ in range(60)]
    rows = q.report(make(texts, extra=True)).collect()
    assert len(rows) == len(texts)
    for row in rows:
        assert tuple(row[1:6]) == brute(texts[row.doc_id]), texts[row.doc_id]
        n, repeated = row.n_words, row.n_repeat_words
        assert row.base_failed == (n < 50 or 100 * repeated > 50 * n)
        assert not (row.base_failed and row.kept)


def test_cascade_keeps_prose_and_all_columns(make):
    prose = " ".join(f"word{i} and" for i in range(60))
    docs = make([prose, prose, None, "", "THE BIG " * 60, "a | b " * 60], extra=True)
    kept = q.keep(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [0, 1]
    assert [r.name for r in q.cascade_order(docs, q._for_text())][0] in {r.name for r in q._for_text()}


def test_empty_table(make):
    assert q.report(make([])).collect() == [] and q.keep(make([])).collect() == []


def test_cheap_and_selective_rules_come_first(make):
    docs = make([f"{'bad ' if i % 3 else ''}text number {i} " * 40 for i in range(300)])
    slow = F.col("text")
    for k in range(60):
        slow = F.regexp_replace(slow, f"(n+u+m+b+e+r+ )({k}+)", "$2$1")
    named = [
        q.Rule("slow", F.contains(slow, F.lit("bad"))), q.Rule("never", F.col("text") == "none"),
        q.Rule("quick", F.col("text").startswith("bad")), q.Rule("same", F.col("text").contains("bad")),
    ]
    for _ in range(2):
        got = q.cascade(docs, named)
        assert got[0].rule.name in ("quick", "same") and abs(got[0].rejects - 2 / 3) < 0.01
        assert all(m.rejects == 0 for m in got[1:])  # the others reject nothing that the first leaves
    cost = {m.rule.name: m.cost for m in got}
    assert cost["slow"] > 5 * cost["quick"]


def test_very_long_text(make):
    rows = q.report(make(["word " * 300_000, "one two three " + "x" * 500_000])).collect()
    assert {(r.doc_id, r.n_words, r.base_failed) for r in rows} == {(0, 300_000, True), (1, 4, True)}
