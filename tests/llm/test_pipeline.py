import random

import pytest
import sentencepiece as spm

from quarrylink.llm.piece_transducer import MODEL

from . import test_line_dedup_full as full

c = pytest.importorskip("corpus_pipeline")


def test_each_stage_keeps_columns_and_the_last_returns_tokens(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    before = docs.count()
    for name, stage in c.STAGES[:-1]:
        out = stage(spark, docs, "/root/testdata/sf0.001")
        assert out.columns == docs.columns, name
        n = out.count()
        assert 0 < n <= before
        docs, before = out, n
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    rows = c.run(spark, "/root/testdata/sf0.001").collect()
    assert {r.doc_id for r in rows} == ids and all(r.round_trip for r in rows)


@pytest.mark.parametrize("k", range(5))
def test_stages_take_empty_tables(spark, make, k):
    assert c.STAGES[k][1](spark, make([]), "").count() == 0


def test_stages_equal_brute_force(spark, make):
    """What each of the first three stages keeps of a small fixture, and the pieces of the rest by the library."""
    r = random.Random(7)
    word = lambda: "".join(r.choice("abcdefghijklmnop") for _ in range(r.randrange(3, 9)))
    line = lambda: " ".join(word() for _ in range(14))
    lines = [[line() for _ in range(6)] for _ in range(14)]
    lines[3][2] = lines[1][4]  # an exact copy of a line
    lines[5][0] = lines[2][1][:-1] + "?"  # a near one
    texts = ["\n".join(x) for x in lines]
    rows = [*enumerate(texts), (20, "too few words"), (21, None), (22, ""), (23, "SHOUT " * 60), (24, texts[0]), (24, texts[0])]
    docs = make(rows, extra=True)
    good = c.good(spark, docs, "")
    assert sorted(x.doc_id for x in good.collect()) == [*range(14), 24, 24]

    gone = full.brute([x for x in rows if x[0] < 14 or x[0] == 24])
    clean = {x.doc_id: x.text for x in c.lines(spark, good, "").collect()}
    want = {i: "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone.get(i, ())) for i, t in rows if i < 14 or i == 24}
    assert clean == {i: t for i, t in want.items() if t}
    assert gone == {3: {2}, 5: {0}, 24: set(range(6))}

    near = " ".join([*texts[6].split()[:-1], "other"])
    one = c.distinct(spark, make([*rows[:14], (30, near), (31, texts[7]), (31, texts[7])]), "")
    assert sorted(x.doc_id for x in one.collect()) == list(range(14))

    pieces = spm.SentencePieceProcessor(model_file=MODEL)
    for x in c.tokens(spark, docs, "").collect():
        text = dict(rows)[x.doc_id] or ""
        assert x.ids == pieces.encode(text) and x.n_tokens == len(x.ids)


def test_mixing_knows_topics_of_few_documents(spark):
    """Three documents of 30,000 are a topic of their own, smaller than its share, so all of them stay."""
    docs = spark.range(30_000).selectExpr("id as doc_id", "if(id in (7, 15000, 29999), 'quartz', 'common') as text", "'en' as lang", "'s' as source", "6L as n_chars")
    assert c.mixed(spark, docs, "").where("text = 'quartz'").count() == 3
