import random

import pytest
import sentencepiece

from quarrylink.llm import piece_transducer as q


@pytest.fixture(scope="module")
def transducer():
    with open(q.MODEL, "rb") as f:
        return q.compile_model(f.read())


def test_equals_the_library(transducer):
    r = random.Random(9)
    letters = "ab the in  \n▁é漢字😀\t..12 <>{}()  aaaa"
    cases = ["", " ", "x", "<s>", "<0x41>", *("".join(r.choice(letters) for _ in range(r.randrange(70))) for _ in range(3000)), *(" " * k + "x" for k in range(40)), "a" * 500, "=-" * 300]
    want = sentencepiece.SentencePieceProcessor(model_file=q.MODEL).encode(cases)
    assert [transducer.encode(c) for c in cases] == want
    assert all(transducer.decode(ids) == c.replace("▁", " ") for c, ids in zip(cases, want, strict=True))


def test_shortest_path_is_the_only_finite_one(transducer):
    t = transducer

    def paths(text, last=q.OTHER):
        if not text:
            yield []
        for end in range(1, min(len(text), t.longest) + 1):
            i = t.ids.get(text[:end])
            if i is not None and t.merged(text[:end]) == [text[:end]] and t.together(last, i):
                for rest in paths(text[end:], i):
                    yield [i, *rest]

    for part in ("▁interesting", "▁▁▁x", "unhappiness", "▁1234"):
        assert list(paths(part)) == [[t.ids[p] for p in t.merged(part)]] == [t._path_of_merges(part)]


def test_unigram_models_take_the_path_of_least_weight(transducer):
    scores = {"a": -1.0, "b": -1.0, "ab": -1.5, "abc": -9.0, "c": -2.0}
    own = object.__new__(q.Transducer)
    own.ids, own.scores, own.longest, own.worst = {p: i for i, p in enumerate(scores)}, list(scores.values()), 3, -20.0
    assert own._path_of_scores("abcx") == [2, 4, "x"]


def test_frames(make):
    texts = ["Hello  world\n", None, "", "▁", "é" * 30000, "Hello  world\n"]
    rows = {r.doc_id: r for r in q.encode(make(texts, extra=True)).collect()}
    assert [rows[i].round_trip for i in range(6)] == [True, True, True, False, True, True]
    assert rows[1].ids == rows[2].ids == [] and rows[0].ids == rows[5].ids and all(r.n_tokens == len(r.ids) for r in rows.values())
    assert q.encode(make([])).collect() == []
