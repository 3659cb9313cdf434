import re

import pytest
from pyspark.sql import functions as F

from quarrylink.functions import dates, numbers, text, vectors


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column(F.col("v")).alias("r")).first().r


@pytest.mark.parametrize(("value", "want"), [
    ("E-Pump datasheet issue", "Pump datasheet issue"), ("CIVIL-Slab", "CIVIL-Slab"), ("-Lead dash", "Lead dash"), (None, ""),
    ("ABCD - P&ID (rev 2)", "ABCD - P&ID (rev 2)"), ("ABC - x-y ", "x-y"), ("no dash", "no dash"),
])
def test_remove_prefix(spark, value, want):
    assert one(spark, text.remove_prefix, value) == want


@pytest.mark.parametrize(("value", "want"), [("P&ID (rev 2) Ä", "p and id"), (None, ""), ("A--b  c", "a b c"), ("(x)(y)", "")])
def test_normalize(spark, value, want):
    assert one(spark, text.normalize, value) == want


def test_codes_names_and_labels(spark):
    assert one(spark, text.extract_project_code, "Plan 12345 v2 6789") == "12345"
    assert one(spark, text.extract_project_code, "Plan 123") == "Plan 123"
    assert text.normalize_column_name(" Task  Name (x) ") == one(spark, text.column_name, " Task  Name (x) ") == "task_name_x"
    assert one(spark, text.task_class, " eng_doc ") == "ENG_DOC" and one(spark, text.task_class, "maybe") is None
    assert one(spark, text.confidence_label, "sure") == "LOW" and one(spark, text.confidence_label, None) == "LOW"
    assert one(spark, text.strip_fence, '```json\n{"a":1}\n```') == '{"a":1}' and one(spark, text.strip_fence, " x ") == "x"
    assert one(spark, text.line_bytes, "é") == 3 and len(one(spark, text.cell_text, "x" * 40000)) == 32767
    assert one(spark, text.text_hash, " a \n b ") == one(spark, text.text_hash, "a b") != one(spark, text.text_hash, None)


def test_task_and_candidate_texts(spark):
    assert one(spark, lambda v: text.task_text(v, F.lit(None).cast("string")), "E-x") == "Task name: x\nWBS: \nTask class: ENG_DOC"
    whole = one(spark, lambda v: text.candidate_text(v, v, F.lit(None).cast("string"), v, v, v, v), "t")
    assert re.fullmatch(r"(?:[A-Za-z ]+: t?\n){6}[A-Za-z ]+: t", whole)


def test_numbers(spark):
    clamp = lambda v: one(spark, numbers.clamp01, v, "double")
    assert (clamp(85.0), clamp(-1.0), clamp(0.5), clamp(float("nan"))) == (1.0, 0.0, 0.5, 0.0)
    assert one(spark, lambda v: numbers.clamp01(v, True), float("nan"), "double") == 1.0
    assert one(spark, numbers.safe_float, "80%") == 0.0 and one(spark, numbers.safe_float, "0.8") == 0.8


def test_dates(spark):
    df = spark.createDataFrame([(None, "2024-01-02", "01-Jan-24 A", "u")], "`Start` string, `Planned Start` string, `Finish Date` string, update_user string")
    row = dates.add_date_columns(df).first()
    assert (row.task_start_date, row.task_finish_date, row.task_actual_start_date) == ("2024-01-02", "01-Jan-24 A", None)
    assert row.task_date_fields_json == '{"Finish Date":"01-Jan-24 A","Planned Start":"2024-01-02","update_user":"u"}'
    assert one(spark, dates.parse_time, "01-Jan-24 A") is None and one(spark, dates.parse_time, "2024-01-02T03:04:05").hour == 3


def test_vectors(spark):
    v = spark.createDataFrame([([3.0, 4.0], [0.0, 0.0], [1.0])], "a array<float>, z array<float>, s array<float>")
    r = v.select(vectors.norm("a").alias("n"), vectors.normalise(F.col("a")).alias("u"), vectors.normalise(F.col("z")).alias("z"), vectors.cosine(F.col("a"), F.col("s")).alias("c"), vectors.from_blob(vectors.to_blob("a")).alias("b")).first()
    assert r.n == 5.0 and [round(x, 5) for x in r.u] == [0.6, 0.8] and r.z == [0.0, 0.0] and r.c == 0.0 and r.b == [3.0, 4.0]
    with pytest.raises(Exception, match="vector sizes differ"):
        v.select(vectors.same_size(F.col("a"), F.col("s"))).collect()


def test_reply_text(spark):
    import json

    line = lambda content: json.dumps({"custom_id": "a", "response": {"body": {"choices": [{"message": {"content": content}}]}}})
    assert one(spark, text.reply_text, line(" x ")) == "x"
    assert one(spark, text.reply_text, line([{"type": "text", "text": "a"}, {"type": "image"}, {"type": "text", "text": " b"}])) == "a\nb"
    assert one(spark, text.reply_text, '{"response":{"body":{"choices":[]}}}') is None and one(spark, text.reply_text, "{bad") is None


def test_unique_id(spark):
    ids = [one(spark, lambda v, n=n: text.unique_id(v, F.lit(n)), "t") for n in (1, 2, 1)]
    assert ids[0] == ids[2] != ids[1] and len(ids[0]) == 32
