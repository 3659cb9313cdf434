import json

import pytest
from pyspark.sql import functions as F

from quarrylink.operators import batching
from quarrylink.plans import batch_jobs, providers
from quarrylink.sources import files


def rows(spark):
    data = [("t1", i, json.dumps({"n": i})) for i in range(6)] + [("t2", 0, "x" * 4000)] + [("t2", 1, "y")]
    return spark.createDataFrame(data, "TimelineName string, TaskRowId long, payload string").withColumn("offered", F.sequence(F.lit(1), F.lit(3)))


def test_round_trip_in_several_files(spark, tmp_path):
    seen = []

    def answer(request):
        seen.append(request["custom_id"])
        if request["custom_id"] == "t1::3":
            return None
        return '```json\n{"task_class":"ENG_DOC","confidence":"HIGH","reason_short":"r","links":[{"candidate_id":2,"confidence":0.8}]}\n```'

    client = batch_jobs.LocalClient(answer)
    skipped = batch_jobs.submit(rows(spark), client, str(tmp_path / "job"), "classify", "m", "s", most=700)
    assert [tuple(r)[:2] for r in skipped.collect()] == [("t2", 0)]
    assert len(client.done) > 2 and sorted(seen) == sorted([f"t1::{i}" for i in range(6)] + ["t2::1"])
    manifest = files.read_manifest(spark, str(tmp_path / "job/manifest"))
    assert manifest["batch_ids"] == sorted(client.done, key=lambda b: int(b.split("-")[1])) and manifest["kind"] == "classify"
    got = batch_jobs.collect(spark, client, str(tmp_path / "job"), sleep=lambda _: None)
    classes = {(r.TimelineName, r.TaskRowId): (r.TaskClass, r.TaskClassReason) for r in batch_jobs.collected_classes(got).collect()}
    assert len(classes) == 8 and classes["t1", 0] == ("ENG_DOC", "r")
    assert classes["t1", 3] == classes["t2", 0] == ("OTHER", providers.FALLBACK_REASON)
    results = {(r.TimelineName, r.TaskRowId): r.result for r in batch_jobs.collected_links(got).collect()}
    assert results["t1", 1].links[0].candidate_id == 2 and results["t1", 3].status == "llm_error"


def test_failed_batches_give_no_replies(spark, tmp_path):
    client = batch_jobs.LocalClient(lambda r: "{}")
    client.status = lambda b: "failed"
    batch_jobs.submit(rows(spark).limit(2), client, str(tmp_path / "job"), "resolve", "m", "s")
    assert all(r.reply is None for r in batch_jobs.collect(spark, client, str(tmp_path / "job"), lambda _: None).collect())


def test_samples_and_discovery(spark, tmp_path):
    df = spark.createDataFrame([("007", 1), ("b", 2)], "TimelineName string, TaskRowId long")
    files.write_sample(df, str(tmp_path / "s"))
    assert {tuple(r) for r in files.read_sample(spark, str(tmp_path / "s")).collect()} == {("007", 1), ("b", 2)}
    with pytest.raises(FileNotFoundError):
        files.list_workbooks(spark, str(tmp_path / "s"))


def test_request_line_is_json(spark):
    line = spark.range(1).select(batching.request_line(F.lit("a::1"), "m", "s", F.lit('{"x":"é"}'))).first()[0]
    body = json.loads(line)
    assert body["custom_id"] == "a::1" and body["body"]["messages"][1]["content"] == '{"x":"é"}' and body["body"]["temperature"] == 0
