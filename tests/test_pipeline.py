import json

import pytest
from pyspark.sql import functions as F

from quarrylink.plans import providers, report, stages
from quarrylink.sources.config import Settings, parse_config
from quarrylink.sources.landing import load_tasks
from quarrylink.sources.storage import Store
from quarrylink.sources.workbook import read_sheet, sheet_rows, write_workbook
from quarrylink.streaming import refresh

HEAD = ["Task Code", " Task Name", "wbs_id", "start", "Finish Date"]
TASKS = [("A100", "E-Pump datasheet issue", 10, "2024-01-02", None), ("A110", "CIVIL-Slab", 10, None, "01-Jan-24 A"), ("A120", "Valve specification review", 11, None, None), ("A130", None, 99, None, None)]
WBS = (["wbs_id", "wbs_name", "wbs_short_name"], [(10, "Process", "PR"), (11, "Civil", "CV"), (11, "Civil dup", "CV2")], [])


@pytest.fixture
def folder(tmp_path):
    f = tmp_path / "books"
    f.mkdir()
    write_workbook(str(f / "Plan 12345.xlsx"), {"TASK": (HEAD, TASKS, []), "PROJWBS": WBS})
    write_workbook(str(f / "Bare.xlsx"), {"TASK": (["x"], [("1",)], [])})
    (f / "Broken.xlsx").write_bytes(b"no zip")
    return str(f)


def test_workbook_round_trip(tmp_path):
    path = tmp_path / "a.xlsx"
    write_workbook(str(path), {"S & T": (["a", "b"], [("x<y", 1), ("", 2.5), ("é\x01", None)], [5, 9])}, {"x<y": "FF0000"})
    assert list(read_sheet(path.read_bytes(), "S & T")) == [{"a": "x<y", "b": "1"}, {"b": "2.5"}, {"a": "é"}]
    with pytest.raises(ValueError, match="no sheet"):
        list(read_sheet(path.read_bytes(), "other"))


def test_landing(spark, folder):
    tasks, problems = load_tasks(spark, folder)
    rows = tasks.orderBy("TaskRowId").collect()
    assert [(r.TaskCode, r.WbsName, r.ProjectCode) for r in rows] == [("A100", "Process", "12345"), ("A110", "Process", "12345"), ("A120", "Civil", "12345"), ("A130", "", "12345")]
    assert rows[0].TaskStartDate.day == 2 and rows[1].TaskFinishDate is None and json.loads(rows[1].TaskDateFieldsJson) == {"Finish Date": "01-Jan-24 A"}
    assert {r.timeline for r in problems.collect()} == {"Bare", "Broken"}
    assert sheet_rows(spark, folder, "PROJWBS", ["wbs_id"]).where("cells is not null").first().cells == {"wbs_id": "10"}


def test_store_versions(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    table = "TimelineTasksClassified"
    rows = spark.createDataFrame([("t", 1, "A"), ("t", 2, "B"), ("u", 1, "C")], "TimelineName string, TaskRowId long, TaskClass string")
    assert store.read(table).count() == 0
    store.append(table, rows, "test")
    store.append(table, rows.where("TaskRowId = 1"), "test")
    assert store.read(table).count() == 5 and stages.latest(store, table).count() == 3
    store.upsert(table, rows.where("TimelineName = 't'").withColumn("TaskClass", F.lit("Z")), "test")
    assert sorted((r.TimelineName, r.TaskClass) for r in stages.latest(store, table).collect()) == [("t", "Z"), ("t", "Z"), ("u", "C")]
    store.replace_where(table, F.col("TimelineName") == "t", rows.limit(0), "test")
    assert {r.TimelineName for r in store.read(table).collect()} == {"u"}
    with pytest.raises(Exception):  # noqa: B017
        store.write(table, rows.withColumn("TaskClass", F.raise_error(F.lit("stop"))))
    assert store.read(table).count() == 2
    assert store.vacuum(table) > 0 and store.read(table).count() == 2


@pytest.mark.parametrize(("reply", "want"), [
    ('{"task_class":" eng_doc ","confidence":"high","reason_short":"x"}', ("ENG_DOC", "HIGH", "x")), ('{"task_class":"ENG_DOC","confidence":"sure"}', ("ENG_DOC", "LOW", "")),
    ('{"task_class":"MAYBE"}', ("OTHER", "LOW", providers.FALLBACK_REASON)), ("{}", ("OTHER", "LOW", "")), ("[1]", ("OTHER", "LOW", providers.FALLBACK_REASON)), (None, ("OTHER", "LOW", providers.FALLBACK_REASON)),
])
def test_classification(spark, reply, want):
    assert tuple(spark.createDataFrame([(reply,)], "r string").select(*providers.classification(F.col("r"))).first()) == want


def test_retrying_waits_longer_each_time():
    slept, calls = [], []

    def fail():
        calls.append(1)
        raise OSError("no")

    with pytest.raises(OSError):
        providers.retrying(fail, 2, 2.0, slept.append)
    assert len(calls) == 3 and slept == [2.0, 4.0]


def test_config(tmp_path):
    (tmp_path / "c.txt").write_text("# x\n\nA = b = c\nbroken\nEMBEDDING_MODEL=m\n")
    assert parse_config(tmp_path / "c.txt") == {"A": "b = c", "EMBEDDING_MODEL": "m"} and parse_config(tmp_path / "none") == {}
    assert Settings.load(tmp_path / "c.txt").embedding_model == "m"
    with pytest.raises(ValueError, match="LLM_API_KEY"):
        Settings.load(tmp_path / "c.txt").required("LLM_API_KEY")


def test_all_stages(spark, folder, tmp_path):
    store, t = Store(spark, str(tmp_path / "s")), "Plan 12345"
    tasks, _ = load_tasks(spark, folder)
    classified = stages.classify(store, tasks, providers.RuleClassifier(), "rules")
    assert {r.TaskRowId: r.TaskClass for r in classified.collect()} == {0: "ENG_DOC", 1: "OTHER", 2: "ENG_DOC", 3: "OTHER"}
    register = spark.createDataFrame([("Pump datasheet", t), ("Pump datasheet", t), ("Valve specification", t), (" ", t), (None, t)], "Document_title string, Mdr_code_name_ref string")
    consolidated = spark.createDataFrame([("Pump datasheet", "MATCH", "k1", "Pump", 0.9, "r", "s"), ("Valve specification", "MATCH", None, "Valve", 0.8, "r", "s"), ("Other", "NO", "k3", "x", 0.1, "r", "s")], "Document_title string, ConsolidatedDecisionType string, ConsolidatedTitleKey string, ConsolidatedRaciTitle string, ConsolidatedConfidence double, ConsolidatedReason string, ConsolidatedSource string")
    descriptions = spark.createDataFrame([("k1", "about pumps")], "TitleKey string, EffectiveDescription string")
    enriched = spark.createDataFrame([("k1", "Process", "DS", "c", "ch")], "TitleKey string, DisciplineName string, TypeName string, CategoryDescription string, ChapterName string")
    views, e = (register, consolidated, descriptions, enriched), providers.HashEmbedder()
    assert stages.embed(store, *views, e) == (2, 2)
    assert stages.embed(store, *views, e) == (0, 0)
    assert stages.embed(store, *views, e, force=True) == (2, 2) and store.read(stages.CANDIDATE_VECTORS).count() == 2
    for _ in range(2):
        top = stages.retrieve(store, e.model, t)
        assert top.count() == 4 and {r.Rank for r in top.collect()} == {1, 2}
    s = Settings(embedding_model=e.model, retries=0, least_confidence=0.1)
    good = json.dumps({"links": [{"candidate_id": 1, "confidence": 0.9, "reason_short": "same"}, {"candidate_id": 2, "confidence": 0.2}]})
    notes, counts = stages.resolve_links(store, providers.ReplayResolver({"A100": good, "A120": "broken"}), s)
    assert counts.first().asDict() == {"ok": 1, "llm_error": 0, "invalid_json": 1} and notes.count() == 2
    view = stages.link_view(store)
    assert report.totals(view).first().asDict() == {"tasks": 4, "eng_doc": 2, "other": 2, "linked": 1, "rows": 5}
    links = report.link_sheet(view).orderBy("#").collect()
    assert [(r.TaskCode, r.LinkRank) for r in links] == [("A100", 1), ("A100", 2), ("A120", None)] and links[0].MdrDocumentTitle in ("Pump datasheet", "Valve specification")
    stages.resolve_links(store, providers.ReplayResolver({"A100": '{"links":[]}', "A120": "broken"}), s)
    assert store.read(stages.LINKS).count() == 0
    report.write(view, str(tmp_path / "r.xlsx"))
    assert len(list(read_sheet((tmp_path / "r.xlsx").read_bytes(), report.SHEETS[0]))) == 4
    assert report.write_csv(notes, str(tmp_path / "csv")) and not report.write_csv(notes.limit(0), str(tmp_path / "none"))


def test_streaming_refresh_is_idempotent(spark, tmp_path):
    store, land = Store(spark, str(tmp_path / "s")), str(tmp_path / "land")
    rows = spark.createDataFrame([("t", 1, "A", 1), ("t", 1, "B", 2), ("t", 2, "C", 1)], "TimelineName string, TaskRowId long, TaskClass string, version long")
    rows.write.parquet(land)
    act = refresh.upsert_into(store, "TimelineTasksClassified", ["TimelineName", "TaskRowId"], "version")
    refresh.run_available(refresh.landing(spark, land, rows.schema.simpleString()[7:-1].replace(":", " ")), act, str(tmp_path / "c"))
    act(rows, 1)
    assert sorted((r.TaskRowId, r.TaskClass) for r in store.read("TimelineTasksClassified").collect()) == [(1, "B"), (2, "C")]
