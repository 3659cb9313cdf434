"""Queries that drive the stages' operators over the driver's tables, each with its SQL.

``orders`` and ``lineitem`` stand in for schedule tasks and their offered candidates: an order's priority is a
timeline, its key a task's row, and a line's number the rank of a candidate.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text, vectors
from ..operators import batching, resolve, retrieval, sampling
from ..session import table
from ..sources import landing, schemas
from ..sources.storage import Store
from . import report, stages
from .catalogue import TOPK_SQL, query

TASK = ["TimelineName", "TaskRowId"]


class Frames:
    """Tables by name, where a stage only reads."""

    def __init__(self, **tables: DataFrame):
        self.tables = tables

    def read(self, name: str) -> DataFrame:
        return self.tables[name]


def _store(spark: SparkSession) -> Store:
    """A store of its own below the folder that all executors share."""
    context = spark.sparkContext
    root = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not context.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = f"{spark.conf.get('spark.sql.warehouse.dir')}/quarrylink"
    return Store(spark, f"{root}/store-{uuid.uuid4().hex}")


@query("""
WITH c AS (SELECT p_name AS title, CASE WHEN min(p_size) % 2 = 0 THEN 'MATCH' ELSE 'NEW' END AS decision, min(p_type) AS key, min(p_brand) AS raci FROM part GROUP BY p_name),
d AS (SELECT p_type AS key, min(p_brand) AS description FROM part GROUP BY p_type),
e AS (SELECT p_type AS key, 'D ' || p_type AS discipline, max(p_size)::VARCHAR AS kind FROM part WHERE p_size < 25 GROUP BY p_type),
r AS (SELECT DISTINCT p_name AS title, p_brand AS timeline FROM part WHERE p_name IS NOT NULL AND trim(p_name) <> ''),
j AS (SELECT DISTINCT r.title, r.timeline, c.key, concat_ws(chr(10), 'MDR title: ' || r.title, 'RACI title: ' || coalesce(c.raci, ''), 'RACI description: ' || coalesce(d.description, ''),
    'Discipline: ' || coalesce(e.discipline, ''), 'Document type: ' || coalesce(e.kind, ''), 'Category: ', 'Chapter: ') AS body
  FROM r JOIN c USING (title) LEFT JOIN d ON d.key = c.key LEFT JOIN e ON e.key = c.key WHERE c.decision = 'MATCH')
SELECT title AS "MdrDocumentTitle", timeline AS "TimelineName", lower(trim(title)) AS "MdrTitleKey", key AS "ConsolidatedTitleKey", body AS "CandidateText",
  sha256(trim(regexp_replace(body, '\\s+', ' ', 'g'))) AS "TextHash" FROM j""")
def build_candidates(spark: SparkSession, sf: str) -> DataFrame:
    """The register, twice over, joined with what is decided and known of its titles."""
    part = table(spark, sf, "part")
    register = part.select(F.col("p_name").alias("Document_title"), F.col("p_brand").alias("Mdr_code_name_ref"))
    decided = part.groupBy(F.col("p_name").alias("Document_title")).agg(
        F.when(F.min("p_size") % 2 == 0, "MATCH").otherwise("NEW").alias("ConsolidatedDecisionType"), F.min("p_type").alias("ConsolidatedTitleKey"), F.min("p_brand").alias("ConsolidatedRaciTitle")
    )
    described = part.groupBy(F.col("p_type").alias("TitleKey")).agg(F.min("p_brand").alias("EffectiveDescription"))
    none = F.lit(None).cast("string")
    enriched = part.where("p_size < 25").groupBy(F.col("p_type").alias("TitleKey")).agg(F.max("p_size").cast("string").alias("TypeName"))
    enriched = enriched.select("TitleKey", F.concat(F.lit("D "), F.col("TitleKey")).alias("DisciplineName"), "TypeName", none.alias("CategoryDescription"), none.alias("ChapterName"))
    found = retrieval.build_candidates(register.unionByName(register), decided, described, enriched)
    return found.select("MdrDocumentTitle", "TimelineName", "MdrTitleKey", "ConsolidatedTitleKey", "CandidateText", "TextHash")


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    """One row for each order and line number, as a rank occurs once."""
    least = [F.min(c).alias(c) for c in ("l_partkey", "l_returnflag", "l_linestatus", "l_shipdate")]
    return table(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(*least)


LINES = "(SELECT l_orderkey, l_linenumber, min(l_partkey) AS l_partkey, min(l_returnflag) AS l_returnflag, min(l_linestatus) AS l_linestatus FROM lineitem GROUP BY l_orderkey, l_linenumber)"


def _view(spark: SparkSession, sf: str) -> DataFrame:
    """Stage 5's view: two versions of every task, links by part and line."""
    orders = table(spark, sf, "orders")
    version = lambda day, kind: orders.select(
        F.col("o_orderpriority").alias("TimelineName"), F.col("o_orderkey").alias("TaskRowId"), F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("TaskCode"),
        F.col("o_orderpriority").alias("TaskName"), F.lit(None).cast("string").alias("WbsName"), kind.alias("TaskClass"), F.lit("HIGH").alias("TaskClassConfidence"),
        F.lit("").alias("TaskClassReason"), F.col("o_orderdate").alias("TaskStartDate"), *(F.lit(None).cast("timestamp_ntz").alias(c) for c in ("TaskFinishDate", "TaskActualStartDate", "TaskActualFinishDate")),
        (F.col("o_orderdate") + F.expr(f"interval {day} day")).alias("CreatedAt"), (F.col("o_orderdate") + F.expr(f"interval {day} day")).alias("UpdatedAt"),
    )
    tasks = version(0, F.lit("OTHER")).unionByName(version(1, F.when(F.col("o_orderstatus") == "O", "ENG_DOC").otherwise("OTHER")))
    lines = _lines(spark, sf).join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    name = F.concat(F.lit("part "), F.col("l_partkey").cast("string"))
    links = lines.where("l_returnflag <> 'A'").select(
        F.col("o_orderpriority").alias("TimelineName"), F.col("o_orderkey").alias("TaskRowId"), F.concat_ws("-", name, F.col("l_linenumber").cast("string")).alias("MdrTitleKey"), F.col("l_linenumber").alias("LinkRank"),
        F.col("l_returnflag").alias("LinkReason"), name.alias("MdrDocumentTitle"), F.col("l_linestatus").alias("ConsolidatedRaciTitle"), F.col("l_shipdate").alias("CreatedAt"),
    )
    return stages.link_view(Frames(**{stages.CLASSIFIED: tasks, stages.LINKS: links}))


VIEW_SQL = f"""
WITH t AS (SELECT o_orderpriority AS "TimelineName", o_orderkey AS "TaskRowId", 'C' || o_custkey AS "TaskCode", o_orderpriority AS "TaskName", '' AS "WbsName",
    CASE WHEN o_orderstatus = 'O' THEN 'ENG_DOC' ELSE 'OTHER' END AS "TaskClass", o_orderdate AS start FROM orders),
l AS (SELECT l_orderkey, l_linenumber AS "LinkRank", l_returnflag AS "LinkReason", 'part ' || l_partkey AS "MdrDocumentTitle", l_linestatus AS "DocumentRaciTitle" FROM {LINES} WHERE l_returnflag <> 'A'),
n AS (SELECT l_orderkey, count(*) AS n FROM l GROUP BY l_orderkey),
v AS (SELECT t.*, coalesce(n.n, 0) AS "ResolverLinkCount", l."LinkRank", l."LinkReason", l."MdrDocumentTitle", l."DocumentRaciTitle"
  FROM t LEFT JOIN n ON n.l_orderkey = "TaskRowId" LEFT JOIN l ON l.l_orderkey = "TaskRowId")
"""


@query(VIEW_SQL + """SELECT "TimelineName", "TaskRowId", "TaskClass", "ResolverLinkCount", coalesce("LinkRank", 0) AS "LinkRank", "LinkReason", "MdrDocumentTitle", "DocumentRaciTitle", "TimelineName" || '::' || "TaskRowId" AS custom_id FROM v""")
def link_view(spark: SparkSession, sf: str) -> DataFrame:
    return _view(spark, sf).select(*TASK, "TaskClass", "ResolverLinkCount", F.coalesce("LinkRank", F.lit(0)).alias("LinkRank"), "LinkReason", "MdrDocumentTitle", "DocumentRaciTitle", "custom_id")


@query(VIEW_SQL + """SELECT row_number() OVER (ORDER BY "TimelineName", "TaskRowId")::INTEGER AS "#", * FROM (
  SELECT DISTINCT "TimelineName", "TaskRowId", "TaskCode", "TaskName", "WbsName", "TaskClass", 'HIGH' AS "TaskClassConfidence", '' AS "TaskClassReason" FROM v)""")
def task_sheet(spark: SparkSession, sf: str) -> DataFrame:
    return report.task_sheet(_view(spark, sf))


@query(VIEW_SQL + """SELECT row_number() OVER (ORDER BY "TimelineName", "TaskRowId", "LinkRank" NULLS LAST)::INTEGER AS "#", "TimelineName", "TaskRowId", "TaskCode", "TaskName", "WbsName", "TaskClass",
  'HIGH' AS "TaskClassConfidence", '' AS "TaskClassReason", coalesce("LinkRank", 0) AS "LinkRank", coalesce("LinkReason", '') AS "LinkReason", coalesce("MdrDocumentTitle", '') AS "MdrDocumentTitle", coalesce("DocumentRaciTitle", '') AS "DocumentRaciTitle",
  strftime(start, '%Y-%m-%d %H:%M:%S') AS "TaskStartDate", '' AS "TaskFinishDate", '' AS "TaskActualStartDate", '' AS "TaskActualFinishDate" FROM v WHERE "TaskClass" = 'ENG_DOC'""")
def link_sheet(spark: SparkSession, sf: str) -> DataFrame:
    return report.link_sheet(_view(spark, sf)).fillna(0, ["LinkRank"])


@query(VIEW_SQL + """SELECT count(DISTINCT "TaskRowId") AS tasks, count(DISTINCT "TaskRowId") FILTER ("TaskClass" = 'ENG_DOC') AS eng_doc, count(DISTINCT "TaskRowId") FILTER ("TaskClass" = 'OTHER') AS other,
  count(DISTINCT "TaskRowId") FILTER ("ResolverLinkCount" > 0) AS linked, count(*)::BIGINT AS rows FROM v""")
def report_totals(spark: SparkSession, sf: str) -> DataFrame:
    return report.totals(_view(spark, sf))


def _topk(spark: SparkSession, sf: str) -> DataFrame:
    """Every order's lines as its candidates."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    none = F.lit(None).cast("string")
    return _lines(spark, sf).join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_orderpriority").alias("TimelineName"), F.col("l_orderkey").alias("TaskRowId"), F.col("l_linenumber").alias("RetrievalRank"), (F.col("l_linenumber") / 8).alias("Similarity"),
        F.concat(F.lit("part "), F.col("l_partkey").cast("string")).alias("MdrDocumentTitle"), F.col("l_returnflag").alias("ConsolidatedRaciTitle"), F.col("l_linestatus").alias("EffectiveDescription"),
        *(none.alias(c) for c in ("DisciplineName", "TypeName", "CategoryDescription", "ChapterName", "TaskCode", "WbsName", "TaskStartDate", "TaskFinishDate", "TaskActualStartDate", "TaskActualFinishDate", "TaskDateFieldsJson", "TaskClassReason")),
        F.col("o_orderpriority").alias("TaskName"), F.col("o_orderstatus").alias("TaskClassConfidence"),
    )


@query("""
WITH c AS (SELECT l_orderkey, list(l_linenumber ORDER BY l_linenumber) AS offered, string_agg('{"candidate_id":' || l_linenumber || ',"similarity":' || (l_linenumber / 8)::DOUBLE::VARCHAR || ',"mdr_document_title":"part ' || l_partkey
    || '","raci_title":"' || l_returnflag || '","raci_description":"' || l_linestatus || '","discipline":"","type":"","category":"","chapter":""}', ',' ORDER BY l_linenumber) AS items FROM """ + LINES + """ GROUP BY l_orderkey)
SELECT o_orderpriority AS "TimelineName", o_orderkey AS "TaskRowId", array_to_string(offered, ',') AS offered,
  '{"task":{"task_code":"","task_name":"' || o_orderpriority || '","wbs_name":"","task_start_date":"","task_finish_date":"","task_actual_start_date":"","task_actual_finish_date":"","task_date_fields_json":"","task_class_reason":"","task_class_confidence":"'
  || o_orderstatus || '","task_name_clean":"' || trim(substring(o_orderpriority, 3)) || '"},"candidates":[' || items || ']}' AS payload
FROM c JOIN orders ON o_orderkey = l_orderkey""")
def resolver_payload(spark: SparkSession, sf: str) -> DataFrame:
    """The resolver's input, whole, of every task."""
    return resolve.payload(_topk(spark, sf)).select(*TASK, F.concat_ws(",", F.col("offered").cast("array<string>")).alias("offered"), "payload")


def _resolved(spark: SparkSession, sf: str) -> DataFrame:
    """A third of the tasks is answered well, a third not at all, a third with no JSON."""
    good = '{"links":[{"candidate_id":1,"confidence":0.9,"reason_short":"a"},{"candidate_id":2,"confidence":0.5},{"candidate_id":3,"confidence":0.9},{"candidate_id":9,"confidence":1},{"candidate_id":4,"confidence":0.75},{"candidate_id":5,"confidence":0.8}]}'
    reply = F.when(F.col("o_orderkey") % 3 == 0, good).when(F.col("o_orderkey") % 3 == 1, F.lit(None)).otherwise("no json")
    offered = F.sequence(F.lit(1), F.lit(7))
    return table(spark, sf, "orders").select(F.col("o_orderpriority").alias("TimelineName"), F.col("o_orderkey").alias("TaskRowId"), resolve.validated(reply, offered).alias("result"))


@query("""
WITH s AS (SELECT * FROM (VALUES (1, 0.9, 'a'), (3, 0.9, ''), (4, 0.75, ''), (5, 0.8, '')) AS x(id, score, reason))
SELECT o_orderpriority AS "TimelineName", o_orderkey AS "TaskRowId", l_linenumber AS "RetrievalRank", score::DOUBLE AS "LinkScore", reason AS "LinkReason", 'part ' || l_partkey AS "MdrDocumentTitle",
  'embedding_topk_llm_resolver' AS "LinkMethod", row_number() OVER (PARTITION BY o_orderkey ORDER BY score DESC, l_linenumber DESC)::INTEGER AS "LinkRank"
FROM orders JOIN """ + LINES + """ ON l_orderkey = o_orderkey JOIN s ON id = l_linenumber WHERE o_orderkey % 3 = 0 QUALIFY "LinkRank" <= 3""")
def chosen_links(spark: SparkSession, sf: str) -> DataFrame:
    """Links above the threshold, ranked by confidence, then similarity, three at most."""
    found = resolve.chosen(_resolved(spark, sf), _topk(spark, sf))
    return found.select(*TASK, "RetrievalRank", "LinkScore", "LinkReason", "MdrDocumentTitle", "LinkMethod", "LinkRank")


@query("""
SELECT o_orderpriority AS "TimelineName", o_orderkey AS "TaskRowId", CASE o_orderkey % 3 WHEN 0 THEN 'ok' WHEN 1 THEN 'llm_error' ELSE 'invalid_json' END AS "TaskStatus",
  CASE o_orderkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'llm_error' ELSE 'invalid_root' END AS "ErrorType",
  CASE WHEN o_orderkey % 3 = 0 THEN 6 ELSE 0 END::INTEGER AS "RawLinkCount", CASE WHEN o_orderkey % 3 = 0 THEN 5 ELSE 0 END::INTEGER AS "ValidLinkCount", CASE WHEN o_orderkey % 3 = 0 THEN 3 ELSE 0 END::INTEGER AS "SavedLinkCount",
  CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END::INTEGER AS "DroppedInvalidCount", CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END::INTEGER AS "DroppedByThreshold", 0::INTEGER AS "DuplicateCandidateCount" FROM orders""")
def resolver_diagnostics(spark: SparkSession, sf: str) -> DataFrame:
    return resolve.diagnostics(_resolved(spark, sf)).drop("ErrorMessage")


@query("""SELECT DISTINCT o_orderpriority AS "TimelineName", o_orderkey AS "TaskRowId" FROM orders WHERE o_orderkey % 3 = 0""")
def resolved_scope(spark: SparkSession, sf: str) -> DataFrame:
    return resolve.scope_ok(_resolved(spark, sf))


@query("""
SELECT l_linestatus AS "TimelineName", l_orderkey AS "TaskRowId", l_linenumber AS "RetrievalRank", l_linenumber / 8 AS "Similarity", 'part ' || l_partkey AS "MdrDocumentTitle", p_type AS "DisciplineName",
  CASE WHEN l_orderkey % 2 = 0 THEN 'ENG_DOC' ELSE 'OTHER' END AS "TaskClass"
FROM """ + LINES + """ LEFT JOIN part ON p_partkey = l_partkey AND l_linestatus = 'O' AND l_returnflag = 'N' WHERE l_linenumber <= 4""")
def offered_candidates(spark: SparkSession, sf: str) -> DataFrame:
    """What stage 4 offers: the newest row of each candidate to rank 4, with what is known of its document and task."""
    line = _lines(spark, sf)
    name = F.concat(F.lit("part "), F.col("l_partkey").cast("string")).alias("MdrDocumentTitle")
    top = lambda day: line.select(
        F.col("l_linestatus").alias("TimelineName"), F.col("l_orderkey").alias("TaskRowId"), name, F.col("l_returnflag").alias("ConsolidatedTitleKey"), F.lit("m").alias("EmbeddingModel"),
        F.col("l_linenumber").alias("Rank"), (F.col("l_linenumber") / 8 - day).alias("Similarity"), (F.col("l_shipdate") - F.expr(f"interval {day} day")).alias("CreatedAt"),
    )
    tasks = line.groupBy(F.col("l_linestatus").alias("TimelineName"), F.col("l_orderkey").alias("TaskRowId")).agg(F.min("l_shipdate").alias("CreatedAt"), F.min("l_shipdate").alias("UpdatedAt"))
    tasks = tasks.withColumn("TaskClass", F.when(F.col("TaskRowId") % 2 == 0, "ENG_DOC").otherwise("OTHER"))
    known = table(spark, sf, "part").select(
        F.lit("O").alias("TimelineName"), F.concat(F.lit("part "), F.col("p_partkey").cast("string")).alias("MdrDocumentTitle"), F.lit("N").alias("ConsolidatedTitleKey"), F.lit("m").alias("EmbeddingModel"),
        F.col("p_type").alias("DisciplineName"), F.lit("2024-01-01").cast("timestamp_ntz").alias("CreatedAt"),
    )
    store = Frames(**{stages.CANDIDATES: top(0).unionByName(top(1)), stages.CLASSIFIED: tasks, stages.CANDIDATE_VECTORS: known})
    return stages.offered(store, "m", top_k=4).select(*TASK, "RetrievalRank", "Similarity", "MdrDocumentTitle", "DisciplineName", "TaskClass")


@query("""
WITH n AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang), a AS (SELECT *, sum(n) OVER () AS total, count(*) OVER () AS groups, least(137, sum(n) OVER ()) AS lim FROM n),
r AS (SELECT *, lim * n / total::DOUBLE AS raw FROM a), q AS (SELECT *, CASE WHEN lim >= groups THEN greatest(floor(raw), 1) ELSE floor(raw) END AS q FROM r),
o AS (SELECT *, greatest(0, lim - sum(q) OVER ()) AS rest, row_number() OVER (PARTITION BY q < n ORDER BY raw - floor(raw) DESC, lang) AS turn FROM q),
w AS (SELECT lang, least(n, q + CASE WHEN q < n AND turn <= rest THEN 1 ELSE 0 END) AS quota FROM o)
SELECT doc_id, lang, source FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS k FROM documents) JOIN w USING (lang) WHERE k <= quota""")
def sample_reused(spark: SparkSession, sf: str) -> DataFrame:
    """A saved sample of the sizes that the quotas ask for is taken as it is."""
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source")
    quotas = sampling.proportional_quotas(sampling.group_counts(docs, ["lang"]), 137, ["lang"])
    first = docs.join(quotas.select("lang", "quota"), "lang").withColumn("k", F.expr("row_number() over (partition by lang order by doc_id)")).where("k <= quota").select("doc_id", "lang")
    return sampling.reuse_or_sample(docs, first, 137, ["lang"], "doc_id").select("doc_id", "lang", "source")


@query("""SELECT doc_id, octet_length(encode(text)) + 1 AS bytes, octet_length(encode(text)) + 1 <= 5000 AS fits FROM documents""")
def oversize_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Lines that fit into a file of 5,000 bytes, and those that don't."""
    fit, over = batching.split_oversize(table(spark, sf, "documents").select("doc_id", "text"), "text", 5000)
    both = fit.withColumn("fits", F.lit(True)).unionByName(over.withColumn("fits", F.lit(False)))
    return both.select("doc_id", "bytes", "fits")


@query("""
SELECT o_orderkey, 'Task name: ' || trim(substring(o_orderpriority, 3)) || chr(10) || 'WBS: ' || o_custkey || chr(10) || 'Task class: ENG_DOC' AS task_text, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS shown,
  o_orderpriority || '::' || o_orderkey AS custom_id, substring(sha256('{"p0":"' || o_orderkey || '","p1":"' || o_orderstatus || '"}'), 1, 32) AS id, left(repeat(o_orderpriority, 60), 300) AS reason FROM orders""")
def task_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Texts, ids and cells of tasks."""
    priority = F.col("o_orderpriority")
    return table(spark, sf, "orders").select(
        "o_orderkey", text.task_text(priority, F.col("o_custkey")).alias("task_text"), text.cell_time(F.col("o_orderdate")).alias("shown"), text.composite_id(priority, F.col("o_orderkey")).alias("custom_id"),
        text.unique_id(F.col("o_orderkey"), F.col("o_orderstatus")).alias("id"), text.clipped(F.repeat(priority, F.lit(60)), text.REASON_LIMIT).alias("reason"),
    )


@query("""
SELECT doc_id, left(coalesce(text, ''), 32767) AS cell, CASE doc_id % 3 WHEN 0 THEN '{"k": 1}' WHEN 1 THEN '{"k": 2}' ELSE 'plain' END AS bare FROM documents""")
def report_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Cells as a workbook holds them, and replies without their fence."""
    reply = F.when(F.col("doc_id") % 3 == 0, '```json\n{"k": 1}\n```').when(F.col("doc_id") % 3 == 1, '```{"k": 2}```').otherwise("  plain ")
    return table(spark, sf, "documents").select("doc_id", text.cell_text(F.col("text")).alias("cell"), text.strip_fence(reply).alias("bare"))


@query("""
SELECT a.vec_id, CASE WHEN a.vec_id % 7 = 0 THEN 0.0 ELSE round(list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) END AS cosine
FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""")
def cosine_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Cosine of neighbours; 0 where a vector is short of a component."""
    e = table(spark, sf, "embeddings")
    left = e.select("vec_id", F.when(F.col("vec_id") % 7 == 0, F.slice("embedding", 1, 3)).otherwise(F.col("embedding")).alias("a"))
    right = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("b"))
    return left.join(right, "vec_id").select("vec_id", F.round(vectors.cosine(F.col("a"), F.col("b")), 6).alias("cosine"))


@query("""
WITH w AS (SELECT r_regionkey AS id, r_name AS name FROM region)
SELECT o_orderpriority AS "TimelineName", o_orderpriority AS "ProjectCode", o_orderkey AS "TaskRowId", 'C' || o_custkey AS "TaskCode", o_orderpriority AS "TaskName", coalesce(w.name, '') AS "WbsName",
  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS start, NULL::VARCHAR AS finish FROM orders LEFT JOIN w ON w.id = o_custkey % 7""")
def landed_tasks(spark: SparkSession, sf: str) -> DataFrame:
    """Sheet rows with headers as people write them; a breakdown id that occurs twice joins once, one that is missing gives no name."""
    pair = lambda name, value: (F.lit(name), value.cast("string"))
    cells = F.create_map(*pair(" Task Name ", F.col("o_orderpriority")), *pair("TASK-Code", F.concat(F.lit("C"), F.col("o_custkey").cast("string"))), *pair("wbs_id", F.col("o_custkey") % 7),
                         *pair("Planned Start", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")), *pair("finish", F.lit("01-Jan-24 A")))
    sheet = table(spark, sf, "orders").select(F.col("o_orderpriority").alias("timeline"), F.col("o_orderkey").alias("row_idx"), cells.alias("cells"))
    regions = table(spark, sf, "region").crossJoin(table(spark, sf, "orders").select(F.col("o_orderpriority").alias("timeline")).distinct())  # 5 by 5 rows
    name = lambda value: regions.select("timeline", F.create_map(*pair("wbs_id", F.col("r_regionkey")), *pair("wbs_name", value)).alias("cells"))
    wbs = name(F.col("r_name")).unionByName(name(F.concat(F.col("r_name"), F.lit(" dup"))))
    out = landing.tasks(sheet, wbs)
    return out.select("TimelineName", "ProjectCode", "TaskRowId", "TaskCode", "TaskName", "WbsName", F.date_format("TaskStartDate", "yyyy-MM-dd HH:mm:ss").alias("start"), F.date_format("TaskFinishDate", "yyyy-MM-dd HH:mm:ss").alias("finish"))


@query("""SELECT o_orderpriority AS "TimelineName", o_orderkey AS "TaskRowId", CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS start, (o_orderkey % 10) / 10::DOUBLE AS score, NULL::VARCHAR AS reason FROM orders""")
def conformed_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Rows cast to a table's columns: texts that are times become times, others null; missing columns are null."""
    rows = table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("TimelineName"), F.col("o_orderkey").cast("string").alias("TaskRowId"), F.when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")).otherwise("soon").alias("TaskStartDate"),
        ((F.col("o_orderkey") % 10) / 10).cast("string").alias("LinkScore"), F.lit("x").alias("NoColumnOfIt"),
    )
    out = schemas.conform(rows, stages.LINKS)
    return out.select(*TASK, F.date_format("TaskStartDate", "yyyy-MM-dd HH:mm:ss").alias("start"), F.col("LinkScore").alias("score"), F.col("LinkReason").alias("reason"))


def _vectors(spark: SparkSession, sf: str, store: Store) -> None:
    """Tasks and candidates of every label, as stage 2 leaves them."""
    e = table(spark, sf, "embeddings").select(F.col("label").cast("string").alias("TimelineName"), F.col("vec_id").alias("TaskRowId"), F.concat(F.lit("title "), F.col("vec_id").cast("string")).alias("MdrDocumentTitle"), F.col("embedding").alias("Embedding"), F.lit("m").alias("EmbeddingModel"))
    tasks = e.where("TaskRowId % 10 = 0")
    store.append(stages.CLASSIFIED, tasks.select(*TASK, F.lit("OTHER").alias("TaskClass")), "first")
    store.append(stages.CLASSIFIED, tasks.select(*TASK, F.lit("ENG_DOC").alias("TaskClass")), "second")
    store.upsert(stages.TASK_VECTORS, tasks.select(*TASK, "Embedding", "EmbeddingModel"), "embed")
    candidates = e.where("TaskRowId % 10 <> 0").select("TimelineName", "MdrDocumentTitle", F.lit(None).cast("string").alias("ConsolidatedTitleKey"), "Embedding", "EmbeddingModel")
    store.upsert(stages.CANDIDATE_VECTORS, candidates, "embed")


@query(f"""SELECT label::VARCHAR AS "TimelineName", query AS "TaskRowId", 'title ' || candidate AS "MdrDocumentTitle", similarity AS "Similarity", rank AS "Rank" FROM ({TOPK_SQL.format(k=5)})""")
def retrieved(spark: SparkSession, sf: str) -> DataFrame:
    """Stage 3 over a store: the newest classes and vectors, joined, the best five of each task put in place of older ones."""
    store = _store(spark)
    _vectors(spark, sf, store)
    stages.retrieve(store, "m", top_k=2)
    found = stages.retrieve(store, "m", top_k=5)
    return found.select(*TASK, "MdrDocumentTitle", F.round("Similarity", 6).alias("Similarity"), "Rank")


@query("""
SELECT o_orderpriority AS "TimelineName", o_orderkey AS "TaskRowId", 'part ' || l_partkey || '-' || l_linenumber AS "MdrTitleKey", CASE WHEN o_orderkey % 3 = 0 THEN 'new' ELSE 'old' END AS "LinkReason"
FROM orders JOIN """ + LINES + """ ON l_orderkey = o_orderkey WHERE o_orderkey % 3 <> 0 OR l_linenumber = 1""")
def links_replaced(spark: SparkSession, sf: str) -> DataFrame:
    """Stage 4's write: links of the tasks resolved give way to the new ones, also where there are none; others stay."""
    store, rows = _store(spark), _topk(spark, sf)
    links = rows.select(*TASK, F.concat_ws("-", "MdrDocumentTitle", F.col("RetrievalRank").cast("string")).alias("MdrTitleKey"), "RetrievalRank")
    store.write(stages.LINKS, links.withColumn("LinkReason", F.lit("old")))
    new = links.where("TaskRowId % 3 = 0 and RetrievalRank = 1").withColumn("LinkReason", F.lit("new"))
    store.replace_keys(stages.LINKS, links.where("TaskRowId % 3 = 0").select(*TASK).distinct(), new, TASK, "resolve")
    return store.read(stages.LINKS).select(*TASK, "MdrTitleKey", "LinkReason")


@query("""SELECT o_orderpriority AS "TimelineName", o_orderkey AS "TaskRowId", CASE WHEN o_orderkey % 2 = 0 THEN 'ENG_DOC' ELSE 'OTHER' END AS "TaskClass", CASE WHEN o_orderkey % 2 = 0 THEN 2 ELSE 1 END::BIGINT AS versions FROM orders""")
def history(spark: SparkSession, sf: str) -> DataFrame:
    """Appended versions accumulate; the newest counts."""
    store = _store(spark)
    rows = table(spark, sf, "orders").select(F.col("o_orderpriority").alias("TimelineName"), F.col("o_orderkey").alias("TaskRowId"))
    store.append(stages.CLASSIFIED, rows.withColumn("TaskClass", F.lit("OTHER")), "first")
    store.append(stages.CLASSIFIED, rows.where("TaskRowId % 2 = 0").withColumn("TaskClass", F.lit("ENG_DOC")), "second")
    versions = store.read(stages.CLASSIFIED).groupBy(*TASK).agg(F.count("*").alias("versions"))
    return stages.latest(store, stages.CLASSIFIED).select(*TASK, "TaskClass").join(versions, TASK)
