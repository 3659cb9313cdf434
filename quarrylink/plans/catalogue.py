"""The library's operators as queries over the driver's tables, each with its SQL.

The tables stand in for the pipeline's: ``embeddings.label`` is a timeline, a vector whose id is
divisible by 10 a task and the others its candidates; ``events`` has versions of (user, type) rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, numbers, text, vectors
from ..operators import batching, relational, resolve, retrieval, sampling
from ..session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _tasks_and_candidates(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    e = table(spark, sf, "embeddings").where("vec_id is not null and embedding is not null")
    tasks = e.where("vec_id % 10 = 0").select("label", F.col("vec_id").alias("query"), F.col("embedding").alias("vector"))
    return tasks, e.where("vec_id % 10 <> 0").select("label", F.col("vec_id").alias("candidate"), F.col("embedding").alias("vector"))


TOPK_SQL = """
SELECT label, query, candidate, round(similarity, 6) AS similarity, rank::INTEGER AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query ORDER BY similarity DESC, candidate) AS rank FROM (
    SELECT q.label, q.vec_id AS query, c.vec_id AS candidate, round(list_dot_product(q.embedding::DOUBLE[], c.embedding::DOUBLE[]), 12) AS similarity
    FROM embeddings q JOIN embeddings c USING (label) WHERE q.vec_id % 10 = 0 AND c.vec_id % 10 <> 0)) WHERE rank <= {k}
"""


@query(TOPK_SQL.format(k=5))
def topk_cosine_blocked(spark: SparkSession, sf: str) -> DataFrame:
    """Top 5 candidates of each task in its block, by products of chunks."""
    found = retrieval.topk_by_blocks(*_tasks_and_candidates(spark, sf), "label", 5)
    return found.withColumns({"similarity": F.round("similarity", 6), "rank": F.col("rank").cast("int")})


@query(TOPK_SQL.format(k=30))
def topk_cosine_expression(spark: SparkSession, sf: str) -> DataFrame:
    """Top 30 by a join on the block and expressions."""
    found = retrieval.topk_by_expression(*_tasks_and_candidates(spark, sf), "label", 30)
    return found.withColumns({"similarity": F.round("similarity", 6), "rank": F.col("rank").cast("int")})


@query(r"SELECT doc_id, sha256(trim(regexp_replace(coalesce(text, ''), '\s+', ' ', 'g'))) AS text_hash FROM documents")
def text_hash(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", text.text_hash(F.col("text")).alias("text_hash"))


@query(r"SELECT doc_id, trim(regexp_replace(regexp_replace(replace(lower(coalesce(text, '')), '&', ' and '), '\([^)]*\)', ' ', 'g'), '[^a-z0-9]+', ' ', 'g')) AS normal FROM documents")
def normalize_text(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", text.normalize(F.col("text")).alias("normal"))


@query("""SELECT o_orderkey, CASE WHEN instr(p, '-') BETWEEN 1 AND 5 THEN trim(substring(p, instr(p, '-') + 1)) ELSE p END AS bare
FROM (SELECT o_orderkey, trim(o_orderpriority) AS p FROM orders)""")
def remove_prefix(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select("o_orderkey", text.remove_prefix(F.col("o_orderpriority")).alias("bare"))


@query(r"SELECT page_id, coalesce(nullif(regexp_extract(url, '[0-9]{4,}'), ''), url) AS code FROM pages")
def extract_code(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", text.extract_project_code(F.col("url")).alias("code"))


@query(r"SELECT DISTINCT trim(regexp_replace(lower(trim(p_name)), '[^a-z0-9]+', '_', 'g'), '_') AS name, trim(lower(trim(p_type)), ' ') AS title_key FROM part")
def column_names(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(text.column_name(F.col("p_name")).alias("name"), text.title_key(F.col("p_type")).alias("title_key")).distinct()


@query("""SELECT event_id, ts, user_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST) AS n FROM events) WHERE n = 1""")
def latest_per_key(spark: SparkSession, sf: str) -> DataFrame:
    found = relational.latest_per_key(table(spark, sf, "events").drop("props"), ["user_id", "event_type"], relational.newest_first("ts", "event_id"))
    return found.select("event_id", "ts", "user_id", "event_type", "value")


@query("""
WITH g AS (SELECT lang, source, count(*) AS n FROM documents GROUP BY ALL), a AS (SELECT *, sum(n) OVER () AS total, count(*) OVER () AS groups FROM g),
l AS (SELECT *, least(137, total) AS lim FROM a), r AS (SELECT *, lim * n / total::DOUBLE AS raw FROM l),
q AS (SELECT *, CASE WHEN lim >= groups THEN greatest(floor(raw), 1) ELSE floor(raw) END AS q FROM r),
o AS (SELECT *, greatest(0, lim - sum(q) OVER ()) AS rest, row_number() OVER (PARTITION BY q < n ORDER BY raw - floor(raw) DESC, lang, source) AS turn FROM q)
SELECT lang, source, n, least(n, q + CASE WHEN q < n AND turn <= rest THEN 1 ELSE 0 END)::BIGINT AS quota FROM o""")
def proportional_quota(spark: SparkSession, sf: str) -> DataFrame:
    counts = sampling.group_counts(table(spark, sf, "documents"), ["lang", "source"])
    return sampling.proportional_quotas(counts, 137, ["lang", "source"])


@query()
def seeded_sample(spark: SparkSession, sf: str) -> DataFrame:
    """A sample of 200 documents, dealt out over languages; Spark's hash has no SQL elsewhere."""
    return sampling.reuse_or_sample(table(spark, sf, "documents").select("doc_id", "lang", "source"), None, 200, ["lang"], "doc_id")


@query("SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def json_field(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", F.try_variant_get(F.try_parse_json("props"), "$.k", "int").alias("k"))


@query("""SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders WHERE o_orderpriority <> '5-LOW'
UNION ALL SELECT o_orderkey, o_custkey, o_totalprice * 2, o_orderpriority FROM orders WHERE o_orderpriority = '5-LOW' AND o_orderkey % 2 = 0""")
def replace_scope(spark: SparkSession, sf: str) -> DataFrame:
    """New rows for one priority, in one pass; keys of the scope without new rows end up empty."""
    old = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    low = old.where("o_orderpriority = '5-LOW'")
    new = low.where("o_orderkey % 2 = 0").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    return relational.replace_scope(old, low.select("o_orderpriority").distinct(), new, ["o_orderpriority"])


@query("""SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey % 3 <> 0
UNION ALL SELECT o_orderkey, o_custkey, o_totalprice + 1 FROM orders WHERE o_orderkey % 3 = 0
UNION ALL SELECT o_orderkey + 1000000000, o_custkey, o_totalprice + 1 FROM orders WHERE o_orderkey % 3 = 0""")
def keyed_upsert(spark: SparkSession, sf: str) -> DataFrame:
    old = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    changed = old.where("o_orderkey % 3 = 0").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    new = changed.unionByName(changed.withColumn("o_orderkey", F.col("o_orderkey") + 1000000000))
    return relational.upsert(old, new, ["o_orderkey"])


LINKS_SQL = """
WITH l AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey),
t AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders)
SELECT c_custkey, c_name, coalesce(l.n, 0) AS n_links, t.o_orderkey, t.rank::INTEGER AS link_rank
FROM customer LEFT JOIN l ON l.o_custkey = c_custkey LEFT JOIN t ON t.o_custkey = c_custkey AND t.rank <= 3
"""


@query(LINKS_SQL)
def link_report(spark: SparkSession, sf: str) -> DataFrame:
    """Each customer with the number of its orders and its three largest; without any too."""
    orders = table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_totalprice")
    counts = orders.groupBy("c_custkey").agg(F.count("*").alias("n"))
    top = relational.ranked(orders, ["c_custkey"], [F.desc("o_totalprice"), F.asc("o_orderkey")], "link_rank", 3).drop("o_totalprice")
    rows = table(spark, sf, "customer").select("c_custkey", "c_name").join(counts, "c_custkey", "left").join(top, "c_custkey", "left")
    return rows.select("c_custkey", "c_name", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), "o_orderkey", "link_rank")


@query(f"SELECT c_custkey, c_name, n_links, row_number() OVER (ORDER BY n_links DESC, c_custkey)::INTEGER AS line FROM (SELECT DISTINCT c_custkey, c_name, n_links FROM ({LINKS_SQL}))")
def task_summary(spark: SparkSession, sf: str) -> DataFrame:
    first = link_report(spark, sf).select("c_custkey", "c_name", "n_links").dropDuplicates(["c_custkey"])
    return relational.numbered(first, [F.desc("n_links"), F.asc("c_custkey")], "line")


@query("""SELECT vec_id, round(sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])), 6) AS norm, len(embedding)::INTEGER AS dim,
round(embedding[1]::DOUBLE / sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])), 5) AS first FROM embeddings""")
def vector_norm(spark: SparkSession, sf: str) -> DataFrame:
    v = F.col("embedding")
    return table(spark, sf, "embeddings").select("vec_id", F.round(vectors.norm(v), 6).alias("norm"), vectors.size(v).alias("dim"), F.round(F.get(vectors.normalise(v), F.lit(0)).cast("double"), 5).alias("first"))


@query("SELECT vec_id, round(sum_all, 4) AS sum_all, size FROM (SELECT vec_id, list_sum(embedding::DOUBLE[]) AS sum_all, 4 * len(embedding) AS size FROM embeddings)")
def vector_blobs(spark: SparkSession, sf: str) -> DataFrame:
    """Vectors to bytes and back."""
    blobs = table(spark, sf, "embeddings").select("vec_id", vectors.to_blob("embedding").alias("b"))
    back = blobs.select("vec_id", F.octet_length("b").cast("long").alias("size"), vectors.from_blob("b").alias("v"))
    return back.select("vec_id", "size", F.round(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double")), 4).alias("sum_all"))


@query("SELECT DISTINCT l_orderkey, l_linestatus FROM lineitem WHERE l_returnflag = 'R'")
def eng_filter_distinct(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").where("l_returnflag = 'R'").select("l_orderkey", "l_linestatus").distinct()


@query("""SELECT p.p_name || '' AS title, lower(trim(p.p_name)) AS title_key,
  concat_ws(chr(10), 'MDR title: ' || p.p_name, 'RACI title: ' || p.p_brand, 'RACI description: ' || coalesce(s.s_name, ''), 'Discipline: ' || coalesce(n.n_name, ''),
    'Document type: ' || p.p_type, 'Category: ' || coalesce(r.r_name, ''), 'Chapter: ') AS text
FROM (SELECT DISTINCT p_partkey, p_name, p_brand, p_type FROM part WHERE p_name IS NOT NULL AND trim(p_name) <> '' AND p_size > 10) p
LEFT JOIN supplier s ON s.s_suppkey = p.p_partkey LEFT JOIN nation n ON n.n_nationkey = s.s_nationkey LEFT JOIN region r ON r.r_regionkey = n.n_regionkey""")
def candidate_build(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part").where(text.is_filled(F.col("p_name")) & (F.col("p_size") > 10)).select("p_partkey", "p_name", "p_brand", "p_type").distinct()
    s, n, r = (table(spark, sf, t) for t in ("supplier", "nation", "region"))
    rows = p.join(s, p["p_partkey"] == s["s_suppkey"], "left").join(n, s["s_nationkey"] == n["n_nationkey"], "left").join(r, n["n_regionkey"] == r["r_regionkey"], "left")
    body = text.candidate_text(*map(F.col, ("p_name", "p_brand", "s_name", "n_name", "p_type", "r_name")), F.lit(None).cast("string"))
    return rows.select(F.col("p_name").alias("title"), text.title_key(F.col("p_name")).alias("title_key"), body.alias("text"))


@query(r"""WITH n AS (SELECT doc_id, sha256(trim(regexp_replace(text, '\s+', ' ', 'g'))) AS h FROM documents),
o AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN h ELSE 'old' END AS h FROM n WHERE doc_id % 3 <> 2)
SELECT n.doc_id, n.h AS "TextHash" FROM n LEFT JOIN o USING (doc_id) WHERE n.h IS DISTINCT FROM o.h""")
def hash_diff_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """Documents whose text is new or other than what is stored; a third of the hashes is up to date."""
    now = table(spark, sf, "documents").select("doc_id", text.text_hash(F.col("text")).alias("TextHash"))
    stored = now.where("doc_id % 3 <> 2").withColumn("TextHash", F.when(F.col("doc_id") % 3 == 0, F.col("TextHash")).otherwise("old"))
    return relational.to_refresh(now, stored, ["doc_id"])


@query("""SELECT l_orderkey, l_linenumber, coalesce(CASE WHEN l_returnflag = 'R' THEN l_shipdate END, CASE WHEN l_linestatus = 'O' THEN l_shipdate + INTERVAL 1 DAY END) AS task_start_date
FROM lineitem""")
def alias_coalesce(spark: SparkSession, sf: str) -> DataFrame:
    """The first filled of a column's names; sources name it differently."""
    ship = F.col("l_shipdate")
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.when(F.col("l_returnflag") == "R", ship).alias("Planned Start"), F.when(F.col("l_linestatus") == "O", ship + F.expr("interval 1 day")).alias("EARLY_START"))
    return df.select("l_orderkey", "l_linenumber", dates.first_filled(df, dates.DATE_ALIASES["task_start_date"]).alias("task_start_date"))


@query("""SELECT o_orderkey, '{"finish":"' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '","update_user":"' || o_orderstatus || '"}' AS fields FROM orders""")
def date_json(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").alias("finish"), F.col("o_orderstatus").alias("update_user"), F.lit(None).cast("string").alias("start"))
    return df.select("o_orderkey", dates.date_fields_of(df.drop("o_orderkey")).alias("fields"))


@query("""SELECT event_id, TRY_CAST(CASE WHEN event_id % 3 = 0 THEN '01-Jan-24 A' WHEN event_id % 3 = 1 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') ELSE NULL END AS TIMESTAMP) AS at FROM events""")
def parse_dates(spark: SparkSession, sf: str) -> DataFrame:
    shown = F.when(F.col("event_id") % 3 == 0, "01-Jan-24 A").when(F.col("event_id") % 3 == 1, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    return table(spark, sf, "events").select("event_id", dates.parse_time(shown).alias("at"))


@query("""SELECT event_id, CASE WHEN c IN ('ENG_DOC', 'OTHER') THEN c END AS task_class, CASE WHEN k IN ('HIGH', 'MEDIUM', 'LOW') THEN k ELSE 'LOW' END AS confidence FROM (
  SELECT event_id, upper(trim(CASE event_type WHEN 'click' THEN ' eng_doc ' WHEN 'view' THEN 'other' ELSE event_type END)) AS c,
    upper(trim(CASE user_id % 3 WHEN 0 THEN 'high' WHEN 1 THEN ' Medium' ELSE 'sure' END)) AS k FROM events)""")
def label_normalise(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.when(F.col("event_type") == "click", " eng_doc ").when(F.col("event_type") == "view", "other").otherwise(F.col("event_type"))
    sure = F.when(F.col("user_id") % 3 == 0, "high").when(F.col("user_id") % 3 == 1, " Medium").otherwise("sure")
    return table(spark, sf, "events").select("event_id", text.task_class(kind).alias("task_class"), text.confidence_label(sure).alias("confidence"))


@query("""SELECT event_id, greatest(0.0::DOUBLE, least(1.0::DOUBLE, coalesce(TRY_CAST(CASE WHEN event_id % 4 = 0 THEN '80%' ELSE (value / 50)::VARCHAR END AS DOUBLE), 0.0))) AS score FROM events""")
def clamp_score(spark: SparkSession, sf: str) -> DataFrame:
    shown = F.when(F.col("event_id") % 4 == 0, "80%").otherwise((F.col("value") / 50).cast("string"))
    return table(spark, sf, "events").select("event_id", numbers.clamp01(numbers.safe_float(shown)).alias("score"))


def _replies(spark: SparkSession, sf: str) -> DataFrame:
    """Replies of all kinds, made from events."""
    e = table(spark, sf, "events")
    u = F.col("user_id").cast("string")
    item = lambda i, c: F.concat(F.lit('{"candidate_id":'), i, F.lit(',"confidence":'), c, F.lit("}"))
    links = F.concat(F.lit('{"links":['), item(F.lit("1"), F.lit("0.9")), F.lit(",7,"), item(u, F.lit('"0.5"')), F.lit(","), item(F.lit('"2"'), F.lit("85")), F.lit(","), item(F.lit("1"), F.lit("0.95")), F.lit("]}"))
    kind = F.col("event_id") % 6
    reply = (
        F.when(kind == 0, "{}").when(kind == 1, '{"links":null}').when(kind == 2, "[1]").when(kind == 3, "no json")
        .when(kind == 4, F.concat(F.lit("```json\n"), links, F.lit("\n```"))).otherwise(links)
    )
    return e.select("event_id", "user_id", reply.alias("reply"), F.sequence(F.lit(1), F.lit(3)).alias("offered"))


@query("""
WITH k AS (SELECT event_id, user_id, event_id % 6 AS k, CASE WHEN user_id IN (1, 2, 3) THEN 1 ELSE 0 END AS ok FROM events)
SELECT event_id, CASE WHEN k IN (0, 4, 5) THEN 'ok' ELSE 'invalid_json' END AS status,
  CASE k WHEN 1 THEN 'invalid_links' WHEN 2 THEN 'invalid_root' WHEN 3 THEN 'invalid_root' ELSE '' END AS error_type,
  CASE WHEN k >= 4 THEN 5 ELSE 0 END::INTEGER AS raw_links, CASE WHEN k >= 4 THEN 2 + CASE WHEN user_id = 3 THEN 1 ELSE 0 END ELSE 0 END::INTEGER AS valid_links,
  CASE WHEN k >= 4 THEN 2 - ok ELSE 0 END::INTEGER AS dropped, CASE WHEN k >= 4 THEN 1 + CASE WHEN user_id IN (1, 2) THEN 1 ELSE 0 END ELSE 0 END::INTEGER AS duplicates,
  CASE WHEN k >= 4 THEN 0.95 + 1.0 + CASE WHEN user_id = 3 THEN 0.5 ELSE 0 END ELSE 0 END::DOUBLE AS confidence
FROM k""")
def links_validate(spark: SparkSession, sf: str) -> DataFrame:
    r = _replies(spark, sf).select("event_id", resolve.validated(F.col("reply"), F.col("offered")).alias("r"))
    total = F.coalesce(F.aggregate("r.links", F.lit(0.0), lambda s, x: s + x["confidence"]), F.lit(0.0))
    return r.select(
        "event_id", "r.status", "r.error_type", F.col("r.raw_links_count").alias("raw_links"), F.col("r.valid_links_count").alias("valid_links"),
        F.col("r.dropped_invalid_count").alias("dropped"), F.col("r.duplicate_candidate_count").alias("duplicates"), total.alias("confidence"),
    )


@query("SELECT count(*) FILTER (event_id % 6 IN (0, 4, 5)) AS ok, 0::BIGINT AS llm_error, count(*) FILTER (event_id % 6 IN (1, 2, 3)) AS invalid_json FROM events")
def resolver_status(spark: SparkSession, sf: str) -> DataFrame:
    return resolve.status_counts(_replies(spark, sf).select(resolve.validated(F.col("reply"), F.col("offered")).alias("result")))


@query(f"""SELECT query, candidate, score, link_rank::INTEGER AS link_rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, rank) AS link_rank FROM (
    SELECT query, candidate, rank, round(greatest(0, similarity), 1) AS score FROM ({TOPK_SQL.format(k=30)})) WHERE score >= 0.2) WHERE link_rank <= 3""")
def links_rank_cap(spark: SparkSession, sf: str) -> DataFrame:
    """The three best links of each task above a threshold; equal scores go by rank."""
    top = retrieval.topk_by_expression(*_tasks_and_candidates(spark, sf), "label", 30)
    score = F.round(F.greatest(F.lit(0.0), F.round("similarity", 6)), 1)
    rows = top.withColumn("score", score).where("score >= 0.2")
    return relational.ranked(rows, ["query"], [F.desc("score"), F.asc("rank")], "link_rank", 3).select("query", "candidate", "score", "link_rank")


@query("""SELECT count(*) FILTER (o_orderstatus = 'F') AS "F", count(*) FILTER (o_orderstatus = 'O') AS "O", count(*) FILTER (o_orderstatus = 'P') AS "P", 0::BIGINT AS "X" FROM orders""")
def status_counts(spark: SparkSession, sf: str) -> DataFrame:
    return relational.counts_of(table(spark, sf, "orders"), "o_orderstatus", ["F", "O", "P", "X"])


@query("""
WITH RECURSIVE s AS (SELECT lang, doc_id, octet_length(encode(text)) + 1 AS bytes, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS n FROM documents),
p AS (
  SELECT lang, doc_id, bytes, n, CASE WHEN bytes > 20000 THEN NULL ELSE 0 END AS chunk, CASE WHEN bytes > 20000 THEN 0 ELSE bytes END AS total, 0 AS at FROM s WHERE n = 1
  UNION ALL
  SELECT s.lang, s.doc_id, s.bytes, s.n, CASE WHEN s.bytes > 20000 THEN NULL WHEN p.total > 0 AND p.total + s.bytes > 20000 THEN p.at + 1 ELSE p.at END,
    CASE WHEN s.bytes > 20000 THEN p.total WHEN p.total > 0 AND p.total + s.bytes > 20000 THEN s.bytes ELSE p.total + s.bytes END,
    CASE WHEN s.bytes <= 20000 AND p.total > 0 AND p.total + s.bytes > 20000 THEN p.at + 1 ELSE p.at END
  FROM p JOIN s ON s.lang = p.lang AND s.n = p.n + 1
) SELECT lang, doc_id, bytes::BIGINT AS bytes, coalesce(chunk, -1)::INTEGER AS chunk FROM p""")
def byte_packing(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "documents").select("lang", "doc_id", text.line_bytes(F.col("text")).alias("bytes"))
    return batching.pack(rows, "lang", "doc_id", "bytes", 20_000).fillna(-1, ["chunk"])


@query("""
WITH RECURSIVE s AS (SELECT user_id, event_id, event_type <> 'error' AS ok, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events),
p AS (
  SELECT user_id, event_id, ok, n, 800 AS lim FROM s WHERE n = 1
  UNION ALL
  SELECT s.user_id, s.event_id, s.ok, s.n, CASE WHEN p.ok THEN least(1200, greatest(p.lim + 1, floor(p.lim * 1.25)::INTEGER)) ELSE greatest(100, least(p.lim - 1, floor(p.lim * 0.5)::INTEGER)) END
  FROM p JOIN s ON s.user_id = p.user_id AND s.n = p.n + 1
) SELECT user_id, event_id, ok, lim::INTEGER AS "limit" FROM p""")
def adaptive_limits(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "events").select("user_id", "event_id", (F.col("event_type") != "error").alias("ok"))
    return batching.limits(rows, "user_id", "event_id", "ok")


@query("""SELECT doc_id, coalesce(quality, -1)::INTEGER AS quality, coalesce(toxic, 0)::INTEGER AS toxic, quality IS NOT NULL AS found FROM documents LEFT JOIN (SELECT doc_id, quality, toxic FROM labels) USING (doc_id)""")
def missing_fill(spark: SparkSession, sf: str) -> DataFrame:
    labels = table(spark, sf, "labels").withColumn("found", F.lit(True))
    return relational.fill_missing(table(spark, sf, "documents").select("doc_id"), labels, ["doc_id"], {"quality": -1, "toxic": 0, "found": False})


@query("""SELECT conv_id, turn::BIGINT AS turn, '{"custom_id":"' || conv_id || '::' || turn || '","method":"POST","url":"/v1/chat/completions","body":{"model":"model","temperature":0,"messages":[{"role":"system","content":"system"},{"role":"user","content":'
|| to_json(text) || '}],"response_format":{"type":"json_object"}}}' AS line, role FROM conversations""")
def request_lines(spark: SparkSession, sf: str) -> DataFrame:
    """The batch request line of every turn, whole."""
    line = batching.request_line(text.composite_id(F.col("conv_id").cast("string"), F.col("turn")), "model", "system", F.col("text"))
    return table(spark, sf, "conversations").select("conv_id", F.col("turn").cast("long").alias("turn"), "role", line.alias("line"))


@query("SELECT conv_id::VARCHAR || '::' || turn AS custom_id, nullif(trim(text), '') AS content FROM conversations")
def batch_replies(spark: SparkSession, sf: str) -> DataFrame:
    """Contents of response lines: strings and lists of parts, with broken lines between them."""
    c = table(spark, sf, "conversations").withColumn("custom_id", text.composite_id(F.col("conv_id").cast("string"), F.col("turn")))
    plain = F.struct(F.struct(F.array(F.struct(F.struct(F.col("text").alias("content")).alias("message"))).alias("choices")).alias("body"))
    parts = F.array(F.struct(F.lit("text").alias("type"), F.col("text").alias("text")), F.struct(F.lit("image").alias("type"), F.lit("x").alias("text")))
    listed = F.struct(F.struct(F.array(F.struct(F.struct(parts.alias("content")).alias("message"))).alias("choices")).alias("body"))
    line = lambda r: F.to_json(F.struct("custom_id", r.alias("response")))
    good = c.select(F.when(F.col("turn") % 2 == 0, line(plain)).otherwise(line(listed)).alias("value"))
    broken = c.limit(3).select(F.explode(F.array(F.lit(""), F.lit("{broken"), F.lit('{"response":{}}'))).alias("value"))
    return batching.replies(good.unionByName(broken))


from . import catalogue_stages  # noqa: E402,F401  registers its queries here
