"""Links that a model proposes for a task: payload, validation, choice and diagnostics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import bind, text_or_empty
from ..functions.numbers import clamp01
from ..functions.text import REASON_LIMIT, clipped, remove_prefix, strip_fence

OK, MODEL_ERROR, INVALID = "ok", "llm_error", "invalid_json"
STATUSES = (OK, MODEL_ERROR, INVALID)
METHOD = "embedding_topk_llm_resolver"
LEAST_CONFIDENCE, MOST_LINKS = 0.75, 3

RESULT = (
    "struct<status:string,links:array<struct<candidate_id:int,confidence:double,reason_short:string>>,error_type:string,error_message:string,"
    "raw_links_count:int,valid_links_count:int,dropped_invalid_count:int,duplicate_candidate_count:int>"
)


def payload(topk: DataFrame, keys: Sequence[str] = ("TimelineName", "TaskRowId")) -> DataFrame:
    """One row of each task: (keys, offered, payload), its candidates in the order of their ranks."""
    s = lambda c: text_or_empty(F.col(c))
    candidate = F.struct(
        F.col("RetrievalRank").cast("int").alias("candidate_id"), F.col("Similarity").alias("similarity"), s("MdrDocumentTitle").alias("mdr_document_title"),
        s("ConsolidatedRaciTitle").alias("raci_title"), s("EffectiveDescription").alias("raci_description"), s("DisciplineName").alias("discipline"),
        s("TypeName").alias("type"), s("CategoryDescription").alias("category"), s("ChapterName").alias("chapter"),
    )
    named = (
        ("task_code", "TaskCode"), ("task_name", "TaskName"), ("wbs_name", "WbsName"), ("task_start_date", "TaskStartDate"), ("task_finish_date", "TaskFinishDate"),
        ("task_actual_start_date", "TaskActualStartDate"), ("task_actual_finish_date", "TaskActualFinishDate"), ("task_date_fields_json", "TaskDateFieldsJson"),
        ("task_class_reason", "TaskClassReason"), ("task_class_confidence", "TaskClassConfidence"),
    )
    task = F.struct(*(s(c).alias(n) for n, c in named), remove_prefix(F.col("TaskName")).alias("task_name_clean"))
    grouped = topk.groupBy(*keys).agg(F.min_by(task, "RetrievalRank").alias("task"), F.array_sort(F.collect_list(candidate)).alias("candidates"))
    return grouped.select(*keys, F.transform("candidates", lambda c: c["candidate_id"]).alias("offered"), F.to_json(F.struct("task", "candidates")).alias("payload"))


def _failure(status: str, kind: str, message: str) -> Column:
    none, zero = F.array().cast("array<struct<candidate_id:int,confidence:double,reason_short:string>>"), F.lit(0)
    return F.struct(
        F.lit(status).alias("status"), none.alias("links"), F.lit(kind).alias("error_type"), F.lit(message).alias("error_message"),
        *(zero.alias(f"{n}_count") for n in ("raw_links", "valid_links", "dropped_invalid", "duplicate_candidate")),
    )


def _kind(v: Column) -> Column:
    return F.schema_of_variant(v)


def _checked(items: Column, offered: Column) -> Column:
    """The result for an array of proposed links, each one a variant."""
    def read(x: Column, at: Column) -> Column:
        proposed = F.when(_kind(x).startswith("OBJECT"), F.try_variant_get(x, "$.candidate_id", "int"))
        sure = clamp01(F.coalesce(F.try_variant_get(x, "$.confidence", "double"), F.lit(0.0)))
        reason = F.try_variant_get(x, "$.reason_short", "string")
        reason = F.when(reason.isin("0", "0.0", "false", "[]", "{}"), "").otherwise(F.coalesce(reason, F.lit("")))
        return F.struct(proposed.alias("id"), (-sure).alias("order"), at.alias("at"), clipped(reason, REASON_LIMIT).alias("reason"))

    def result(valid: Column) -> Column:
        best = F.filter(valid, lambda x, i: (i == 0) | (x["id"] != F.get(valid, F.greatest(i - 1, F.lit(0)))["id"]))
        links = F.transform(best, lambda x: F.struct(x["id"].alias("candidate_id"), (F.lit(0.0) - x["order"]).alias("confidence"), x["reason"].alias("reason_short")))
        return F.struct(
            F.lit(OK).alias("status"), links.alias("links"), F.lit("").alias("error_type"), F.lit("").alias("error_message"), F.size(items).alias("raw_links_count"),
            F.size(best).alias("valid_links_count"), (F.size(items) - F.size(valid)).alias("dropped_invalid_count"), (F.size(valid) - F.size(best)).alias("duplicate_candidate_count"),
        )

    kept = F.filter(F.transform(items, read), lambda x: F.coalesce(F.array_contains(offered, x["id"]), F.lit(False)))
    return bind(F.array_sort(kept), result)


def validated(response: Column, offered: Column) -> Column:
    """The checked result of a model's reply, given the ids that were offered.

    The reply may be fenced. Its root must be an object; ``links`` may be missing but not be anything
    else than a list. Items that are no objects, or whose id is no number or was not offered, are
    dropped. Of items with one id that of the highest confidence stays, the first of equals. A null
    reply is a failed call.
    """
    def read(v: Column) -> Column:
        links = F.try_variant_get(v, "$.links", "variant")
        items = F.try_variant_get(v, "$.links", "array<variant>")
        no_root = _failure(INVALID, "invalid_root", "the reply's root is not a JSON object")
        no_list = _failure(INVALID, "invalid_links", "the reply's links are not a list")
        return (
            F.when(v.isNull() | ~F.coalesce(_kind(v).startswith("OBJECT"), F.lit(False)), no_root)
            .when(links.isNull(), _checked(F.array().cast("array<variant>"), offered))
            .when(~_kind(links).startswith("ARRAY"), no_list)
            .otherwise(_checked(items, offered))
        )

    failed = _failure(MODEL_ERROR, "llm_error", "the call failed")
    return F.when(response.isNull(), failed.cast(RESULT)).otherwise(bind(F.try_parse_json(strip_fence(response)), read).cast(RESULT))


def chosen(resolved: DataFrame, topk: DataFrame, keys: Sequence[str] = ("TimelineName", "TaskRowId"), least: float = LEAST_CONFIDENCE, most: int = MOST_LINKS) -> DataFrame:
    """The links above the threshold, with their candidates' columns, LinkRank, LinkScore and LinkReason.

    ``resolved`` has the keys and ``result``. Ranks go by confidence, then similarity, then candidate id;
    ``most`` of 0 keeps all.
    """
    links = resolved.where(F.col("result.status") == OK).select(*keys, F.explode("result.links").alias("link"))
    links = links.where(F.col("link.confidence") >= least).select(*keys, F.col("link.candidate_id").alias("RetrievalRank"), F.col("link.confidence").alias("LinkScore"), F.col("link.reason_short").alias("LinkReason"))
    rows = links.join(topk, [*keys, "RetrievalRank"])
    order = (F.desc("LinkScore"), F.desc_nulls_last("Similarity"), F.asc("RetrievalRank"))
    rows = rows.withColumn("LinkRank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("int")).withColumn("LinkMethod", F.lit(METHOD))
    return rows.where(F.col("LinkRank") <= most) if most > 0 else rows


def diagnostics(resolved: DataFrame, least: float = LEAST_CONFIDENCE, most: int = MOST_LINKS, keys: Sequence[str] = ("TimelineName", "TaskRowId")) -> DataFrame:
    """One row of each task: its status and what became of the proposed links."""
    above = F.size(F.filter("result.links", lambda x: x["confidence"] >= least))
    saved = F.least(above, F.lit(most)) if most > 0 else above
    ok = F.col("result.status") == OK
    return resolved.select(
        *keys, F.col("result.status").alias("TaskStatus"), F.col("result.error_type").alias("ErrorType"), F.col("result.error_message").alias("ErrorMessage"),
        F.col("result.raw_links_count").alias("RawLinkCount"), F.col("result.valid_links_count").alias("ValidLinkCount"), F.when(ok, saved).otherwise(0).alias("SavedLinkCount"),
        F.col("result.dropped_invalid_count").alias("DroppedInvalidCount"), F.when(ok, F.size("result.links") - above).otherwise(0).alias("DroppedByThreshold"),
        F.col("result.duplicate_candidate_count").alias("DuplicateCandidateCount"),
    )


def status_counts(resolved: DataFrame) -> DataFrame:
    return resolved.agg(*(F.count_if(F.col("result.status") == s).alias(s) for s in STATUSES))


def scope_ok(resolved: DataFrame, keys: Sequence[str] = ("TimelineName", "TaskRowId")) -> DataFrame:
    """The tasks whose stored links are to be replaced: those resolved, also with no link."""
    return resolved.where(F.col("result.status") == OK).select(*keys).distinct()
