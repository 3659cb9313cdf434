"""The five stages: classify, embed, retrieve, resolve and report, over a store of tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import composite_id, remove_prefix, task_text, text_hash
from ..operators import relational, resolve, retrieval, sampling
from ..sources.config import Settings
from ..sources.schemas import KEYS
from ..sources.storage import Store
from . import providers

TASK = ["TimelineName", "TaskRowId"]
PROMPT_VERSION = "timeline_task_classification_v1"
CLASSIFIED, TASK_VECTORS, CANDIDATE_VECTORS, CANDIDATES, LINKS = KEYS


def _of(df: DataFrame, timeline: str | None) -> DataFrame:
    return df if timeline is None else df.where(F.col("TimelineName") == timeline)


def latest(store: Store, table: str, timeline: str | None = None) -> DataFrame:
    """The newest version of each of the table's keys."""
    order = [c for c in ("UpdatedAt", "CreatedAt") if c in store.read(table).columns]
    return relational.latest_per_key(_of(store.read(table), timeline), KEYS[table], relational.newest_first(*order))


def classify(store: Store, tasks: DataFrame, classifier: providers.Classifier, model: str, limit: int = 0, saved: DataFrame | None = None) -> DataFrame:
    """Stage 1: a class for each task, or for a proportional sample, appended as its newest version."""
    rows = sampling.reuse_or_sample(tasks, saved, limit, ["TimelineName"], "TaskRowId")
    rows = rows.withColumn("_clean", remove_prefix(F.col("TaskName")))
    asked = providers.ask(rows, ["TaskName", "_clean", "WbsName"], classifier.classify)
    asked = asked.select("*", *providers.classification(F.col("reply"))).drop("reply", "_clean")
    text = task_text(F.col("TaskName"), F.col("WbsName"), F.col("TaskClass"))
    full = asked.withColumns({"TaskText": text, "ClassifierModel": F.lit(model), "ClassifierPromptVersion": F.lit(PROMPT_VERSION)})
    store.append(CLASSIFIED, full, "classify")
    return latest(store, CLASSIFIED)


def _refresh(store: Store, table: str, rows: DataFrame, text: str, embedder: providers.Embedder, batch: int, force: bool) -> int:
    """Embed the rows that are new or have changed and put them into the table; how many."""
    keys = KEYS[table]
    known = latest(store, table)
    rows = rows.withColumns({"TextHash": text_hash(F.col(text)), "EmbeddingModel": F.lit(embedder.model)}).dropDuplicates(keys)
    todo = relational.to_refresh(rows, known, keys, force=force).drop("EmbeddingModel")
    done = providers.embed(todo, text, embedder, batch).persist()
    try:
        n = done.count()
        if n:
            store.upsert(table, done, "embed")
        return n
    finally:
        done.unpersist()


def embed(store: Store, register: DataFrame, consolidated: DataFrame, descriptions: DataFrame, enriched: DataFrame, embedder: providers.Embedder, timeline: str | None = None, batch: int = 256, force: bool = False) -> tuple[int, int]:
    """Stage 2: vectors of tasks that progress documents, and of candidates; only what has changed is embedded."""
    tasks = latest(store, CLASSIFIED, timeline).where("TaskClass = 'ENG_DOC'").select("TimelineName", "ProjectCode", "TaskRowId", "TaskText")
    found = retrieval.build_candidates(register, consolidated, descriptions, enriched)
    found = _of(found, timeline).withColumn("ProjectCode", F.col("TimelineName"))
    return (
        _refresh(store, TASK_VECTORS, tasks, "TaskText", embedder, batch, force),
        _refresh(store, CANDIDATE_VECTORS, found, "CandidateText", embedder, batch, force),
    )


def retrieve(store: Store, model: str, timeline: str | None = None, top_k: int = retrieval.TOP_K) -> DataFrame:
    """Stage 3: the nearest candidates of each task in its timeline, in place of those of the scope."""
    classified = latest(store, CLASSIFIED, timeline).where("TaskClass = 'ENG_DOC'")
    tasks = latest(store, TASK_VECTORS, timeline).where(F.col("EmbeddingModel") == model).join(classified.select(*TASK), TASK, "left_semi")
    documents = latest(store, CANDIDATE_VECTORS, timeline).where(F.col("EmbeddingModel") == model)
    documents = documents.withColumn("candidate", F.xxhash64("TimelineName", "MdrDocumentTitle", "ConsolidatedTitleKey"))
    best = retrieval.topk_by_blocks(
        tasks.select("TimelineName", F.col("TaskRowId").alias("query"), F.col("Embedding").alias("vector")),
        documents.select("TimelineName", "candidate", F.col("Embedding").alias("vector")), "TimelineName", top_k,
    )
    best = best.withColumnsRenamed({"query": "TaskRowId", "similarity": "Similarity", "rank": "Rank"})
    rows = best.join(documents.select("TimelineName", "candidate", "MdrDocumentTitle", "MdrTitleKey", "ConsolidatedTitleKey", "ConsolidatedRaciTitle", F.col("TextHash").alias("CandidateTextHash")), ["TimelineName", "candidate"])
    rows = rows.join(tasks.select(*TASK, F.col("TextHash").alias("TaskTextHash")), TASK)
    rows = rows.join(classified.select(*TASK, "ProjectCode", "TaskName", "WbsName", "TaskStartDate", "TaskFinishDate", "TaskActualStartDate", "TaskActualFinishDate", "TaskDateFieldsJson"), TASK)
    rows = rows.withColumns({"EmbeddingModel": F.lit(model), "RetrievalMethod": F.lit(retrieval.METHOD)})
    scope = F.col("EmbeddingModel") == model
    store.replace_where(CANDIDATES, scope if timeline is None else scope & (F.col("TimelineName") == timeline), rows, "retrieve")
    return store.read(CANDIDATES)


def offered(store: Store, model: str, timeline: str | None = None, top_k: int = retrieval.TOP_K) -> DataFrame:
    """What is offered for each task: its candidates to rank ``top_k`` with task and candidate columns."""
    top = _of(store.read(CANDIDATES), timeline).where((F.col("EmbeddingModel") == model) & (F.col("Rank") <= top_k))
    top = relational.latest_per_key(top, KEYS[CANDIDATES], relational.newest_first("CreatedAt"))
    top = top.select(*TASK, "MdrDocumentTitle", "ConsolidatedTitleKey", "EmbeddingModel", F.col("Rank").alias("RetrievalRank"), "Similarity")
    tasks = latest(store, CLASSIFIED, timeline).drop("CreatedAt", "UpdatedAt", "CreatedBy", "TaskText", "ClassifierModel", "ClassifierPromptVersion")
    known = latest(store, CANDIDATE_VECTORS, timeline).drop("ProjectCode", "Embedding", "Dim", "TextHash", "CandidateText", "CreatedAt", "UpdatedAt", "CreatedBy")
    keys = ["TimelineName", "MdrDocumentTitle", "EmbeddingModel"]
    same = (top["ConsolidatedTitleKey"].eqNullSafe(known["ConsolidatedTitleKey"])) & relational.null_safe(top, known, keys)
    rows = top.join(known, same, "left").select(top["*"], *(known[c] for c in known.columns if c not in top.columns))
    return rows.join(tasks, TASK)


def resolve_links(store: Store, resolver: providers.Resolver, settings: Settings, timeline: str | None = None, workers: int = 1) -> tuple[DataFrame, DataFrame]:
    """Stage 4: links that the resolver proposes and that hold, in place of those of the tasks it answered for.

    Returns the diagnostics and the status counts. Tasks whose call failed or whose reply is broken keep
    the links they had.
    """
    rows = offered(store, settings.embedding_model, timeline, settings.top_k)
    call = lambda payload: providers.retrying(lambda: resolver.resolve(payload), settings.retries, settings.backoff)
    answered = providers.ask(resolve.payload(rows), ["payload"], call, workers=workers)
    result = answered.select(*TASK, resolve.validated(F.col("reply"), F.col("offered")).alias("result")).persist()
    try:
        links = resolve.chosen(result, rows, TASK, settings.least_confidence, settings.most_links)
        store.replace_keys(LINKS, resolve.scope_ok(result, TASK), links, TASK, "resolve")
        notes = resolve.diagnostics(result, settings.least_confidence, settings.most_links, TASK)
        spark = store.spark
        return spark.createDataFrame(notes.toArrow()), spark.createDataFrame(resolve.status_counts(result).toArrow())
    finally:
        result.unpersist()


def link_view(store: Store, timeline: str | None = None) -> DataFrame:
    """Stage 5: every task with its links, and tasks without any; one row for each link."""
    links = latest(store, LINKS, timeline)
    counts = links.groupBy(*TASK).agg(F.count("*").alias("n"))
    own = links.select(*TASK, "LinkRank", "LinkReason", "MdrDocumentTitle", F.col("ConsolidatedRaciTitle").alias("DocumentRaciTitle"))
    tasks = latest(store, CLASSIFIED, timeline)
    rows = tasks.join(counts, TASK, "left").join(own, TASK, "left").withColumn("ResolverLinkCount", F.coalesce("n", F.lit(0)))
    return rows.withColumn("custom_id", composite_id(F.col("TimelineName"), F.col("TaskRowId"))).drop("n")
