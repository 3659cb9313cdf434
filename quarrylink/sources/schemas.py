"""Schemas of the pipeline's tables, and their DDL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_DATES = "TaskStartDate timestamp_ntz, TaskFinishDate timestamp_ntz, TaskActualStartDate timestamp_ntz, TaskActualFinishDate timestamp_ntz, TaskDateFieldsJson string"
_CLASS = "TaskClass string, TaskClassConfidence string, TaskClassReason string"
_CONSOLIDATED = "ConsolidatedDecisionType string, ConsolidatedTitleKey string, ConsolidatedRaciTitle string, ConsolidatedConfidence double, ConsolidatedReason string, ConsolidatedSource string"
_EMBEDDED = "EmbeddingModel string, TextHash string, Embedding array<float>, Dim int"
_AUDIT = "CreatedAt timestamp_ntz, UpdatedAt timestamp_ntz, CreatedBy string"

#: The columns of each table, in order.
TABLES = {
    "TimelineTasksClassified": f"TimelineName string, ProjectCode string, TaskRowId long, TaskCode string, TaskName string, WbsName string, {_DATES}, TaskText string, {_CLASS}, ClassifierModel string, ClassifierPromptVersion string, {_AUDIT}",
    "TimelineTaskEmbeddings": f"TimelineName string, ProjectCode string, TaskRowId long, TaskText string, {_EMBEDDED}, {_AUDIT}",
    "TimelineMdrCandidateEmbeddings": f"TimelineName string, ProjectCode string, MdrDocumentTitle string, MdrTitleKey string, {_CONSOLIDATED}, EffectiveDescription string, DisciplineName string, TypeName string, CategoryDescription string, ChapterName string, CandidateText string, {_EMBEDDED}, {_AUDIT}",
    "TimelineTaskToMdrCandidates": f"TimelineName string, ProjectCode string, TaskRowId long, TaskName string, WbsName string, {_DATES}, MdrDocumentTitle string, MdrTitleKey string, ConsolidatedTitleKey string, ConsolidatedRaciTitle string, Similarity double, Rank int, EmbeddingModel string, RetrievalMethod string, TaskTextHash string, CandidateTextHash string, CreatedAt timestamp_ntz, CreatedBy string",
    "TimelineTaskToMdrLinks": f"TimelineName string, ProjectCode string, TaskRowId long, TaskCode string, TaskName string, WbsName string, {_DATES}, {_CLASS}, MdrDocumentTitle string, MdrTitleKey string, LinkRank int, LinkScore double, LinkMethod string, LinkReason string, {_CONSOLIDATED}, CreatedAt timestamp_ntz, CreatedBy string",
}
KEYS = {
    "TimelineTasksClassified": ["TimelineName", "TaskRowId"],
    "TimelineTaskEmbeddings": ["TimelineName", "TaskRowId", "EmbeddingModel"],
    "TimelineMdrCandidateEmbeddings": ["TimelineName", "MdrDocumentTitle", "ConsolidatedTitleKey", "EmbeddingModel"],
    "TimelineTaskToMdrCandidates": ["TimelineName", "TaskRowId", "MdrDocumentTitle", "ConsolidatedTitleKey", "EmbeddingModel", "Rank"],
    "TimelineTaskToMdrLinks": ["TimelineName", "TaskRowId", "MdrTitleKey"],
}
ABOUT = {
    "TimelineTasksClassified": "Schedule tasks with their class; a row for each version",
    "TimelineTaskEmbeddings": "Vectors of the texts of tasks that progress documents",
    "TimelineMdrCandidateEmbeddings": "Vectors of the matched titles of the document register",
    "TimelineTaskToMdrCandidates": "The nearest documents of each task",
    "TimelineTaskToMdrLinks": "Links of tasks to documents that were resolved",
}


def columns(table: str) -> list[str]:
    return [c.split()[0] for c in TABLES[table].split(", ")]


def ddl(table: str, database: str) -> list[str]:
    """Statements that create the table if it is missing, with comments and defaults of the audit columns."""
    parts = []
    for column in TABLES[table].split(", "):
        name, kind = column.split()
        default = " DEFAULT localtimestamp()" if name in ("CreatedAt", "UpdatedAt") else ""
        parts.append(f"{name} {kind}{default} COMMENT '{_about(name)}'")
    return [f"CREATE SCHEMA IF NOT EXISTS {database}", f"CREATE TABLE IF NOT EXISTS {database}.{table} ({', '.join(parts)}) USING parquet COMMENT '{ABOUT[table]}'"]


def _about(name: str) -> str:
    """A column's comment: its name as words."""
    words = "".join(f" {c.lower()}" if c.isupper() else c for c in name).strip()
    return words[0].upper() + words[1:]


def create(spark: SparkSession, database: str) -> None:
    """Create what is missing, and add columns that tables of an earlier version lack."""
    for table, schema in TABLES.items():
        for statement in ddl(table, database):
            spark.sql(statement)
        have = set(spark.table(f"{database}.{table}").columns)
        lacking = [c for c in schema.split(", ") if c.split()[0] not in have]
        if lacking:
            spark.sql(f"ALTER TABLE {database}.{table} ADD COLUMNS ({', '.join(lacking)})")


def conform(df: DataFrame, table: str) -> DataFrame:
    """The table's columns in order and type; columns that are missing are null, texts that are no times too."""
    from pyspark.sql import functions as F

    out = []
    for column in TABLES[table].split(", "):
        name, kind = column.split()
        value = F.col(name) if name in df.columns else F.lit(None)
        out.append((value.try_cast(kind) if kind in ("timestamp_ntz", "double", "int", "long") else value.cast(kind)).alias(name))
    return df.select(*out)
