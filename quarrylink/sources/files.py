"""Plain files of the stages: saved samples, manifests, request files and reply files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SAMPLE = "TimelineName string, TaskRowId long"
MANIFEST = "created_at string, kind string, model string, prompt_version string, top_k int, batch_ids array<string>, snapshot string"


def list_workbooks(spark: SparkSession, folder: str) -> list[str]:
    """Paths of the folder's workbooks by name; an error if there is none."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").load(folder).select("path").orderBy("path").collect()
    if not files:
        raise FileNotFoundError(f"no workbooks in {folder}")
    return [f.path for f in files]


def read_sample(spark: SparkSession, path: str) -> DataFrame:
    """A saved sample; the schema is given, as ids of digits would be read as numbers."""
    return spark.read.schema(SAMPLE).option("header", True).csv(path)


def write_sample(rows: DataFrame, path: str) -> None:
    rows.select("TimelineName", "TaskRowId").write.mode("overwrite").option("header", True).csv(path)


def write_manifest(spark: SparkSession, path: str, **fields) -> None:
    """One JSON document that says what was sent, for the process that collects."""
    spark.createDataFrame([{k: fields.get(k) for k in (c.split()[0] for c in MANIFEST.split(", "))}], MANIFEST).coalesce(1).write.mode("overwrite").json(path)


def read_manifest(spark: SparkSession, path: str) -> dict:
    found = spark.read.schema(MANIFEST).json(path).first()
    if found is None or found.batch_ids is None:
        raise ValueError(f"no manifest in {path}")
    return found.asDict()


def write_requests(packed: DataFrame, folder: str) -> None:
    """Request lines as text, a folder of one file for each chunk, in order within it."""
    rows = packed.where("chunk is not null").withColumn("file", F.concat_ws("-", "group", F.format_string("%06d", "chunk")))
    rows.repartition("file").sortWithinPartitions("file", "position").select("file", F.col("line").alias("value")).write.mode("overwrite").partitionBy("file").text(folder)


def read_lines(spark: SparkSession, folder: str) -> DataFrame:
    """(value, file, pos) of the lines of all files, in the order that decides between lines with one id."""
    rows = spark.read.text(folder, lineSep="\n").select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    return rows.select("value", "file", F.struct("block", "row").alias("pos"))


