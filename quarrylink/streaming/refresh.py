"""Continuous refresh: rows that land in a folder are put into a table by micro-batches."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.relational import latest_per_key
from ..sources.storage import Store


def landing(spark: SparkSession, folder: str, schema: str, files: int = 100) -> DataFrame:
    """New parquet files of a folder, at most so many in a batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(folder)


def upsert_into(store: Store, table: str, keys: Sequence[str], order: str, by: str = "stream") -> Callable[[DataFrame, int], None]:
    """What to do with a batch: its newest row of each key goes into the table. Doing so twice changes nothing."""
    def run(batch: DataFrame, _: int) -> None:
        store.upsert(table, latest_per_key(batch, list(keys), [F.desc_nulls_last(order)]), by)

    return run


def run_available(stream: DataFrame, action: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Everything that has landed so far, then stop; the checkpoint knows what was done."""
    query = stream.writeStream.foreachBatch(action).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
