"""Tables of parquet files that change in whole versions.

A table is a folder with a folder for each version and a file ``current`` that names the one that
counts. A write makes a new version and then moves the name, in one rename: readers see the old rows or
the new ones, and a write that fails leaves the old version as it was. Old versions stay, as frames made
from them may still be read, until ``vacuum`` removes them. Paths may be of any file system that Spark
knows; files other than data are written through it too.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.relational import replace_scope, upsert
from . import schemas


class Store:
    """The pipeline's tables below one path."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _file(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def _current(self, table: str) -> str | None:
        fs, p = self._file(f"{self.root}/{table}/current")
        if not fs.exists(p):
            return None
        stream = fs.open(p)
        try:
            name = bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()
        return f"{self.root}/{table}/{name}"

    def read(self, table: str) -> DataFrame:
        """The current version; an empty frame of the table's schema if there is none."""
        path = self._current(table)
        if path is None:
            return self.spark.createDataFrame([], schemas.TABLES[table])
        return self.spark.read.schema(schemas.TABLES[table]).parquet(path)

    def write(self, table: str, rows: DataFrame) -> DataFrame:
        """Replace the table by these rows."""
        name = f"v-{uuid.uuid4().hex}"
        schemas.conform(rows, table).write.parquet(f"{self.root}/{table}/{name}")
        fs, new = self._file(f"{self.root}/{table}/current-{name}")
        stream = fs.create(new)
        stream.write(bytearray(name.encode()))
        stream.close()
        context = self.spark.sparkContext._jvm.org.apache.hadoop.fs.FileContext.getFileContext(new.toUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        _, target = self._file(f"{self.root}/{table}/current")
        option = self.spark.sparkContext._gateway.new_array(self.spark.sparkContext._jvm.org.apache.hadoop.fs.Options.Rename, 1)
        option[0] = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        qualified = fs.makeQualified
        context.rename(qualified(new), qualified(target), option)
        return self.read(table)

    def vacuum(self, table: str) -> int:
        """Remove all versions but the current one, for which no reader may still wait; how many."""
        current = self._current(table)
        fs, folder = self._file(f"{self.root}/{table}")
        gone = [x.getPath() for x in fs.listStatus(folder) if x.isDirectory() and x.getPath().getName() != (current or "").rsplit("/", 1)[-1]]
        return sum(bool(fs.delete(path, True)) for path in gone)

    def append(self, table: str, rows: DataFrame, by: str) -> DataFrame:
        """Add rows as new versions of their keys; the files of the others are not written again."""
        path = self._current(table)
        stamped = self._stamped(rows, by)
        if path is None:
            return self.write(table, stamped)
        schemas.conform(stamped, table).write.mode("append").parquet(path)
        return self.read(table)

    def _stamped(self, rows: DataFrame, by: str) -> DataFrame:
        now = F.current_timestamp().cast("timestamp_ntz")
        return rows.withColumns({"CreatedAt": now, "UpdatedAt": now, "CreatedBy": F.lit(by)})

    def upsert(self, table: str, rows: DataFrame, by: str) -> DataFrame:
        """Rows in place of those with their keys; null keys equal each other."""
        new = schemas.conform(self._stamped(rows, by), table)
        return self.write(table, upsert(self.read(table), new, schemas.KEYS[table]))

    def replace_where(self, table: str, scope: Column, rows: DataFrame, by: str) -> DataFrame:
        """Rows in place of all those in the scope, in one step, also if there are none."""
        old = self.read(table).where(~F.coalesce(scope, F.lit(False)))
        return self.write(table, old.unionByName(schemas.conform(self._stamped(rows, by), table)))

    def replace_keys(self, table: str, scope: DataFrame, rows: DataFrame, keys: Sequence[str], by: str) -> DataFrame:
        """Rows in place of those with the scope's keys; keys out of the scope keep theirs."""
        return self.write(table, replace_scope(self.read(table), scope, schemas.conform(self._stamped(rows, by), table), keys))

    def prune(self, table: str, keep: DataFrame, keys: Sequence[str]) -> DataFrame:
        """Only rows whose keys still exist."""
        return self.write(table, self.read(table).join(keep.select(*keys).distinct(), list(keys), "left_semi"))
