"""Helpers the operators share: checkpoints, lambda-bound values, connected components."""

from __future__ import annotations

import atexit
import contextlib
import gc
import tempfile
import time
import uuid
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def ready_checkpoints(spark: SparkSession) -> None:
    """Use the folder of spark.checkpoint.dir; only where it is unset, and Spark local, a temporary one."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared and not context.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(shared or tempfile.mkdtemp(prefix="quarrylink-checkpoint-"))


def settle(df: DataFrame) -> DataFrame:
    """Write to a table of its own in the shared checkpoint folder, and read that.

    It survives lost executors and cuts the lineage as a checkpoint does, but the last step runs once
    and the rows are compressed. The tables of a process are removed when it ends.
    """
    ready_checkpoints(df.sparkSession)
    context = df.sparkSession.sparkContext
    path = f"{context.getCheckpointDir()}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if not _registered:
        _registered.append(atexit.register(_remove, context))
    _written.append(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._settled = path
    return out


def discard(table: DataFrame) -> None:
    """Remove a table that ``settle`` gave and that no frame will read again, to free its disk before the process ends."""
    _written.remove(table._settled)
    _delete(table.sparkSession.sparkContext, table._settled)


_written: list[str] = []
_registered: list = []


def _remove(context) -> None:
    with contextlib.suppress(Exception):  # the session may have ended before
        for path in _written:
            _delete(context, path)


def _delete(context, path: str) -> None:
    p = context._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(context._jsc.hadoopConfiguration()).delete(p, True)


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of frames that are no longer referenced, before more are written."""
    for _ in range(2):  # the first pass lets go of what Python held, the second of what that held
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.2)


def small_batches(spark: SparkSession, rows: int = 512) -> None:
    """Bound what one Arrow batch of whole texts holds; texts may be very long."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key, "10000")) > rows:
        spark.conf.set(key, str(rows))


#: Bits of a table that tells which rows an exact join may find (8 MB at any size of the input).
TABLE_BITS = 26


def bit_table(rows: DataFrame, column: str, bits: int = TABLE_BITS) -> np.ndarray:
    """A table of 2**bits bits, set at the column's lowest bits: its size does not depend on the rows."""
    at = F.col(column).bitwiseAND(F.lit((1 << bits) - 1)) + 1  # these functions number from 1
    parts = rows.groupBy(F.bitmap_bucket_number(at).alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits"))
    out = np.zeros((1 << bits) // 8, np.uint8)
    for b, found in parts.collect():  # 4 KB for each of 2**(bits - 15) buckets at most
        own = out[(b - 1) * 4096 : b * 4096]
        own[:] = np.frombuffer(bytes(found), np.uint8)[: len(own)]
    return out


def in_table(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Whether each value's bit is set: always for values the table was made of, seldom for others while it is sparse."""
    at = values & (8 * len(table) - 1)
    return (table[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and hand it to ``body``, also where ``body`` uses it inside lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def components(edges: DataFrame, left: str = "u", right: str = "v") -> DataFrame:
    """Connected components of an undirected edge list: one row (node, component) per node.

    Randomised contraction: in each round every node moves to the closed neighbour whose hash is
    least, then edges are rewritten to those targets. The number of edges falls geometrically, also
    on chains whose ids ascend. Hubs cost no more than a partial aggregate and a join that AQE can
    split. Self-loops and null ends are ignored; no edges give no rows. ``component`` is the id of
    one of the nodes, the same for all of a component.
    """
    rank = lambda c: F.struct(F.xxhash64(c).alias("h"), c.alias("n"))
    live = settle(
        edges.select(F.col(left).alias("u"), F.col(right).alias("v"))
        .where("u is not null and v is not null and u <> v")
        .select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
        .distinct()
    )
    steps: list[DataFrame] = []
    while not live.isEmpty():
        both = live.unionByName(live.select(F.col("v").alias("u"), F.col("u").alias("v")))
        best = both.groupBy("u").agg(F.min(rank(F.col("v"))).alias("m"))
        to = best.select(F.col("u").alias("node"), F.least(rank(F.col("u")), F.col("m"))["n"].alias("to"))
        jump = to.select(F.col("node").alias("to"), F.col("to").alias("far"))
        to = settle(to.join(jump, "to").select("node", F.col("far").alias("to")))
        steps.append(to)
        at_u = to.select(F.col("node").alias("u"), F.col("to").alias("pu"))
        at_v = to.select(F.col("node").alias("v"), F.col("to").alias("pv"))
        live = settle(
            live.join(at_u, "u").join(at_v, "v").where("pu <> pv")
            .select(F.least("pu", "pv").alias("u"), F.greatest("pu", "pv").alias("v")).distinct()
        )
    if not steps:
        return live.select(F.col("u").alias("node"), F.col("v").alias("component"))
    found = steps[0].withColumnRenamed("to", "component")
    for step in steps[1:]:
        step = step.select(F.col("node").alias("component"), F.col("to").alias("_next"))
        found = found.join(step, "component", "left").select("node", F.coalesce("_next", "component").alias("component"))
    return found if len(steps) == 1 else settle(found)
