"""Batch files for a model provider: requests, packing, adaptive limits, and reading the replies."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import line_bytes, reply_text

#: Limits of a batch file in bytes, and of adaptive tranches in requests.
HARD_BYTES, TARGET_BYTES = 209_715_200, 120_000_000
FIRST_LIMIT, LEAST_LIMIT, MOST_LIMIT, BACKOFF, GROWTH = 800, 100, 1200, 0.5, 1.25
ENDPOINT = "/v1/chat/completions"
ENDED = ("completed", "failed", "cancelled", "canceled", "expired")


def request_line(custom_id: Column, model: str, system: str, user: Column, endpoint: str = ENDPOINT) -> Column:
    """One JSON line of a batch file."""
    said = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    body = F.struct(
        F.lit(model).alias("model"), F.lit(0).alias("temperature"), F.array(said("system", F.lit(system)), said("user", user)).alias("messages"),
        F.struct(F.lit("json_object").alias("type")).alias("response_format"),
    )
    return F.to_json(F.struct(custom_id.alias("custom_id"), F.lit("POST").alias("method"), F.lit(endpoint).alias("url"), body.alias("body")))


def split_oversize(lines: DataFrame, column: str = "line", most: int = TARGET_BYTES) -> tuple[DataFrame, DataFrame]:
    """The lines that fit into a file, with their bytes, and those that don't."""
    sized = lines.withColumn("bytes", line_bytes(F.col(column)).cast("long"))
    return sized.where(F.col("bytes") <= min(most, HARD_BYTES)), sized.where(F.col("bytes") > min(most, HARD_BYTES))


def pack(lines: DataFrame, group: str, order: str, size: str = "bytes", most: int = TARGET_BYTES) -> DataFrame:
    """(group, order, size, chunk): in each group, a line that would overflow the chunk opens the next one.

    The fold needs a group's order but no more memory than a running total. A line over the limit has no
    chunk. Only the three columns are shuffled.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, total, chunk = object(), 0, 0
        for batch in batches:
            chunks = []
            for g, n in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if g != at:
                    at, total, chunk = g, 0, 0
                if n > most:
                    chunks.append(None)
                    continue
                if total and total + n > most:
                    total, chunk = 0, chunk + 1
                total += n
                chunks.append(chunk)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(chunks, pa.int32())], [*batch.schema.names, "chunk"])

    rows = lines.select(group, order, F.col(size).cast("long").alias(size))
    kinds = dict(rows.dtypes)
    return rows.repartition(group).sortWithinPartitions(group, order).mapInArrow(run, f"`{group}` {kinds[group]}, `{order}` {kinds[order]}, `{size}` long, chunk int")


def next_limit(limit: int, ok: bool, least: int = LEAST_LIMIT, most: int = MOST_LIMIT, backoff: float = BACKOFF, growth: float = GROWTH) -> int:
    """The next tranche's size: smaller by at least one after a failure, larger by at least one after a success."""
    if ok:
        return min(most, max(limit + 1, int(limit * growth)))
    return max(least, min(limit - 1, int(limit * backoff)))


def limits(outcomes: DataFrame, group: str, order: str, ok: str, first: int = FIRST_LIMIT) -> DataFrame:
    """(group, order, ok, limit): the limit in force at each outcome of a group's sequence."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, now = object(), first
        for batch in batches:
            out = []
            for g, good in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if g != at:
                    at, now = g, min(MOST_LIMIT, max(LEAST_LIMIT, first))
                out.append(now)
                now = next_limit(now, bool(good))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.int32())], [*batch.schema.names, "limit"])

    rows = outcomes.select(group, order, ok)
    kinds = dict(rows.dtypes)
    return rows.repartition(group).sortWithinPartitions(group, order).mapInArrow(run, f"`{group}` {kinds[group]}, `{order}` {kinds[order]}, `{ok}` boolean, limit int")


@dataclass
class Tranches:
    """What an adaptive run did: how many were sent in each round, and what is left."""

    sent: list[int]
    left: int


def run_adaptive(pending: DataFrame, order: str, send: Callable[[DataFrame], DataFrame], keys: Sequence[str], first: int = FIRST_LIMIT, rounds: int = 0) -> tuple[DataFrame | None, Tranches]:
    """Sends tranches until none is pending, ``rounds`` are over, or a round at the least limit succeeds for none.

    ``send`` returns the rows that succeeded; a round is a success if all of its rows did.
    """
    done, now, sent = None, min(MOST_LIMIT, max(LEAST_LIMIT, first)), []
    while not rounds or len(sent) < rounds:
        left = pending if done is None else pending.join(done.select(*keys), list(keys), "left_anti")
        tranche = left.orderBy(order).limit(now)
        n = tranche.count()
        if not n:
            break
        got = send(tranche).checkpoint()
        ok = got.count()
        sent.append(n)
        done = got if done is None else done.unionByName(got)
        if not ok and now == LEAST_LIMIT:
            break
        now = next_limit(now, ok == n)
    left = pending if done is None else pending.join(done.select(*keys), list(keys), "left_anti")
    return done, Tranches(sent, left.count())


def wait(poll: Callable[[], str], sleep: Callable[[float], None], every: float = 60.0) -> str:
    """Polls a job until it has ended; its last status."""
    while (status := poll()) not in ENDED:
        sleep(every)
    return status


def replies(lines: DataFrame, column: str = "value") -> DataFrame:
    """(custom_id, content) from batch response lines; lines that are no JSON or have no id are left out.

    Of lines with one id the last by file and position counts, which the columns ``file`` and ``pos`` tell.
    """
    parsed = F.try_parse_json(column)
    rows = lines.select(F.try_variant_get(parsed, "$.custom_id", "string").alias("custom_id"), reply_text(F.col(column)).alias("content"), *[c for c in ("file", "pos") if c in lines.columns])
    rows = rows.where(F.coalesce(F.trim("custom_id") != "", F.lit(False)))
    order = [F.col(c).desc() for c in ("file", "pos") if c in lines.columns] or [F.col("content").desc_nulls_last()]
    last = F.row_number().over(Window.partitionBy("custom_id").orderBy(*order))
    return rows.withColumn("_last", last).where("_last = 1").select("custom_id", "content")
