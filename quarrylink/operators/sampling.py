"""Proportional quotas and seeded samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def group_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def proportional_quotas(counts: DataFrame, limit: int, keys: Sequence[str], n: str = "n") -> DataFrame:
    """Adds ``quota``: the limit dealt out by largest remainder, never more than a group has.

    If the limit is at least the number of non-empty groups each gets one at least, so that the sum may
    exceed the limit. Equal remainders go by key. A limit over the total gives every row. The frame has
    a row for each group, so one window over all of it is small.
    """
    everything, order = Window.partitionBy(), [F.col(k).asc_nulls_last() for k in keys]
    df = counts.withColumn("_all", F.sum(n).over(everything)).withColumn("_groups", F.sum(F.when(F.col(n) > 0, 1).otherwise(0)).over(everything))
    df = df.withColumn("_limit", F.least(F.lit(limit).cast("long"), F.col("_all")))
    raw = F.when(F.col(n) > 0, F.col("_limit") * F.col(n) / F.col("_all")).otherwise(0.0)
    df = df.withColumn("_raw", raw).withColumn("_floor", F.floor("_raw"))
    df = df.withColumn("_q", F.when((F.col(n) > 0) & (F.col("_limit") >= F.col("_groups")), F.greatest("_floor", F.lit(1))).otherwise(F.col("_floor")))
    df = df.withColumn("_left", F.greatest(F.lit(0), F.col("_limit") - F.sum("_q").over(everything)))
    open_ = F.col("_q") < F.col(n)
    turn = F.row_number().over(Window.partitionBy(open_).orderBy((F.col("_raw") - F.col("_floor")).desc(), *order))
    quota = F.col("_q") + F.when(open_ & (turn <= F.col("_left")), 1).otherwise(0)
    return df.withColumn("quota", F.least(quota, F.col(n)).cast("long")).select(*counts.columns, "quota")


def seeded_sample(df: DataFrame, quotas: DataFrame, keys: Sequence[str], row_id: str, seed: int = 42) -> DataFrame:
    """Of each group as many rows as its quota, in the order of a seeded hash of the row id."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.xxhash64(F.lit(seed), row_id), row_id))
    wanted = quotas.select(*keys, "quota")
    return df.join(wanted, list(keys)).withColumn("_place", place).where("_place <= quota").drop("_place", "quota")


def sample_fits(sample: DataFrame, quotas: DataFrame, keys: Sequence[str]) -> bool:
    """Whether a saved sample has just the groups and sizes that the quotas ask for."""
    have = group_counts(sample, keys)
    want = quotas.where("quota > 0").select(*keys, F.col("quota").alias("want"))
    return have.join(want, list(keys), "full").where("not (n <=> want)").isEmpty()


def reuse_or_sample(df: DataFrame, saved: DataFrame | None, limit: int, keys: Sequence[str], row_id: str, seed: int = 42) -> DataFrame:
    """The rows of the saved sample if it still fits, else a new sample; all rows for a limit of 0."""
    if limit <= 0:
        return df
    quotas = proportional_quotas(group_counts(df, keys), limit, keys)
    if saved is not None and sample_fits(saved, quotas, keys):
        return df.join(saved.select(*keys, row_id), [*keys, row_id], "left_semi")
    return seeded_sample(df, quotas, keys, row_id, seed)
