"""Relational operators over any frame: versions, differences, defaults and counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F


def newest_first(*columns: str) -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in columns]


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row of each key, the first by ``order``; the order should be total.

    Filters on keys pass below the window; a limit per group is pushed below the shuffle.
    """
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).where("_place = 1").drop("_place")


def ranked(df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str = "rank", most: int = 0) -> DataFrame:
    """Numbers each key's rows from 1; keeps the first ``most`` unless that is 0."""
    out = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("int"))
    return out.where(F.col(name) <= most) if most > 0 else out


def null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    on = F.lit(True)
    for k in keys:
        on = on & left[k].eqNullSafe(right[k])
    return on


def to_refresh(rows: DataFrame, stored: DataFrame, keys: Sequence[str], hash_column: str = "TextHash", force: bool = False) -> DataFrame:
    """The rows whose hash is not the stored one; all of them with ``force``. Null keys equal each other."""
    if force:
        return rows
    known = stored.select(*keys, hash_column)
    same = null_safe(rows, known, keys) & (rows[hash_column] == known[hash_column])
    return rows.join(known, same, "left_anti")


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target with the source's rows in place of those of equal keys (nulls equal)."""
    return target.join(source.select(*keys).distinct(), null_safe(target, source, keys), "left_anti").unionByName(source, allowMissingColumns=True)


def replace_scope(target: DataFrame, scope: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target without the rows of the scope's keys, and with the new ones."""
    return target.join(scope.select(*keys).distinct(), list(keys), "left_anti").unionByName(new, allowMissingColumns=True)


def fill_missing(rows: DataFrame, results: DataFrame, keys: Sequence[str], defaults: Mapping[str, object]) -> DataFrame:
    """Every row with its result, or the defaults where there is none."""
    found = results.withColumn("_found", F.lit(True))
    joined = rows.join(found, list(keys), "left")
    value = lambda c: F.when(F.col("_found"), F.col(c)).otherwise(F.lit(defaults[c])) if c in defaults else F.col(c)
    return joined.withColumns({c: value(c) for c in results.columns if c not in keys}).drop("_found")


def counts_of(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """One row with the number of rows of each value, 0 where there is none."""
    return df.agg(*(F.count_if(F.col(column) == v).alias(v) for v in values))


def numbered(df: DataFrame, order: Sequence[Column], name: str = "#") -> DataFrame:
    """Lines of a report, numbered in order; for results that a person reads."""
    return df.withColumn(name, F.row_number().over(Window.orderBy(*order)))


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """The same rows, and a count of them that an action on these fills in as it runs."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen
