"""Dates of tasks, which come in columns of many names, and as texts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import column_name, normalize_column_name

#: For each target column, the normalised names it may have, best first.
DATE_ALIASES: Mapping[str, Sequence[str]] = {
    "task_start_date": ("start", "start_date", "planned_start", "planned_start_date", "early_start", "early_start_date"),
    "task_finish_date": ("finish", "finish_date", "planned_finish", "planned_finish_date", "early_finish", "early_finish_date"),
    "task_actual_start_date": ("actual_start", "actual_start_date"),
    "task_actual_finish_date": ("actual_finish", "actual_finish_date"),
}
#: Parts of a normalised name that make a column one of dates.
DATE_WORDS = ("date", "start", "finish")


def first_filled(df: DataFrame, aliases: Sequence[str]) -> Column:
    """The first value that is not null among the columns of those normalised names; of equal names the last column."""
    by_name = {normalize_column_name(c): c for c in df.columns}
    found = [F.col(f"`{by_name[a]}`") for a in aliases if a in by_name]
    return F.coalesce(*found) if found else F.lit(None).cast("string")


def first_in_cells(cells: Column, aliases: Sequence[str]) -> Column:
    """The same over a map of cells whose keys are normalised names."""
    return F.coalesce(*(F.try_element_at(cells, F.lit(a)) for a in aliases))


def parse_time(value: Column) -> Column:
    """A time without zone from ISO text; null, not an error, for anything else."""
    return value.try_cast("timestamp_ntz")


def iso(value: Column) -> Column:
    return F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss")


def date_fields(cells: Column) -> Column:
    """A JSON object, keys sorted, of the filled cells whose names speak of dates."""
    named = F.map_filter(cells, lambda k, v: v.isNotNull() & F.exists(F.array(*map(F.lit, DATE_WORDS)), lambda w: F.contains(column_name(k), w)))
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(named))))


def date_fields_of(df: DataFrame) -> Column:
    """The same over a frame's columns: those of a date type, and those whose names speak of dates."""
    entries = []
    for name, kind in sorted(df.dtypes):
        dated = kind in ("date", "timestamp", "timestamp_ntz")
        if dated or any(w in normalize_column_name(name) for w in DATE_WORDS):
            value = iso(F.col(f"`{name}`")) if dated else F.col(f"`{name}`").cast("string")
            entries.append(F.struct(F.lit(name).alias("k"), value.alias("v")))
    if not entries:
        return F.lit("{}")
    return F.to_json(F.map_from_entries(F.filter(F.array(*entries), lambda e: e["v"].isNotNull())))


def add_date_columns(df: DataFrame) -> DataFrame:
    """The four date columns and the JSON of all date fields."""
    return df.withColumns({"task_date_fields_json": date_fields_of(df)} | {t: first_filled(df, a) for t, a in DATE_ALIASES.items()})
