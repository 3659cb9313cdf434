"""Small expression helpers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it by name in ``body``, inside lambdas too."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def text_or_empty(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(""))
