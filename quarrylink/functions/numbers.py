"""Number expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_float(value: Column, default: float = 0.0) -> Column:
    return F.coalesce(value.try_cast("double"), F.lit(default))


def clamp01(value: Column, nan_is_one: bool = False) -> Column:
    """Into [0, 1]. NaN is 0; with ``nan_is_one`` it is 1, as by comparisons in order."""
    kept = F.greatest(F.lit(0.0), F.least(F.lit(1.0), value))
    return kept if nan_is_one else F.when(F.isnan(value), F.lit(0.0)).otherwise(kept)
