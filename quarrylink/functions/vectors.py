"""Vectors are arrays of floats; sums are in double precision."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .expr import bind


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def normalise(v: Column) -> Column:
    """The vector over its norm; a zero vector stays."""
    return bind(norm(v), lambda n: F.when(n > 0, F.transform(v, lambda x: (x / n).cast("float"))).otherwise(v))


def cosine(a: Column, b: Column) -> Column:
    """The dot product of unit vectors; 0 where one is null, empty or of another length."""
    fine = (F.size(a) == F.size(b)) & (F.size(a) > 0)
    return F.when(F.coalesce(fine, F.lit(False)), dot(a, b)).otherwise(F.lit(0.0))


def same_size(a: Column, b: Column) -> Column:
    """Raises where two vectors differ in length."""
    return F.when(F.size(a) != F.size(b), F.raise_error(F.concat(F.lit("vector sizes differ: "), F.size(a), F.lit(" and "), F.size(b))))


def size(v: Column) -> Column:
    return F.size(v)


@F.pandas_udf(T.BinaryType())
def to_blob(v: pd.Series) -> pd.Series:
    """Little-endian float32 bytes, for stores without arrays."""
    return v.map(lambda x: None if x is None else np.asarray(x, "<f4").tobytes())


@F.pandas_udf(T.ArrayType(T.FloatType()))
def from_blob(v: pd.Series) -> pd.Series:
    """The vector of such bytes; null is an empty one."""
    return v.map(lambda x: np.frombuffer(x or b"", "<f4"))
