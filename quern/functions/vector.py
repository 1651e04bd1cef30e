"""Vector functions over arrays of numbers, computed in double."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def cosine(a: Column, b: Column) -> Column:
    """0 for vectors of different length or without length."""
    n = norm(a) * norm(b)
    return F.when((F.size(a) == F.size(b)) & (n > 0), dot(a, b) / n).otherwise(F.lit(0.0))


def normalised(a: Column) -> Column:
    n = norm(a)
    return F.when(n > 0, F.transform(a, lambda x: x.cast("double") / n)).otherwise(F.transform(a, lambda x: x.cast("double")))


def valid(a: Column) -> Column:
    """Not null or empty, no NaN or infinite element, not all zero."""
    bad = F.exists(a, lambda x: F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")) | x.isNull())
    return a.isNotNull() & (F.size(a) > 0) & ~F.coalesce(bad, F.lit(False)) & (norm(a) > 0)


def literal(c: Column) -> Column:
    """``[1,2.5]`` as array<double>; null where it can't be read."""
    return F.from_json(c, "array<double>")
