"""Vectors in array columns. Values are cast to double before any arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_double(x: Column) -> Column:
    return F.transform(x, lambda v: v.cast("double"))


def dot(x: Column, y: Column) -> Column:
    return F.aggregate(F.zip_with(to_double(x), to_double(y), lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)


def squared_l2(x: Column, y: Column) -> Column:
    return F.aggregate(F.zip_with(to_double(x), to_double(y), lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v: s + v)


def l2_normalise(x: Column) -> Column:
    """x over its length; null where the length is 0."""
    n = F.sqrt(dot(x, x))
    return F.when(n > 0, F.transform(to_double(x), lambda v: v / n))


def pretty(x: Column) -> Column:
    """Whole numbers plain, others with two decimals, in brackets; [] when empty."""
    one = lambda v: F.when(v == F.floor(v), v.cast("long").cast("string")).otherwise(F.format_string("%.2f", F.bround(v, 2)))
    return F.concat(F.lit("["), F.array_join(F.transform(to_double(x), one), " "), F.lit("]"))
