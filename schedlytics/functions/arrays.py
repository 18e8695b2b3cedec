"""Array rules over lists that are bounded by their domain (types, areas, weekdays)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def has_repeats(arr: Column) -> Column:
    return F.size(arr) != F.size(F.array_distinct(arr))


def repeated(arr: Column) -> Column:
    """The distinct values that occur more than once."""
    return F.array_distinct(F.filter(arr, lambda x: F.size(F.filter(arr, lambda y: y == x)) > 1))


def overlap_size(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b))


def text(arr: Column) -> Column:
    return F.array_join(F.sort_array(arr).cast("array<string>"), ",")
