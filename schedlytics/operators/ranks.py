"""Positions and exact order statistics by ranges: no task sorts or holds a whole key.

Rows are dealt into ranges of (key, value) and written once. Counts per key and range, added up along the ranges, give the
number of rows before each range, so a hot key is spread over as many tasks as it needs. Where only values matter they are
counted first, and equal values are one row, however many rows share them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from schedlytics.sources.sinks import stage

# Rows of one group that a single task may hold; larger groups go by ranges.
HEAVY = 100_000


def ranged(df: DataFrame, order: Sequence[Column], folder: str, name: str) -> DataFrame:
    """``df`` dealt into ranges of ``order`` and written once, with its range number ``part`` (ranges ascend)."""
    return stage(df.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), folder, name)


def global_row_number(df: DataFrame, order: Sequence[Column], folder: str, alias: str = "row_number") -> DataFrame:
    """Number all rows 1..n by ``order``: a rank inside each range plus the rows of the ranges before it.

    ``order`` must be a total order for a repeatable result. The offsets come from one row per range.
    """
    rows = ranged(df, order, folder, f"ranged_{alias}")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy("part").agg(F.count("*").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy(*order))
    return rows.withColumn("inside", inside).join(offsets, "part").withColumn(alias, (F.col("before") + F.col("inside")).cast("long")).drop("part", "inside", "before")


def _dealt(df: DataFrame, order: Sequence[Column], folder: str, name: str) -> DataFrame:
    """``ranged`` with a range number, ``_range``, that no column of the caller's clashes with."""
    return stage(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), folder, name)


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str], prefix: str = "_k_") -> Column:
    """Null-safe equality of ``keys`` with the prefixed columns of ``right``."""
    same = F.lit(True)
    for k in keys:
        same = same & left[k].eqNullSafe(right[f"{prefix}{k}"])
    return same


def _range_offsets(rows: DataFrame, keys: Sequence[str], size: Column) -> DataFrame:
    """Per (key, range) of dealt rows: _held, the sum of ``size``, _before, that of the ranges before it, and _total of the key.

    A key has one row per range it reaches into, which bounds the window.
    """
    named = [F.col(k).alias(f"_k_{k}") for k in keys]
    held = rows.groupBy(*named, "_range").agg(size.alias("_held"))
    key = Window.partitionBy(*[f"_k_{k}" for k in keys])
    before = F.sum("_held").over(key.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    return held.withColumns({"_before": F.coalesce(before, F.lit(0)), "_total": F.sum("_held").over(key)})


def row_numbers(df: DataFrame, keys: Sequence[str], order: Sequence[Column], folder: str, alias: str = "row_number") -> DataFrame:
    """Number the rows of each key 1..n by ``order``, which must be total for a repeatable result."""
    rows = _dealt(df, [*map(F.col, keys), *order], folder, f"ranged_{alias}")
    offsets = _range_offsets(rows, keys, F.count("*"))
    inside = rows.withColumn("_inside", F.row_number().over(Window.partitionBy("_range", *keys).orderBy(*order)))
    joined = inside.join(offsets, (inside["_range"] == offsets["_range"]) & _same(inside, offsets, keys))
    return joined.select(*df.columns, (F.col("_before") + F.col("_inside")).cast("long").alias(alias))


def value_positions(df: DataFrame, keys: Sequence[str], value: str, folder: str) -> DataFrame:
    """Per distinct (key, non-null value): _n rows with it, _below rows with a smaller one, _total rows of the key, and its range."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"))
    rows = _dealt(counts, [F.col(c) for c in (*keys, value)], folder, f"values_{value}")
    offsets = _range_offsets(rows, keys, F.sum("_n"))
    smaller = F.sum("_n").over(Window.partitionBy("_range", *keys).orderBy(value).rowsBetween(Window.unboundedPreceding, -1))
    inside = rows.withColumn("_inside", F.coalesce(smaller, F.lit(0)))
    joined = inside.join(offsets, (inside["_range"] == offsets["_range"]) & _same(inside, offsets, keys))
    return joined.select(*keys, value, "_n", (F.col("_before") + F.col("_inside")).alias("_below"), "_total")


def average_ranks(df: DataFrame, keys: Sequence[str], value: str, folder: str, alias: str) -> DataFrame:
    """Ascending rank of each row inside its key where equal values share the mean rank; a null value has none."""
    at = value_positions(df, keys, value, folder)
    at = at.select(*[F.col(c).alias(f"_k_{c}") for c in (*keys, value)], (F.col("_below") + (F.col("_n") + 1) / 2).alias(alias))
    return df.join(at, _same(df, at, [*keys, value]), "left").select(*df.columns, alias)


def select_ranks(df: DataFrame, keys: Sequence[str], value: str, ranks: Mapping[str, Column], folder: str) -> DataFrame:
    """Per key the values at given places of its sorted non-null values.

    ``ranks`` maps a result name to a 0-based place, a column over ``_total``, the number of values of the key.
    """
    at = value_positions(df, keys, value, folder)
    holds = lambda place: (F.col("_below") <= place) & (place < F.col("_below") + F.col("_n"))
    return at.groupBy(*keys).agg(*[F.max(F.when(holds(place), F.col(value))).alias(name) for name, place in ranks.items()])


def medians(df: DataFrame, keys: Sequence[str], value: str, folder: str, alias: str) -> DataFrame:
    """The exact median of each key's non-null values: the mean of the two in the middle."""
    middle = {"_low": F.expr("(_total - 1) div 2"), "_high": F.expr("_total div 2")}
    picked = select_ranks(df, keys, value, middle, folder)
    return picked.select(*keys, ((F.col("_low").cast("double") + F.col("_high").cast("double")) / 2).alias(alias))
