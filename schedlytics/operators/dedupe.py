"""Distinct, first/last per key, duplicate flags.

All of them are aggregates with a map-side combine (``max_by`` and friends), so
a key holding a large share of the rows is reduced before the shuffle. Each
takes a full tie-break order, because rows carry no position.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def keep_one(df: DataFrame, keys: Sequence[str], order: Sequence[str], last: bool = True) -> DataFrame:
    """One row per key: the last (or first) by ``order``; columns keep their order."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    if set(rest) <= set(order):
        # The order says all there is to say of a row, which then moves once instead of as a row and as an order.
        one = df.groupBy(*keys).agg((F.max if last else F.min)(F.struct(*dict.fromkeys(order))).alias("_row"))
        return one.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])
    pick = F.max_by if last else F.min_by
    by = F.struct(*[F.col(c) for c in order])
    one = df.groupBy(*keys).agg(pick(F.struct(*rest), by).alias("_row"))
    return one.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def flag_repeats(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "is_repeat") -> DataFrame:
    """Mark every row that is not the first of its key by ``order``, then by the other columns.

    Rows equal in every column are told apart: they are one row with a count until the end, where the first copy
    of the first row alone is unmarked. Grouping by whole rows spreads a hot key over tasks; the first of each key
    is an aggregate of those, joined back null-safely, and adaptive skew splitting has the rest.
    """
    counted = df.groupBy(*df.columns).agg(F.count("*").alias("_copies"))
    row = F.struct(*order, *[c for c in df.columns if c not in order])
    first = counted.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(F.min(row).alias("_first"))
    cond = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    each = counted.join(first, cond, "left").withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "_copies")))
    return each.select(*df.columns, ((row > F.col("_first")) | (F.col("_copy") > 1)).alias(name))


def top_n(df: DataFrame, keys: Sequence[str], order: Sequence, n: int, rank: str | None = None) -> DataFrame:
    """The first ``n`` rows per key; the literal limit lets each map task keep only its own first ``n``."""
    name = rank or "_rn"
    out = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(name) <= n)
    return out if rank else out.drop(name)
