"""Grouped values attached back to rows, order statistics, pivots and reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from schedlytics.operators import ranks
from schedlytics.session import work_dir


def attach_groups(df: DataFrame, *specs: tuple[Sequence[str], Sequence[Column]]) -> DataFrame:
    """Group values on every row, for one or more (keys, aggregates); rows with a null key get NULL.

    Each group table is a map-side combined aggregate of ``df`` itself, joined
    back: unlike a window, a group holding a third of the rows never meets in
    one task. ``df`` is read once more per spec, with only the columns it
    needs, so hand in a table or a staged frame when it is costly.
    """
    out = df
    for keys, aggs in specs:
        out = out.join(df.groupBy(*keys).agg(*aggs), list(keys), "left")
    return out


def keep_groups(df: DataFrame, keys: Sequence[str], having: Column) -> DataFrame:
    """Rows of the groups whose aggregate predicate holds."""
    good = df.groupBy(*keys).agg(having.alias("_ok")).where("_ok").select(*keys)
    return df.join(good, list(keys), "left_semi")


def quantiles_higher(df: DataFrame, value: str, qs: Sequence[float], folder: str | None = None) -> DataFrame:
    """One row (q1, q2, ...): the exact quantiles at sorted index ceil(q * (n - 1)), and the maximum as ``top``.

    A frame of more than ``ranks.HEAVY`` rows is selected from by ranges of its values. A smaller one fits a single task: the
    interpolated quantile lies between that element and the one below it, so the answer is the smallest value not under it.
    """
    x = F.col(value)
    if df.count() > ranks.HEAVY:
        places = {f"q{i + 1}": F.ceil(F.lit(q) * (F.col("_total") - 1)) for i, q in enumerate(qs)} | {"top": F.col("_total") - 1}
        return ranks.select_ranks(df, [], value, places, folder or work_dir(df.sparkSession))
    mids = df.select(F.percentile(x, F.array(*[F.lit(q) for q in qs]))).scalar()
    cut = df.withColumn("_mids", mids)
    return cut.select(*[F.min(F.when(x >= F.col("_mids")[i], x)).alias(f"q{i + 1}") for i in range(len(qs))], F.max(x).alias("top"))


def distinct_with_null(col: Column) -> Column:
    """Distinct count where NULL counts as one value."""
    return F.count_distinct(col) + F.coalesce(F.max(col.isNull().cast("int")), F.lit(0))


def pivot_counts(df: DataFrame, keys: Sequence[str], column: str, values: Sequence, prefix: str = "n_") -> DataFrame:
    """Counts per value as columns, 0 where absent; the value list is explicit, so no extra pass looks for it."""
    return df.groupBy(*keys).agg(*[
        F.count_if(F.col(column) == F.lit(v)).alias(f"{prefix}{v}") for v in values
    ])


def metrics_long(df: DataFrame, scope: str, domain: str, metrics: Sequence[str]) -> DataFrame:
    """A one-row frame of metrics as (scope, domain, name, value) rows."""
    casted = df.select(*[F.col(m).cast("double").alias(m) for m in metrics])
    return casted.unpivot([], list(metrics), "name", "value").select(
        F.lit(scope).alias("scope"), F.lit(domain).alias("domain"), "name", "value")


def with_total_row(df: DataFrame, key: str, name: str, totals: dict) -> DataFrame:
    """Rows of a frame with one row per ``key``, keyed by text, plus one "All" row of the given functions, in one roll-up."""
    named = df.select(F.col(key).cast("string").alias(name), *totals)
    rolled = named.rollup(name).agg(*[fn(c).alias(c) for c, fn in totals.items()], F.grouping(name).alias("_all"))
    return rolled.withColumn(name, F.when(F.col("_all") == 1, "All").otherwise(F.col(name))).drop("_all")


def melt_sizes(wide: DataFrame, key: str, sizes: Sequence[str], size_name: str, value_name: str, default: int) -> DataFrame:
    """One row per (key, size) of a limit table with a column per size; a missing limit becomes ``default``."""
    long = wide.unpivot([key], list(sizes), size_name, value_name)
    return long.withColumns({size_name: F.col(size_name).cast("int"), value_name: F.coalesce(value_name, F.lit(default))})
