"""Weekly statistical panels per client, restaurant and client-restaurant pair, and the features built from them.

Rows are reduced to one per (key, week) by a map-side combined aggregate before
any window runs, so a window partition holds at most one row per week of the
history, however many raw rows its key has.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from schedlytics.functions import calendar as cal
from schedlytics.functions import moments
from schedlytics.operators import ranks
from schedlytics.operators.aggregates import distinct_with_null
from schedlytics.operators.joins import prefixed
from schedlytics.session import work_dir
from schedlytics.sources.sinks import stage

WEEK = "week_no"


def weekly_stats(df: DataFrame, keys: Sequence[str], values: Sequence[str], folder: str | None = None) -> DataFrame:
    """The seven statistics of each value per (key, week).

    One map-side combined aggregate, unless a (key, week) has more than ``ranks.HEAVY`` rows: the medians of such groups are
    selected by ranges of their values, and their other six statistics need no more than a few sums.
    """
    group = [*keys, WEEK]
    columns = [*group, *[n for v in values for n in moments.names(v)]]
    heavy = df.groupBy(*group).agg(F.count("*").alias("_rows")).where(F.col("_rows") > ranks.HEAVY).select(*group)
    once = lambda rows: rows.groupBy(*group).agg(*[c for v in values for c in moments.seven(v)])
    if heavy.isEmpty():
        return once(df)
    folder = folder or work_dir(df.sparkSession)
    named = stage(heavy.select(*[F.col(k).alias(f"_h_{k}") for k in group]), folder, "heavy_groups")
    same = lambda rows, other, prefix: functools.reduce(lambda a, b: a & b, [rows[k].eqNullSafe(other[f"{prefix}{k}"]) for k in group])
    large = stage(df.join(named, same(df, named, "_h_"), "left_semi").select(*group, *values), folder, "heavy_rows")
    out = large.groupBy(*group).agg(*[c for v in values for c in moments.seven(v, skip=["median"])])
    for v in values:
        middle = ranks.medians(large, group, v, folder, f"{v}_median").withColumnsRenamed({k: f"_m_{k}" for k in group})
        out = out.join(middle, same(out, middle, "_m_"), "left").drop(*[f"_m_{k}" for k in group])
    return once(df.join(named, same(df, named, "_h_"), "left_anti")).select(*columns).unionByName(out.select(*columns))


def expanding_stats(weekly: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """The seven statistics of the weekly means up to and including each week."""
    run = moments.running(keys, WEEK)
    return weekly.select("*", *[c for v in values for c in moments.seven(f"{v}_mean", run, f"exp_{v}")])


def intervals(df: DataFrame, keys: Sequence[str], last_week: Column, carry: Sequence[str]) -> DataFrame:
    """Observed rows with ``until_week``, the last week they hold for: the one before the key's next row, or ``last_week``.

    ``carry`` columns keep the last known value.
    """
    by_week = Window.partitionBy(*keys).orderBy(WEEK)
    run = moments.running(keys, WEEK)
    return df.withColumns({
        **{c: F.expr(f"last({c}, true) {run}") for c in carry},
        "until_week": F.coalesce(F.lead(WEEK).over(by_week) - 1, last_week),
    })


def every_week(rows: DataFrame) -> DataFrame:
    """Rows of ``intervals`` repeated for each week they hold."""
    return rows.withColumn(WEEK, F.explode(F.sequence(F.col(WEEK), F.col("until_week")))).drop("until_week")


def gap_fill(df: DataFrame, keys: Sequence[str], last_week: Column, carry: Sequence[str]) -> DataFrame:
    """One row per key for each week from its first to ``last_week``; ``carry`` columns keep the last known value.

    Each observed row is repeated over the gap behind it, so no grid is joined.
    """
    return every_week(intervals(df, keys, last_week, carry))


def holding_at(base: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``base`` with the columns of the interval row that holds at its (keys, week); NULLs where none does.

    The weeks asked for and the rows' first weeks are merged in one sorted order per key, in which each week asked takes the
    last row before it. A key has at most two entries per week of the history there, however many rows ask; these are joined
    back on (keys, week). No interval is repeated over its weeks.
    """
    rest = [c for c in rows.columns if c not in (*keys, WEEK, "until_week")]
    asked = base.select(*keys, WEEK).distinct().withColumn("_row", F.lit(None).cast(rows.select(F.struct("until_week", *rest).alias("r")).schema["r"].dataType))
    known = rows.select(*keys, WEEK, F.struct("until_week", *rest).alias("_row"))
    # At one week the row that starts there comes before the question.
    merged = known.withColumn("_asked", F.lit(0)).unionByName(asked.withColumn("_asked", F.lit(1)))
    run = Window.partitionBy(*keys).orderBy(WEEK, "_asked").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = merged.withColumn("_row", F.last("_row", ignorenulls=True).over(run)).where("_asked = 1")
    held = last.where(F.col("_row.until_week") >= F.col(WEEK)).select(*keys, WEEK, *[F.col(f"_row.{c}").alias(c) for c in rest])
    return base.join(held, [*keys, WEEK], "left")


def panel_intervals(df: DataFrame, keys: Sequence[str], values: Sequence[str], flag: str, rank: str | None = None) -> DataFrame:
    """Weekly panel of a frame with ``week_no``, as rows that hold from ``week_no`` to ``until_week``.

    ``flag`` (first week of the key) and ``rank`` (dense week rank) hold on each
    week the value of the key's next observed week. Past the last one the flag
    is false and the rank is one more than the highest rank; a key seen in one
    week only has no rank.
    """
    stats = [n for v in values for n in moments.names(v) + moments.names(v, expanding=True)]
    by_week = Window.partitionBy(*keys).orderBy(WEEK)
    made = expanding_stats(weekly_stats(df, keys, values), keys, values)
    extra = {}
    observed = made.withColumn("_first", F.lag(WEEK).over(by_week).isNull())
    extra[flag] = F.coalesce(F.lead("_first").over(by_week), F.lit(False))
    if rank:
        weeks = F.count(F.lit(1)).over(Window.partitionBy(*keys))
        extra[rank] = F.when(weeks > 1, F.row_number().over(by_week) + 1)
    observed = observed.withColumns(extra).drop("_first")
    last_week = df.select(F.max(WEEK)).scalar()
    order = [*keys, WEEK, "until_week", *stats, flag] + ([rank] if rank else [])
    return intervals(observed, keys, last_week, stats).select(*order)


CLIENT = (["client_id"], ["rating", "orders"], "is_first_time_client")
RESTAURANT = (["restaurant_id"], ["rating", "orders"], "is_first_time_restaurant")
PAIR = (["client_id", "restaurant_id"], ["orders"], "is_first_time_pair", "pair_rank")


def panel(df: DataFrame, keys: Sequence[str], values: Sequence[str], flag: str, rank: str | None = None) -> DataFrame:
    """The gap-filled form of ``panel_intervals``: a row for each week from the key's first to the last of all."""
    return every_week(panel_intervals(df, keys, values, flag, rank))


def client_panel(df: DataFrame) -> DataFrame:
    return panel(df, *CLIENT)


def restaurant_panel(df: DataFrame) -> DataFrame:
    return panel(df, *RESTAURANT)


def pair_panel(df: DataFrame) -> DataFrame:
    return panel(df, *PAIR)


def client_usage(orders: DataFrame, user: str = "user_id", quantity: str = "quantity") -> DataFrame:
    """Distinct users (an unknown user counts once) and total orders per (client, week)."""
    return orders.groupBy("client_id", WEEK).agg(
        distinct_with_null(F.col(user)).alias("unique_users"), F.sum(quantity).alias("total_orders"))


def previous_orders(df: DataFrame, quantity: str = "orders", order: Sequence[str] = ("schedule_on", "event_id")) -> DataFrame:
    """Per (pair, week): the last quantity of the pair's previous observed week, 0 for the first."""
    last = df.groupBy("client_id", "restaurant_id", WEEK).agg(F.max_by(quantity, F.struct(*order)).alias("_q"))
    by_week = Window.partitionBy("client_id", "restaurant_id").orderBy(WEEK)
    return last.select("client_id", "restaurant_id", WEEK,
                       F.coalesce(F.lag("_q").over(by_week), F.lit(0)).alias("previous_orders"))


def assemble(base: DataFrame, clients: DataFrame, restaurants: DataFrame, pairs: DataFrame, usage: DataFrame,
             restaurant_dims: DataFrame, client_dims: DataFrame, week: Sequence[str] = (WEEK,)) -> DataFrame:
    """Attach panels (left), usage (left), restaurant attributes (inner) and client area (left).

    Panel columns get the prefixes c_, r_ and p_. ``week`` is empty when the
    panels hold one row per key. The pair panel is joined last of the three
    because it is the only one as large as the base.
    """
    w = list(week)
    return (base
            .join(prefixed(clients, "c_", ["client_id", WEEK]), ["client_id", *w], "left")
            .join(prefixed(restaurants, "r_", ["restaurant_id", WEEK]), ["restaurant_id", *w], "left")
            .join(usage, ["client_id", *w], "left")
            .join(prefixed(pairs, "p_", ["client_id", "restaurant_id", WEEK]), ["client_id", "restaurant_id", *w], "left")
            .join(restaurant_dims, "restaurant_id")
            .join(client_dims, "client_id", "left"))


def training_features(history: DataFrame, usage: DataFrame, restaurant_dims: DataFrame, client_dims: DataFrame) -> DataFrame:
    """One row per schedule: the panels of the week before, the previous order, dimensions, the label last."""
    prev = previous_orders(history)
    base = (history.select("schedule_on", "client_id", "restaurant_id", WEEK, "event_id", "orders")
            .join(prev, ["client_id", "restaurant_id", WEEK], "left").withColumn(WEEK, F.col(WEEK) - 1))
    joined = base
    for (keys, *rest), prefix in ((CLIENT, "c_"), (RESTAURANT, "r_"), (PAIR, "p_")):
        joined = holding_at(joined, prefixed(panel_intervals(history, keys, *rest), prefix, [*keys, WEEK, "until_week"]), keys)
    joined = joined.join(usage, ["client_id", WEEK], "left").join(restaurant_dims, "restaurant_id").join(client_dims, "client_id", "left")
    return joined.withColumn("day_of_week", cal.weekday(F.col("schedule_on"))).select(
        *[c for c in joined.columns if c != "orders"], "day_of_week", "orders")


def latest_panel(df: DataFrame, keys: Sequence[str], values: Sequence[str], flag: str, rank: str | None = None) -> DataFrame:
    """The panel row of each key that holds at the last week of all, without its weeks."""
    rows = panel_intervals(df, keys, values, flag, rank)
    return latest(rows, keys).drop(WEEK, "until_week")


def latest(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The row of the largest week per key, as an aggregate: no sort, no window."""
    rest = [c for c in df.columns if c not in keys]
    one = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), WEEK).alias("_row"))
    return one.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])
