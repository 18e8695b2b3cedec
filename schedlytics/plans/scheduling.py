"""Scheduling input: group history, blackout, weights, relevance, capacity, roll-ups, top restaurants."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from schedlytics.functions import calendar as cal
from schedlytics.functions import scalars as S
from schedlytics.operators import ranks
from schedlytics.operators.aggregates import attach_groups
from schedlytics.operators.dedupe import top_n
from schedlytics.plans.entities import menu_is_open
from schedlytics.plans.history import days_since
from schedlytics.session import work_dir
from schedlytics.sources.sinks import stage


def rollup_group(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Company rows to group rows: largest per-day size, most frequent type and category (ties: smallest), summed orders, minima."""
    return df.groupBy(*keys).agg(
        F.max("perday_resto").alias("per_day"), F.mode("type", deterministic=True).alias("type"),
        F.mode("category", deterministic=True).alias("category"), F.sum("orders").alias("orders"),
        F.min("is_not_blackout").alias("is_not_blackout"), F.min("days_diff").alias("days_diff"))


def group_schedules(schedules: DataFrame, companies: DataFrame, lo: date, hi: date) -> DataFrame:
    """Distinct (day, group, branch) of the live schedules in [lo, hi]."""
    live = schedules.where(F.col("deleted_at").isNull() & cal.in_window(F.col("schedule_on"), lo, hi))
    grouped = companies.where(F.col("group_id").isNotNull()).select("company_id", "group_id")
    return live.select("company_id", "branch_id", "schedule_on").join(grouped, "company_id").select("schedule_on", "group_id", "branch_id").distinct()


def group_history(schedules: DataFrame, companies: DataFrame, lo: date, hi: date) -> DataFrame:
    """Per (group, branch): the days scheduled, how many, and the last one. The list holds at most one entry per day of the window."""
    days = group_schedules(schedules, companies, lo, hi)
    return days.groupBy("group_id", "branch_id").agg(
        F.sort_array(F.collect_set("schedule_on")).alias("schedule_history"), F.count("*").alias("c2r_count"), F.max("schedule_on").alias("last_schedule_on"))


def blackout_flag(df: DataFrame, period: str = "blackout_period", days: str = "days_diff") -> DataFrame:
    """is_not_blackout: 1 when at least the blackout period has passed."""
    return df.withColumn("is_not_blackout", F.when(F.col(days) >= F.col(period), 1).otherwise(0))


def schedule_weight(df: DataFrame) -> DataFrame:
    """Novelty class and scheduling weight from how often and how recently the pair was scheduled."""
    n, d = F.col("c2r_count"), F.col("days_diff")
    return df.withColumn("c2r_count", F.coalesce("c2r_count", F.lit(0))).withColumns({
        "novelty": F.when(n == 0, 1).when((n == 1) & (d >= 45), 2).otherwise(0),
        "weight": F.when(n == 0, 200).when((n == 1) & (d >= 45), 50).when((n == 1) & (d < 14), 100).otherwise(0),
    })


def schedule_input(predictions: DataFrame, groups: DataFrame, areas: DataFrame, branches: DataFrame, branch_area: DataFrame, menus: DataFrame,
                   restaurants: DataFrame, schedules: DataFrame, companies: DataFrame, start: date,
                   types: Sequence[int], categories: Sequence[int], folder: str, type_col: str = "type") -> DataFrame:
    """Group predictions with everything the scheduler needs; ``predictions``: p_date, group_id, branch_id, restaurant_id, orders.

    The joined table is written below ``folder`` once, because the earliest day, the two group
    maxima and the result all read it. The earliest day is that of all its rows, also of restaurants that are not kept.
    """
    hi = cal.lookback(start, days=1)
    served = branch_area.where(F.col("is_deliverable") == 1).select("branch_id").distinct()
    open_branches = (branches.where(F.col("status").isin(1, 2) & (F.col("home_delivery_category_status") != 3) & ~S.is_test(F.col("branch_name")))
                     .join(served, "branch_id", "left_semi").select("branch_id", "delivery_capacity"))
    kept = (restaurants.where(F.col("status").isin(1, 2) & F.col("category_status").isin(1, 3) & ~S.is_test(F.col("restaurant_name")))
            .where(F.col(type_col).isin(*types) & F.col("category").isin(*categories))
            .select("restaurant_id", F.col(type_col).alias("type"), "category", "is_premium", F.lit(True).alias("_kept")))
    on_menu = menus.where(menu_is_open()).select("restaurant_id").distinct()
    pool = (predictions.join(on_menu, "restaurant_id", "left_semi")
            .join(groups.select("group_id", "area_id", "per_day_restaurants", "is_perk_group"), "group_id", "left")
            .join(areas, "area_id", "left").join(open_branches, "branch_id")
            .join(group_history(schedules, companies, cal.lookback(hi, months=3), hi), ["group_id", "branch_id"], "left"))
    joined = stage(pool.join(kept, "restaurant_id", "left"), folder, "schedule_input")
    dated = blackout_flag(days_since(joined, "p_date", "last_schedule_on")).where("_kept").drop("_kept")
    ready = dated.withColumns({
        "per_day_restaurants": S.clamp(F.col("per_day_restaurants"), 3, 5), "day": cal.weekday(F.col("p_date")),
        "y_week_no": cal.year_week(F.col("p_date")), "pair": F.concat_ws("_", "group_id", "restaurant_id"),
    })
    return attach_groups(ready, (["p_date", "group_id"], [F.max("orders").alias("group_day_max")]),
                         (["p_date", "branch_id"], [F.max("orders").alias("branch_day_max")]))


def relevance_share(history: DataFrame, lo_week: int, hi_week: int, min_orders: int = 5, folder: str | None = None) -> DataFrame:
    """Mean daily share of a group's delivered orders per (group, restaurant), over the clients active in the weeks.

    ``history``: schedule_on, client_id, group_id, restaurant_id, branch_id, delivered, y_week_no. A day's share is that of
    one branch; the mean is over the branches and days of a restaurant. The sums of the weeks are written below ``folder`` once,
    because the active clients, the days and their totals all read them.
    """
    sums = (history.where(F.col("y_week_no").between(lo_week, hi_week))
            .groupBy("client_id", "schedule_on", "group_id", "restaurant_id", "branch_id").agg(F.sum("delivered").alias("delivered")))
    recent = stage(sums, folder or work_dir(history.sparkSession), "recent_orders")
    active = recent.groupBy("client_id").agg(F.sum("delivered").alias("n")).where(F.col("n") > min_orders).select("client_id")
    daily = (recent.join(active, "client_id", "left_semi")
             .groupBy("schedule_on", "group_id", "restaurant_id", "branch_id").agg(F.sum("delivered").alias("delivered")))
    return mean_day_share(daily, ["schedule_on", "group_id"], ["group_id", "restaurant_id"], "delivered")


def mean_day_share(daily: DataFrame, day_keys: Sequence[str], keys: Sequence[str], value: str, name: str = "share") -> DataFrame:
    """Share of the day's total, averaged per ``keys``; ``daily`` holds one row per day and key."""
    with_total = attach_groups(daily, (day_keys, [F.sum(value).alias("_total")]))
    return with_total.groupBy(*keys).agg(F.avg(S.safe_ratio(F.col(value), F.col("_total"))).alias(name))


def default_share(pairs: DataFrame, shares: DataFrame) -> DataFrame:
    """Distinct (group, restaurant, size) pairs with their share, 1 / size where unknown."""
    known = pairs.select("group_id", "restaurant_id", "per_day_restaurants").distinct().join(shares, ["group_id", "restaurant_id"], "left")
    return known.withColumn("share", F.coalesce("share", S.safe_ratio(F.lit(1), F.col("per_day_restaurants"))))


def quantile_bins(df: DataFrame, key: str, value: str, tie: str, bins: str) -> DataFrame:
    """First-come rank inside ``key`` and its equal-count bin k of n, n taken from the row: max(1, ceil(n (r - 1) / (m - 1))).

    One row per (key, restaurant) is expected, so a window holds at most the
    restaurants of one group.
    """
    ranked = df.withColumns({
        "rank": F.row_number().over(Window.partitionBy(key).orderBy(value, tie)),
        "_m": F.count(F.lit(1)).over(Window.partitionBy(key)),
    })
    step = F.expr(f"({bins} * (rank - 1) + _m - 2) div greatest(_m - 1, 1)")
    return ranked.withColumn("bin", F.greatest(step, F.lit(1))).withColumn("bin_share", F.col("bin") / F.col(bins)).drop("_m")


def priority_order() -> list[Column]:
    return [F.desc("weight"), F.desc("orders"), F.desc("bin"), F.desc("rank")]


def assign_capacity(df: DataFrame, order: Sequence[Column], largest: int | None, capacity: str = "delivery_capacity",
                    keys: Sequence[str] = ("p_date", "branch_id")) -> DataFrame:
    """The first ``capacity`` rows of each (day, branch) by priority.

    ``largest`` is the largest capacity of any branch. As a literal bound on the
    rank it lets map tasks drop everything beyond it before the shuffle. A branch
    without a capacity is never full: its rows all stay, without a slot.
    """
    free = df.where(F.col(capacity).isNull()).withColumn("slot", F.lit(None).cast("int"))
    if largest is None:
        return free
    ranked = top_n(df.where(F.col(capacity).isNotNull()), keys, order, largest, rank="slot")
    return ranked.where(F.col("slot") <= F.col(capacity)).unionByName(free)


def average_rank(df: DataFrame, keys: Sequence[str], order: str, name: str, folder: str | None = None) -> DataFrame:
    """Ascending rank where ties share the mean rank.

    Without a ``folder`` a key is one window and must be reduced beforehand; with one, keys of any size are ranked by ranges.
    """
    if folder is not None:
        return ranks.average_ranks(df, keys, order, folder, name)
    w = Window.partitionBy(*keys).orderBy(order)
    ties = F.count(F.lit(1)).over(Window.partitionBy(*keys, order))
    return df.withColumn(name, F.rank().over(w) + (ties - 1) / 2)


def recency_weighted(orders: DataFrame, schedules: DataFrame, companies: DataFrame, branches: DataFrame, lo: date, hi: date) -> DataFrame:
    """Mean of quantity x schedule position per (group, restaurant).

    Positions rank the distinct last-schedule days of a (group, restaurant), so
    a window holds at most the days of the look-back.
    """
    groups = companies.where(F.col("group_id").isNotNull()).select("company_id", "group_id")
    place = branches.select("branch_id", "restaurant_id")
    keys = ["schedule_on", "group_id", "restaurant_id"]
    window = cal.in_window(F.col("schedule_on"), lo, hi) & F.col("deleted_at").isNull()
    totals = (orders.where(window & (F.col("category_id") == 2)).groupBy("schedule_on", "company_id", "branch_id").agg(F.sum("quantity").alias("q"))
              .join(place, "branch_id").join(groups, "company_id").groupBy(*keys).agg(F.sum("q").alias("quantity")))
    last = schedules.where(window).groupBy("company_id", "branch_id").agg(F.max("schedule_on").alias("schedule_on"))
    planned = last.join(groups, "company_id").join(place, "branch_id").select(*keys).distinct()
    rows = totals.join(planned, keys, "right").withColumn("quantity", F.coalesce("quantity", F.lit(0)))
    ranked = average_rank(rows, ["group_id", "restaurant_id"], "schedule_on", "position")
    return ranked.groupBy("group_id", "restaurant_id").agg(F.avg(F.col("quantity") * F.col("position")).alias("score"))


def top_restaurants(scores: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` best restaurants per group (ties: the smaller id)."""
    return top_n(scores, ["group_id"], [F.desc("score"), F.asc("restaurant_id")], n, rank="place")
