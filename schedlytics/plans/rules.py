"""Schedule validation rules. Each returns the violating rows or groups.

A pool row is one proposed (day, group, branch) with ``schedule_status``: 0
valid, other values left over, NULL not scheduled. Group rules aggregate with
sets over small domains (types, categories), never over the rows of a group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from schedlytics.functions import arrays
from schedlytics.functions import scalars as S
from schedlytics.operators.aggregates import keep_groups, melt_sizes, metrics_long, with_total_row
from schedlytics.operators.dedupe import flag_repeats
from schedlytics.operators.ranks import row_numbers
from schedlytics.sources.inline import inline_table

GROUP_DAY = ["p_date", "group_id"]

# Schedules allowed per category for 3, 4 and 5 restaurants a day (None: unlimited), first rule set.
CATEGORY_LIMITS = [
    (23, None, None, None), (21, None, None, None), (1, None, 3, 3), (18, 2, 3, 3), (17, 3, 3, 3), (27, 3, 4, 4),
    (2, 2, 3, 3), (8, 2, 3, 3), (14, None, None, None), (22, 2, 3, 3), (28, None, None, None),
]

# The same, second rule set.
CATEGORY_LIMITS_2 = [
    (25, None, None, None), (26, None, None, None), (1, None, None, None), (21, 3, 3, 3), (27, None, None, None),
    (22, 1, 1, 1), (17, 1, 1, 1), (24, 3, 3, 3), (15, 3, 3, 3), (19, 2, 2, 2), (20, None, None, None), (8, 3, 3, 3),
    (9, 3, 3, 3), (11, 2, 2, 2), (30, 1, 1, 1), (28, None, None, None), (29, 2, 2, 2),
]
UNLIMITED = 100

# Types that may occur twice on a large day.
MAY_REPEAT = (9, 10)

# Fixed values: (restaurants a day, type set, how many distinct types of the set may be scheduled).
TYPE_SETS = [
    (3, [1], 1), (3, [9], 1), (3, [5, 6, 7], 1),
    (4, [1], 1), (4, [9], 1), (4, [5, 6, 7], 2),
    (5, [1], 1), (5, [9], 1), (5, [5], 1), (5, [6], 1), (5, [7], 1),
]


def valid(pool: DataFrame) -> DataFrame:
    return pool.where(F.col("schedule_status") == 0)


def on_working_day(day: Column) -> Column:
    """Sunday to Thursday."""
    return ~F.weekday(day).isin(4, 5)


def with_novelty(df: DataFrame) -> DataFrame:
    """is_new: never scheduled or more than 90 days ago; is_partly_new: strictly between 45 and 90 days ago."""
    d = F.col("days_diff")
    return df.withColumns({
        "is_new": d.isNull() | (d > 90),
        "is_partly_new": F.coalesce((d > 45) & (d < 90), F.lit(False)),
    })


def descriptive(pool: DataFrame) -> DataFrame:
    """Numbers of days, branches, restaurants, areas and groups."""
    scheduled_day = F.when(F.col("schedule_status") == 0, F.col("p_date"))
    one = pool.agg(F.count_distinct("p_date").alias("pool_days"), F.count_distinct(scheduled_day).alias("scheduled_days"),
                   F.count_distinct("branch_id").alias("branches"), F.count_distinct("restaurant_id").alias("restaurants"),
                   F.count_distinct("area_id").alias("areas"), F.count_distinct("group_id").alias("groups"))
    return metrics_long(one, "Descriptive", "Stats", one.columns)


def pair_coverage(pool: DataFrame) -> DataFrame:
    """Pairs made against the pairs every (weekday, group) needs."""
    st = F.col("schedule_status")
    made = pool.agg(F.count_if(st == 0).alias("made"), F.count_if(st.isNotNull() & (st != 0)).alias("leftover"))
    needed = pool.select(F.weekday("p_date").alias("day"), "group_id", "perday_resto").distinct().select(F.sum("perday_resto")).scalar()
    share = F.col("made") / F.col("essential") * 100
    one = made.withColumn("essential", needed).select(
        F.col("made").alias("pairs_made"), F.col("made").alias("valid_pairs"), F.col("leftover").alias("leftover_pairs"),
        (F.col("essential") - F.col("made")).alias("missing_pairs"), F.col("essential").alias("essential_pairs"),
        share.alias("valid_percent"), (100 - share).alias("leftover_percent"), share.alias("after_leftover_percent"), (100 - share).alias("missing_percent"))
    return metrics_long(one, "Comparative", "Pairs", one.columns)


def perday_matrix(pool: DataFrame) -> DataFrame:
    """Per day: number of groups by "made/size" (sizes 3 to 5), and share of groups by number of missing pairs, with "All" rows.

    Long rows (day, kind, label, value): counts add up over days, shares are averaged over the days where they occur.
    """
    per = pool.groupBy(*GROUP_DAY).agg(F.max("perday_resto").alias("size"), F.count_if(F.col("schedule_status") == 0).alias("made"))
    day = F.col("p_date").cast("string").alias("day")
    inside = F.col("size").between(3, 5) & (F.col("made") <= F.col("size"))
    counts = (per.where(inside).groupBy(day, F.concat_ws("/", "made", "size").alias("label")).agg(F.count("*").cast("double").alias("value")))
    missing = per.groupBy(day, (F.col("size") - F.col("made")).alias("label")).agg(F.count("*").alias("n"))
    shares = missing.select("day", F.col("label").cast("string"), (F.col("n") / F.sum("n").over(Window.partitionBy("day"))).alias("value"))

    def with_all(df: DataFrame, fn, kind: str) -> DataFrame:
        rolled = df.rollup("label", "day").agg(fn("value").alias("value"), F.grouping("label").alias("_l"), F.grouping("day").alias("_d"))
        day_name = F.when(F.col("_d") == 1, "All").otherwise(F.col("day"))
        return rolled.where(F.col("_l") == 0).select(day_name.alias("day"), F.lit(kind).alias("kind"), "label", "value")

    return with_all(counts, F.sum, "made/size").unionByName(with_all(shares, F.avg, "missing share"))


def daily_totals(pool: DataFrame) -> DataFrame:
    """Pairs and orders per day, all scheduled ones and the valid ones, with an "All" row."""
    st, q = F.col("schedule_status"), F.col("orders")
    daily = pool.where(st.isNotNull()).groupBy("p_date").agg(
        F.count("*").alias("pairs"), F.count_if(st == 0).alias("valid_pairs"), F.sum(q).alias("orders"),
        F.coalesce(F.sum(F.when(st == 0, q)), F.lit(0)).alias("valid_orders"))
    return with_total_row(daily, "p_date", "day", {c: F.sum for c in ("pairs", "valid_pairs", "orders", "valid_orders")})


def blackout(pool: DataFrame) -> DataFrame:
    """Valid schedules inside the blackout period."""
    return valid(pool).where(F.col("is_not_blackout") == 0)


def branch_areas(pool: DataFrame) -> DataFrame:
    """Schedules of branches with capacity 1 that serve more than one area on a day."""
    spread = keep_groups(valid(pool), ["p_date", "branch_id"], F.min("area_id") != F.max("area_id"))
    return spread.where(F.col("delivery_capacity") == 1)


def branch_capacity(pool: DataFrame) -> DataFrame:
    """(day, branch) scheduled more often than its capacity."""
    per = valid(pool).groupBy("p_date", "branch_id").agg(F.count("*").alias("times_scheduled"), F.max("delivery_capacity").alias("delivery_capacity"))
    return per.where(F.col("delivery_capacity") < F.col("times_scheduled"))


def category_limit(pool: DataFrame, limits: Sequence[tuple], weekdays_only: bool) -> DataFrame:
    """(group, size, category) scheduled more often than its limit; categories outside the table have none."""
    rows = valid(pool)
    if weekdays_only:
        rows = rows.where(on_working_day(F.col("p_date")))
    wide = inline_table(pool.sparkSession, "category, `3`, `4`, `5`", limits)
    table = melt_sizes(wide, "category", ["3", "4", "5"], "perday_resto", "max_schedules", UNLIMITED)
    times = rows.groupBy("group_id", "perday_resto", "category").agg(F.count("*").alias("times_scheduled"))
    return times.join(F.broadcast(table), ["category", "perday_resto"]).where(F.col("max_schedules") < F.col("times_scheduled"))


def type_duplicate(pool: DataFrame, type_col: str, order: Sequence[str]) -> DataFrame:
    """Valid schedules that repeat a type of their group-day."""
    return flag_repeats(valid(pool), [*GROUP_DAY, type_col], order).where("is_repeat").drop("is_repeat")


def group_days(pool: DataFrame, type_col: str = "type", list_type_col: str = "type2") -> DataFrame:
    """One row per (day, group, size) of the valid schedules with everything the group-day rules look at.

    A rule that uses part of it makes the optimizer drop the other aggregates.
    """
    listed = F.col(list_type_col)
    return with_novelty(valid(pool)).groupBy(*GROUP_DAY, "perday_resto").agg(
        F.count("*").alias("scheduled"), F.collect_set(type_col).alias("types"), F.collect_set(listed).alias("listed_types"),
        F.collect_set("category").alias("categories"), F.count_if(~listed.isin(*MAY_REPEAT)).alias("listed_others"),
        F.count_if("is_new").alias("n_new"), F.count_if("is_partly_new").alias("n_partly_new"),
        F.count_if(F.col("is_premium") == 1).alias("n_premium"), F.count_if(F.col("is_premium") == 0).alias("n_regular"))


def type_sets(days: DataFrame, rules: Sequence[tuple] = TYPE_SETS) -> DataFrame:
    """Group-days with more distinct types of a rule's set than it allows."""
    table = inline_table(days.sparkSession, "perday_resto, rule_types, allowed", rules)
    joined = days.where(on_working_day(F.col("p_date"))).join(F.broadcast(table), "perday_resto")
    found = joined.withColumn("found", arrays.overlap_size(F.col("types"), F.col("rule_types")))
    return found.where(F.col("found") > F.col("allowed"))


def type_mismatch(days: DataFrame) -> DataFrame:
    """Group-days whose number of schedules is not their size."""
    return days.where(on_working_day(F.col("p_date")) & (F.col("scheduled") != F.col("perday_resto")))


def top_overlap(pool: DataFrame, top: DataFrame, limit: int = 2) -> DataFrame:
    """Group-days with more than ``limit`` of the group's top restaurants; the list holds at most the group's top entries."""
    placed = valid(pool).select(*GROUP_DAY, "restaurant_id").distinct()
    both = placed.join(top.select("group_id", "restaurant_id"), ["group_id", "restaurant_id"])
    per = both.groupBy(*GROUP_DAY).agg(F.count("*").alias("top_count"), F.sort_array(F.collect_list("restaurant_id")).alias("top_restaurants"))
    return per.where(F.col("top_count") > limit)


def _per_group_day(days: DataFrame, *names: str) -> DataFrame:
    return days.groupBy(*GROUP_DAY).agg(*[F.sum(n).alias(n) for n in names])


def new_per_day(days: DataFrame) -> DataFrame:
    """Group-days with more than one new restaurant."""
    return _per_group_day(days, "n_new").where(F.col("n_new") > 1)


def partial_per_group(days: DataFrame) -> DataFrame:
    """Groups with more than two partly new restaurants."""
    return days.groupBy("group_id").agg(F.sum("n_partly_new").alias("n_partly_new")).where(F.col("n_partly_new") > 2)


def new_and_partial(days: DataFrame) -> DataFrame:
    """Group-days with new and partly new restaurants together."""
    return _per_group_day(days, "n_new", "n_partly_new").where((F.col("n_new") > 0) & (F.col("n_partly_new") > 0))


def premium_share(days: DataFrame, limit: float = 0.4) -> DataFrame:
    """Group-days whose premium restaurants exceed ``limit`` of the per-day size."""
    per = _per_group_day(days, "n_premium", "n_regular").where(F.col("n_premium") + F.col("n_regular") > 0)
    sizes = days.select("group_id", "perday_resto").distinct()
    share = S.safe_ratio(F.col("n_premium"), F.col("perday_resto"))
    return per.join(sizes, "group_id").withColumn("share", share).where(F.col("share") > limit)


def type_list(days: DataFrame) -> DataFrame:
    """Group-days that break the type-list rule.

    Up to 3 a day: no type twice and type 10 present. Above: types 10 and 11
    present, only 9 and 10 may repeat, and then all categories must differ.
    """
    return days.where(breaks_type_list())


def breaks_type_list() -> Column:
    distinct = F.size("listed_types") == F.col("scheduled")
    has = lambda x: F.array_contains("listed_types", x)
    others = F.size(F.filter("listed_types", lambda x: ~x.isin(*MAY_REPEAT)))
    small_ok = distinct & has(10)
    large_ok = has(10) & has(11) & (distinct | ((F.col("listed_others") == others) & (F.size("categories") == F.col("scheduled"))))
    return ~F.when(F.col("perday_resto") <= 3, small_ok).otherwise(large_ok)


def unscheduled_branches(pool: DataFrame, period: Sequence[str], folder: str) -> DataFrame:
    """Branches of the pool without a valid schedule, ranked by demand; one aggregate replaces the set difference.

    The places of a period are numbered by ranges, so its branches need not meet in one task.
    """
    totals = pool.groupBy(*period, "branch_id").agg(F.sum("orders").alias("orders"), F.count_if(F.col("schedule_status") == 0).alias("_valid"))
    unused = totals.where(F.col("_valid") == 0).drop("_valid")
    return row_numbers(unused, period, [F.desc("orders"), F.col("branch_id")], folder, "place")


def require_scheduled(pool: DataFrame) -> DataFrame:
    """Fail when nothing is scheduled; stops at the first valid row."""
    if valid(pool).limit(1).isEmpty():
        raise ValueError("the schedule is empty")
    return pool


# The row sets that rules over the pool count by, each a set of these columns.
COUNTED_BY = ("p_date", "branch_id", "group_id", "restaurant_id", "top_restaurant", "area_id", "type", "category", "perday_resto", "day")
BRANCH_DAY, CATEGORY, TYPE, PLACED, NEED = (
    ("p_date", "branch_id"), ("group_id", "category", "perday_resto"), ("p_date", "group_id", "type"), ("p_date", "group_id", "top_restaurant"), ("group_id", "perday_resto", "day"))
SINGLE = {"pool_days": "p_date", "branches": "branch_id", "restaurants": "restaurant_id", "areas": "area_id", "groups": "group_id"}


def _pool_report(pool: DataFrame, top: DataFrame, type_col: str) -> DataFrame:
    """One row: every number that comes from pool rows, from one pass over them by grouping sets.

    ``top`` has a few rows per group. It meets the pool first, so that the restaurants of a group-day are counted by its top ones only.
    """
    st, ok = F.col("schedule_status"), F.col("schedule_status") == 0
    sets = [BRANCH_DAY, CATEGORY, TYPE, PLACED, NEED, *[(c,) for c in SINGLE.values()], ()]
    gid = {s: sum(1 << i for i, c in enumerate(reversed(COUNTED_BY)) if c not in s) for s in sets}
    named_top = top.select("group_id", "restaurant_id", F.col("restaurant_id").alias("top_restaurant"))
    rows = pool.join(named_top, ["group_id", "restaurant_id"], "left").withColumns({"type": F.col(type_col), "day": F.weekday("p_date"), "_area": F.col("area_id"), "_work": ok & on_working_day(F.col("p_date"))})
    counted = rows.groupingSets([[F.col(c) for c in s] for s in sets], *COUNTED_BY).agg(
        F.grouping_id().alias("gid"), F.count_if(ok).alias("valid"), F.count_if("_work").alias("on_work_days"), F.count_if(st.isNotNull() & ~ok).alias("left_over"),
        F.count_if(ok & (F.col("is_not_blackout") == 0)).alias("blacked"), F.max(F.when(ok, F.col("delivery_capacity"))).alias("capacity"),
        F.count_if(ok & (F.col("delivery_capacity") == 1)).alias("single"), F.min(F.when(ok, F.col("_area"))).alias("low_area"), F.max(F.when(ok, F.col("_area"))).alias("high_area"))
    for limits, name in ((CATEGORY_LIMITS, "first_limit"), (CATEGORY_LIMITS_2, "second_limit")):
        wide = inline_table(pool.sparkSession, "category, `3`, `4`, `5`", limits)
        counted = counted.join(F.broadcast(melt_sizes(wide, "category", ["3", "4", "5"], "perday_resto", name, UNLIMITED)), ["category", "perday_resto"], "left")

    of = lambda s, value: F.coalesce(F.sum(F.when(F.col("gid") == gid[s], value)), F.lit(0))
    flag = lambda s, test: of(s, test.cast("int"))
    held, named = F.col("valid") > 0, F.col("p_date").isNotNull() & F.col("branch_id").isNotNull()
    sums = {
        "made": of((), F.col("valid")), "leftover": of((), F.col("left_over")), "blackout": of((), F.col("blacked")), "essential": of(NEED, F.col("perday_resto")),
        "scheduled_days": flag(("p_date",), held & F.col("p_date").isNotNull()), **{name: flag((c,), F.col(c).isNotNull()) for name, c in SINGLE.items()},
        "branch_areas": of(BRANCH_DAY, F.when(named & (F.col("low_area") != F.col("high_area")), F.col("single"))), "branch_capacity": flag(BRANCH_DAY, held & (F.col("capacity") < F.col("valid"))),
        "category_limit": flag(CATEGORY, F.col("first_limit") < F.col("on_work_days")), "category_limit_2": flag(CATEGORY, F.col("second_limit") < F.col("valid")),
        "type_duplicate": of(TYPE, F.when(held, F.col("valid") - 1)),
    }
    # Top restaurants are counted per group-day first; all other rows are one group of sums.
    placed = F.col("gid") == gid[PLACED]
    by_day = counted.groupBy(placed.alias("_placed"), *[F.when(placed, F.col(c)).alias(f"_{c}") for c in GROUP_DAY]).agg(
        *[v.alias(k) for k, v in sums.items()], flag(PLACED, held & F.col("top_restaurant").isNotNull()).alias("_hits"))
    return by_day.agg(*[F.sum(k).alias(k) for k in sums], F.count_if(F.col("_hits") > 2).alias("top_overlap"))


def _day_report(days: DataFrame) -> DataFrame:
    """One row: every number that comes from group-days, from one pass over them."""
    work = on_working_day(F.col("p_date"))
    count = lambda test: F.coalesce(F.sum(test.cast("int")), F.lit(0))
    over_set = F.lit(0)
    for size, types, allowed in TYPE_SETS:
        hit = work & (F.col("perday_resto") == size) & (arrays.overlap_size(F.col("types"), F.array(*[F.lit(t) for t in types])) > allowed)
        over_set = over_set + F.coalesce(hit.cast("int"), F.lit(0))
    per_day = days.groupBy(*GROUP_DAY).agg(
        F.sum(over_set).alias("type_sets"), count(work & (F.col("scheduled") != F.col("perday_resto"))).alias("type_mismatch"), count(breaks_type_list()).alias("type_list"),
        *[F.sum(c).alias(c) for c in ("n_new", "n_partly_new", "n_premium", "n_regular")], F.collect_set("perday_resto").alias("sizes"))
    rated = F.col("n_premium") + F.col("n_regular") > 0
    # Sizes are a small domain, and a group has one count of premium restaurants per day of the pool.
    per_group = per_day.groupBy("group_id").agg(
        *[F.sum(c).alias(c) for c in ("type_sets", "type_mismatch", "type_list")], count(F.col("n_new") > 1).alias("new_per_day"), F.sum("n_partly_new").alias("_partly"),
        count((F.col("n_new") > 0) & (F.col("n_partly_new") > 0)).alias("new_and_partial"),
        F.collect_list(F.when(rated, F.col("n_premium"))).alias("_premium"), F.array_distinct(F.flatten(F.collect_set("sizes"))).alias("_sizes"))
    over = F.aggregate("_sizes", F.lit(0), lambda n, size: n + F.size(F.filter("_premium", lambda p: S.safe_ratio(p, size) > 0.4)))
    return per_group.agg(*[F.sum(c).alias(c) for c in ("type_sets", "type_mismatch", "type_list", "new_per_day", "new_and_partial")],
                         count(F.col("_partly") > 2).alias("partial_per_group"), F.sum(F.when(F.col("group_id").isNotNull(), over)).alias("premium_share"))


REPORT_DOMAINS = {"blackout": "Blackout", "branch_areas": "Branch_Capacity", "branch_capacity": "Branch_Capacity", "category_limit": "Category", "category_limit_2": "Category",
                  "type_duplicate": "Type", "type_sets": "Type", "type_mismatch": "Type", "type_list": "Type", "top_overlap": "Top_Restaurants", "new_per_day": "Novelty",
                  "partial_per_group": "Novelty", "new_and_partial": "Novelty", "premium_share": "Premium"}


def report(pool: DataFrame, days: DataFrame, top: DataFrame, type_col: str = "type") -> DataFrame:
    """(scope, domain, name, value) of every rule: the descriptive numbers and one violation count per rule.

    One conditional aggregate over ``pool`` and one over ``days`` (its ``group_days``); each frame is read once.
    """
    from_pool, from_days = _pool_report(pool, top, type_col), _day_report(days).fillna(0)
    share = F.col("made") / F.col("essential") * 100
    pairs = {"pairs_made": F.col("made"), "valid_pairs": F.col("made"), "leftover_pairs": F.col("leftover"), "missing_pairs": F.col("essential") - F.col("made"),
             "essential_pairs": F.col("essential"), "valid_percent": share, "leftover_percent": 100 - share, "after_leftover_percent": share, "missing_percent": 100 - share}
    stats = ["pool_days", "scheduled_days", "branches", "restaurants", "areas", "groups"]
    entries = lambda scope, domain, values: [F.struct(F.lit(scope).alias("scope"), F.lit(domain).alias("domain"), F.lit(n).alias("name"), v.cast("double").alias("value")) for n, v in values.items()]
    rules_of = lambda df: [e for n, d in REPORT_DOMAINS.items() if n in df.columns for e in entries("Comparative", d, {n: F.col(n)})]
    listed = lambda df, cells: df.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*")
    first = entries("Descriptive", "Stats", {n: F.col(n) for n in stats}) + entries("Comparative", "Pairs", pairs) + rules_of(from_pool)
    return listed(from_pool, first).unionByName(listed(from_days, rules_of(from_days)))
