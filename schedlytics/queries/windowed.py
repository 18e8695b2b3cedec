"""Window queries: expanding statistics, ranks, lags, fills, shares."""

from datetime import date

from pyspark.sql import Window
from pyspark.sql import functions as F

from schedlytics.functions import calendar as cal
from schedlytics.functions import moments
from schedlytics.operators.aggregates import attach_groups
from schedlytics.operators.dedupe import top_n
from schedlytics.plans import panels, scheduling
from schedlytics.queries.grouped import STATS, visit_weeks, weekly_sql
from schedlytics.registry import check_step, query
from schedlytics.session import work_dir

HI, LO = date(1998, 12, 19), date(1998, 9, 19)


def expanding_sql(keys: str, values=("rating", "orders")) -> str:
    """Check SQL of the expanding statistics over the weekly means, next to the weekly ones."""
    w = f"OVER (PARTITION BY {keys} ORDER BY week_no ROWS UNBOUNDED PRECEDING)"
    lists = ", ".join(f"list({x}_mean) FILTER (WHERE {x}_mean IS NOT NULL) {w} AS {x}_xs, count(*) {w} - count({x}_mean) {w} AS {x}_nulls" for x in values)
    kept = ", ".join(f"{x}_{s}" for x in values for s in moments.STATS)
    stats = ",\n".join(moments.seven_sql(x, f"exp_{x}") for x in values)
    return f"SELECT {keys}, week_no, {kept},\n{stats}\nFROM (SELECT *, {lists} FROM ({weekly_sql(keys, values)}) AS weekly) AS t"


@query("expanding_stats", f"client_id s, week_no i, {STATS('exp_rating', 'exp_orders')}", expanding_sql("client_id"))
def expanding_stats(v):
    weekly = panels.weekly_stats(visit_weeks(v), ["client_id"], ["rating", "orders"])
    return panels.expanding_stats(weekly, ["client_id"], ["rating", "orders"])


@query("window_broadcast", "id i, p_date d, group_id i, branch_id i, group_day_max i, branch_day_total i", """
    SELECT id, p_date, group_id, branch_id, max(orders) OVER (PARTITION BY p_date, group_id) AS group_day_max,
           sum(orders) OVER (PARTITION BY p_date, branch_id) AS branch_day_total FROM schedule_pool""")
def window_broadcast(v):
    pool = v.schedule_pool.select("id", "p_date", "group_id", "branch_id", "orders")
    return attach_groups(pool, (["p_date", "group_id"], [F.max("orders").alias("group_day_max")]),
                         (["p_date", "branch_id"], [F.sum("orders").alias("branch_day_total")]))


def weekly_totals(v, *keys):
    return visit_weeks(v).groupBy(*keys, "week_no").agg(F.sum("orders").alias("total"))


check_step("pair_weeks", "SELECT client_id, restaurant_id, week_no, sum(orders) AS total FROM visit_weeks GROUP BY 1, 2, 3")


@query("first_seen_flag", "client_id s, restaurant_id i, week_no i, is_first b", """
    SELECT client_id, restaurant_id, week_no, week_no = min(week_no) OVER (PARTITION BY client_id, restaurant_id) AS is_first FROM pair_weeks""")
def first_seen_flag(v):
    w = Window.partitionBy("client_id", "restaurant_id")
    return weekly_totals(v, "client_id", "restaurant_id").withColumn("is_first", F.col("week_no") == F.min("week_no").over(w))


@query("dense_rank", "client_id s, restaurant_id i, week_no i, position i", """
    SELECT client_id, restaurant_id, week_no, dense_rank() OVER (PARTITION BY client_id, restaurant_id ORDER BY week_no) AS position FROM pair_weeks""")
def dense_rank(v):
    w = Window.partitionBy("client_id", "restaurant_id").orderBy("week_no")
    return weekly_totals(v, "client_id", "restaurant_id").withColumn("position", F.dense_rank().over(w))


@query("average_rank", "restaurant_id i, week_no i, visits i, position f", """
    SELECT restaurant_id, week_no, visits, rank() OVER (PARTITION BY week_no ORDER BY visits) + (count(*) OVER (PARTITION BY week_no, visits) - 1) / 2.0 AS position
    FROM (SELECT restaurant_id, week_no, count(*) // 100 AS visits FROM visit_weeks GROUP BY 1, 2) AS t""")
def average_rank(v):
    counts = visit_weeks(v).groupBy("restaurant_id", "week_no").agg(F.floor(F.count("*") / 100).alias("visits"))
    return scheduling.average_rank(counts, ["week_no"], "visits", "position", work_dir(v.spark))


check_step("pool_pairs", "SELECT group_id, restaurant_id, perday_resto, sum(orders) AS orders FROM schedule_pool GROUP BY 1, 2, 3")


def pool_pairs(v):
    return v.schedule_pool.groupBy("group_id", "restaurant_id", "perday_resto").agg(F.sum("orders").alias("orders"))


@query("rank_first", "group_id i, restaurant_id i, orders i, position i", """
    SELECT group_id, restaurant_id, orders, row_number() OVER (PARTITION BY group_id ORDER BY orders, restaurant_id) AS position FROM pool_pairs""")
def rank_first(v):
    # One row per (group, restaurant): a window holds at most the restaurants.
    w = Window.partitionBy("group_id").orderBy("orders", "restaurant_id")
    return pool_pairs(v).withColumn("position", F.row_number().over(w))


@query("quantile_bin", "group_id i, restaurant_id i, rank i, bin i, bin_share f", """
    SELECT group_id, restaurant_id, rank, greatest((perday_resto * (rank - 1) + m - 2) // greatest(m - 1, 1), 1) AS bin,
           greatest((perday_resto * (rank - 1) + m - 2) // greatest(m - 1, 1), 1) / CAST(perday_resto AS DOUBLE) AS bin_share
    FROM (SELECT *, row_number() OVER (PARTITION BY group_id ORDER BY orders, restaurant_id) AS rank, count(*) OVER (PARTITION BY group_id) AS m FROM pool_pairs) AS t""")
def quantile_bin(v):
    return scheduling.quantile_bins(pool_pairs(v), "group_id", "orders", "restaurant_id", "perday_resto")


check_step("previous_by_week", """
    SELECT client_id, restaurant_id, week_no, coalesce(lag(q) OVER (PARTITION BY client_id, restaurant_id ORDER BY week_no), 0) AS previous_orders
    FROM (SELECT client_id, restaurant_id, week_no, arg_max(orders, (schedule_on, event_id)) AS q FROM visit_weeks GROUP BY 1, 2, 3) AS t""")


@query("previous_orders", "client_id s, restaurant_id i, week_no i, previous_orders f", "SELECT * FROM previous_by_week")
def previous_orders(v):
    return panels.previous_orders(visit_weeks(v))


@query("forward_fill", "client_id s, restaurant_id i, week_no i, rating f", """
    SELECT client_id, restaurant_id, week_no, last_value(r IGNORE NULLS) OVER (PARTITION BY client_id, restaurant_id ORDER BY week_no ROWS UNBOUNDED PRECEDING) AS rating
    FROM (SELECT client_id, restaurant_id, week_no, avg(rating) AS r FROM visit_weeks GROUP BY 1, 2, 3) AS t""")
def forward_fill(v):
    w = Window.partitionBy("client_id", "restaurant_id").orderBy("week_no").rowsBetween(Window.unboundedPreceding, 0)
    weekly = visit_weeks(v).groupBy("client_id", "restaurant_id", "week_no").agg(F.avg("rating").alias("r"))
    return weekly.withColumn("rating", F.last("r", ignorenulls=True).over(w))


@query("next_known", "client_id s, restaurant_id i, week_no i, rating f", """
    SELECT client_id, restaurant_id, week_no, first_value(r IGNORE NULLS) OVER (PARTITION BY client_id, restaurant_id ORDER BY week_no
           ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS rating
    FROM (SELECT client_id, restaurant_id, week_no, avg(rating) AS r FROM visit_weeks GROUP BY 1, 2, 3) AS t""")
def next_known(v):
    w = Window.partitionBy("client_id", "restaurant_id").orderBy("week_no").rowsBetween(1, Window.unboundedFollowing)
    weekly = visit_weeks(v).groupBy("client_id", "restaurant_id", "week_no").agg(F.avg("rating").alias("r"))
    return weekly.withColumn("rating", F.first("r", ignorenulls=True).over(w))


@query("gap_fill_weeks", "client_id s, restaurant_id i, week_no i, total f", """
    SELECT client_id, restaurant_id, week_no, last_value(total IGNORE NULLS) OVER (PARTITION BY client_id, restaurant_id ORDER BY week_no ROWS UNBOUNDED PRECEDING) AS total
    FROM (SELECT client_id, restaurant_id, unnest(generate_series(min(week_no), (SELECT max(week_no) FROM visit_weeks))) AS week_no FROM pair_weeks GROUP BY 1, 2) AS grid
    LEFT JOIN pair_weeks USING (client_id, restaurant_id, week_no)""")
def gap_fill_weeks(v):
    weekly = weekly_totals(v, "client_id", "restaurant_id")
    last_week = visit_weeks(v).select(F.max("week_no")).scalar()
    return panels.gap_fill(weekly, ["client_id", "restaurant_id"], last_week, ["total"])


@query("last_per_group", "company_id i, schedule_on d, menu_id i, quantity i", """
    SELECT company_id, schedule_on, menu_id, quantity FROM (
      SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY schedule_on DESC, order_id DESC, menu_id DESC, quantity DESC) AS rn FROM order_rows) AS t WHERE rn = 1""")
def last_per_group(v):
    return top_n(v.order_rows, ["company_id"], [F.desc("schedule_on"), F.desc("order_id"), F.desc("menu_id"), F.desc("quantity")], 1)


@query("top5_per_group", "group_id i, restaurant_id i, orders i, place i", """
    SELECT group_id, restaurant_id, orders, place FROM (
      SELECT *, row_number() OVER (PARTITION BY group_id ORDER BY orders DESC, restaurant_id) AS place FROM pool_pairs) AS t WHERE place <= 5""")
def top5_per_group(v):
    return top_n(pool_pairs(v), ["group_id"], [F.desc("orders"), F.asc("restaurant_id")], 5, rank="place")


check_step("weighted_scores", """
    SELECT group_id, restaurant_id, avg(quantity * position) AS score FROM (
      SELECT s.group_id, s.restaurant_id, coalesce(q, 0) AS quantity,
             rank() OVER (PARTITION BY s.group_id, s.restaurant_id ORDER BY s.schedule_on)
               + (count(*) OVER (PARTITION BY s.group_id, s.restaurant_id, s.schedule_on) - 1) / 2.0 AS position
      FROM (SELECT DISTINCT l.schedule_on, group_id, restaurant_id FROM (
              SELECT company_id, branch_id, max(schedule_on) AS schedule_on FROM menu_schedules
              WHERE deleted_at IS NULL AND schedule_on BETWEEN DATE '1998-09-19' AND DATE '1998-12-19' GROUP BY 1, 2) AS l
            JOIN companies AS c ON l.company_id = c.company_id JOIN branches AS b ON l.branch_id = b.branch_id WHERE group_id IS NOT NULL) AS s
      LEFT JOIN (SELECT schedule_on, group_id, restaurant_id, sum(quantity) AS q FROM order_rows AS o JOIN companies AS c ON o.company_id = c.company_id
                 WHERE o.deleted_at IS NULL AND category_id = 2 AND schedule_on BETWEEN DATE '1998-09-19' AND DATE '1998-12-19' GROUP BY 1, 2, 3) AS t
      ON s.schedule_on = t.schedule_on AND s.group_id = t.group_id AND s.restaurant_id = t.restaurant_id) AS ranked GROUP BY 1, 2""")


def weighted_scores(v):
    return scheduling.recency_weighted(v.order_rows, v.menu_schedules, v.companies, v.branches, LO, HI)


@query("recency_weighted", "group_id i, restaurant_id i, score f", "SELECT * FROM weighted_scores")
def recency_weighted(v):
    return weighted_scores(v)


@query("day_share", "client_id s, restaurant_id i, share f", """
    SELECT client_id, restaurant_id, avg(o / total) AS share FROM (
      SELECT *, sum(o) OVER (PARTITION BY client_id, schedule_on) AS total FROM (
        SELECT client_id, restaurant_id, schedule_on, sum(orders) AS o FROM visits GROUP BY 1, 2, 3) AS d) AS t GROUP BY 1, 2""")
def day_share(v):
    daily = v.visits.groupBy("client_id", "restaurant_id", "schedule_on").agg(F.sum("orders").alias("o"))
    return scheduling.mean_day_share(daily, ["client_id", "schedule_on"], ["client_id", "restaurant_id"], "o")
