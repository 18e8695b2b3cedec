"""Aggregation queries."""

from datetime import date

from pyspark.sql import functions as F

from schedlytics.functions import calendar as cal
from schedlytics.functions import moments
from schedlytics.functions import scalars as S
from schedlytics.functions.arrays import text
from schedlytics.operators import aggregates as A
from schedlytics.operators import dedupe
from schedlytics.plans import model, panels, ratio, scheduling
from schedlytics.registry import check_step, query
from schedlytics.session import work_dir
from schedlytics.sources import sinks
from schedlytics.sources.inline import inline_table, values_sql

PERIOD = ratio.Period(date(1998, 12, 20), date(1998, 12, 24), date(1998, 10, 1), date(1998, 10, 31))
STATS = lambda *prefixes: ", ".join(f"{p}_{s} f" for p in prefixes for s in moments.STATS)

check_step("visit_weeks", "SELECT *, dense_rank() OVER (ORDER BY isoyear(schedule_on + 1) * 100 + week(schedule_on + 1)) AS week_no FROM visits")


def visit_weeks(v):
    return cal.with_week_index(v.visits, "schedule_on")


def staged_weeks(v):
    """The indexed visits written once, for jobs that read them many times."""
    return sinks.stage(visit_weeks(v), work_dir(v.spark), "visit_weeks")


def weekly_sql(keys: str, values=("rating", "orders")) -> str:
    """Check SQL of the weekly statistics for ``keys``."""
    lists = ", ".join(f"list({x}) FILTER (WHERE {x} IS NOT NULL) AS {x}_xs, count(*) - count({x}) AS {x}_nulls" for x in values)
    stats = ",\n".join(moments.seven_sql(x, x) for x in values)
    return f"SELECT {keys}, week_no,\n{stats}\nFROM (SELECT {keys}, week_no, {lists} FROM visit_weeks GROUP BY {keys}, week_no) AS t"


@query("group_agg", "company_id i, schedules i, total i, mean f, smallest i, largest i", """
    SELECT company_id, count(*) AS schedules, sum(quantity) AS total, avg(quantity) AS mean, min(quantity) AS smallest, max(quantity) AS largest
    FROM order_rows GROUP BY 1""")
def group_agg(v):
    q = "quantity"
    return v.order_rows.groupBy("company_id").agg(F.count("*").alias("schedules"), F.sum(q).alias("total"), F.avg(q).alias("mean"),
                                                  F.min(q).alias("smallest"), F.max(q).alias("largest"))


@query("weekly_stats", f"client_id s, restaurant_id i, week_no i, {STATS('rating', 'orders')}", weekly_sql("client_id, restaurant_id"))
def weekly_stats(v):
    return panels.weekly_stats(visit_weeks(v), ["client_id", "restaurant_id"], ["rating", "orders"])


@query("weekly_mean", "client_id s, weeks i, mean_rating f, mean_orders f", """
    SELECT client_id, count(*) AS weeks, avg(r) AS mean_rating, avg(o) AS mean_orders
    FROM (SELECT client_id, week_no, avg(rating) AS r, avg(orders) AS o FROM visit_weeks GROUP BY 1, 2) AS t GROUP BY 1""")
def weekly_mean(v):
    weekly = visit_weeks(v).groupBy("client_id", "week_no").agg(F.avg("rating").alias("r"), F.avg("orders").alias("o"))
    return weekly.groupBy("client_id").agg(F.count("*").alias("weeks"), F.avg("r").alias("mean_rating"), F.avg("o").alias("mean_orders"))


@query("distinct_users", "restaurant_id i, week_no i, users i", """
    SELECT restaurant_id, week_no, count(DISTINCT visitor_id) + max(CASE WHEN visitor_id IS NULL THEN 1 ELSE 0 END) AS users
    FROM visit_weeks GROUP BY 1, 2""")
def distinct_users(v):
    return visit_weeks(v).groupBy("restaurant_id", "week_no").agg(A.distinct_with_null(F.col("visitor_id")).alias("users"))


@query("collect_lists", "branch_id i, areas s, n i", """
    SELECT branch_id, string_agg(CAST(area_id AS VARCHAR), ',' ORDER BY area_id) AS areas, count(*) AS n FROM branch_area GROUP BY 1""")
def collect_lists(v):
    # At most one entry per area and branch.
    return v.branch_area.groupBy("branch_id").agg(text(F.collect_list("area_id")).alias("areas"), F.count("*").alias("n"))


check_step("group_modes", """
    SELECT p_date, group_id, area_id, min(type) FILTER (WHERE what = 'type' AND n = top) AS type, min(type) FILTER (WHERE what = 'category' AND n = top) AS category
    FROM (SELECT *, max(n) OVER (PARTITION BY p_date, group_id, area_id, what) AS top FROM (
      SELECT p_date, group_id, area_id, 'type' AS what, type, count(*) AS n FROM schedule_pool WHERE type IS NOT NULL GROUP BY ALL
      UNION ALL SELECT p_date, group_id, area_id, 'category', category, count(*) FROM schedule_pool GROUP BY ALL) AS counts) AS ranked GROUP BY 1, 2, 3""")


@query("group_rollup_mode", "p_date d, group_id i, area_id i, per_day i, type i, category i, orders i, is_not_blackout i, days_diff i", """
    SELECT p.p_date, p.group_id, p.area_id, per_day, type, category, orders, is_not_blackout, days_diff
    FROM (SELECT p_date, group_id, area_id, max(perday_resto) AS per_day, sum(orders) AS orders, min(is_not_blackout) AS is_not_blackout,
                 min(days_diff) AS days_diff FROM schedule_pool GROUP BY 1, 2, 3) AS p
    LEFT JOIN group_modes AS m ON p.p_date = m.p_date AND p.group_id = m.group_id AND p.area_id = m.area_id""")
def group_rollup_mode(v):
    return scheduling.rollup_group(v.schedule_pool, ["p_date", "group_id", "area_id"])


check_step("delivered_totals", """
    SELECT restaurant_id, sum(quantity) AS orders_total FROM active_branches AS b JOIN (SELECT branch_id, quantity FROM order_rows
      WHERE status = 5 AND schedule_on BETWEEN DATE '1998-08-10' AND DATE '1998-12-10'
        AND NOT (schedule_on >= DATE '1998-10-01' AND schedule_on < DATE '1998-10-31')) AS o ON b.branch_id = o.branch_id GROUP BY 1""")
check_step("total_cuts", """
    SELECT count(*) AS n, list_sort(list(orders_total))[CAST(ceil(0.25 * (count(*) - 1)) AS INTEGER) + 1] AS q1,
           list_sort(list(orders_total))[CAST(ceil(0.5 * (count(*) - 1)) AS INTEGER) + 1] AS q2,
           list_sort(list(orders_total))[CAST(ceil(0.75 * (count(*) - 1)) AS INTEGER) + 1] AS q3, max(orders_total) AS q4 FROM delivered_totals""")
check_step("quartiles", """
    SELECT restaurant_id, orders_total, CASE WHEN orders_total <= q1 THEN 'D' WHEN orders_total <= q2 THEN 'C' WHEN orders_total <= q3 THEN 'B' ELSE 'A' END AS quartile
    FROM delivered_totals, total_cuts""")


@query("quantile_higher", "name s, value f", """
    SELECT name, value FROM (SELECT CAST(q1 AS DOUBLE) AS q1, CAST(q2 AS DOUBLE) AS q2, CAST(q3 AS DOUBLE) AS q3, CAST(q4 AS DOUBLE) AS q4 FROM total_cuts) AS t
    UNPIVOT (value FOR name IN (q1, q2, q3, q4))""")
def quantile_higher(v):
    totals = ratio.restaurant_totals(ratio.window_facts(v.order_rows, PERIOD), v.branches)
    cuts = A.quantiles_higher(totals, "orders_total", (0.25, 0.5, 0.75)).withColumnRenamed("top", "q4")
    return cuts.unpivot([], ["q1", "q2", "q3", "q4"], "name", "value")


@query("restaurant_quartiles", "restaurant_id i, orders_total i, quartile s, restaurants i, orders_min i, orders_max i", """
    SELECT restaurant_id, orders_total, q.quartile, restaurants, orders_min, orders_max FROM quartiles AS q JOIN (
      SELECT quartile, count(*) AS restaurants, min(orders_total) AS orders_min, max(orders_total) AS orders_max FROM quartiles GROUP BY 1) AS s ON q.quartile = s.quartile""")
def restaurant_quartiles(v):
    totals = ratio.restaurant_totals(ratio.window_facts(v.order_rows, PERIOD), v.branches)
    labelled = ratio.restaurant_quartiles(sinks.stage(totals, work_dir(v.spark), "restaurant_totals"))
    return labelled.join(ratio.quartile_summary(labelled), "quartile")


@query("scalar_broadcast", "company_id i, months i, per_size f", """
    SELECT company_id, months, total / CAST((SELECT count(DISTINCT months) FROM m) AS DOUBLE) AS per_size FROM m""".replace(" m)", " company_months)").replace("FROM m", "FROM company_months"))
def scalar_broadcast(v):
    per = v.order_rows.groupBy("company_id").agg(F.count_distinct(F.trunc("schedule_on", "MM")).alias("months"), F.sum("quantity").alias("total"))
    sizes = per.select(F.count_distinct("months")).scalar()
    return per.select("company_id", "months", (F.col("total") / sizes).alias("per_size"))


check_step("company_months", "SELECT company_id, count(DISTINCT date_trunc('month', schedule_on)) AS months, sum(quantity) AS total FROM order_rows GROUP BY 1")


@query("category_ratio", "area_id i, category i, ratio f", """
    SELECT area_id, category, coalesce(round_even(sum(orders) FILTER (WHERE schedule_status = 0) / CAST(nullif(count(*) FILTER (WHERE schedule_status = 1), 0) AS DOUBLE) * 100, 0) / 100, 0) AS ratio
    FROM schedule_pool GROUP BY 1, 2""")
def category_ratio(v):
    st = F.col("schedule_status")
    sums = v.schedule_pool.groupBy("area_id", "category").agg(F.sum(F.when(st == 0, F.col("orders"))).alias("o"), F.count_if(st == 1).alias("n"))
    return sums.withColumn("ratio", F.coalesce(S.round_half_even(S.safe_ratio(F.col("o"), F.col("n")), 2), F.lit(0.0)))


@query("count_if_having", "p_date d, group_id i, n_new i", """
    SELECT p_date, group_id, count(*) FILTER (WHERE days_diff IS NULL OR days_diff > 90) AS n_new FROM schedule_pool GROUP BY 1, 2 HAVING n_new > 1""")
def count_if_having(v):
    d = F.col("days_diff")
    return v.schedule_pool.groupBy("p_date", "group_id").agg(F.count_if(d.isNull() | (d > 90)).alias("n_new")).where(F.col("n_new") > 1)


@query("group_filter", "id i, p_date d, branch_id i, area_id i", """
    SELECT id, p.p_date, p.branch_id, area_id FROM schedule_pool AS p JOIN (
      SELECT p_date, branch_id FROM schedule_pool GROUP BY 1, 2 HAVING count(DISTINCT area_id) > 1) AS g ON p.p_date = g.p_date AND p.branch_id = g.branch_id""")
def group_filter(v):
    return A.keep_groups(v.schedule_pool, ["p_date", "branch_id"], F.min("area_id") != F.max("area_id"))


check_step("status_days", """
    SELECT p_date, count(*) FILTER (WHERE schedule_status = 0) AS n_0, count(*) FILTER (WHERE schedule_status = 1) AS n_1, count(*) AS n
    FROM schedule_pool GROUP BY 1""")


@query("pivot_counts", "p_date d, group_id i, n_0 i, n_1 i", """
    SELECT p_date, group_id, count(*) FILTER (WHERE schedule_status = 0) AS n_0, count(*) FILTER (WHERE schedule_status = 1) AS n_1 FROM schedule_pool GROUP BY 1, 2""")
def pivot_counts(v):
    return A.pivot_counts(v.schedule_pool, ["p_date", "group_id"], "schedule_status", [0, 1])


@query("pivot_totals", "day s, n_0 i, n_1 i", """
    SELECT CAST(p_date AS VARCHAR) AS day, n_0, n_1 FROM status_days UNION ALL SELECT 'All', sum(n_0), sum(n_1) FROM status_days""")
def pivot_totals(v):
    daily = A.pivot_counts(v.schedule_pool, ["p_date"], "schedule_status", [0, 1])
    return A.with_total_row(daily, "p_date", "day", {"n_0": F.sum, "n_1": F.sum})


@query("pivot_share", "day s, share_0 f, share_1 f", """
    SELECT CAST(p_date AS VARCHAR) AS day, n_0 / CAST(n_0 + n_1 AS DOUBLE) AS share_0, n_1 / CAST(n_0 + n_1 AS DOUBLE) AS share_1 FROM status_days
    UNION ALL SELECT 'All', avg(n_0 / CAST(n_0 + n_1 AS DOUBLE)), avg(n_1 / CAST(n_0 + n_1 AS DOUBLE)) FROM status_days""")
def pivot_share(v):
    daily = A.pivot_counts(v.schedule_pool, ["p_date"], "schedule_status", [0, 1])
    total = F.col("n_0") + F.col("n_1")
    shares = daily.select("p_date", S.safe_ratio(F.col("n_0"), total).alias("share_0"), S.safe_ratio(F.col("n_1"), total).alias("share_1"))
    return A.with_total_row(shares, "p_date", "day", {"share_0": F.avg, "share_1": F.avg})


# A category limit table, one column per per-day size.
LIMITS = [(18, 2, 3, 3), (17, 3, 3, 3), (27, 3, 4, 4), (2, 2, 3, 3), (8, 2, 3, 3), (22, 2, 3, 3), (1, None, 3, 3)]


@query("melt_rules", "category i, perday_resto i, max_schedules i, n i", f"""
    SELECT l.category, l.perday_resto, max_schedules, count(id) AS n FROM (
      SELECT category, 3 AS perday_resto, coalesce(a, 100) AS max_schedules FROM (VALUES {values_sql(LIMITS)}) AS t(category, a, b, c)
      UNION ALL SELECT category, 4, coalesce(b, 100) FROM (VALUES {values_sql(LIMITS)}) AS t(category, a, b, c)
      UNION ALL SELECT category, 5, coalesce(c, 100) FROM (VALUES {values_sql(LIMITS)}) AS t(category, a, b, c)) AS l
    LEFT JOIN schedule_pool AS p ON p.category = l.category AND p.perday_resto = l.perday_resto GROUP BY 1, 2, 3""")
def melt_rules(v):
    wide = inline_table(v.spark, "category, `3`, `4`, `5`", LIMITS)
    limits = A.melt_sizes(wide, "category", ["3", "4", "5"], "perday_resto", "max_schedules", default=100)
    used = v.schedule_pool.groupBy("category", "perday_resto").agg(F.count("*").alias("n"))
    return limits.join(used, ["category", "perday_resto"], "left").fillna(0, ["n"])


@query("dedupe_last", "company_id i, branch_id i, schedule_on d, id i, menu_id i", """
    SELECT company_id, branch_id, arg_max(schedule_on, (schedule_on, id, menu_id)) AS schedule_on, arg_max(id, (schedule_on, id, menu_id)) AS id,
           arg_max(menu_id, (schedule_on, id, menu_id)) AS menu_id FROM menu_schedules GROUP BY 1, 2""")
def dedupe_last(v):
    rows = v.menu_schedules.select("company_id", "branch_id", "schedule_on", "id", "menu_id")
    return dedupe.keep_one(rows, ["company_id", "branch_id"], ["schedule_on", "id", "menu_id"], last=True)


@query("dedupe_first", "branch_id i, schedule_on d, company_id i, menu_id i", """
    SELECT branch_id, schedule_on, company_id, menu_id FROM (
      SELECT *, row_number() OVER (PARTITION BY branch_id, schedule_on ORDER BY id, menu_id, company_id) AS rn FROM menu_schedules) AS t WHERE rn = 1""")
def dedupe_first(v):
    return dedupe.keep_one(v.menu_schedules.drop("deleted_at"), ["branch_id", "schedule_on"], ["id", "menu_id", "company_id"], last=False)


@query("distinct_rows", "company_id i, schedule_on d, branch_id i", "SELECT DISTINCT company_id, schedule_on, branch_id FROM menu_schedules")
def distinct_rows(v):
    return v.menu_schedules.select("company_id", "schedule_on", "branch_id").distinct()


@query("duplicate_flag", "p_date d, group_id i, type2 i, n_repeats i", """
    SELECT p_date, group_id, type2, count(*) FILTER (WHERE rn > 1) AS n_repeats FROM (
      SELECT *, row_number() OVER (PARTITION BY p_date, group_id, type2 ORDER BY id, branch_id, orders, days_diff NULLS FIRST) AS rn FROM schedule_pool) AS t GROUP BY 1, 2, 3""")
def duplicate_flag(v):
    flagged = dedupe.flag_repeats(v.schedule_pool, ["p_date", "group_id", "type2"], ["id", "branch_id", "orders", "days_diff"])
    return flagged.groupBy("p_date", "group_id", "type2").agg(F.count_if("is_repeat").alias("n_repeats"))


@query("latest_row", "client_id s, week_no i, n i, total f", """
    SELECT client_id, max(week_no) AS week_no, arg_max(n, week_no) AS n, arg_max(total, week_no) AS total
    FROM (SELECT client_id, week_no, count(*) AS n, sum(orders) AS total FROM visit_weeks GROUP BY 1, 2) AS t GROUP BY 1""")
def latest_row(v):
    weekly = visit_weeks(v).groupBy("client_id", "week_no").agg(F.count("*").alias("n"), F.sum("orders").alias("total"))
    return panels.latest(weekly, ["client_id"])


@query("rows_at_max", "event_id i, week_no i", "SELECT event_id, week_no FROM visit_weeks WHERE week_no = (SELECT max(week_no) FROM visit_weeks)")
def rows_at_max(v):
    weeks = visit_weeks(v)
    return weeks.where(F.col("week_no") == weeks.select(F.max("week_no")).scalar())


@query("schedule_history", "group_id i, branch_id i, days s, times i", """
    SELECT group_id, branch_id, string_agg(CAST(schedule_on AS VARCHAR), ',' ORDER BY schedule_on) AS days, count(*) AS times FROM (
      SELECT DISTINCT group_id, branch_id, schedule_on FROM menu_schedules AS m JOIN companies AS c ON m.company_id = c.company_id
      WHERE group_id IS NOT NULL AND m.deleted_at IS NULL AND schedule_on BETWEEN DATE '1998-09-19' AND DATE '1998-12-19') AS t GROUP BY 1, 2""")
def schedule_history(v):
    anchor = date(1998, 12, 20)
    hist = scheduling.group_history(v.menu_schedules, v.companies, cal.lookback(anchor, months=3, days=1), cal.lookback(anchor, days=1))
    return hist.select("group_id", "branch_id", text("schedule_history").alias("days"), F.col("c2r_count").alias("times"))


@query("regression_report", "records i, mean_abs_error f, mse f, rmse f, r2 f, y f, y_hat f, overall_acc f, diff_orders f, diff_adj1_orders f, diff_records i, "
       "diff_adj1_records i, acc f, acc_adj1 f, acc_orders f, acc_adj1_orders f, actual_r2 f", """
    SELECT count(*) AS records, avg(d) AS mean_abs_error, avg(d * d) AS mse, sqrt(avg(d * d)) AS rmse, 1 - sum(d * d) / sum((y - m) * (y - m)) AS r2,
           sum(y) AS y, sum(p) AS y_hat, least(sum(y), sum(p)) / greatest(sum(y), sum(p)) AS overall_acc, sum(d) AS diff_orders,
           sum(CASE WHEN d > 1 THEN d ELSE 0 END) AS diff_adj1_orders, count(*) FILTER (WHERE d > 0) AS diff_records,
           count(*) FILTER (WHERE d > 1) AS diff_adj1_records, 1 - count(*) FILTER (WHERE d > 0) / CAST(count(*) AS DOUBLE) AS acc,
           1 - count(*) FILTER (WHERE d > 1) / CAST(count(*) AS DOUBLE) AS acc_adj1, (sum(y) - sum(d)) / sum(y) AS acc_orders,
           (sum(y) - sum(CASE WHEN d > 1 THEN d ELSE 0 END)) / sum(y) AS acc_adj1_orders, 1 - sum((y - p) * (y - p)) / sum((y - m) * (y - m)) AS actual_r2
    FROM (SELECT y, predictions AS p, abs(y - CASE WHEN predictions <= 0 THEN 0 ELSE round_even(predictions, 0) END) AS d,
                 (SELECT avg(y) FROM metric_pairs) AS m FROM metric_pairs) AS t""")
def regression_report(v):
    return model.regression_report(v.metric_pairs)


check_step("confusion", "SELECT CAST(y AS BIGINT) AS y, CAST(CASE WHEN predictions <= 0 THEN 0 ELSE round_even(predictions, 0) END AS BIGINT) AS r FROM metric_pairs")


@query("macro_f1", "macro_f1 f, classes i", """
    SELECT avg(2.0 * tp / (2.0 * tp + fp + fn)) AS macro_f1, count(*) AS classes FROM (
      SELECT k, (SELECT count(*) FROM confusion WHERE y = k AND r = k) AS tp, (SELECT count(*) FROM confusion WHERE y <> k AND r = k) AS fp,
             (SELECT count(*) FROM confusion WHERE y = k AND r <> k) AS fn
      FROM (SELECT y AS k FROM confusion UNION SELECT r FROM confusion) AS classes) AS t""")
def macro_f1(v):
    return model.macro_f1(v.metric_pairs)
