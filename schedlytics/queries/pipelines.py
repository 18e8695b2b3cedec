"""The business jobs: ratio, routing, history, panels, features, candidates, scheduling, publishing."""

from datetime import date, timedelta

from pyspark.sql import functions as F

from schedlytics.contract import marked, shaped
from schedlytics.functions import calendar as cal
from schedlytics.functions import moments
from schedlytics.functions import scalars as S
from schedlytics.plans import candidates, clusters, entities, history, lateness, model, panels, publishing, ratio, scheduling
from schedlytics.queries.grouped import PERIOD, staged_weeks, visit_weeks
from schedlytics.queries.windowed import expanding_sql, weighted_scores
from schedlytics.registry import check_step, contract_of, query
from schedlytics.session import work_dir
from schedlytics.sources.sinks import stage

ANCHOR = date(1998, 12, 20)

# ---- ratio and routing ----

check_step("covered_orders", """
    SELECT * FROM order_rows WHERE status = 5 AND schedule_on BETWEEN DATE '1998-08-10' AND DATE '1998-12-10'
      AND NOT (schedule_on >= DATE '1998-10-01' AND schedule_on < DATE '1998-10-31')""")
check_step("ratio_pairs", """
    SELECT company_id, group_id, c.area_id, b.branch_id, b.restaurant_id, type, category FROM active_clients AS c JOIN branch_area AS a ON c.area_id = a.area_id
    JOIN active_branches AS b ON a.branch_id = b.branch_id JOIN active_restaurants AS r ON b.restaurant_id = r.restaurant_id""")
check_step("routed_weeks", """
    SELECT company_id, 'W_' || CAST(week(schedule_on + 1) + 1 AS VARCHAR) AS week, sum(quantity) AS q FROM covered_orders
    WHERE company_id IN (SELECT company_id FROM ratio_pairs) GROUP BY 1, 2""")
check_step("routed_counts", """
    SELECT company_id, count(*) AS weeks_count, sum(q) AS orders_sum FROM routed_weeks GROUP BY 1
    UNION ALL SELECT DISTINCT company_id, (SELECT count(DISTINCT week) FROM routed_weeks), 0 FROM ratio_pairs
    WHERE company_id NOT IN (SELECT company_id FROM routed_weeks)""")
check_step("routes", """
    SELECT company_id, weeks_count, orders_sum, order_avg, all_avg,
           CASE WHEN all_avg = 0 THEN 'ratio' WHEN all_avg >= 7 AND weeks_count >= round_even(k * 0.7, 0) THEN 'model'
                WHEN all_avg >= 4 AND weeks_count >= round_even(k * 0.5, 0) THEN 'model' WHEN weeks_count >= round_even(k * 0.7, 0) THEN 'model' ELSE 'ratio' END AS model
    FROM (SELECT *, round_even(orders_sum / CAST(weeks_count AS DOUBLE), 0) AS order_avg, round_even(orders_sum / CAST(k AS DOUBLE), 0) AS all_avg
          FROM routed_counts, (SELECT CAST(count(DISTINCT weeks_count) AS DOUBLE) AS k FROM routed_counts) AS sizes) AS t""")
check_step("ratio_table", """
    SELECT p.*, quartile, model, total_orders, times_scheduled FROM ratio_pairs AS p
    LEFT JOIN quartiles AS q ON p.restaurant_id = q.restaurant_id LEFT JOIN routes AS r ON p.company_id = r.company_id
    LEFT JOIN (SELECT company_id, b.restaurant_id, sum(quantity) AS total_orders FROM covered_orders AS o JOIN active_branches AS b ON o.branch_id = b.branch_id
               JOIN active_restaurants AS a ON b.restaurant_id = a.restaurant_id GROUP BY 1, 2) AS t ON p.company_id = t.company_id AND p.restaurant_id = t.restaurant_id
    LEFT JOIN (SELECT company_id, b.restaurant_id, count(*) AS times_scheduled FROM menu_schedules AS m JOIN active_branches AS b ON m.branch_id = b.branch_id
               WHERE deleted_at IS NULL AND schedule_on BETWEEN DATE '1998-08-10' AND DATE '1998-12-10'
                 AND NOT (schedule_on >= DATE '1998-10-01' AND schedule_on < DATE '1998-10-31') GROUP BY 1, 2) AS s
      ON p.company_id = s.company_id AND p.restaurant_id = s.restaurant_id""")
check_step("ratio_rows", """
    SELECT company_id, group_id, CAST(d AS DATE) AS schedule_on, branch_id, restaurant_id, model,
           round_even(coalesce(CASE WHEN total_orders <> 0 AND times_scheduled IS NOT NULL THEN round_even(total_orders / CAST(times_scheduled AS DOUBLE) * 100, 0) / 100
                                    WHEN total_orders IS NULL AND times_scheduled > 2 THEN 0 END, fallback, 0), 0) AS ots
    FROM ratio_table AS t LEFT JOIN (
      SELECT area_id, category, quartile, coalesce(round_even(coalesce(sum(total_orders), 0) / CAST(sum(times_scheduled) AS DOUBLE) * 100, 0) / 100, 0) AS fallback
      FROM ratio_table GROUP BY 1, 2, 3) AS f ON t.area_id = f.area_id AND t.category = f.category AND t.quartile = f.quartile
    CROSS JOIN generate_series(DATE '1998-12-20', DATE '1998-12-24', INTERVAL 1 DAY) AS days(d)""")


def routed(v):
    """The shared steps: folder, serving branches, order facts and client routes, each written once."""
    folder = work_dir(v.spark)
    serving = stage(ratio.serving_branches(v.branches, v.restaurants, v.branch_area), folder, "serving")
    facts = ratio.window_facts(v.order_rows, PERIOD, folder)
    routes = ratio.client_routing(ratio.pair_clients(v.companies, v.client_groups, serving), facts, folder)
    return folder, serving, facts, stage(routes, folder, "routes")


def ratio_rows(v, folder, serving, facts, routes, **options):
    return ratio.order_schedule_ratio(v.companies, v.client_groups, v.branches, v.restaurants, serving, facts, v.menu_schedules, routes, PERIOD, folder, **options)


def finished(name):
    """Shapes the contract columns of query ``name`` on a side of its large join."""
    return lambda side: shaped(side, contract_of(name))


def with_day_text(df, start, end, columns=(("schedule_on", "d"),)):
    """Days of a period as text, and ``columns`` that have the shape of the contract."""
    return marked(df.withColumn("schedule_on", cal.day_text(F.col("schedule_on"), start, end)), columns)


# Ratios are whole numbers.
RATIO_SHAPE = (("schedule_on", "d"), ("ots", "f"))


@query("order_schedule_ratio", "company_id i, group_id i, schedule_on d, branch_id i, restaurant_id i, ots f, model s", "SELECT * FROM ratio_rows")
def order_schedule_ratio(v):
    return with_day_text(ratio_rows(v, *routed(v)), PERIOD.start, PERIOD.end, RATIO_SHAPE)


@query("client_routing", "company_id i, weeks_count i, orders_sum i, order_avg i, all_avg i, model s", "SELECT * FROM routes")
def client_routing(v):
    return routed(v)[-1]


# ---- history ----

check_step("history_all", """
    SELECT s.schedule_on, s.restaurant_id, s.client_id, rating, coalesce(quantity, 0) AS quantity FROM (
      SELECT DISTINCT schedule_on, b.restaurant_id, company_id || '_C' AS client_id FROM menu_schedules AS m JOIN active_branches AS b ON m.branch_id = b.branch_id
      WHERE schedule_on >= DATE '1998-06-14' AND deleted_at IS NULL AND menu_id IN (SELECT menu_id FROM menus WHERE category_id = 2)) AS s
    LEFT JOIN (SELECT schedule_on, company_id || '_C' AS client_id, b.restaurant_id, avg(rating) AS rating, sum(quantity) AS quantity
               FROM order_rows AS o JOIN active_branches AS b ON o.branch_id = b.branch_id
               WHERE schedule_on >= DATE '1998-06-14' AND category_id = 2
                 AND company_id NOT IN (SELECT company_id FROM companies WHERE lower(company_name) LIKE '%test%') GROUP BY 1, 2, 3) AS t
      ON s.schedule_on = t.schedule_on AND s.restaurant_id = t.restaurant_id AND s.client_id = t.client_id""")
check_step("vital", """
    SELECT client_id, sum(quantity) AS quantity FROM history_all WHERE schedule_on BETWEEN DATE '1998-10-20' AND DATE '1998-12-20' GROUP BY 1 HAVING sum(quantity) > 0""")


def history_args(v):
    return v.menu_schedules, v.order_rows, v.menus, entities.active_branches(v.branches), v.companies, ANCHOR


@query("prepared_history", "schedule_on d, restaurant_id i, client_id s, rating f, quantity i", """
    SELECT * FROM history_all WHERE client_id IN (SELECT client_id FROM vital)""")
def prepared_history(v):
    return history.prepared_history(*history_args(v), work_dir(v.spark))


# Buildings have the schedules of the companies that share them, and an order is created up to two days ahead.
UNTIL = date(1998, 12, 5)
check_step("history_until", """
    SELECT s.*, rating, coalesce(quantity, 0) AS quantity FROM (
      SELECT DISTINCT schedule_on, b.restaurant_id, client_id FROM (
        SELECT *, unnest(CASE WHEN company_id % 23 = 0 THEN [company_id || '_C', company_id || '_B'] ELSE [company_id || '_C'] END) AS client_id FROM menu_schedules) AS m
      JOIN active_branches AS b ON m.branch_id = b.branch_id
      WHERE schedule_on >= DATE '1998-06-14' AND deleted_at IS NULL AND menu_id IN (SELECT menu_id FROM menus WHERE category_id = 2)) AS s
    LEFT JOIN (SELECT schedule_on, coalesce(building_id || '_B', company_id || '_C') AS client_id, b.restaurant_id, avg(rating) AS rating, sum(quantity) AS quantity
               FROM order_rows AS o JOIN active_branches AS b ON o.branch_id = b.branch_id
               WHERE schedule_on >= DATE '1998-06-14' AND category_id = 2 AND schedule_on - CAST(order_id % 3 AS INTEGER) <= DATE '1998-12-05'
                 AND company_id NOT IN (SELECT company_id FROM companies WHERE lower(company_name) LIKE '%test%')
                 AND coalesce(building_id, -1) NOT IN (SELECT building_id FROM buildings WHERE lower(building_name) LIKE '%test%') GROUP BY 1, 2, 3) AS t
      ON s.schedule_on = t.schedule_on AND s.restaurant_id = t.restaurant_id AND s.client_id = t.client_id""")


@query("prepared_history_until", "schedule_on d, restaurant_id i, client_id s, rating f, quantity i", """
    SELECT * FROM history_until WHERE schedule_on <= DATE '1998-12-05' AND client_id IN (
      SELECT client_id FROM history_until WHERE schedule_on BETWEEN DATE '1998-10-20' AND DATE '1998-12-20' GROUP BY 1 HAVING sum(quantity) > 0)""")
def prepared_history_until(v):
    schedules, orders, *rest = history_args(v)
    orders = orders.withColumn("created_at", F.date_sub("schedule_on", F.pmod("order_id", F.lit(3)).cast("int")))
    by_building = schedules.where(F.pmod("company_id", F.lit(23)) == 0).withColumnRenamed("company_id", "building_id")
    return history.prepared_history(schedules, orders, *rest, work_dir(v.spark), by_building, v.buildings, UNTIL, "created_at")


@query("vital_clients", "client_id s", "SELECT client_id FROM vital")
def vital_clients(v):
    return history.vital_clients(history.schedules_vs_orders(*history_args(v)), ANCHOR)


# ---- panels and features ----


def panel_columns(keys: str, values, flag: str, rank: bool) -> str:
    stats = [n for x in values for n in moments.names(x) + moments.names(x, expanding=True)]
    return ", ".join([keys, "week_no i", *[f"{n} f" for n in stats], f"{flag} b"] + (["pair_rank i"] if rank else []))


def panel_sql(keys: str, values=("rating", "orders"), flag: str = "first", rank: bool = False) -> str:
    """Check SQL of a panel: explicit grid, left join, ignore-nulls fills."""
    w = f"OVER (PARTITION BY {keys} ORDER BY week_no ROWS UNBOUNDED PRECEDING)"
    nxt = f"OVER (PARTITION BY {keys} ORDER BY week_no ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)"
    stats = [n for x in values for n in moments.names(x) + moments.names(x, expanding=True)]
    filled = ", ".join(f"last_value({n} IGNORE NULLS) {w} AS {n}" for n in stats)
    ranks = f", coalesce(first_value(r IGNORE NULLS) {nxt}, max(n_weeks) OVER (PARTITION BY {keys}) + 1) AS pair_rank" if rank else ""
    return f"""SELECT {keys}, week_no, {filled}, coalesce(first_value(f IGNORE NULLS) {nxt}, FALSE) AS {flag}{ranks}
    FROM (SELECT {keys}, unnest(generate_series(min(week_no), (SELECT max(week_no) FROM visit_weeks))) AS week_no FROM visit_weeks GROUP BY {keys}) AS grid
    LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY week_no) = 1 AS f, dense_rank() OVER (PARTITION BY {keys} ORDER BY week_no) AS r,
                      nullif(count(*) OVER (PARTITION BY {keys}), 1) AS n_weeks
               FROM ({expanding_sql(keys, values)}) AS e) AS observed USING ({keys}, week_no)"""


check_step("client_panel", panel_sql("client_id", flag="is_first_time_client"))
check_step("restaurant_panel", panel_sql("restaurant_id", flag="is_first_time_restaurant"))
check_step("pair_panel", panel_sql("client_id, restaurant_id", ("orders",), "is_first_time_pair", True))


@query("panel_client", panel_columns("client_id s", ("rating", "orders"), "is_first_time_client", False), "SELECT * FROM client_panel")
def panel_client(v):
    return panels.client_panel(visit_weeks(v))


@query("panel_restaurant", panel_columns("restaurant_id i", ("rating", "orders"), "is_first_time_restaurant", False), "SELECT * FROM restaurant_panel")
def panel_restaurant(v):
    return panels.restaurant_panel(visit_weeks(v))


@query("panel_pair", panel_columns("client_id s, restaurant_id i", ("orders",), "is_first_time_pair", True), "SELECT * FROM pair_panel")
def panel_pair(v):
    return panels.pair_panel(visit_weeks(v))


check_step("lunch_weeks", """
    SELECT *, company_id || '_C' AS client_id, dense_rank() OVER (ORDER BY isoyear(schedule_on + 1) * 100 + week(schedule_on + 1)) AS week_no
    FROM order_rows WHERE status = 5 AND category_id = 2""")


@query("client_usage", "client_id s, week_no i, unique_users i, total_orders i", """
    SELECT client_id, week_no, count(DISTINCT user_id) + max(CASE WHEN user_id IS NULL THEN 1 ELSE 0 END) AS unique_users, sum(quantity) AS total_orders
    FROM lunch_weeks GROUP BY 1, 2""")
def client_usage(v):
    lunch = v.order_rows.where("status = 5 AND category_id = 2").withColumn("client_id", S.client_id(F.col("company_id")))
    return panels.client_usage(cal.with_week_index(lunch, "schedule_on"))


check_step("visit_usage", """
    SELECT client_id, week_no, count(DISTINCT visitor_id) + max(CASE WHEN visitor_id IS NULL THEN 1 ELSE 0 END) AS unique_users, sum(orders) AS total_orders
    FROM visit_weeks GROUP BY 1, 2""")
FEATURES = ["c_rating_mean", "c_orders_std", "c_exp_orders_median", "c_exp_rating_kurtosis", "r_rating_max", "r_orders_skew", "r_exp_orders_mean",
            "r_exp_rating_std", "p_orders_mean", "p_orders_kurtosis", "p_exp_orders_min", "p_exp_orders_skew"]
FEATURE_COLUMNS = ("schedule_on d, client_id s, restaurant_id i, week_no i, event_id i, previous_orders f, " + ", ".join(f"{c} f" for c in FEATURES) +
                   ", c_is_first_time_client b, r_is_first_time_restaurant b, p_is_first_time_pair b, p_pair_rank i, unique_users i, total_orders f, "
                   "type i, category i, area_id i, day_of_week i, orders f")
check_step("feature_rows", f"""
    SELECT b.schedule_on, b.client_id, b.restaurant_id, b.week_no - 1 AS week_no, b.event_id, previous_orders, {", ".join(c.replace("_", ".", 1) + " AS " + c for c in FEATURES)},
           c.is_first_time_client AS c_is_first_time_client, r.is_first_time_restaurant AS r_is_first_time_restaurant, p.is_first_time_pair AS p_is_first_time_pair,
           p.pair_rank AS p_pair_rank, unique_users, total_orders, type, category, k.area_id, isodow(b.schedule_on) - 1 AS day_of_week, b.orders
    FROM visit_weeks AS b LEFT JOIN client_panel AS c ON b.client_id = c.client_id AND b.week_no - 1 = c.week_no
    LEFT JOIN restaurant_panel AS r ON b.restaurant_id = r.restaurant_id AND b.week_no - 1 = r.week_no
    LEFT JOIN pair_panel AS p ON b.client_id = p.client_id AND b.restaurant_id = p.restaurant_id AND b.week_no - 1 = p.week_no
    LEFT JOIN visit_usage AS u ON b.client_id = u.client_id AND b.week_no - 1 = u.week_no
    LEFT JOIN previous_by_week AS q ON b.client_id = q.client_id AND b.restaurant_id = q.restaurant_id AND b.week_no = q.week_no
    JOIN active_restaurants AS a ON b.restaurant_id = a.restaurant_id LEFT JOIN companies AS k ON b.client_id = k.company_id || '_C'""")


def client_areas(v):
    return v.companies.select(S.client_id(F.col("company_id")).alias("client_id"), "area_id")


def visit_usage(weeks):
    return panels.client_usage(weeks, "visitor_id", "orders")


def feature_rows(v):
    weeks = staged_weeks(v)
    return panels.training_features(weeks, visit_usage(weeks), entities.active_restaurants(v.restaurants), client_areas(v))


@query("training_features", FEATURE_COLUMNS, "SELECT * FROM feature_rows")
def training_features(v):
    return feature_rows(v)


@query("feature_assembly", "client_id s, restaurant_id i, week_no i, visits i, c_orders_mean f, r_orders_mean f, p_orders_mean f, unique_users i, type i, area_id i", """
    SELECT b.client_id, b.restaurant_id, b.week_no, visits, c.orders_mean AS c_orders_mean, r.orders_mean AS r_orders_mean, p.orders_mean AS p_orders_mean,
           unique_users, type, k.area_id
    FROM (SELECT client_id, restaurant_id, week_no, count(*) AS visits FROM visit_weeks GROUP BY 1, 2, 3) AS b
    LEFT JOIN (SELECT client_id, week_no, avg(orders) AS orders_mean FROM visit_weeks GROUP BY 1, 2) AS c ON b.client_id = c.client_id AND b.week_no = c.week_no
    LEFT JOIN (SELECT restaurant_id, week_no, avg(orders) AS orders_mean FROM visit_weeks GROUP BY 1, 2) AS r ON b.restaurant_id = r.restaurant_id AND b.week_no = r.week_no
    LEFT JOIN (SELECT client_id, restaurant_id, week_no, avg(orders) AS orders_mean FROM visit_weeks GROUP BY 1, 2, 3) AS p
      ON b.client_id = p.client_id AND b.restaurant_id = p.restaurant_id AND b.week_no = p.week_no
    LEFT JOIN visit_usage AS u ON b.client_id = u.client_id AND b.week_no = u.week_no
    JOIN active_restaurants AS a ON b.restaurant_id = a.restaurant_id LEFT JOIN companies AS k ON b.client_id = k.company_id || '_C'""")
def feature_assembly(v):
    weeks = staged_weeks(v)
    mean = lambda *keys: weeks.groupBy(*keys, "week_no").agg(F.avg("orders").alias("orders_mean"))
    base = weeks.groupBy("client_id", "restaurant_id", "week_no").agg(F.count("*").alias("visits"))
    return panels.assemble(base, mean("client_id"), mean("restaurant_id"), mean("client_id", "restaurant_id"), visit_usage(weeks),
                           entities.active_restaurants(v.restaurants), client_areas(v))


WIDE = FEATURES + ["previous_orders", "total_orders"]
check_step("clean_rows", f"""
    SELECT schedule_on, client_id, restaurant_id, event_id, {", ".join(f"coalesce({c}, {-3 if 'kurtosis' in c else 0}) AS {c}" for c in WIDE)},
           coalesce(c_is_first_time_client, TRUE) AS c_is_first_time_client, coalesce(r_is_first_time_restaurant, TRUE) AS r_is_first_time_restaurant,
           coalesce(p_is_first_time_pair, TRUE) AS p_is_first_time_pair, coalesce(p_pair_rank, 1) AS p_pair_rank, coalesce(unique_users, 0) AS unique_users,
           type, category, day_of_week, orders
    FROM feature_rows WHERE schedule_on >= DATE '2024-01-07' AND type IS NOT NULL AND category IS NOT NULL""")


def clean_rows(v, start=date(2024, 1, 7)):
    rows = feature_rows(v).where(F.col("schedule_on") >= F.lit(start)).dropna(subset=["type", "category"])
    return S.fill_by_family(rows, skip=["client_id", "restaurant_id", "event_id", "week_no"])


@query("clean_features", "schedule_on d, client_id s, restaurant_id i, event_id i, " + ", ".join(f"{c} f" for c in WIDE) +
       ", c_is_first_time_client b, r_is_first_time_restaurant b, p_is_first_time_pair b, p_pair_rank i, unique_users i, type i, category i, day_of_week i, orders f",
       "SELECT * FROM clean_rows")
def clean_features(v):
    return clean_rows(v)


# ---- lateness ----


def late_sql(keys: str, name: str) -> str:
    return f"""
    SELECT {keys}, week, minutes, lag(minutes) OVER (PARTITION BY {keys} ORDER BY week) AS {name},
           last_value(week) OVER (PARTITION BY {keys} ORDER BY week ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last_week,
           last_value(minutes) OVER (PARTITION BY {keys} ORDER BY week ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last_minutes
    FROM (SELECT {keys}, week, avg(minutes) AS minutes FROM late_rows WHERE week > '1996_44' GROUP BY {keys}, week) AS t"""


check_step("late_rows", """
    SELECT CASE WHEN building_id IS NULL THEN company_id || '_C' ELSE building_id || '_B' END AS client_id, restaurant_id,
           CAST(year(s) - CASE WHEN week(s) > 45 AND month(s) = 1 THEN 1 ELSE 0 END AS VARCHAR) || '_' || lpad(CAST(week(s) AS VARCHAR), 2, '0') AS week,
           CASE WHEN m < -120 THEN -120 WHEN m > 120 THEN 120 ELSE m END AS minutes
    FROM (SELECT *, schedule_on + 1 AS s, date_diff('second', expected_time, coalesce(delivered_at, history_created_at)) / 60.0 AS m FROM deliveries) AS t""")
check_step("late_pairs", late_sql("client_id, restaurant_id", "lagged"))
check_step("late_clients", late_sql("client_id", "lagged"))
check_step("late_restaurants", late_sql("restaurant_id", "lagged"))
check_step("late_base", """
    SELECT DISTINCT CASE WHEN building_id IS NULL THEN company_id || '_C' ELSE building_id || '_B' END AS client_id, restaurant_id, schedule_on,
           CAST(year(s) - CASE WHEN week(s) > 45 AND month(s) = 1 THEN 1 ELSE 0 END AS VARCHAR) || '_' || lpad(CAST(week(s) AS VARCHAR), 2, '0') AS week
    FROM (SELECT *, schedule_on + 1 AS s FROM order_rows) AS t""")


def late_pick(alias: str, value: str) -> str:
    return f"coalesce({alias}.lagged, CASE WHEN b.week > {alias}l.last_week THEN {alias}l.last_minutes END, 0) AS {value}"


def late_join(alias: str, step: str, on) -> str:
    same = " AND ".join(f"b.{k} = {alias}.{k}" for k in on)
    last = " AND ".join(f"b.{k} = {alias}l.{k}" for k in on)
    return f"""LEFT JOIN {step} AS {alias} ON {same} AND b.week = {alias}.week
    LEFT JOIN (SELECT DISTINCT {', '.join(on)}, last_week, last_minutes FROM {step}) AS {alias}l ON {last}"""


@query("lateness_features", "client_id s, restaurant_id i, schedule_on d, p_lateness f, c_lateness f, r_lateness f", f"""
    SELECT b.client_id, b.restaurant_id, b.schedule_on, {late_pick("p", "p_lateness")}, {late_pick("c", "c_lateness")}, {late_pick("r", "r_lateness")}
    FROM late_base AS b {late_join("p", "late_pairs", ["client_id", "restaurant_id"])}
    {late_join("c", "late_clients", ["client_id"])} {late_join("r", "late_restaurants", ["restaurant_id"])}""")
def lateness_features(v):
    cid = S.client_id(F.col("company_id"), F.col("building_id"))
    base = v.order_rows.select(cid.alias("client_id"), "restaurant_id", "schedule_on").distinct()
    return lateness.attach_lateness(base, lateness.delivery_minutes(v.deliveries.withColumn("client_id", cid)), since="1996_44")


def last_mean_sql(keys: str) -> str:
    return f"""
    SELECT {keys}, arg_max(minutes, week) AS minutes FROM (SELECT {keys}, week, avg(minutes) AS minutes FROM late_rows WHERE week > '1996_44' GROUP BY {keys}, week) AS t GROUP BY {keys}"""


check_step("last_late_pair", last_mean_sql("client_id, restaurant_id"))
check_step("last_late_client", last_mean_sql("client_id"))
check_step("last_late_restaurant", last_mean_sql("restaurant_id"))


@query("latest_lateness", "client_id s, restaurant_id i, p_lateness f, c_lateness f, r_lateness f", """
    SELECT s.client_id, s.restaurant_id, coalesce(p.minutes, 0) AS p_lateness, coalesce(c.minutes, 0) AS c_lateness, coalesce(r.minutes, 0) AS r_lateness
    FROM score_pairs AS s LEFT JOIN last_late_pair AS p ON s.client_id = p.client_id AND s.restaurant_id = p.restaurant_id
    LEFT JOIN last_late_client AS c ON s.client_id = c.client_id LEFT JOIN last_late_restaurant AS r ON s.restaurant_id = r.restaurant_id""")
def latest_lateness(v):
    cid = S.client_id(F.col("company_id"), F.col("building_id"))
    rows = stage(lateness.delivery_minutes(v.deliveries.withColumn("client_id", cid)), work_dir(v.spark), "minutes")
    serving = candidates.serving_restaurants(v.restaurants, v.branches, v.branch_area)
    pairs = lateness.latest_of_candidates(candidates.candidate_clients(v.companies), serving.select("restaurant_id", "area_id"), rows, "1996_44", finished("latest_lateness"))
    return marked(pairs, contract_of("latest_lateness"))


# ---- candidates, scoring, hybrid ----

check_step("score_pairs", """
    SELECT DISTINCT c.client_id, c.area_id, b.restaurant_id, r.type, r.category FROM candidate_clients AS c JOIN branch_area AS a ON c.area_id = a.area_id
    JOIN branches AS b ON a.branch_id = b.branch_id JOIN valid_restaurants AS r ON b.restaurant_id = r.restaurant_id WHERE b.status IN (1, 2)""")
check_step("last_client", "SELECT * FROM client_panel WHERE week_no = (SELECT max(week_no) FROM visit_weeks)")
check_step("last_restaurant", "SELECT * FROM restaurant_panel WHERE week_no = (SELECT max(week_no) FROM visit_weeks)")
check_step("last_pair", "SELECT * FROM pair_panel WHERE week_no = (SELECT max(week_no) FROM visit_weeks)")
SCORED = ["c_orders_mean", "c_exp_orders_kurtosis", "r_orders_median", "r_exp_rating_mean", "p_orders_max", "p_exp_orders_mean"]
check_step("score_rows", f"""
    SELECT CAST(d AS DATE) AS schedule_on, s.client_id, s.restaurant_id, s.area_id, s.type, s.category,
           {", ".join(f"coalesce({c.replace('_', '.', 1)}, {-3 if 'kurtosis' in c else 0}) AS {c}" for c in SCORED)},
           coalesce(c.is_first_time_client, TRUE) AS c_is_first_time_client,
           CASE WHEN r.restaurant_id IS NULL THEN TRUE ELSE FALSE END AS r_is_first_time_restaurant, coalesce(p.is_first_time_pair, TRUE) AS p_is_first_time_pair,
           CASE WHEN p.client_id IS NULL THEN 1 ELSE coalesce(p.pair_rank, 2) END AS p_pair_rank, coalesce(u.unique_users, 0) AS unique_users,
           coalesce(o.previous_orders, 0) AS previous_orders, isodow(d) - 1 AS day_of_week, -1 AS orders
    FROM score_pairs AS s LEFT JOIN last_client AS c ON s.client_id = c.client_id LEFT JOIN last_restaurant AS r ON s.restaurant_id = r.restaurant_id
    LEFT JOIN last_pair AS p ON s.client_id = p.client_id AND s.restaurant_id = p.restaurant_id
    LEFT JOIN (SELECT * FROM visit_usage WHERE week_no = (SELECT max(week_no) FROM visit_usage)) AS u ON s.client_id = u.client_id
    LEFT JOIN (SELECT client_id, restaurant_id, arg_max(orders, (schedule_on, event_id)) AS previous_orders FROM visits WHERE schedule_on < DATE '2024-01-28' GROUP BY 1, 2) AS o
      ON s.client_id = o.client_id AND s.restaurant_id = o.restaurant_id
    CROSS JOIN generate_series(DATE '2024-01-28', DATE '2024-02-01', INTERVAL 1 DAY) AS days(d)""")


def score_rows(v, clients=None, place=lambda serving: serving, **options):
    """Rows to score; ``clients`` may be some clients with columns to keep, ``place`` adds columns to the serving restaurants."""
    weeks = staged_weeks(v)
    serving = place(candidates.serving_restaurants(v.restaurants, v.branches, v.branch_area))
    clients = candidates.candidate_clients(v.companies) if clients is None else clients
    return candidates.scoring_rows(clients, serving, weeks, visit_usage(weeks), PREDICTION_START, PREDICTION_END, **options)


@query("scoring_candidates", "schedule_on d, client_id s, restaurant_id i, area_id i, type i, category i, " + ", ".join(f"{c} f" for c in SCORED) +
       ", c_is_first_time_client b, r_is_first_time_restaurant b, p_is_first_time_pair b, p_pair_rank i, unique_users i, previous_orders f, day_of_week i, orders i",
       "SELECT * FROM score_rows")
def scoring_candidates(v):
    return marked(score_rows(v, finish=finished("scoring_candidates")), contract_of("scoring_candidates"))


SPEC = model.FeatureSpec(
    numeric=["previous_orders", "c_rating_mean", "c_exp_orders_mean", "r_orders_mean", "r_exp_orders_mean", "p_orders_max", "p_exp_orders_mean",
             "p_pair_rank", "unique_users", "total_orders"],
    categorical=["c_is_first_time_client", "p_is_first_time_pair", "category", "day_of_week", "type", "client_type"])
KNOWN = ["category", "type"]
TREES = 150
PREDICTION_START, PREDICTION_END = date(2024, 1, 28), date(2024, 2, 1)


def with_client_type(df):
    return df.withColumn("client_type", S.client_type(F.col("client_id")))


def feature_table(v, folder):
    """The feature table as a stage of its own: fitting reads its input once per stage of the pipeline."""
    return stage(with_client_type(clean_rows(v)), folder, "features")


@query("train_score", "event_id i, schedule_on d, client_id s, restaurant_id i, predictions f, orders i")
def train_score(v):
    folder = work_dir(v.spark)
    train, valid = history.time_split(feature_table(v, folder), "schedule_on", PREDICTION_START)
    known, _ = model.split_unseen(valid, train, KNOWN)
    return model.score(model.fit(train, SPEC, folder, "split_model", trees=TREES), known, SPEC, ["event_id", "schedule_on", "client_id", "restaurant_id"])


check_step("fit_rows", """
    SELECT *, schedule_on <= DATE '2024-01-20' AS is_train, schedule_on BETWEEN DATE '2024-01-21' AND DATE '2024-01-27' AS is_valid FROM clean_rows""")
check_step("valid_rows_tagged", """
    SELECT *, CASE WHEN category NOT IN (SELECT category FROM fit_rows WHERE is_train) THEN 'unseen category'
                   WHEN type NOT IN (SELECT type FROM fit_rows WHERE is_train) THEN 'unseen type' END AS reason FROM fit_rows WHERE is_valid""")
MEASURES = ["mean_abs_error", "mse", "rmse", "r2", "y", "y_hat", "overall_acc", "diff_orders", "diff_adj1_orders", "diff_records", "diff_adj1_records",
            "acc", "acc_adj1", "acc_orders", "acc_adj1_orders", "actual_r2", "macro_f1"]


def recomputed(predictions):
    """The report of staged predictions once more, as plain SQL that shares no code with it.

    A dataset holds a large part of all rows, so its mean and its F1 are aggregates, of one row per dataset, that are sent to the rows.
    """
    return predictions.sparkSession.sql("""
        WITH m AS (SELECT /*+ BROADCAST(a) */ p.dataset, y, predictions, CASE WHEN predictions <= 0 THEN 0 ELSE bround(predictions) END AS r, mean
                   FROM {p} AS p LEFT JOIN (SELECT dataset, avg(y) AS mean FROM {p} GROUP BY dataset) AS a ON p.dataset = a.dataset),
        d AS (SELECT *, abs(y - r) AS d FROM m),
        f AS (SELECT dataset, avg(2 * hit / (truths + guesses)) AS macro_f1 FROM (
                SELECT dataset, class, sum(hit) AS hit, sum(truth) AS truths, sum(guess) AS guesses FROM (
                  SELECT dataset, CAST(y AS BIGINT) AS class, int(CAST(y AS BIGINT) = r) AS hit, 1 AS truth, 0 AS guess FROM m UNION ALL SELECT dataset, CAST(r AS BIGINT), 0, 0, 1 FROM m) GROUP BY dataset, class) GROUP BY dataset)
        SELECT /*+ BROADCAST(f) */ d.dataset, count(*) AS records, avg(d) AS mean_abs_error, avg(d * d) AS mse, sqrt(avg(d * d)) AS rmse, 1 - sum(d * d) / sum((y - mean) * (y - mean)) AS r2,
               sum(y) AS y, sum(predictions) AS y_hat, least(sum(y), sum(predictions)) / greatest(sum(y), sum(predictions)) AS overall_acc, sum(d) AS diff_orders,
               sum(if(d > 1, d, 0)) AS diff_adj1_orders, count_if(d > 0) AS diff_records, count_if(d > 1) AS diff_adj1_records,
               1 - count_if(d > 0) / count(*) AS acc, 1 - count_if(d > 1) / count(*) AS acc_adj1, (sum(y) - sum(d)) / sum(y) AS acc_orders,
               (sum(y) - sum(if(d > 1, d, 0))) / sum(y) AS acc_adj1_orders, 1 - sum((y - predictions) * (y - predictions)) / sum((y - mean) * (y - mean)) AS actual_r2, any_value(macro_f1) AS macro_f1
        FROM d JOIN f ON d.dataset = f.dataset GROUP BY d.dataset""", p=predictions)


@query("model_report", "dataset s, records i, y f, fits b, agrees b", """
    SELECT 'train' AS dataset, count(*) AS records, sum(orders) AS y, TRUE AS fits, TRUE AS agrees FROM fit_rows WHERE is_train
    UNION ALL SELECT 'validation', count(*), sum(orders), TRUE, TRUE FROM valid_rows_tagged WHERE reason IS NULL
    UNION ALL SELECT 'complete', count(*), sum(orders), TRUE, TRUE FROM fit_rows""")
def model_report(v):
    """Fit reports of the trained model; ``fits``: better than the mean (on validation rows only a share), ``agrees``: equal to what plain SQL gives."""
    folder = work_dir(v.spark)
    predictions, report, _ = model.fit_reports(feature_table(v, folder), SPEC, "schedule_on", PREDICTION_START, KNOWN, folder, ["event_id"], trees=TREES)
    again = recomputed(predictions)
    near = lambda c: F.abs(report[c] - again[c]) <= 1e-6 * F.greatest(F.lit(1.0), F.abs(again[c]))
    agrees = near("records")
    for c in MEASURES:
        agrees = agrees & near(c)
    fits = F.when(report["dataset"] == "validation", report["acc_adj1"].between(0, 1)).otherwise(report["actual_r2"] > 0)
    return report.join(again, report["dataset"] == again["dataset"]).select(report["dataset"], report["records"], report["y"], fits.alias("fits"), agrees.alias("agrees"))


@query("model_rejects", "dataset s, reason s, n i", """
    SELECT 'validation' AS dataset, reason, count(*) AS n FROM valid_rows_tagged WHERE reason IS NOT NULL GROUP BY reason
    UNION ALL SELECT 'candidates', reason, count(*) FROM model_candidates WHERE reason IS NOT NULL GROUP BY reason
    UNION ALL SELECT 'kept candidates', NULL, count(*) FROM model_candidates WHERE reason IS NULL""")
def model_rejects(v):
    """Rows that the model cannot score, by reason, and how many candidates it can."""
    rows = feature_table(v, work_dir(v.spark))
    train, valid = history.time_split(rows, "schedule_on", PREDICTION_START)
    counts = lambda df: df.groupBy("reason").agg(F.count("*").alias("n"))
    # What a candidate is rejected for are values of its restaurant.
    candidate_counts = stage(score_rows(v, place=lambda serving: model.tag_unseen(serving, rows, KNOWN), counted=["reason"]), work_dir(v.spark), "counts")
    kept = candidate_counts.agg(F.coalesce(F.sum(F.when(F.col("reason").isNull(), F.col("n"))), F.lit(0)).alias("n")).withColumn("reason", F.lit(None).cast("string"))
    named = lambda df, name: df.withColumn("dataset", F.lit(name))
    return (named(counts(model.split_unseen(valid, train, KNOWN)[1]), "validation").unionByName(named(candidate_counts.where(F.col("reason").isNotNull()), "candidates"))
            .unionByName(named(kept, "kept candidates")))


check_step("model_candidates", """
    SELECT *, CASE WHEN category NOT IN (SELECT category FROM clean_rows) THEN 'unseen category'
                   WHEN type NOT IN (SELECT type FROM clean_rows) THEN 'unseen type' END AS reason FROM score_rows""")
check_step("model_branches", """
    SELECT s.schedule_on + 7 AS schedule_on, s.client_id, s.restaurant_id, b.branch_id FROM model_candidates AS s JOIN branch_area AS a ON s.area_id = a.area_id
    JOIN branches AS b ON a.branch_id = b.branch_id AND b.restaurant_id = s.restaurant_id WHERE b.status IN (1, 2) AND reason IS NULL""")


def model_scores(v, folder, clients, keep):
    """Scores of the model of all feature rows for the candidates it knows, of ``clients`` and with the ``keep`` columns of them."""
    rows = feature_table(v, folder)
    fitted = model.fit(rows, SPEC, folder, "complete_model", trees=TREES)
    place = lambda serving: model.branch_lists(model.split_unseen(serving, rows, KNOWN)[0], v.branches, v.branch_area)
    known = with_client_type(score_rows(v, clients, place))
    return model.score(fitted, known, SPEC, ["schedule_on", "client_id", "restaurant_id", "area_id", "branch_ids", *keep])


@query("model_hybrid", "company_id i, group_id i, schedule_on d, branch_id i, restaurant_id i, model s, ratio_orders i, is_count b", """
    SELECT company_id, group_id, schedule_on, branch_id, restaurant_id, model, ots AS ratio_orders, ots >= 0 AS is_count FROM ratio_rows WHERE model = 'ratio'
    UNION ALL
    SELECT r.company_id, g.group_id, schedule_on, branch_id, restaurant_id, model, NULL, TRUE FROM model_branches AS s
    JOIN routes AS r ON s.client_id = r.company_id || '_C' LEFT JOIN (SELECT DISTINCT company_id, group_id FROM ratio_pairs) AS g ON r.company_id = g.company_id
    WHERE model = 'model'""")
def model_hybrid(v):
    """The blend with the trained model; orders of model rows are trees' output and only checked for being counts."""
    folder, serving, facts, routes = routed(v)
    clients, keep = entities.active_clients(v.companies, v.client_groups), ["company_id", "group_id", "model"]
    scores = model_scores(v, folder, model.routed_clients(candidates.candidate_clients(v.companies), routes, clients), keep)
    by_model = placed_day(model.attach_branches(scores, v.branches, v.branch_area, shift_days=7, keep=keep))
    by_ratio = with_day_text(ratio_rows(v, folder, serving, facts, routes), PERIOD.start, PERIOD.end)
    blend = marked(model.hybrid(by_ratio, by_model, routes, clients), [("schedule_on", "d")])
    return blend.withColumns({"ratio_orders": F.when(F.col("model") == "ratio", F.col("orders")), "is_count": F.col("orders") >= 0})


# A fixed linear predictor over client, restaurant and pair features. It needs no training, so its blend is checked to the last number.
LINEAR = "0.05 * c_orders_mean + 0.02 * r_orders_median + 0.1 * p_orders_max - 0.5 * p_pair_rank + 0.25 * day_of_week - 1"
check_step("branch_scores", f"""
    SELECT s.schedule_on + 7 AS schedule_on, s.client_id, s.restaurant_id, b.branch_id, CASE WHEN p <= 0 THEN 0 ELSE round_even(p, 0) END AS orders
    FROM (SELECT *, CAST({LINEAR} AS DOUBLE) AS p FROM score_rows) AS s JOIN branch_area AS a ON s.area_id = a.area_id
    JOIN branches AS b ON a.branch_id = b.branch_id AND b.restaurant_id = s.restaurant_id WHERE b.status IN (1, 2)""")


def branch_scores(v, clients=None, keep=()):
    place = lambda serving: model.branch_lists(serving, v.branches, v.branch_area)
    scored = score_rows(v, clients, place).withColumn("orders", S.as_count(F.expr(LINEAR))).select("schedule_on", "client_id", "restaurant_id", "area_id", "branch_ids", "orders", *keep)
    return model.attach_branches(scored, v.branches, v.branch_area, shift_days=7, keep=keep)


def placed_day(rows):
    """Days of branch scores as text: predictions are moved a week ahead."""
    return with_day_text(rows, PREDICTION_START + timedelta(7), PREDICTION_END + timedelta(7))


@query("score_attach_branch", "schedule_on d, client_id s, restaurant_id i, branch_id i, orders i", "SELECT * FROM branch_scores")
def score_attach_branch(v):
    return placed_day(branch_scores(v))


@query("hybrid_predictions", "company_id i, group_id i, schedule_on d, branch_id i, restaurant_id i, orders i, model s", """
    SELECT company_id, group_id, schedule_on, branch_id, restaurant_id, ots AS orders, model FROM ratio_rows WHERE model = 'ratio'
    UNION ALL
    SELECT r.company_id, g.group_id, schedule_on, branch_id, restaurant_id, orders, model FROM branch_scores AS s
    JOIN routes AS r ON s.client_id = r.company_id || '_C' LEFT JOIN (SELECT DISTINCT company_id, group_id FROM ratio_pairs) AS g ON r.company_id = g.company_id
    WHERE model = 'model'""")
def hybrid_predictions(v):
    folder, serving, facts, routes = routed(v)
    clients = entities.active_clients(v.companies, v.client_groups)
    # Each half has more rows than any table and is read once: none is written.
    by_ratio = with_day_text(ratio_rows(v, folder, serving, facts, routes), PERIOD.start, PERIOD.end)
    candidates_routed = model.routed_clients(candidates.candidate_clients(v.companies), routes, clients)
    by_model = placed_day(branch_scores(v, candidates_routed, ["company_id", "group_id", "model"]))
    return marked(model.hybrid(by_ratio, by_model, routes, clients), [("schedule_on", "d")])


# ---- scheduling input ----

check_step("pool_predictions", "SELECT DATE '1998-12-20' AS p_date, group_id, branch_id, restaurant_id, sum(orders) AS orders FROM schedule_pool GROUP BY 1, 2, 3, 4")
SCHED_TYPES = tuple(sorted(entities.TYPE_NAMES.values()))
SCHED_CATEGORIES = (*sorted(entities.CATEGORY_NAMES.values()), 2, 14, 18, 23)
check_step("group_days", """
    SELECT group_id, branch_id, count(*) AS c2r_count, max(schedule_on) AS last_schedule_on FROM (
      SELECT DISTINCT group_id, branch_id, schedule_on FROM menu_schedules AS m JOIN companies AS c ON m.company_id = c.company_id
      WHERE group_id IS NOT NULL AND m.deleted_at IS NULL AND schedule_on BETWEEN DATE '1998-09-19' AND DATE '1998-12-19') AS t GROUP BY 1, 2""")
check_step("pool_input", f"""
    SELECT *, max(orders) OVER (PARTITION BY p_date, group_id) AS group_day_max, max(orders) OVER (PARTITION BY p_date, branch_id) AS branch_day_max FROM (
      SELECT p.p_date, p.group_id, p.branch_id, p.restaurant_id, p.orders, g.area_id, a.blackout_period, b.delivery_capacity, h.c2r_count,
             DATE '1998-12-20' - coalesce(h.last_schedule_on, DATE '1998-12-20' - 90) AS days_diff,
             CASE WHEN DATE '1998-12-20' - coalesce(h.last_schedule_on, DATE '1998-12-20' - 90) >= a.blackout_period THEN 1 ELSE 0 END AS is_not_blackout,
             r.type2 AS type, r.category, CASE WHEN per_day_restaurants > 5 THEN 5 WHEN per_day_restaurants < 3 THEN 3 ELSE per_day_restaurants END AS per_day_restaurants,
             isodow(p.p_date) - 1 AS day, year(p.p_date) * 100 + week(p.p_date) AS y_week_no, p.group_id || '_' || p.restaurant_id AS pair
      FROM pool_predictions AS p JOIN (SELECT DISTINCT restaurant_id FROM menus WHERE category_id = 2 AND status = 1 AND publish_status = 1) AS m ON p.restaurant_id = m.restaurant_id
      LEFT JOIN client_groups AS g ON p.group_id = g.group_id LEFT JOIN areas AS a ON g.area_id = a.area_id
      JOIN branches AS b ON p.branch_id = b.branch_id LEFT JOIN group_days AS h ON p.group_id = h.group_id AND p.branch_id = h.branch_id
      JOIN restaurants AS r ON p.restaurant_id = r.restaurant_id
      WHERE b.status IN (1, 2) AND home_delivery_category_status <> 3 AND lower(branch_name) NOT LIKE '%test%'
        AND b.branch_id IN (SELECT branch_id FROM branch_area WHERE is_deliverable = 1)
        AND r.status IN (1, 2) AND category_status IN (1, 3) AND lower(restaurant_name) NOT LIKE '%test%'
        AND r.type2 IN {SCHED_TYPES} AND r.category IN {SCHED_CATEGORIES}) AS t""")


def pool_predictions(v):
    return (v.schedule_pool.groupBy("group_id", "branch_id", "restaurant_id").agg(F.sum("orders").alias("orders")).withColumn("p_date", F.lit(ANCHOR)))


def pool_input(v):
    return scheduling.schedule_input(pool_predictions(v), v.client_groups, v.areas, v.branches, v.branch_area, v.menus, v.restaurants,
                                     v.menu_schedules, v.companies, ANCHOR, SCHED_TYPES, SCHED_CATEGORIES, work_dir(v.spark), "type2")


@query("schedule_input", "p_date d, group_id i, branch_id i, restaurant_id i, orders i, area_id i, blackout_period i, delivery_capacity i, c2r_count i, days_diff i, "
       "is_not_blackout i, type i, category i, per_day_restaurants i, day i, y_week_no i, pair s, group_day_max i, branch_day_max i", "SELECT * FROM pool_input")
def schedule_input(v):
    return pool_input(v)


@query("blackout_flag", "company_id i, branch_id i, days_diff i, is_not_blackout i", """
    SELECT company_id, l.branch_id, DATE '1998-12-20' - coalesce(last_schedule_on, DATE '1998-12-20' - 90) AS days_diff,
           CASE WHEN DATE '1998-12-20' - coalesce(last_schedule_on, DATE '1998-12-20' - 90) >= blackout_period THEN 1 ELSE 0 END AS is_not_blackout
    FROM last_schedules AS l JOIN branches AS b ON l.branch_id = b.branch_id""")
def blackout_flag(v):
    from schedlytics.queries.time import days_since_last
    return scheduling.blackout_flag(days_since_last(v).join(v.branches.select("branch_id", "blackout_period"), "branch_id"))


@query("schedule_weight", "p_date d, group_id i, branch_id i, c2r_count i, days_diff i, novelty i, weight i", """
    SELECT p_date, group_id, branch_id, coalesce(c2r_count, 0) AS c2r_count, days_diff,
           CASE WHEN c2r_count IS NULL OR c2r_count = 0 THEN 1 WHEN c2r_count = 1 AND days_diff >= 45 THEN 2 ELSE 0 END AS novelty,
           CASE WHEN c2r_count IS NULL OR c2r_count = 0 THEN 200 WHEN c2r_count = 1 AND days_diff < 14 THEN 100 WHEN c2r_count = 1 AND days_diff >= 45 THEN 50 ELSE 0 END AS weight
    FROM pool_input""")
def schedule_weight(v):
    return scheduling.schedule_weight(pool_input(v))


check_step("relevance_rows", """
    SELECT o.schedule_on, o.company_id || '_C' AS client_id, group_id, restaurant_id, branch_id, CASE WHEN o.status = 5 THEN quantity ELSE 0 END AS delivered,
           (year(o.schedule_on) - CASE WHEN week(o.schedule_on) >= 51 AND month(o.schedule_on) = 1 THEN 1 ELSE 0 END) * 100 + week(o.schedule_on) AS y_week_no
    FROM order_rows AS o JOIN companies AS c ON o.company_id = c.company_id WHERE group_id IS NOT NULL""")
check_step("relevance_shares", """
    SELECT group_id, restaurant_id, avg(delivered / CAST(nullif(total, 0) AS DOUBLE)) AS share FROM (
      SELECT *, sum(delivered) OVER (PARTITION BY schedule_on, group_id) AS total FROM (
        SELECT schedule_on, group_id, restaurant_id, branch_id, sum(delivered) AS delivered FROM relevance_rows WHERE y_week_no BETWEEN 199846 AND 199851
          AND client_id IN (SELECT client_id FROM relevance_rows WHERE y_week_no BETWEEN 199846 AND 199851 GROUP BY 1 HAVING sum(delivered) > 5)
        GROUP BY 1, 2, 3, 4) AS d) AS t GROUP BY 1, 2""")
check_step("relevance", """
    SELECT group_id, restaurant_id, per_day_restaurants, share, rank, greatest((per_day_restaurants * (rank - 1) + m - 2) // greatest(m - 1, 1), 1) AS bin FROM (
      SELECT *, row_number() OVER (PARTITION BY group_id ORDER BY share, restaurant_id) AS rank, count(*) OVER (PARTITION BY group_id) AS m FROM (
        SELECT p.group_id, p.restaurant_id, per_day_restaurants, round(coalesce(share, 1 / CAST(per_day_restaurants AS DOUBLE)), 9) AS share
        FROM (SELECT DISTINCT group_id, restaurant_id, per_day_restaurants FROM pool_input) AS p
        LEFT JOIN relevance_shares AS s ON p.group_id = s.group_id AND p.restaurant_id = s.restaurant_id) AS d) AS r""")


def relevance(v, staged=None):
    y_week = cal.year_week(F.col("schedule_on"))
    rows = (v.order_rows.join(v.companies.where(F.col("group_id").isNotNull()).select("company_id", "group_id"), "company_id")
            .select("schedule_on", S.client_id(F.col("company_id")).alias("client_id"), "group_id", "restaurant_id", "branch_id",
                    F.when(F.col("status") == 5, F.col("quantity")).otherwise(0).alias("delivered"), y_week.alias("y_week_no")))
    shares = scheduling.relevance_share(rows, 199846, 199851)
    # Equal shares can differ in their last bits; the rank compares them at 9 digits.
    pairs = scheduling.default_share(staged if staged is not None else pool_input(v), shares).withColumn("share", F.round("share", 9))
    return scheduling.quantile_bins(pairs, "group_id", "share", "restaurant_id", "per_day_restaurants")


@query("relevance_share", "group_id i, restaurant_id i, per_day_restaurants i, share f, rank i, bin i", "SELECT * FROM relevance")
def relevance_share(v):
    return relevance(v)


@query("capacity_assign", "p_date d, branch_id i, group_id i, orders i, weight i, slot i", """
    SELECT p_date, branch_id, group_id, orders, weight, CASE WHEN delivery_capacity IS NOT NULL THEN slot END AS slot FROM (
      SELECT *, row_number() OVER (PARTITION BY p_date, branch_id ORDER BY weight DESC, orders DESC, bin DESC, rank DESC, group_id) AS slot FROM (
        SELECT i.p_date, i.branch_id, i.group_id, i.orders, r.bin, r.rank, delivery_capacity,
               CASE WHEN c2r_count IS NULL OR c2r_count = 0 THEN 200 WHEN c2r_count = 1 AND days_diff < 14 THEN 100 WHEN c2r_count = 1 AND days_diff >= 45 THEN 50 ELSE 0 END AS weight
        FROM pool_input AS i JOIN relevance AS r ON i.group_id = r.group_id AND i.restaurant_id = r.restaurant_id) AS w) AS t
    WHERE delivery_capacity IS NULL OR slot <= delivery_capacity""")
def capacity_assign(v):
    staged = stage(pool_input(v), work_dir(v.spark), "pool_input")
    ranked = scheduling.schedule_weight(staged).join(relevance(v, staged).select("group_id", "restaurant_id", "bin", "rank"), ["group_id", "restaurant_id"])
    largest = v.branches.agg(F.max("delivery_capacity")).first()[0]
    return scheduling.assign_capacity(ranked, [*scheduling.priority_order(), F.asc("group_id")], largest)


@query("top_restaurants", "group_id i, restaurant_id i, score f, place i", """
    SELECT group_id, restaurant_id, score, place FROM (
      SELECT *, row_number() OVER (PARTITION BY group_id ORDER BY score DESC, restaurant_id) AS place FROM weighted_scores) AS t WHERE place <= 5""")
def top_restaurants(v):
    return scheduling.top_restaurants(weighted_scores(v))


# ---- clusters and publishing ----

check_step("clustered", """
    SELECT c.company_id, c.area_id, group_id || '_' || CASE WHEN s.area_id IS NULL THEN 0 ELSE coalesce(own.cluster_id, near.cluster_id, 0) END AS group_id
    FROM relabelled AS c LEFT JOIN (SELECT DISTINCT area_id FROM cluster_samples) AS s ON c.area_id = s.area_id
    LEFT JOIN cluster_samples AS own ON c.company_id = own.company_id
    LEFT JOIN (SELECT a.company_id, arg_min(b.cluster_id, (pow(a.latitude - b.latitude, 2) + pow(a.longitude - b.longitude, 2), b.company_id)) AS cluster_id
               FROM relabelled AS a JOIN cluster_samples AS b ON a.area_id = b.area_id GROUP BY 1) AS near ON c.company_id = near.company_id
    WHERE status = 1 AND is_active_virtual = 0""")


@query("cluster_groups", "company_id i, area_id i, group_id s", "SELECT * FROM clustered")
def cluster_groups(v):
    return clusters.cluster_groups(v.companies, v.cluster_samples)


@query("publish_rows", "schedule_on d, branch_id i, company_id i, menu_id i, ots i", """
    SELECT p.schedule_on, p.branch_id, c.company_id, m.menu_id, o.orders AS ots
    FROM (SELECT DISTINCT schedule_on, group_id, branch_id, restaurant_id FROM schedule_pool WHERE schedule_status = 0) AS p
    LEFT JOIN (SELECT company_id, group_id FROM companies WHERE status = 1 AND is_active_virtual = 0 AND lower(company_name) NOT LIKE '%test%') AS c ON p.group_id = c.group_id
    LEFT JOIN (SELECT restaurant_id, max(menu_id) AS menu_id FROM menus WHERE category_id = 2 AND status = 1 AND publish_status = 1 GROUP BY 1) AS m
      ON p.restaurant_id = m.restaurant_id
    LEFT JOIN (SELECT branch_id, restaurant_id, schedule_on, arg_min(quantity, (company_id, order_id, quantity)) AS orders FROM order_rows GROUP BY 1, 2, 3) AS o
      ON p.branch_id = o.branch_id AND p.restaurant_id = o.restaurant_id AND p.schedule_on = o.schedule_on""")
def publish_rows(v):
    schedule = v.schedule_pool.where("schedule_status = 0").select("schedule_on", "group_id", "branch_id", "restaurant_id").distinct()
    predictions = v.order_rows.select("branch_id", "restaurant_id", "schedule_on", "company_id", "order_id", F.col("quantity").alias("orders"))
    rows = publishing.publish_rows(schedule, v.companies, v.menus, predictions, ["company_id", "order_id", "orders"], finish=finished("publish_rows"))
    return marked(rows, contract_of("publish_rows"))


check_step("current_menus", "SELECT restaurant_id, max(menu_id) AS menu_id FROM menus WHERE category_id = 2 AND status = 1 AND publish_status = 1 GROUP BY 1")
check_step("first_predictions", """
    SELECT branch_id, restaurant_id, schedule_on, arg_min(quantity, (company_id, order_id, quantity)) AS orders FROM order_rows GROUP BY 1, 2, 3""")
# Schedules of building clients, and of drop-off points that several companies share, from the days that have orders.
check_step("client_schedules", """
    SELECT DISTINCT schedule_on, CASE WHEN building_id IS NULL THEN company_id % 50 || '_CD' ELSE building_id || '_B' END AS client_code, branch_id, restaurant_id
    FROM order_rows WHERE schedule_on BETWEEN DATE '1998-11-01' AND DATE '1998-12-19'""")


def client_orders(v):
    return v.order_rows.where(F.col("schedule_on").between(F.lit(date(1998, 11, 1)), F.lit(date(1998, 12, 19))))


def client_schedules(v):
    code = F.when(F.col("building_id").isNull(), F.concat(F.pmod("company_id", F.lit(50)).cast("string"), F.lit("_CD"))).otherwise(F.concat(F.col("building_id").cast("string"), F.lit("_B")))
    return client_orders(v).select("schedule_on", code.alias("client_code"), "branch_id", "restaurant_id").distinct()


def first_orders(v):
    """Orders of the days that are scheduled: the first of a day is looked for among those of the day."""
    return client_orders(v).select("branch_id", "restaurant_id", "schedule_on", "company_id", "order_id", F.col("quantity").alias("orders"))


@query("publish_buildings", "schedule_on d, branch_id i, building_id i, menu_id i, ots i", """
    SELECT s.schedule_on, s.branch_id, CAST(split_part(client_code, '_', 1) AS BIGINT) AS building_id, menu_id, orders AS ots
    FROM client_schedules AS s LEFT JOIN current_menus AS m ON s.restaurant_id = m.restaurant_id
    LEFT JOIN first_predictions AS o ON s.branch_id = o.branch_id AND s.restaurant_id = o.restaurant_id AND s.schedule_on = o.schedule_on WHERE client_code LIKE '%\\_B' ESCAPE '\\'""")
def publish_buildings(v):
    return publishing.building_rows(client_schedules(v).withColumnRenamed("client_code", "client_id"), v.menus, first_orders(v), ["company_id", "order_id", "orders"])


@query("publish_drop_offs", "schedule_on d, branch_id i, company_id i, menu_id i, ots i", """
    SELECT s.schedule_on, s.branch_id, company_id, menu_id, orders AS ots
    FROM client_schedules AS s LEFT JOIN current_menus AS m ON s.restaurant_id = m.restaurant_id
    LEFT JOIN first_predictions AS o ON s.branch_id = o.branch_id AND s.restaurant_id = o.restaurant_id AND s.schedule_on = o.schedule_on
    LEFT JOIN (SELECT company_id, drop_off_point_id FROM companies WHERE status = 1 AND is_active_virtual = 0) AS c ON c.drop_off_point_id = CAST(split_part(client_code, '_', 1) AS BIGINT)
    WHERE client_code LIKE '%CD'""")
def publish_drop_offs(v):
    schedule = publishing.drop_off_points(client_schedules(v))
    rows = publishing.publish_rows(schedule, v.companies, v.menus, first_orders(v), ["company_id", "order_id", "orders"], "drop_off_point_id", drop_tests=False, finish=finished("publish_drop_offs"))
    return marked(rows, contract_of("publish_drop_offs"))


@query("cluster_predictions", "group_id s, area_id i, schedule_on d, branch_id i, restaurant_id i, orders i", """
    SELECT c.group_id, c.area_id, schedule_on, branch_id, restaurant_id, sum(ots) AS orders FROM clustered AS c JOIN ratio_rows AS r ON c.company_id = r.company_id GROUP BY 1, 2, 3, 4, 5""")
def cluster_predictions(v):
    """Companies take their cluster group and are summed in it before they meet the branches, and the days, all alike, come after the sums."""
    groups = clusters.cluster_groups(v.companies, v.cluster_samples)
    by_ratio = ratio_rows(v, *routed(v), members=clusters.member_labels(groups), days=False, summed=True).withColumnRenamed("ots", "orders")
    return cal.date_spine(clusters.cluster_predictions(groups, by_ratio), PERIOD.start, PERIOD.end)
