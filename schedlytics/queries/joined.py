"""Join queries."""

from datetime import date

from pyspark.sql import functions as F

from schedlytics.contract import shaped
from schedlytics.functions import calendar as cal
from schedlytics.operators import joins
from schedlytics.operators.dedupe import keep_one
from schedlytics.plans import clusters, entities
from schedlytics.registry import check_step, contract_of, query

START, END = date(1998, 12, 20), date(1998, 12, 24)

check_step("active_clients", """
    SELECT company_id, c.group_id, c.area_id FROM companies AS c JOIN client_groups AS g ON c.group_id = g.group_id
    WHERE c.status = 1 AND is_active_virtual = 0 AND g.status = 1 AND lower(company_name) NOT LIKE '%test%'""")
check_step("active_branches", "SELECT branch_id, restaurant_id FROM branches WHERE status IN (1, 2) AND lower(branch_name) NOT LIKE '%test%'")
check_step("active_restaurants", """
    SELECT restaurant_id, type, category FROM restaurants
    WHERE status IN (1, 2) AND category_status IN (1, 3) AND lower(restaurant_name) NOT LIKE '%test%' AND type IS NOT NULL AND category IS NOT NULL""")


@query("join_inner", "branch_id i, restaurant_id i, type i, category i", """
    SELECT branch_id, b.restaurant_id, type, category FROM active_branches AS b JOIN active_restaurants AS r ON b.restaurant_id = r.restaurant_id""")
def join_inner(v):
    return entities.active_branches(v.branches).join(entities.active_restaurants(v.restaurants), "restaurant_id")


@query("join_left", "group_status i, companies i", """
    SELECT g.status AS group_status, count(*) AS companies FROM companies AS c LEFT JOIN client_groups AS g ON c.group_id = g.group_id GROUP BY 1""")
def join_left(v):
    groups = v.client_groups.select("group_id", F.col("status").alias("group_status"))
    return v.companies.join(groups, "group_id", "left").groupBy("group_status").agg(F.count("*").alias("companies"))


@query("join_right", "company_id i, schedule_on d, branch_id i, quantity i", """
    SELECT s.company_id, s.schedule_on, s.branch_id, coalesce(o.quantity, 0) AS quantity
    FROM (SELECT company_id, schedule_on, branch_id, sum(quantity) AS quantity FROM order_rows GROUP BY 1, 2, 3) AS o
    RIGHT JOIN (SELECT DISTINCT company_id, schedule_on, branch_id FROM menu_schedules WHERE deleted_at IS NULL) AS s
    ON o.company_id = s.company_id AND o.schedule_on = s.schedule_on AND o.branch_id = s.branch_id""")
def join_right(v):
    keys = ["company_id", "schedule_on", "branch_id"]
    planned = v.menu_schedules.where(F.col("deleted_at").isNull()).select(*keys).distinct()
    ordered = v.order_rows.groupBy(*keys).agg(F.sum("quantity").alias("quantity"))
    return ordered.join(planned, keys, "right").withColumn("quantity", F.coalesce("quantity", F.lit(0)))


@query("join_full", "company_id i, menu_id i, delivered i, dropped i", """
    SELECT coalesce(a.company_id, b.company_id) AS company_id, coalesce(a.menu_id, b.menu_id) AS menu_id, delivered, dropped
    FROM (SELECT company_id, menu_id, sum(quantity) AS delivered FROM order_rows WHERE status = 5 GROUP BY 1, 2) AS a
    FULL JOIN (SELECT company_id, menu_id, count(*) AS dropped FROM menu_schedules WHERE deleted_at IS NOT NULL GROUP BY 1, 2) AS b
    ON a.company_id = b.company_id AND a.menu_id = b.menu_id""")
def join_full(v):
    keys = ["company_id", "menu_id"]
    a = v.order_rows.where("status = 5").groupBy(*keys).agg(F.sum("quantity").alias("delivered"))
    b = v.menu_schedules.where(F.col("deleted_at").isNotNull()).groupBy(*keys).agg(F.count("*").alias("dropped"))
    return a.join(b, keys, "full")


@query("join_natural", "company_id i, branch_id i, schedule_on d, menu_id i, quantity i", """
    SELECT company_id, branch_id, schedule_on, menu_id, quantity
    FROM (SELECT DISTINCT company_id, branch_id, schedule_on, menu_id FROM menu_schedules WHERE deleted_at IS NOT NULL) AS a
    NATURAL JOIN (SELECT company_id, branch_id, schedule_on, menu_id, quantity FROM order_rows) AS b""")
def join_natural(v):
    a = v.menu_schedules.where(F.col("deleted_at").isNotNull()).select("company_id", "branch_id", "schedule_on", "menu_id").distinct()
    return joins.join_natural(a, v.order_rows.select("company_id", "branch_id", "schedule_on", "menu_id", "quantity"))


@query("cross_join", "company_id i, group_id i, schedule_on d", """
    SELECT company_id, group_id, CAST(d AS DATE) AS schedule_on
    FROM active_clients CROSS JOIN generate_series(DATE '1998-12-20', DATE '1998-12-24', INTERVAL 1 DAY) AS days(d)""")
def cross_join(v):
    # The days of a scheduling period are a literal list: repeating each client needs no join at all.
    return cal.date_spine(entities.active_clients(v.companies, v.client_groups), START, END)


check_step("candidate_clients", "SELECT company_id || '_C' AS client_id, area_id FROM companies WHERE status = 1 AND lower(company_name) NOT LIKE '%test%'")
check_step("candidate_pairs", """
    SELECT DISTINCT client_id, c.area_id, b.restaurant_id FROM candidate_clients AS c JOIN branch_area AS a ON c.area_id = a.area_id
    JOIN branches AS b ON a.branch_id = b.branch_id JOIN valid_restaurants AS r ON b.restaurant_id = r.restaurant_id WHERE b.status IN (1, 2)""")


@query("candidate_grid", "schedule_on d, client_id s, restaurant_id i", """
    SELECT CAST(d AS DATE) AS schedule_on, client_id, restaurant_id
    FROM candidate_pairs CROSS JOIN generate_series(DATE '1998-12-20', DATE '1998-12-26', INTERVAL 1 DAY) AS days(d) WHERE isodow(d) NOT IN (5, 6)""")
def candidate_grid(v):
    from schedlytics.plans.candidates import candidate_rows
    return candidate_rows(v.companies, v.restaurants, v.branches, v.branch_area, START, date(1998, 12, 26), lambda side: shaped(side, contract_of("candidate_grid")))


@query("area_membership", "company_id i, branch_id i, restaurant_id i", """
    SELECT company_id, b.branch_id, restaurant_id FROM active_clients AS c JOIN branch_area AS a ON c.area_id = a.area_id
    JOIN active_branches AS b ON a.branch_id = b.branch_id""")
def area_membership(v):
    clients = entities.active_clients(v.companies, v.client_groups).select("company_id", "area_id")
    return joins.serving_pairs(clients, entities.active_branches(v.branches), v.branch_area)


@query("area_contains", "company_id i, branch_id i, areas_served i", """
    SELECT company_id, branch_id, len(areas) AS areas_served FROM active_clients AS c
    JOIN (SELECT branch_id, list(area_id) AS areas FROM branch_area GROUP BY 1) AS b ON list_contains(areas, area_id)""")
def area_contains(v):
    # The list test becomes an equality on the exploded list (at most one entry per area); the list stays available.
    lists = v.branch_area.groupBy("branch_id").agg(F.collect_set("area_id").alias("areas"))
    served = lists.withColumn("area_id", F.explode("areas")).where(F.array_contains("areas", F.col("area_id"))).withColumn("areas_served", F.size("areas"))
    clients = entities.active_clients(v.companies, v.client_groups).select("company_id", "area_id")
    return joins.expanding_join(clients, served.select("branch_id", "area_id", "areas_served"), "area_id")


@query("join_semi", "company_id i, branch_id i, n i", """
    SELECT company_id, branch_id, count(*) AS n FROM menu_schedules
    WHERE menu_id IN (SELECT menu_id FROM menus WHERE category_id = 2) GROUP BY 1, 2""")
def join_semi(v):
    lunch = v.menus.where("category_id = 2").select("menu_id")
    return v.menu_schedules.join(lunch, "menu_id", "left_semi").groupBy("company_id", "branch_id").agg(F.count("*").alias("n"))


@query("join_anti", "company_id i, group_id i", """
    SELECT company_id, group_id FROM companies AS c WHERE NOT EXISTS (SELECT 1 FROM client_groups AS g WHERE g.status = 0 AND g.group_id = c.group_id)""")
def join_anti(v):
    closed = v.client_groups.where("status = 0").select("group_id")
    return v.companies.join(closed, "group_id", "left_anti")


@query("join_indicator", "branch_id i, area_id i, found_in s", """
    SELECT b.branch_id, area_id, CASE WHEN a.branch_id IS NULL THEN 'left_only' ELSE 'both' END AS found_in
    FROM branches AS b LEFT JOIN (SELECT * FROM branch_area WHERE is_deliverable = 0) AS a ON a.branch_id = b.branch_id""")
def join_indicator(v):
    areas = v.branch_area.where("is_deliverable = 0").select("branch_id", "area_id")
    return joins.join_indicator(v.branches.select("branch_id"), areas, ["branch_id"], "left")


@query("join_prefixed", "company_id i, group_id i, c_status i, c_area_id i, g_status i, g_area_id i", """
    SELECT company_id, c.group_id, c.status AS c_status, c.area_id AS c_area_id, g.status AS g_status, g.area_id AS g_area_id
    FROM companies AS c JOIN client_groups AS g ON c.group_id = g.group_id""")
def join_prefixed(v):
    c = joins.prefixed(v.companies.select("company_id", "group_id", "status", "area_id"), "c_", ["company_id", "group_id"])
    g = joins.prefixed(v.client_groups.select("group_id", "status", "area_id"), "g_", ["group_id"])
    return c.join(g, "group_id")


@query("lookup_dedup", "branch_id i, restaurant_id i, menu_id i, menu_name s", """
    SELECT branch_id, b.restaurant_id, menu_id, menu_name FROM branches AS b LEFT JOIN
      (SELECT restaurant_id, max(menu_id) AS menu_id, arg_max(menu_name, menu_id) AS menu_name FROM menus
       WHERE category_id = 2 AND status = 1 AND publish_status = 1 GROUP BY 1) AS m ON b.restaurant_id = m.restaurant_id""")
def lookup_dedup(v):
    current = keep_one(v.menus.where(entities.menu_is_open()).select("restaurant_id", "menu_id", "menu_name"), ["restaurant_id"], ["menu_id"])
    return v.branches.select("branch_id", "restaurant_id").join(current, "restaurant_id", "left")


check_step("late_weeks", """
    SELECT restaurant_id, CAST(year(s) - CASE WHEN week(s) > 45 AND month(s) = 1 THEN 1 ELSE 0 END AS VARCHAR) || '_' || lpad(CAST(week(s) AS VARCHAR), 2, '0') AS week,
           avg(minutes) AS minutes
    FROM (SELECT restaurant_id, schedule_on + 1 AS s,
                 date_diff('second', expected_time, coalesce(delivered_at, history_created_at)) / 60.0 AS minutes FROM deliveries) AS t GROUP BY 1, 2""")


@query("fill_latest_known", "restaurant_id i, week s, minutes f", """
    SELECT w.restaurant_id, w.week, CASE WHEN h.minutes IS NULL AND w.week > last_week THEN last_minutes ELSE h.minutes END AS minutes
    FROM late_weeks AS w LEFT JOIN (SELECT * FROM late_weeks WHERE week < '2000_01') AS h ON w.restaurant_id = h.restaurant_id AND w.week = h.week
    LEFT JOIN (SELECT restaurant_id, max(week) AS last_week, arg_max(minutes, week) AS last_minutes FROM late_weeks WHERE week < '2000_01' GROUP BY 1) AS l
    ON w.restaurant_id = l.restaurant_id""")
def fill_latest_known(v):
    minutes = cal.minutes_between(F.coalesce("delivered_at", "history_created_at"), F.col("expected_time"))
    weekly = (v.deliveries.groupBy("restaurant_id", cal.year_week_text(cal.sunday_shift(F.col("schedule_on"))).alias("week"))
              .agg(F.avg(minutes).alias("minutes")))
    known = weekly.where(F.col("week") < "2000_01")
    rows = weekly.withColumn("minutes", F.when(F.col("week") < "2000_01", F.col("minutes")))
    return joins.fill_latest_known(rows, known, ["restaurant_id"], "week", "minutes", "minutes")


@query("nearest_cluster", "vec_id i, area_id i, nearest_label i, nearest_vec_id i", """
    SELECT vec_id, area_id, nearest_label, nearest_vec_id FROM (
      SELECT p.vec_id, p.area_id, r.label AS nearest_label, r.vec_id AS nearest_vec_id,
             row_number() OVER (PARTITION BY p.vec_id ORDER BY pow(p.latitude - r.latitude, 2) + pow(p.longitude - r.longitude, 2), r.vec_id) AS rn
      FROM points AS p JOIN refs AS r ON p.area_id = r.area_id) AS t WHERE rn = 1""")
def nearest_cluster(v):
    return joins.nearest_label(v.points.select("vec_id", "area_id", "latitude", "longitude"), v.refs, "area_id", ("latitude", "longitude"), "label", "vec_id")


check_step("relabelled", """
    SELECT company_id, c.area_id, coalesce(top_group, group_id) AS group_id, status, is_active_virtual, latitude, longitude
    FROM (SELECT * FROM companies WHERE deleted_at IS NULL AND group_id IS NOT NULL) AS c LEFT JOIN (
      SELECT area_id, arg_min(group_id, (-n, group_id)) AS top_group
      FROM (SELECT area_id, group_id, count(*) AS n FROM companies WHERE deleted_at IS NULL AND group_id IS NOT NULL GROUP BY 1, 2) AS counts
      WHERE area_id IN (SELECT area_id FROM cluster_samples) GROUP BY 1) AS m ON c.area_id = m.area_id""")


@query("dominant_group", "company_id i, area_id i, group_id i", "SELECT company_id, area_id, group_id FROM relabelled")
def dominant_group(v):
    live = v.companies.where(F.col("deleted_at").isNull() & F.col("group_id").isNotNull())
    return clusters.dominant_group(live, v.cluster_samples.select("area_id").distinct())
