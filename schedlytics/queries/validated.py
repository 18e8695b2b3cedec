"""Schedule validation rules and nested documents."""

from pyspark.sql import functions as F

from schedlytics.functions.arrays import text
from schedlytics.plans import documents, entities, rules, scheduling
from schedlytics.queries.windowed import weighted_scores
from schedlytics.registry import check_step, query
from schedlytics.session import work_dir
from schedlytics.sources import sinks, tables
from schedlytics.sources.inline import inline_table, values_sql

ORDER = ["id", "branch_id", "orders", "days_diff"]

check_step("valid_rows", "SELECT *, days_diff IS NULL OR days_diff > 90 AS is_new, coalesce(days_diff > 45 AND days_diff < 90, FALSE) AS is_partly FROM schedule_pool WHERE schedule_status = 0")


def pool(v):
    return v.schedule_pool


def top5(v):
    return scheduling.top_restaurants(weighted_scores(v))


check_step("descriptive", """
    SELECT 'Descriptive' AS scope, 'Stats' AS domain, name, value FROM (
      SELECT CAST(count(DISTINCT p_date) AS DOUBLE) AS pool_days, CAST(count(DISTINCT p_date) FILTER (WHERE schedule_status = 0) AS DOUBLE) AS scheduled_days,
             CAST(count(DISTINCT branch_id) AS DOUBLE) AS branches, CAST(count(DISTINCT restaurant_id) AS DOUBLE) AS restaurants,
             CAST(count(DISTINCT area_id) AS DOUBLE) AS areas, CAST(count(DISTINCT group_id) AS DOUBLE) AS groups FROM schedule_pool) AS t
    UNPIVOT (value FOR name IN (pool_days, scheduled_days, branches, restaurants, areas, groups))""")


@query("rule_descriptive", "scope s, domain s, name s, value f", "SELECT * FROM descriptive")
def rule_descriptive(v):
    return rules.descriptive(pool(v))


check_step("coverage", """
    SELECT 'Comparative' AS scope, 'Pairs' AS domain, name, value FROM (
      SELECT CAST(made AS DOUBLE) AS pairs_made, CAST(made AS DOUBLE) AS valid_pairs, CAST(leftover AS DOUBLE) AS leftover_pairs,
             CAST(essential - made AS DOUBLE) AS missing_pairs, CAST(essential AS DOUBLE) AS essential_pairs, made / CAST(essential AS DOUBLE) * 100 AS valid_percent,
             100 - made / CAST(essential AS DOUBLE) * 100 AS leftover_percent, made / CAST(essential AS DOUBLE) * 100 AS after_leftover_percent,
             100 - made / CAST(essential AS DOUBLE) * 100 AS missing_percent
      FROM (SELECT count(*) FILTER (WHERE schedule_status = 0) AS made, count(*) FILTER (WHERE schedule_status <> 0) AS leftover FROM schedule_pool) AS m,
           (SELECT sum(perday_resto) AS essential FROM (SELECT DISTINCT isodow(p_date), group_id, perday_resto FROM schedule_pool) AS d) AS e) AS t
    UNPIVOT (value FOR name IN (pairs_made, valid_pairs, leftover_pairs, missing_pairs, essential_pairs, valid_percent, leftover_percent, after_leftover_percent, missing_percent))""")


@query("rule_pair_coverage", "scope s, domain s, name s, value f", "SELECT * FROM coverage")
def rule_pair_coverage(v):
    return rules.pair_coverage(pool(v))


check_step("group_made", """
    SELECT p_date, group_id, max(perday_resto) AS size, count(*) FILTER (WHERE schedule_status = 0) AS made FROM schedule_pool GROUP BY 1, 2""")
check_step("made_cells", "SELECT CAST(p_date AS VARCHAR) AS day, made || '/' || size AS label, CAST(count(*) AS DOUBLE) AS value FROM group_made WHERE size BETWEEN 3 AND 5 AND made <= size GROUP BY 1, 2")
check_step("missing_cells", """
    SELECT day, label, n / sum(n) OVER (PARTITION BY day) AS value
    FROM (SELECT CAST(p_date AS VARCHAR) AS day, CAST(size - made AS VARCHAR) AS label, CAST(count(*) AS DOUBLE) AS n FROM group_made GROUP BY 1, 2) AS c""")


@query("rule_perday_matrix", "day s, kind s, label s, value f", """
    SELECT day, 'made/size' AS kind, label, value FROM made_cells UNION ALL SELECT 'All', 'made/size', label, sum(value) FROM made_cells GROUP BY label
    UNION ALL SELECT day, 'missing share', label, value FROM missing_cells UNION ALL SELECT 'All', 'missing share', label, avg(value) FROM missing_cells GROUP BY label""")
def rule_perday_matrix(v):
    return rules.perday_matrix(pool(v))


check_step("day_sums", """
    SELECT p_date, count(*) AS pairs, count(*) FILTER (WHERE schedule_status = 0) AS valid_pairs, sum(orders) AS orders,
           coalesce(sum(orders) FILTER (WHERE schedule_status = 0), 0) AS valid_orders FROM schedule_pool WHERE schedule_status IS NOT NULL GROUP BY 1""")


@query("rule_daily_totals", "day s, pairs i, valid_pairs i, orders i, valid_orders i", """
    SELECT CAST(p_date AS VARCHAR) AS day, pairs, valid_pairs, orders, valid_orders FROM day_sums
    UNION ALL SELECT 'All', sum(pairs), sum(valid_pairs), sum(orders), sum(valid_orders) FROM day_sums""")
def rule_daily_totals(v):
    return rules.daily_totals(pool(v))


@query("rule_blackout", "id i, p_date d, group_id i, branch_id i, days_diff i", "SELECT id, p_date, group_id, branch_id, days_diff FROM valid_rows WHERE is_not_blackout = 0")
def rule_blackout(v):
    return rules.blackout(pool(v))


check_step("spread_branches", """
    SELECT r.* FROM valid_rows AS r JOIN (SELECT p_date, branch_id FROM valid_rows GROUP BY 1, 2 HAVING count(DISTINCT area_id) > 1) AS g
      ON r.p_date = g.p_date AND r.branch_id = g.branch_id WHERE delivery_capacity = 1""")


@query("rule_branch_areas", "id i, p_date d, branch_id i, restaurant_id i, area_id i, delivery_capacity i", "SELECT * FROM spread_branches")
def rule_branch_areas(v):
    return rules.branch_areas(pool(v))


check_step("over_capacity", """
    SELECT p_date, branch_id, count(*) AS times_scheduled, max(delivery_capacity) AS delivery_capacity FROM valid_rows GROUP BY 1, 2 HAVING count(*) > max(delivery_capacity)""")


@query("rule_branch_capacity", "p_date d, branch_id i, times_scheduled i, delivery_capacity i", "SELECT * FROM over_capacity")
def rule_branch_capacity(v):
    return rules.branch_capacity(pool(v))


def limits_sql(limits) -> str:
    vals = values_sql(limits)
    return " UNION ALL ".join(
        f"SELECT category, {size} AS perday_resto, coalesce({c}, 100) AS max_schedules FROM (VALUES {vals}) AS t(category, a, b, c)" for size, c in ((3, "a"), (4, "b"), (5, "c")))


def over_limit_sql(limits, weekdays: bool) -> str:
    where = "WHERE isodow(p_date) NOT IN (5, 6)" if weekdays else ""
    return f"""
    SELECT group_id, n.perday_resto, n.category, times_scheduled, max_schedules
    FROM (SELECT group_id, perday_resto, category, count(*) AS times_scheduled FROM valid_rows {where} GROUP BY 1, 2, 3) AS n
    JOIN ({limits_sql(limits)}) AS l ON n.category = l.category AND n.perday_resto = l.perday_resto WHERE max_schedules < times_scheduled"""


check_step("over_limit", over_limit_sql(rules.CATEGORY_LIMITS, True))
check_step("over_limit_2", over_limit_sql(rules.CATEGORY_LIMITS_2, False))


@query("rule_category_limit", "rule_set i, group_id i, perday_resto i, category i, times_scheduled i, max_schedules i", """
    SELECT 1 AS rule_set, * FROM over_limit UNION ALL SELECT 2, * FROM over_limit_2""")
def rule_category_limit(v):
    first = rules.category_limit(pool(v), rules.CATEGORY_LIMITS, weekdays_only=True).withColumn("rule_set", F.lit(1))
    second = rules.category_limit(pool(v), rules.CATEGORY_LIMITS_2, weekdays_only=False).withColumn("rule_set", F.lit(2))
    return first.unionByName(second)


check_step("type_repeats", """
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY p_date, group_id, type ORDER BY id, branch_id, orders, days_diff NULLS FIRST) AS rn FROM valid_rows) AS t WHERE rn > 1""")


@query("rule_type_duplicate", "id i, p_date d, group_id i, branch_id i, restaurant_id i, type i", "SELECT * FROM type_repeats")
def rule_type_duplicate(v):
    return rules.type_duplicate(pool(v), "type", ORDER)


check_step("type_days", """
    SELECT p_date, group_id, perday_resto, count(*) AS scheduled, list(DISTINCT type) FILTER (WHERE type IS NOT NULL) AS types
    FROM valid_rows WHERE isodow(p_date) NOT IN (5, 6) GROUP BY 1, 2, 3""")
RULE_SETS = ", ".join(f"({size}, {types}, {allowed})" for size, types, allowed in rules.TYPE_SETS)
check_step("over_sets", f"""
    SELECT * FROM (SELECT p_date, group_id, d.perday_resto, list_aggregate(list_sort(list_transform(rule_types, lambda x: CAST(x AS VARCHAR))), 'string_agg', ',') AS rule,
                          allowed, len(list_intersect(types, rule_types)) AS found
                   FROM type_days AS d JOIN (VALUES {RULE_SETS}) AS r(perday_resto, rule_types, allowed) ON d.perday_resto = r.perday_resto) AS t WHERE found > allowed""")


@query("rule_type_sets", "p_date d, group_id i, perday_resto i, rule s, allowed i, found i", "SELECT * FROM over_sets")
def rule_type_sets(v):
    return rules.type_sets(rules.group_days(pool(v))).withColumn("rule", text(F.col("rule_types")))


@query("rule_type_mismatch", "p_date d, group_id i, perday_resto i, scheduled i", "SELECT * FROM type_days WHERE scheduled <> perday_resto")
def rule_type_mismatch(v):
    return rules.type_mismatch(rules.group_days(pool(v)))


check_step("top_hits", """
    SELECT p_date, r.group_id, count(*) AS top_count, string_agg(CAST(r.restaurant_id AS VARCHAR), ',' ORDER BY r.restaurant_id) AS top_list
    FROM (SELECT DISTINCT p_date, group_id, restaurant_id FROM valid_rows) AS r
    JOIN (SELECT group_id, restaurant_id, row_number() OVER (PARTITION BY group_id ORDER BY score DESC, restaurant_id) AS place FROM weighted_scores) AS t
      ON r.group_id = t.group_id AND r.restaurant_id = t.restaurant_id AND place <= 5 GROUP BY 1, 2 HAVING count(*) > 2""")


@query("rule_top_overlap", "p_date d, group_id i, top_count i, top_list s", "SELECT * FROM top_hits")
def rule_top_overlap(v):
    return rules.top_overlap(pool(v), top5(v)).withColumn("top_list", F.array_join(F.col("top_restaurants").cast("array<string>"), ","))


check_step("many_new", "SELECT p_date, group_id, count(*) FILTER (WHERE is_new) AS n_new FROM valid_rows GROUP BY 1, 2 HAVING n_new > 1")
check_step("many_partly", "SELECT group_id, count(*) FILTER (WHERE is_partly) AS n_partly_new FROM valid_rows GROUP BY 1 HAVING n_partly_new > 2")
check_step("new_with_partly", """
    SELECT p_date, group_id, count(*) FILTER (WHERE is_new) AS n_new, count(*) FILTER (WHERE is_partly) AS n_partly_new FROM valid_rows GROUP BY 1, 2
    HAVING n_new > 0 AND n_partly_new > 0""")


@query("rule_new_per_day", "p_date d, group_id i, n_new i", "SELECT * FROM many_new")
def rule_new_per_day(v):
    return rules.new_per_day(rules.group_days(pool(v)))


@query("rule_partial_per_week", "group_id i, n_partly_new i", "SELECT * FROM many_partly")
def rule_partial_per_week(v):
    return rules.partial_per_group(rules.group_days(pool(v)))


@query("rule_new_and_partial", "p_date d, group_id i, n_new i, n_partly_new i", "SELECT * FROM new_with_partly")
def rule_new_and_partial(v):
    return rules.new_and_partial(rules.group_days(pool(v)))


check_step("premium_days", """
    SELECT p.p_date, p.group_id, n_premium, n_regular, perday_resto, n_premium / CAST(perday_resto AS DOUBLE) AS share
    FROM (SELECT p_date, group_id, count(*) FILTER (WHERE is_premium = 1) AS n_premium, count(*) FILTER (WHERE is_premium = 0) AS n_regular
          FROM valid_rows WHERE is_premium IS NOT NULL GROUP BY 1, 2) AS p
    JOIN (SELECT DISTINCT group_id, perday_resto FROM valid_rows) AS s ON p.group_id = s.group_id WHERE n_premium / CAST(perday_resto AS DOUBLE) > CAST(0.4 AS DOUBLE)""")


@query("rule_premium_share", "p_date d, group_id i, n_premium i, n_regular i, perday_resto i, share f", "SELECT * FROM premium_days")
def rule_premium_share(v):
    return rules.premium_share(rules.group_days(pool(v)))


check_step("list_breaks", """
    SELECT p_date, group_id, perday_resto, scheduled, types FROM (
      SELECT p_date, group_id, perday_resto, sum(n) AS scheduled, string_agg(CAST(type2 AS VARCHAR), ',' ORDER BY type2) AS types, max(n) AS most,
             bool_or(type2 = 10) AS has10, bool_or(type2 = 11) AS has11, bool_or(n > 1 AND type2 NOT IN (9, 10)) AS bad_repeat, any_value(cats) AS cats
      FROM (SELECT p_date, group_id, perday_resto, type2, count(*) AS n FROM valid_rows GROUP BY 1, 2, 3, 4) AS c
      JOIN (SELECT p_date, group_id, perday_resto, count(DISTINCT category) AS cats FROM valid_rows GROUP BY 1, 2, 3) AS k USING (p_date, group_id, perday_resto)
      GROUP BY 1, 2, 3) AS t
    WHERE CASE WHEN perday_resto <= 3 THEN NOT (most = 1 AND has10) ELSE NOT (has10 AND has11 AND (most = 1 OR (NOT bad_repeat AND cats = scheduled))) END""")


@query("rule_type_list", "p_date d, group_id i, perday_resto i, scheduled i, types s", "SELECT * FROM list_breaks")
def rule_type_list(v):
    return rules.type_list(rules.group_days(pool(v))).withColumn("types", text(F.col("listed_types")))


@query("rule_report", "scope s, domain s, name s, value f", "\n    UNION ALL ".join([
    "SELECT * FROM descriptive", "SELECT * FROM coverage",
    *[f"SELECT 'Comparative' AS scope, '{d}' AS domain, '{n}' AS name, CAST(count(*) AS DOUBLE) AS value FROM {src}" for d, n, src in [
        ("Blackout", "blackout", "(SELECT 1 FROM valid_rows WHERE is_not_blackout = 0) AS b"), ("Branch_Capacity", "branch_areas", "spread_branches"),
        ("Branch_Capacity", "branch_capacity", "over_capacity"), ("Category", "category_limit", "over_limit"), ("Category", "category_limit_2", "over_limit_2"),
        ("Type", "type_duplicate", "type_repeats"), ("Type", "type_sets", "over_sets"),
        ("Type", "type_mismatch", "(SELECT 1 FROM type_days WHERE scheduled <> perday_resto) AS m"), ("Type", "type_list", "list_breaks"),
        ("Top_Restaurants", "top_overlap", "top_hits"), ("Novelty", "new_per_day", "many_new"), ("Novelty", "partial_per_group", "many_partly"),
        ("Novelty", "new_and_partial", "new_with_partly"), ("Premium", "premium_share", "premium_days")]]]))
def rule_report(v):
    folder = work_dir(v.spark)
    staged = rules.require_scheduled(sinks.stage(pool(v), folder, "pool"))
    top = sinks.stage(top5(v), folder, "top")
    days = sinks.stage(rules.group_days(staged), folder, "group_days")
    return rules.report(staged, days, top)


# ---- documents ----


def doc_rows(v):
    """Scheduled rows with the names a document shows."""
    cats = inline_table(v.spark, "category_name, category", list(entities.CATEGORY_NAMES.items()))
    types = inline_table(v.spark, "type_name, type2", list(entities.TYPE_NAMES.items()))
    named = v.branches.select("branch_id", "branch_name", F.col("delivery_capacity").alias("capacity"))
    return (pool(v).where(F.col("schedule_status").isNotNull())
            .select("id", "schedule_on", "group_id", "branch_id", "restaurant_id", "type2", "category", "schedule_status", "orders", "days_diff")
            .join(named, "branch_id").join(v.restaurants.select("restaurant_id", "restaurant_name"), "restaurant_id")
            .join(v.client_groups.select("group_id", "group_name"), "group_id")
            .join(F.broadcast(types), "type2", "left").join(F.broadcast(cats), "category", "left"))


BRANCH_DOC = ("branch_id long, branch_name string, capacity int, restaurant_id long, restaurant_name string, week date, "
              "schedules map<string, array<struct<group_id: long, group_name: string, schedule_status: int, orders: long>>>")


@query("json_branch_docs", "branch_id i, branch_name s, restaurant_name s, week d, day s, entries s", """
    SELECT r.branch_id, any_value(b.branch_name) AS branch_name, any_value(restaurant_name) AS restaurant_name,
           schedule_on - CAST(isodow(schedule_on) % 7 AS INTEGER) AS week, dayname(schedule_on) AS day,
           string_agg(r.group_id || ':' || g.group_name || ':' || schedule_status || ':' || orders, ',' ORDER BY r.group_id, g.group_name, schedule_status, orders) AS entries
    FROM (SELECT * FROM schedule_pool WHERE schedule_status IS NOT NULL) AS r JOIN branches AS b ON r.branch_id = b.branch_id
    JOIN restaurants AS n ON r.restaurant_id = n.restaurant_id JOIN client_groups AS g ON r.group_id = g.group_id GROUP BY 1, 4, 5""")
def json_branch_docs(v):
    rows = doc_rows(v).drop("id", "type2", "category", "days_diff", "type_name", "category_name")
    path = documents.write_branch_docs(rows, f"{work_dir(v.spark)}/branch_docs")
    days = tables.scan_json(v.spark, path, BRANCH_DOC).select("branch_id", "branch_name", "restaurant_name", "week", F.explode("schedules").alias("day", "list"))
    entry = lambda e: F.concat_ws(":", e.group_id.cast("string"), e.group_name, e.schedule_status.cast("string"), e.orders.cast("string"))
    return days.withColumn("entries", F.array_join(F.transform("list", entry), ","))


check_step("open_menus", """
    SELECT restaurant_id, max(menu_id) AS menu_id, arg_max(menu_name, menu_id) AS menu_name FROM menus WHERE category_id = 2 AND status = 1 AND publish_status = 1 GROUP BY 1""")


@query("menu_docs", "restaurant_id i, menu s, meals s, n i", """
    SELECT restaurant_id, menu_name AS menu, string_agg(meal_name, ',' ORDER BY meal_name) AS meals, count(*) AS n
    FROM open_menus AS m LEFT JOIN menus_meals AS x ON m.menu_id = x.menu_id LEFT JOIN meals AS l ON x.meal_id = l.meal_id GROUP BY 1, 2""")
def menu_docs(v):
    docs = documents.menu_docs(v.menus, v.menus_meals, v.meals)
    parsed = docs.select("restaurant_id", F.from_json(F.to_json("menu"), "name string, meal array<struct<name: string>>").alias("menu"))
    return parsed.select("restaurant_id", F.col("menu.name").alias("menu"), F.array_join("menu.meal.name", ",").alias("meals"), F.size("menu.meal").alias("n"))


GROUP_DOC = ("group_id long, group_name string, per_day_allowed int, schedules struct<days: map<string, map<string, struct<branch_name: string, branch_id: string, "
             "capacity: int, schedule_status: string, restaurant_category: string, orders: long, menu: struct<name: string, meal: array<struct<name: string>>>>>>>")


@query("json_group_docs", "group_id i, group_name s, day s, slots i, orders i, capacity i, with_menu i, meals i", """
    SELECT group_id, group_name, day, count(*) AS slots, sum(orders) AS orders, sum(coalesce(capacity, -1)) AS capacity, count(m.restaurant_id) AS with_menu,
           coalesce(sum(n_meals), 0) AS meals
    FROM (SELECT *, row_number() OVER (PARTITION BY r.group_id, dayname(schedule_on), type2 ORDER BY id DESC, r.branch_id DESC, orders DESC, days_diff DESC NULLS LAST) AS rn,
                 r.group_id, group_name, dayname(schedule_on) AS day, b.delivery_capacity AS capacity, r.restaurant_id AS rid
          FROM (SELECT id, schedule_on, group_id, branch_id, restaurant_id, type2, orders, days_diff FROM schedule_pool WHERE schedule_status IS NOT NULL) AS r
          JOIN (SELECT branch_id, delivery_capacity FROM branches) AS b ON r.branch_id = b.branch_id
          JOIN (SELECT group_id, group_name FROM client_groups) AS g ON r.group_id = g.group_id) AS t
    LEFT JOIN (SELECT restaurant_id, count(*) AS n_meals FROM open_menus AS o JOIN menus_meals AS x ON o.menu_id = x.menu_id GROUP BY 1) AS m ON t.rid = m.restaurant_id
    WHERE rn = 1 GROUP BY 1, 2, 3""")
def json_group_docs(v):
    menus = documents.menu_docs(v.menus, v.menus_meals, v.meals)
    path = sinks.write_json_docs(documents.group_docs(doc_rows(v), menus, ORDER), f"{work_dir(v.spark)}/group_docs")
    docs = tables.scan_json(v.spark, path, GROUP_DOC)
    slots = docs.select("group_id", "group_name", F.explode("schedules.days").alias("day", "slots")).select("group_id", "group_name", "day", F.explode("slots").alias("type", "slot"))
    return slots.groupBy("group_id", "group_name", "day").agg(
        F.count("*").alias("slots"), F.sum("slot.orders").alias("orders"), F.sum("slot.capacity").alias("capacity"),
        F.count("slot.menu").alias("with_menu"), F.coalesce(F.sum(F.size("slot.menu.meal")), F.lit(0)).alias("meals"))
