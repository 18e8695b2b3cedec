"""Filters, projections and scalar rules."""

from pyspark.sql import functions as F

from schedlytics.functions import scalars as S
from schedlytics.plans import entities
from schedlytics.registry import query
from schedlytics.sources.inline import inline_table, values_sql


@query("active_entities", "kind s, n i, id_sum i", """
    SELECT 'company' AS kind, count(*) AS n, sum(company_id) AS id_sum FROM companies AS c JOIN client_groups AS g ON c.group_id = g.group_id
    WHERE c.status = 1 AND is_active_virtual = 0 AND g.status = 1 AND lower(company_name) NOT LIKE '%test%'
    UNION ALL SELECT 'branch', count(*), sum(branch_id) FROM branches WHERE status IN (1, 2) AND lower(branch_name) NOT LIKE '%test%'
    UNION ALL SELECT 'restaurant', count(*), sum(restaurant_id) FROM restaurants
      WHERE status IN (1, 2) AND category_status IN (1, 3) AND lower(restaurant_name) NOT LIKE '%test%' AND type IS NOT NULL
    UNION ALL SELECT 'menu', count(*), sum(menu_id) FROM menus WHERE category_id = 2 AND status = 1 AND publish_status = 1""")
def active_entities(v):
    kinds = [("company", entities.active_clients(v.companies, v.client_groups), "company_id"),
             ("branch", entities.active_branches(v.branches), "branch_id"),
             ("restaurant", entities.active_restaurants(v.restaurants), "restaurant_id"),
             ("menu", v.menus.where(entities.menu_is_open()), "menu_id")]
    parts = [df.agg(F.lit(k).alias("kind"), F.count("*").alias("n"), F.sum(i).alias("id_sum")) for k, df, i in kinds]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query("drop_test_names", "company_id i, company_name s", "SELECT company_id, company_name FROM companies WHERE lower(company_name) NOT LIKE '%test%'")
def drop_test_names(v):
    return v.companies.where(~S.is_test(F.col("company_name")))


@query("soft_delete", "company_id i, live i", "SELECT company_id, count(*) AS live FROM menu_schedules WHERE deleted_at IS NULL GROUP BY 1")
def soft_delete(v):
    return v.menu_schedules.where(F.col("deleted_at").isNull()).groupBy("company_id").agg(F.count("*").alias("live"))


@query("delivered_lunch", "company_id i, quantity i", "SELECT company_id, sum(quantity) AS quantity FROM order_rows WHERE status = 5 AND category_id = 2 GROUP BY 1")
def delivered_lunch(v):
    return v.order_rows.where("status = 5 AND category_id = 2").groupBy("company_id").agg(F.sum("quantity").alias("quantity"))


@query("domain_allowlist", "restaurant_id i, type i, category i", f"""
    SELECT restaurant_id, type, category FROM restaurants WHERE type IN {entities.TYPES} AND category IN {entities.CATEGORIES}""")
def domain_allowlist(v):
    return v.restaurants.where(F.col("type").isin(*entities.TYPES) & F.col("category").isin(*entities.CATEGORIES))


@query("drop_nulls", "state s, n i", """
    SELECT 'complete' AS state, count(*) AS n FROM restaurants WHERE type IS NOT NULL AND is_premium IS NOT NULL
    UNION ALL SELECT 'typed', count(*) FROM restaurants WHERE type IS NOT NULL
    UNION ALL SELECT 'with nulls', count(*) FROM restaurants WHERE type IS NULL OR is_premium IS NULL""")
def drop_nulls(v):
    r = v.restaurants
    some_null = F.lit(False)
    for c in r.columns:
        some_null = some_null | F.col(c).isNull()
    parts = [r.dropna().agg(F.lit("complete").alias("state"), F.count("*").alias("n")),
             r.dropna(subset=["type"]).agg(F.lit("typed").alias("state"), F.count("*").alias("n")),
             r.where(some_null).agg(F.lit("with nulls").alias("state"), F.count("*").alias("n"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("fill_by_family", "event_id i, orders_kurtosis f, is_first_time_pair b, pair_rank i, rating f", """
    SELECT event_id, coalesce(CASE WHEN rating > 2 THEN orders END, -3) AS orders_kurtosis,
           coalesce(CASE WHEN rating > 3 THEN rating > 4 END, TRUE) AS is_first_time_pair,
           coalesce(CASE WHEN rating > 3 THEN restaurant_id END, 1) AS pair_rank, coalesce(rating, 0) AS rating FROM visits""")
def fill_by_family(v):
    r = F.col("rating")
    raw = v.visits.select("event_id", F.when(r > 2, F.col("orders")).alias("orders_kurtosis"), F.when(r > 3, r > 4).alias("is_first_time_pair"),
                          F.when(r > 3, F.col("restaurant_id")).alias("pair_rank"), "rating")
    return S.fill_by_family(raw)


@query("coalesce_columns", "order_id i, delivered_at s, capacity i", """
    SELECT order_id, strftime(coalesce(delivered_at, history_created_at), '%Y-%m-%d %H:%M:%S') AS delivered_at,
           coalesce(delivery_capacity, 1) AS capacity
    FROM deliveries AS d LEFT JOIN branches AS b ON b.branch_id = d.restaurant_id * 2""")
def coalesce_columns(v):
    cap = v.branches.select("branch_id", "delivery_capacity")
    return (v.deliveries.withColumn("branch_id", F.col("restaurant_id") * 2).join(cap, "branch_id", "left")
            .select("order_id", F.date_format(F.coalesce("delivered_at", "history_created_at"), "yyyy-MM-dd HH:mm:ss").alias("delivered_at"),
                    F.coalesce("delivery_capacity", F.lit(1)).alias("capacity")))


@query("case_assign", "id i, is_new b, is_partly_new b, size_class s", """
    SELECT id, days_diff IS NULL OR days_diff > 90 AS is_new, coalesce(days_diff > 45 AND days_diff < 90, FALSE) AS is_partly_new,
           CASE WHEN orders <= 10 THEN 'D' WHEN orders <= 25 THEN 'C' WHEN orders <= 40 THEN 'B' ELSE 'A' END AS size_class
    FROM schedule_pool""")
def case_assign(v):
    from schedlytics.plans.rules import with_novelty
    o = F.col("orders")
    return with_novelty(v.schedule_pool).withColumn("size_class", F.when(o <= 10, "D").when(o <= 25, "C").when(o <= 40, "B").otherwise("A"))


@query("where_flags", "id i, is_weekday b, day_key i", """
    SELECT id, isodow(schedule_on) NOT IN (5, 6) AS is_weekday, CASE WHEN isodow(schedule_on) NOT IN (5, 6) THEN 0 END AS day_key FROM schedule_pool""")
def where_flags(v):
    weekday = ~F.weekday("schedule_on").isin(4, 5)
    return v.schedule_pool.select("id", weekday.alias("is_weekday"), F.when(weekday, 0).alias("day_key"))


@query("clamp_per_day", "group_id i, per_day i", """
    SELECT group_id, CASE WHEN per_day_restaurants > 5 THEN 5 WHEN per_day_restaurants < 3 THEN 3 ELSE per_day_restaurants END AS per_day FROM client_groups""")
def clamp_per_day(v):
    return v.client_groups.select("group_id", S.clamp(F.col("per_day_restaurants"), 3, 5).alias("per_day"))


@query("round_half_even", "event_id i, whole f, cents f, counted i", """
    SELECT event_id, round_even(value / 2, 0) AS whole, round_even(value / 8 * 100, 0) / 100 AS cents,
           CASE WHEN value - 50 <= 0 THEN 0 ELSE round_even(value - 50, 0) END AS counted FROM events""")
def round_half_even(v):
    x = F.col("value")
    return v.events.select("event_id", S.round_half_even(x / 2).alias("whole"), S.round_half_even(x / 8, 2).alias("cents"), S.as_count(x - 50).alias("counted"))


@query("safe_ratio", "company_id i, ratio f, filled f", """
    SELECT company_id, ratio, coalesce(ratio, 0) AS filled FROM (
      SELECT company_id, CAST(sum(quantity) AS DOUBLE) / nullif(count(*) FILTER (WHERE status = 5), 0) AS ratio FROM order_rows GROUP BY 1) AS t""")
def safe_ratio(v):
    per = v.order_rows.groupBy("company_id").agg(F.sum("quantity").alias("q"), F.count_if(F.col("status") == 5).alias("n"))
    ratio = S.safe_ratio(F.col("q"), F.col("n"))
    return per.select("company_id", ratio.alias("ratio"), F.coalesce(ratio, F.lit(0.0)).alias("filled"))


@query("client_id_build", "client_id s, n i", """
    SELECT CASE WHEN building_id IS NULL THEN company_id || '_C' ELSE building_id || '_B' END AS client_id, count(*) AS n FROM order_rows GROUP BY 1""")
def client_id_build(v):
    return v.order_rows.groupBy(S.client_id(F.col("company_id"), F.col("building_id")).alias("client_id")).agg(F.count("*").alias("n"))


@query("client_id_parse", "client_id s, number i, kind s, client_type i, packed i", """
    SELECT client_id, CAST(split_part(client_id, '_', 1) AS BIGINT) AS number, split_part(client_id, '_', 2) AS kind,
           CASE WHEN contains(client_id, 'C') THEN 0 ELSE 1 END AS client_type,
           CAST(split_part(client_id, '_', 1) || '0000' || n AS BIGINT) AS packed
    FROM (SELECT CASE WHEN building_id IS NULL THEN company_id || '_C' ELSE building_id || '_B' END AS client_id, count(*) AS n FROM order_rows GROUP BY 1) AS t""")
def client_id_parse(v):
    c = F.col("client_id")
    packed = S.pack_group(F.concat_ws("_", S.client_number(c).cast("string"), F.col("n").cast("string")))
    return client_id_build(v).select("client_id", S.client_number(c).alias("number"), S.client_kind(c).alias("kind"), S.client_type(c).alias("client_type"), packed.alias("packed"))


@query("pair_key", "pair s, n i", "SELECT group_id || '_' || restaurant_id AS pair, count(*) AS n FROM schedule_pool GROUP BY 1")
def pair_key(v):
    return v.schedule_pool.groupBy(F.concat_ws("_", "group_id", "restaurant_id").alias("pair")).agg(F.count("*").alias("n"))


@query("cast_floats", "event_id i, orders i, rating i", "SELECT event_id, trunc(orders) AS orders, trunc(rating) AS rating FROM visits")
def cast_floats(v):
    return S.floats_to_longs(v.visits.select("event_id", "orders", "rating"))


@query("column_reorder", "client_id s, restaurant_id i, schedule_on d, rating f, label f", "SELECT client_id, restaurant_id, schedule_on, rating, orders AS label FROM visits")
def column_reorder(v):
    df = v.visits.withColumnRenamed("orders", "label")
    last = ["rating", "label"]
    return df.select(*[c for c in df.columns if c not in last + ["event_id", "visitor_id"]], *last)


@query("self_equal_notnull", "p_date d, scheduled i", "SELECT p_date, count(*) AS scheduled FROM schedule_pool WHERE schedule_status IS NOT NULL GROUP BY 1")
def self_equal_notnull(v):
    return v.schedule_pool.where(F.col("schedule_status").isNotNull()).groupBy("p_date").agg(F.count("*").alias("scheduled"))


@query("enum_lookup", "restaurant_id i, type_name s, category_name s", f"""
    SELECT restaurant_id, t.name AS type_name, c.name AS category_name FROM restaurants AS r
    LEFT JOIN (VALUES {values_sql(list(entities.TYPE_NAMES.items()))}) AS t(name, id) ON r.type2 = t.id
    LEFT JOIN (VALUES {values_sql(list(entities.CATEGORY_NAMES.items()))}) AS c(name, id) ON r.category = c.id""")
def enum_lookup(v):
    types = inline_table(v.spark, "type_name, type2", list(entities.TYPE_NAMES.items()))
    cats = inline_table(v.spark, "category_name, category", list(entities.CATEGORY_NAMES.items()))
    return v.restaurants.join(F.broadcast(types), "type2", "left").join(F.broadcast(cats), "category", "left")


@query("expr_column", "id i, spare i, over_limit b", "SELECT id, delivery_capacity - orders AS spare, delivery_capacity < orders AS over_limit FROM schedule_pool")
def expr_column(v):
    return v.schedule_pool.withColumns({"spare": F.expr("delivery_capacity - orders"), "over_limit": F.expr("delivery_capacity < orders")})


@query("concat_label", "group_id i, label s", "SELECT group_id, group_name || '_' || area_id || '-' || per_day_restaurants AS label FROM client_groups")
def concat_label(v):
    return v.client_groups.select("group_id", F.concat(F.concat_ws("_", "group_name", "area_id"), F.lit("-"), F.col("per_day_restaurants").cast("string")).alias("label"))
