"""Sorts, limits, set and array queries."""

from pyspark.sql import functions as F

from schedlytics.functions import arrays
from schedlytics.plans import rules, scheduling
from schedlytics.queries.windowed import pool_pairs
from schedlytics.registry import query
from schedlytics.session import work_dir


@query("priority_sort", "group_id i, restaurant_id i, orders i, bin i, rank i, weight i", """
    SELECT group_id, restaurant_id, orders, greatest((perday_resto * (rank - 1) + m - 2) // greatest(m - 1, 1), 1) AS bin, rank,
           CASE WHEN orders > 500 THEN 200 ELSE 0 END AS weight
    FROM (SELECT *, row_number() OVER (PARTITION BY group_id ORDER BY orders, restaurant_id) AS rank, count(*) OVER (PARTITION BY group_id) AS m FROM pool_pairs) AS t
    ORDER BY weight DESC, orders DESC, bin DESC, rank DESC""")
def priority_sort(v):
    binned = scheduling.quantile_bins(pool_pairs(v), "group_id", "orders", "restaurant_id", "perday_resto")
    return binned.withColumn("weight", F.when(F.col("orders") > 500, 200).otherwise(0)).orderBy(*scheduling.priority_order())


@query("limit_n", "event_id i, value f", "SELECT event_id, value FROM events ORDER BY value DESC, event_id LIMIT 50")
def limit_n(v):
    return v.events.orderBy(F.desc("value"), "event_id").limit(50)


@query("union_by_name", "client_id s, area_id i, building_group_id i, group_id i", """
    SELECT company_id || '_C' AS client_id, area_id, NULL AS building_group_id, group_id FROM companies
    UNION ALL SELECT building_id || '_B', area_id, building_group_id, NULL FROM buildings""")
def union_by_name(v):
    c = v.companies.select(F.concat(F.col("company_id").cast("string"), F.lit("_C")).alias("client_id"), "area_id", "group_id")
    b = v.buildings.select("building_group_id", F.concat(F.col("building_id").cast("string"), F.lit("_B")).alias("client_id"), "area_id")
    return c.unionByName(b, allowMissingColumns=True)


@query("unscheduled_branches", "p_date d, branch_id i, orders i, place i", """
    SELECT p_date, branch_id, orders, row_number() OVER (PARTITION BY p_date ORDER BY orders DESC, branch_id) AS place
    FROM (SELECT p_date, branch_id, sum(orders) AS orders FROM schedule_pool GROUP BY 1, 2 HAVING count(*) FILTER (WHERE schedule_status = 0) = 0) AS t""")
def unscheduled_branches(v):
    return rules.unscheduled_branches(v.schedule_pool, ["p_date"], work_dir(v.spark))


@query("array_overlap", "p_date d, group_id i, common i", """
    SELECT p_date, group_id, common FROM (
      SELECT p_date, group_id, len(list_intersect(list(DISTINCT type2) FILTER (WHERE schedule_status = 0), list(DISTINCT type2) FILTER (WHERE schedule_status = 1))) AS common
      FROM schedule_pool GROUP BY 1, 2) AS t WHERE common > 2""")
def array_overlap(v):
    st = F.col("schedule_status")
    # Sets over the type domain, not over rows.
    sets = v.schedule_pool.groupBy("p_date", "group_id").agg(
        F.collect_set(F.when(st == 0, F.col("type2"))).alias("a"), F.collect_set(F.when(st == 1, F.col("type2"))).alias("b"))
    return sets.withColumn("common", arrays.overlap_size(F.col("a"), F.col("b"))).where(F.col("common") > 2)


@query("array_duplicates", "branch_id i, has_repeats b, repeated s, has_24 b", """
    SELECT branch_id, max(n) > 1 AS has_repeats, coalesce(string_agg(CAST(city AS VARCHAR), ',' ORDER BY city) FILTER (WHERE n > 1), '') AS repeated,
           bool_or(city = 4) AS has_24
    FROM (SELECT branch_id, area_id // 5 AS city, count(*) AS n FROM branch_area GROUP BY 1, 2) AS t GROUP BY 1""")
def array_duplicates(v):
    city = F.floor(F.col("area_id") / 5).cast("bigint")
    lists = v.branch_area.groupBy("branch_id").agg(F.sort_array(F.collect_list(city)).alias("cities"))
    c = F.col("cities")
    return lists.select("branch_id", arrays.has_repeats(c).alias("has_repeats"), arrays.text(arrays.repeated(c)).alias("repeated"), F.array_contains(c, 4).alias("has_24"))


@query("explode_areas", "branch_id i, area_id i, areas i", """
    SELECT branch_id, area_id, count(*) OVER (PARTITION BY branch_id) AS areas FROM branch_area""")
def explode_areas(v):
    lists = v.branch_area.groupBy("branch_id").agg(F.collect_list("area_id").alias("list"))
    return lists.select("branch_id", F.explode("list").alias("area_id"), F.size("list").alias("areas"))


@query("distinct_lists", "areas s, branches i", """
    SELECT areas, count(*) AS branches FROM (
      SELECT branch_id, string_agg(CAST(area_id AS VARCHAR), ',' ORDER BY area_id) AS areas FROM branch_area GROUP BY 1) AS t GROUP BY 1""")
def distinct_lists(v):
    lists = v.branch_area.groupBy("branch_id").agg(F.sort_array(F.collect_list("area_id")).alias("list"))
    return lists.groupBy("list").agg(F.count("*").alias("branches")).select(arrays.text(F.col("list")).alias("areas"), "branches")
