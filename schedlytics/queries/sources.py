"""Sources, sinks, rejects and appends."""

from pyspark.sql import functions as F

from schedlytics.functions import scalars as S
from schedlytics.operators import aggregates, publish, rejects
from schedlytics.registry import check_step, query
from schedlytics.session import work_dir
from schedlytics.sources import sinks, tables
from schedlytics.plans.entities import CATEGORIES, TYPES, restaurant_reject_rules


@query("scan_projected", "order_id i, client i, placed_on d", """
    SELECT o_orderkey AS order_id, o_custkey AS client, CAST(o_orderdate AS DATE) AS placed_on FROM orders""")
def scan_projected(v):
    raw = tables.scan(v.spark, f"{v.folder}/orders.parquet",
                      columns={"order_id": "o_orderkey", "client": "o_custkey", "placed_on": "o_orderdate"})
    return raw.withColumn("placed_on", F.to_date("placed_on"))


@query("scan_parquet", "r_regionkey i, r_name s, nations i", """
    SELECT r_regionkey, r_name, count(n_nationkey) AS nations FROM region JOIN nation ON n_regionkey = r_regionkey GROUP BY 1, 2""")
def scan_parquet(v):
    region, nation = (tables.scan(v.spark, f"{v.folder}/{t}.parquet") for t in ("region", "nation"))
    return (region.join(nation, region.r_regionkey == nation.n_regionkey)
            .groupBy("r_regionkey", "r_name").agg(F.count("n_nationkey").alias("nations")))


@query("scan_json_props", "event_id i, k i", """
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""")
def scan_json_props(v):
    return v.events.select("event_id", F.from_json("props", "k long").alias("p")).select("event_id", "p.k")


@query("sink_roundtrip", "id i, company_id i, branch_id i, menu_id i, schedule_on d, deleted_at d", """
    SELECT id, company_id, branch_id, menu_id, schedule_on, deleted_at FROM menu_schedules""")
def sink_roundtrip(v):
    path = sinks.write_table(v.menu_schedules, f"{work_dir(v.spark)}/schedules", "csv")
    return tables.scan(v.spark, path, "csv", "id long, company_id long, branch_id long, menu_id long, schedule_on date, deleted_at date")


@query("stage_roundtrip", "client_id s, schedule_on d, total f", """
    SELECT client_id, schedule_on, sum(orders) AS total FROM visits GROUP BY 1, 2""")
def stage_roundtrip(v):
    daily = v.visits.groupBy("client_id", "schedule_on").agg(F.sum("orders").alias("total"))
    return sinks.stage(daily, work_dir(v.spark), "daily_totals")


@query("publish_replace", "branch_id i, rows i", """
    SELECT branch_id, count(*) AS rows FROM menu_schedules GROUP BY 1""")
def publish_replace(v):
    path = f"{work_dir(v.spark)}/published"
    sinks.publish_replace(v.branches.select("branch_id").withColumn("rows", F.lit(0).cast("long")), path)
    return sinks.publish_replace(v.menu_schedules.groupBy("branch_id").agg(F.count("*").alias("rows")), path)


@query("reject_split", "outcome s, reason s, rows i, distinct_companies i", """
    SELECT CASE WHEN reason IS NULL THEN 'kept' ELSE 'rejected' END AS outcome, reason, count(*) AS rows,
           count(DISTINCT company_id) AS distinct_companies
    FROM (SELECT company_id, CASE WHEN status <> 1 OR is_active_virtual <> 0 THEN 'inactive company'
                 WHEN lower(company_name) LIKE '%test%' THEN 'test company' WHEN group_id IS NULL THEN 'no group' END AS reason
          FROM companies) AS tagged GROUP BY 1, 2""")
def reject_split(v):
    kept, dropped = rejects.split_rejects(v.companies, [
        ("inactive company", (F.col("status") != 1) | (F.col("is_active_virtual") != 0)),
        ("test company", S.is_test(F.col("company_name"))),
        ("no group", F.col("group_id").isNull()),
    ])
    path = sinks.write_table(dropped, f"{work_dir(v.spark)}/rejects", partition_by=["reason"])
    both = (kept.select("company_id", F.lit("kept").alias("outcome"), F.lit(None).cast("string").alias("reason"))
            .unionByName(v.spark.read.schema(dropped.schema).parquet(path).select("company_id", F.lit("rejected").alias("outcome"), "reason")))
    return both.groupBy("outcome", "reason").agg(F.count("*").alias("rows"), F.count_distinct("company_id").alias("distinct_companies"))


check_step("valid_restaurants", f"""
    SELECT restaurant_id, type, category FROM restaurants
    WHERE type IN {TYPES} AND category IN {CATEGORIES} AND status IN (1, 2) AND lower(restaurant_name) NOT LIKE '%test%'""")


@query("reject_report", "restaurant_id i, restaurant_name s, restaurant_reason s, branch_id i, branch_status i, branch_reason s", f"""
    SELECT coalesce(r.restaurant_id, b.restaurant_id) AS restaurant_id, coalesce(r.restaurant_name, b.restaurant_name) AS restaurant_name,
           restaurant_reason, branch_id, branch_status, branch_reason
    FROM (SELECT restaurant_id, restaurant_name, 'empty type or category' AS restaurant_reason FROM restaurants WHERE type IS NULL OR category IS NULL
          UNION ALL SELECT restaurant_id, restaurant_name, 'invalid type' FROM restaurants WHERE type IS NOT NULL AND type NOT IN {TYPES}
          UNION ALL SELECT restaurant_id, restaurant_name, 'invalid category' FROM restaurants
                    WHERE type IS NOT NULL AND category NOT IN {CATEGORIES}
          UNION ALL SELECT restaurant_id, restaurant_name, 'test restaurant' FROM restaurants
                    WHERE type IN {TYPES} AND category IN {CATEGORIES} AND lower(restaurant_name) LIKE '%test%') AS r
    FULL JOIN (SELECT b.restaurant_id, n.restaurant_name, branch_id, b.status AS branch_status, 'inactive branch' AS branch_reason
               FROM branches AS b LEFT JOIN restaurants AS n ON b.restaurant_id = n.restaurant_id WHERE b.status NOT IN (1, 2)) AS b
         ON r.restaurant_id = b.restaurant_id
    UNION ALL
    SELECT b.restaurant_id, n.restaurant_name, NULL, b.branch_id, b.status, 'branch of an invalid restaurant'
    FROM branches AS b JOIN restaurants AS n ON b.restaurant_id = n.restaurant_id
    WHERE b.status IN (1, 2) AND b.branch_id IN (SELECT branch_id FROM branch_area)
      AND b.restaurant_id NOT IN (SELECT restaurant_id FROM valid_restaurants)""")
def reject_report(v):
    info = v.restaurants.select("restaurant_id", "restaurant_name", "type", "category", "status")
    bad = (rejects.all_reasons(info, restaurant_reject_rules(), "restaurant_reason")
           .select("restaurant_id", "restaurant_name", "restaurant_reason"))
    inactive, active = ~F.col("status").isin(1, 2), F.col("status").isin(1, 2)
    branch = v.branches.select("restaurant_id", "branch_id", F.col("status"))
    named = info.select("restaurant_id", "restaurant_name")
    closed = branch.where(inactive).select("restaurant_id", "branch_id", F.col("status").alias("branch_status"), F.lit("inactive branch").alias("branch_reason"))
    valid = info.where(F.col("type").isin(*TYPES) & F.col("category").isin(*CATEGORIES) & active & ~S.is_test(F.col("restaurant_name")))
    orphan = (branch.where(active).join(v.branch_area, "branch_id", "left_semi").join(valid, "restaurant_id", "left_anti")
              .join(named, "restaurant_id")
              .select("restaurant_id", "restaurant_name", "branch_id", F.col("status").alias("branch_status"),
                      F.lit("branch of an invalid restaurant").alias("branch_reason")))
    return rejects.combine_rejects(bad, closed, named).unionByName(orphan, allowMissingColumns=True)


@query("reject_tagged", "company_id i, branch_id i, schedule_on d, reason s, iteration_no i", """
    SELECT company_id, branch_id, schedule_on, 'deleted schedule' AS reason, 1 AS iteration_no FROM menu_schedules WHERE deleted_at IS NOT NULL
    UNION ALL
    SELECT m.company_id, branch_id, schedule_on, 'inactive company', 2 FROM menu_schedules AS m JOIN companies AS c ON m.company_id = c.company_id
    WHERE m.deleted_at IS NULL AND c.status <> 1""")
def reject_tagged(v):
    cols = ["company_id", "branch_id", "schedule_on", "reason", "iteration_no"]
    first = rejects.tag_rejects(v.menu_schedules, F.col("deleted_at").isNotNull(), "deleted schedule", 1)
    left = v.menu_schedules.where(F.col("deleted_at").isNull()).join(v.companies.select("company_id", "status"), "company_id")
    return first.select(*cols).unionByName(rejects.tag_rejects(left, F.col("status") != 1, "inactive company", 2).select(*cols))


# A row is missing when its key is in the set of offered keys but not in that of published ones.
check_step("published_keys", "SELECT company_id, menu_id, branch_id, schedule_on FROM menu_schedules WHERE deleted_at IS NULL")
check_step("offered_rows", """
    SELECT company_id, menu_id, branch_id, schedule_on, count(*) AS copies FROM (
      SELECT company_id, nullif(menu_id, CASE status WHEN 2 THEN menu_id END) AS menu_id, branch_id, schedule_on FROM order_rows) AS o
    WHERE menu_id IS NOT NULL GROUP BY ALL""")
check_step("fresh_keys", "SELECT company_id, menu_id, branch_id, schedule_on FROM offered_rows EXCEPT SELECT * FROM published_keys")


@query("append_missing", "company_id i, menu_id i, branch_id i, schedule_on d, created_at d, updated_at d", """
    SELECT *, NULL AS created_at, NULL AS updated_at FROM published_keys
    UNION ALL SELECT company_id, menu_id, branch_id, schedule_on, DATE '2001-09-01', DATE '2001-09-01'
    FROM (SELECT company_id, menu_id, branch_id, schedule_on, unnest(range(copies)) FROM offered_rows JOIN fresh_keys USING (company_id, menu_id, branch_id, schedule_on)) AS repeated""")
def append_missing(v):
    keys = ["company_id", "menu_id", "branch_id", "schedule_on"]
    new = v.order_rows.withColumn("menu_id", F.when(F.col("status") != 2, F.col("menu_id"))).select(*keys)
    # The live rows are compared with and kept, so they are derived once.
    live = sinks.stage(v.menu_schedules.where(F.col("deleted_at").isNull()).select(*keys), work_dir(v.spark), "live")
    return publish.append_missing(new, live, keys, required=["menu_id"], stamp=F.lit("2001-09-01").cast("date"))


# Grouping takes nulls as equal: both sides are counted by key, and the keys that nobody published give their quantities back.
check_step("keyed_both", """
    SELECT building_id, menu_id, branch_id, schedule_on, list(quantity) AS amounts, sum(is_published) AS published FROM (
      SELECT building_id, menu_id, branch_id, schedule_on, quantity, 0 AS is_published FROM order_rows
      UNION ALL SELECT nullif(company_id, CASE WHEN company_id % 23 > 0 THEN company_id END), menu_id, branch_id, schedule_on, 0, 1 FROM menu_schedules WHERE deleted_at IS NULL) AS sides
    GROUP BY ALL""")


@query("append_missing_nullsafe", "building_id i, menu_id i, branch_id i, schedule_on d, quantity i",
       "SELECT building_id, menu_id, branch_id, schedule_on, unnest(amounts) AS quantity FROM keyed_both WHERE published = 0")
def append_missing_nullsafe(v):
    keys = ["building_id", "menu_id", "branch_id", "schedule_on"]
    live = v.menu_schedules.where(F.col("deleted_at").isNull()).withColumn(
        "building_id", F.when(F.pmod("company_id", F.lit(23)) == 0, F.col("company_id"))).select(*keys)
    return publish.missing_rows(v.order_rows.select(*keys, "quantity"), live, keys, null_safe=["building_id", "menu_id"])


@query("metrics_long", "scope s, domain s, name s, value f", """
    SELECT 'Descriptive' AS scope, 'Stats' AS domain, name, value FROM (
      SELECT 'branches' AS name, CAST(count(DISTINCT branch_id) AS DOUBLE) AS value FROM menu_schedules UNION ALL
      SELECT 'companies', count(DISTINCT company_id) FROM menu_schedules UNION ALL
      SELECT 'days', count(DISTINCT schedule_on) FROM menu_schedules) AS m""")
def metrics_long(v):
    one = v.menu_schedules.agg(F.count_distinct("branch_id").alias("branches"), F.count_distinct("company_id").alias("companies"),
                               F.count_distinct("schedule_on").alias("days"))
    return aggregates.metrics_long(one, "Descriptive", "Stats", ["branches", "companies", "days"])
