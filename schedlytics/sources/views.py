"""Entity views over the benchmark tables.

The engine's entities (companies, branches, schedules, order rows, ...) are
derived from the star-schema tables. Simple views are one portable SELECT used
by both engines; the three views that repeat a row for a literal list use
``explode`` here and ``unnest`` in the check SQL.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "embeddings")

# Views written once for both engines.
PORTABLE = {
    "companies": """
        SELECT c_custkey AS company_id,
               CASE WHEN c_custkey % 29 = 0 THEN 'Test ' || c_name ELSE c_name END AS company_name,
               CASE WHEN c_custkey % 11 = 0 THEN 2 ELSE 1 END AS status,
               CASE WHEN c_custkey % 13 = 0 THEN 1 ELSE 0 END AS is_active_virtual,
               CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE CAST(c_nationkey AS BIGINT) * 5 + c_custkey % 5 END AS group_id,
               CAST(c_nationkey AS BIGINT) AS area_id,
               c_custkey % 50 AS drop_off_point_id,
               CASE WHEN c_custkey % 19 = 0 THEN DATE '1998-01-01' ELSE NULL END AS deleted_at,
               c_acctbal / 100 AS latitude,
               CAST(c_custkey % 97 AS DOUBLE) AS longitude
        FROM customer""",
    "buildings": """
        SELECT c_custkey AS building_id,
               CASE WHEN c_custkey % 29 = 0 THEN 'Test ' || c_name ELSE c_name END AS building_name,
               CASE WHEN c_custkey % 11 = 0 THEN 2 ELSE 1 END AS status,
               CAST(c_nationkey AS BIGINT) AS area_id,
               CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE CAST(c_nationkey AS BIGINT) * 5 + c_custkey % 5 END AS building_group_id
        FROM customer""",
    "areas": """
        SELECT CAST(n_nationkey AS BIGINT) AS area_id, 7 + n_nationkey % 14 AS blackout_period,
               CAST(n_regionkey AS BIGINT) AS city_id
        FROM nation""",
    "restaurants": """
        SELECT s_suppkey AS restaurant_id,
               CASE WHEN s_suppkey % 31 = 0 THEN 'Test ' || s_name ELSE s_name END AS restaurant_name,
               CASE WHEN s_suppkey % 7 = 0 THEN 3 ELSE 1 + s_suppkey % 2 END AS status,
               CASE WHEN s_suppkey % 10 = 0 THEN 2 ELSE 1 + 2 * (s_suppkey % 2) END AS category_status,
               CASE WHEN s_suppkey % 23 = 0 THEN NULL WHEN s_suppkey % 5 = 0 THEN 1 WHEN s_suppkey % 5 = 1 THEN 5
                    WHEN s_suppkey % 5 = 2 THEN 6 WHEN s_suppkey % 5 = 3 THEN 7 ELSE 9 END AS type,
               9 + s_suppkey % 6 AS type2,
               CASE s_suppkey % 11 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 8 WHEN 3 THEN 14 WHEN 4 THEN 17 WHEN 5 THEN 18
                    WHEN 6 THEN 21 WHEN 7 THEN 22 WHEN 8 THEN 23 WHEN 9 THEN 27 ELSE 28 END AS category,
               CASE WHEN s_suppkey % 6 = 0 THEN NULL WHEN s_acctbal > 5000 THEN 1 ELSE 0 END AS is_premium
        FROM supplier""",
    "menus": """
        SELECT p_partkey AS menu_id, p_name AS menu_name,
               p_partkey % (SELECT count(*) FROM supplier) AS restaurant_id,
               1 + p_size % 2 AS category_id,
               CASE WHEN p_partkey % 5 = 0 THEN 0 ELSE 1 END AS status,
               CASE WHEN p_partkey % 7 = 0 THEN 0 ELSE 1 END AS publish_status
        FROM part""",
    "meals": "SELECT p_partkey AS meal_id, p_name || ' ' || p_brand AS meal_name FROM part",
    "menu_schedules": """
        SELECT l_orderkey * 10 + l_linenumber AS id, o_custkey AS company_id, l_suppkey * 2 + l_linenumber % 2 AS branch_id,
               l_partkey AS menu_id, CAST(o_orderdate AS DATE) AS schedule_on,
               CASE WHEN l_linenumber = 7 THEN CAST(o_orderdate AS DATE) ELSE NULL END AS deleted_at
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "order_rows": """
        SELECT l_orderkey * 10 + l_linenumber AS order_id, o_custkey AS company_id,
               CASE WHEN o_custkey % 23 = 0 THEN o_custkey ELSE NULL END AS building_id,
               l_suppkey * 2 + l_linenumber % 2 AS branch_id, l_suppkey AS restaurant_id, l_partkey AS menu_id,
               CAST(o_orderdate AS DATE) AS schedule_on, CAST(l_quantity AS BIGINT) AS quantity,
               CASE o_orderstatus WHEN 'F' THEN 5 WHEN 'O' THEN 1 ELSE 2 END AS status,
               CASE WHEN o_orderpriority = '5-LOW' THEN 1 ELSE 2 END AS category_id,
               o_custkey * 3 + l_linenumber % 3 AS user_id,
               CASE WHEN l_returnflag = 'R' THEN NULL ELSE CAST(1 + CAST(l_quantity AS BIGINT) % 5 AS DOUBLE) END AS rating,
               CASE WHEN l_linenumber = 7 THEN CAST(o_orderdate AS DATE) ELSE NULL END AS deleted_at
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "deliveries": """
        SELECT l_orderkey * 10 + l_linenumber AS order_id, o_custkey AS company_id,
               CASE WHEN o_custkey % 23 = 0 THEN o_custkey ELSE NULL END AS building_id,
               l_suppkey AS restaurant_id, CAST(o_orderdate AS DATE) AS schedule_on,
               CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + INTERVAL '12' HOUR AS expected_time,
               CASE WHEN l_partkey % 7 = 0 THEN NULL
                    ELSE CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + INTERVAL '12' HOUR
                         + CAST(l_partkey % 400 - 200 AS INT) * INTERVAL '1' MINUTE END AS delivered_at,
               CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + INTERVAL '12' HOUR
                   + CAST(l_suppkey % 60 AS INT) * INTERVAL '1' MINUTE AS history_created_at
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        WHERE o_orderstatus = 'F' AND o_orderpriority <> '5-LOW' AND l_linenumber <> 7""",
    "visits": """
        SELECT event_id, CAST(user_id AS STRING) || '_C' AS client_id,
               CASE event_type WHEN 'click' THEN 1 WHEN 'error' THEN 2 WHEN 'purchase' THEN 3 WHEN 'signup' THEN 4 ELSE 5 END AS restaurant_id,
               CAST(ts AS DATE) AS schedule_on, value AS orders,
               CASE WHEN CAST(regexp_extract(props, '[0-9]+', 0) AS INT) % 4 = 0 THEN NULL
                    ELSE CAST(1 + CAST(regexp_extract(props, '[0-9]+', 0) AS INT) % 5 AS DOUBLE) END AS rating,
               CASE WHEN event_id % 41 = 0 THEN NULL ELSE event_id % 37 END AS visitor_id
        FROM events""",
    "schedule_pool": """
        SELECT l_orderkey * 10 + l_linenumber AS id, CAST(date_trunc('month', CAST(o_orderdate AS DATE)) AS DATE) AS p_date,
               CAST(o_orderdate AS DATE) AS schedule_on,
               group_id, area_id, l_suppkey * 2 + l_linenumber % 2 AS branch_id, l_suppkey AS restaurant_id,
               type, type2, category, is_premium, 3 + group_id % 3 AS perday_resto, CAST(l_quantity AS BIGINT) AS orders,
               CASE WHEN l_partkey % 15 = 0 THEN NULL ELSE l_partkey % 120 END AS days_diff,
               CASE WHEN l_partkey % 15 <> 0 AND l_partkey % 120 >= 7 + (l_suppkey * 2 + l_linenumber % 2) % 14 THEN 1 ELSE 0 END AS is_not_blackout,
               CASE WHEN l_suppkey % 8 = 0 THEN 1 ELSE 1 + (l_suppkey * 2 + l_linenumber % 2) % 3 END AS delivery_capacity,
               CASE WHEN l_linenumber <= 4 THEN 0 WHEN l_linenumber <= 6 THEN 1 ELSE NULL END AS schedule_status
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
             JOIN companies ON o_custkey = company_id JOIN restaurants ON l_suppkey = restaurant_id
        WHERE group_id IS NOT NULL""",
    "cluster_samples": """
        SELECT c_custkey AS company_id, c_custkey % 4 AS cluster_id, CAST(c_nationkey AS BIGINT) AS area_id,
               c_acctbal / 100 AS latitude, CAST(c_custkey % 97 AS DOUBLE) AS longitude
        FROM customer WHERE c_acctbal > 5000 AND c_nationkey < 12""",
    "metric_pairs": """
        SELECT event_id, floor(value / 50) AS y, value / 50 + (event_id % 7 - 3) / CAST(4 AS DOUBLE) AS predictions
        FROM events""",
}

# Views that repeat a source row for a literal list: (list columns, source, SELECT list).
_REPEATED = {
    "client_groups": (
        [("j", range(5))], "nation",
        """CAST(n_nationkey AS BIGINT) * 5 + j AS group_id, 'Group ' || CAST(n_nationkey * 5 + j AS STRING) AS group_name,
           CASE WHEN (n_nationkey * 5 + j) % 9 = 0 THEN 0 ELSE 1 END AS status,
           2 + (n_nationkey * 5 + j) % 5 AS per_day_restaurants, CAST(n_nationkey AS BIGINT) AS area_id,
           (n_nationkey * 5 + j) % 2 AS is_perk_group""",
    ),
    "branches": (
        [("j", range(2))], "supplier",
        """s_suppkey * 2 + j AS branch_id,
           CASE WHEN (s_suppkey * 2 + j) % 37 = 0 THEN 'TEST ' || s_name ELSE s_name END AS branch_name,
           s_suppkey AS restaurant_id, CASE WHEN (s_suppkey * 2 + j) % 9 = 0 THEN 3 ELSE 1 + j END AS status,
           CASE WHEN s_suppkey % 8 = 0 THEN NULL ELSE 1 + (s_suppkey * 2 + j) % 3 END AS delivery_capacity,
           CASE WHEN (s_suppkey * 2 + j) % 12 = 0 THEN 3 ELSE 1 END AS home_delivery_category_status,
           7 + (s_suppkey * 2 + j) % 14 AS blackout_period""",
    ),
    "menus_meals": ([("j", range(3))], "part", "p_partkey AS menu_id, p_partkey + j AS meal_id"),
    "branch_area": (
        [("j", range(2)), ("k", range(6))], "supplier",
        """s_suppkey * 2 + j AS branch_id, CAST((s_nationkey + 3 * j + 7 * k) % 25 AS BIGINT) AS area_id,
           CASE WHEN (s_suppkey * 2 + j + k) % 10 = 0 THEN 0 ELSE 1 END AS is_deliverable""",
    ),
}

# Two-dimensional points for the nearest-label view; array positions start at 1 in both texts.
_POINTS = {
    "points": "vec_id % 2 = 1",
    "refs": "vec_id % 2 = 0",
}


class Views:
    """Lazy entity frames for one data folder; each attribute call builds a plan only."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name in BASE_TABLES:
            return self.table(name)
        if name in PORTABLE:
            text = PORTABLE[name]
            used = {n: getattr(self, n) for n in _mentioned(text)}
            for n in used:
                text = re.sub(rf"\b(FROM|JOIN) {n}\b", rf"\1 {{{n}}}", text)
            return self.spark.sql(text, **used)
        if name in _REPEATED:
            lists, source, select = _REPEATED[name]
            df = self.table(source)
            for column, values in lists:
                df = df.withColumn(column, F.explode(F.array(*[F.lit(v) for v in values])))
            items = [s.strip() for s in re.split(r",\s*(?![^()]*\))", select)]
            return df.selectExpr(*items)
        if name in _POINTS:
            return self.table("embeddings").where(_POINTS[name]).select(
                "vec_id", F.floor(F.col("vec_id") / 2).cast("bigint").alias("half_id"),
                F.pmod(F.floor(F.col("vec_id") / 2), F.lit(5)).cast("bigint").alias("area_id"),
                F.col("embedding")[0].cast("double").alias("latitude"),
                F.col("embedding")[1].cast("double").alias("longitude"), "label",
            )
        raise AttributeError(name)


def _mentioned(text: str) -> list[str]:
    return [n for n in re.findall(r"\b(?:FROM|JOIN) (\w+)", text) if n in BASE_TABLES or n in PORTABLE or n in _REPEATED]


def check_views() -> dict[str, str]:
    """Every entity view as SQL text for the checking engine."""
    out = dict(PORTABLE)
    for name, (lists, source, select) in _REPEATED.items():
        froms = "".join(f", unnest([{', '.join(map(str, v))}]) AS t_{c}({c})" for c, v in lists)
        out[name] = f"SELECT {select} FROM {source}{froms}"
    for name, predicate in _POINTS.items():
        out[name] = (
            "SELECT vec_id, vec_id // 2 AS half_id, (vec_id // 2) % 5 AS area_id, CAST(embedding[1] AS DOUBLE) AS latitude, "
            f"CAST(embedding[2] AS DOUBLE) AS longitude, label FROM embeddings WHERE {predicate}"
        )
    return out
