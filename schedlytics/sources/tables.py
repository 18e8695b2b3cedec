"""Explicit schemas of the raw tables and the scans over them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Raw table layouts.
SCHEMAS = {
    "companies": "id long, name string, group_id long, status int, is_active_virtual int, area_id long, "
                 "drop_off_point_id long, latitude double, longitude double, deleted_at timestamp",
    "buildings": "id long, name string, status int, area_id long, building_group_id long",
    "groups": "id long, name string, status int, area_id long, per_day_restaurants int, is_perk_group int",
    "areas": "id long, blackout_period int, city_id long",
    "restaurants": "id long, name string, status int, category_status int, type int, category int, is_premium int",
    "restaurant_details": "restaurant_id long, type int, category int",
    "restaurant_types": "id long, name string",
    "restaurant_categories": "id long, name string",
    "branches": "id long, name string, restaurant_id long, status int, delivery_capacity int, daily_dropoffs int, "
                "home_delivery_category_status int, capacity int",
    "branch_details": "branch_id long, blackout_period int",
    "branch_area": "branch_id long, area_id long, is_deliverable int",
    "menus": "id long, name string, restaurant_id long, category_id int, status int, publish_status int",
    "menus_meals": "menu_id long, meal_id long",
    "meals": "id long, name string",
    "menu_schedules": "id long, menu_id long, company_id long, branch_id long, schedule_on date, deleted_at timestamp, "
                      "ots double, created_at timestamp, updated_at timestamp",
    "menu_schedules_building": "menu_id long, building_id long, branch_id long, schedule_on date, deleted_at timestamp",
    "orders": "id long, quantity int, category_id int, branch_id long, status int, schedule_on date, company_id long, "
              "building_id long, created_at timestamp, deleted_at timestamp, user_id long, user_subscription_id long",
    "order_histories": "order_id long, status int, expected_time timestamp, created_at timestamp",
    "order_deliveries": "order_id long, delivery_notification_sent_at timestamp, order_delivered_at timestamp, created_at timestamp",
    "meal_ratings": "order_id long, rating double",
    "cluster_samples": "company_id long, cluster_id int, area_name string, area_id long, latitude double, longitude double",
    "schedule_pairs": "schedule_on date, group_id long, branch_id long, restaurant_id long, schedule_status double",
    "prepared_history": "schedule_on date, restaurant_id long, client_id string, rating double, quantity double",
    "ratio_predictions": "company_id long, group_id long, schedule_on date, branch_id long, restaurant_id long, ots double, model string",
}


def scan(spark: SparkSession, path: str, fmt: str = "parquet", schema: str | None = None,
         columns: Mapping[str, str] | None = None) -> DataFrame:
    """Read a table with an explicit schema and keep ``{new name: source column}``.

    The projection reaches the Parquet scan as its read schema; CSV needs a
    schema (nothing is inferred) and a header row.
    """
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    elif fmt != "parquet":
        raise ValueError("text formats need an explicit schema")
    if fmt == "csv":
        reader = reader.option("header", True)
    df = reader.load(path)
    return df if columns is None else df.select(*[F.col(source).alias(new) for new, source in columns.items()])


def scan_named(spark: SparkSession, folder: str, name: str, fmt: str = "csv", columns: Mapping[str, str] | None = None) -> DataFrame:
    """A raw table of the inventory by name, with its fixed schema."""
    suffix = "" if fmt == "parquet" else f".{fmt}"
    return scan(spark, f"{folder.rstrip('/')}/{name}{suffix}", fmt, SCHEMAS[name], columns)


def scan_json(spark: SparkSession, path: str, schema: str, whole_documents: bool = False) -> DataFrame:
    """JSON documents, one per line or (``whole_documents``) one array per file."""
    return spark.read.schema(schema).option("multiLine", whole_documents).json(path)
