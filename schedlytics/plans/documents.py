"""Nested documents of a schedule, as struct columns ready for JSON lines or written as they are sorted."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from schedlytics.functions.calendar import day_name, snap_sunday
from schedlytics.operators.dedupe import keep_one
from schedlytics.plans.publishing import current_menus


def write_branch_docs(rows: DataFrame, path: str) -> str:
    """One JSON line per branch and schedule week (from Sunday): weekday -> list of {group, status, orders}, sorted.

    ``rows``: branch_id, branch_name, capacity, restaurant_id, restaurant_name,
    schedule_on, group_id, group_name, schedule_status, orders. A document is
    written row by row as its sorted rows come by, opened at its first and closed
    at its last one. So a branch without a capacity may have any number of
    entries in a week: they are spilled while they are sorted, never held.
    """
    head = ["branch_id", "branch_name", "capacity", "restaurant_id", "restaurant_name", "week"]
    entry = ["group_id", "group_name", "schedule_status", "orders"]
    dated = rows.withColumns({"week": snap_sunday(F.col("schedule_on")), "day": F.coalesce(day_name(F.col("schedule_on")), F.lit(""))})
    order = Window.partitionBy(*head).orderBy("day", *entry)
    near = dated.select(*head, "day", *entry, F.lag("day").over(order).alias("_before"), F.lead("day").over(order).alias("_after"))
    opens, closes = F.col("_before").isNull(), F.col("_after").isNull()
    day_opens, day_closes = opens | (F.col("_before") != F.col("day")), closes | (F.col("_after") != F.col("day"))
    fields = F.to_json(F.struct(*head))
    piece = F.concat(
        F.when(opens, F.concat(F.expr("left({0}, length({0}) - 1)".format("_head")), F.lit(',"schedules":{'))).otherwise(""),
        F.when(day_opens, F.concat(F.when(opens, "").otherwise(","), F.lit('"'), "day", F.lit('":['))).otherwise(","),
        F.to_json(F.struct(*entry)), F.when(day_closes, "]").otherwise(""), F.when(closes, "}}\n").otherwise(""))
    # Pieces are separated by a space, which JSON allows between them; the line ends with the document.
    near.withColumn("_head", F.when(opens, fields)).select(piece.alias("value")).write.mode("overwrite").option("lineSep", " ").text(path)
    return path


def menu_docs(menus: DataFrame, menus_meals: DataFrame, meals: DataFrame) -> DataFrame:
    """restaurant_id -> {name, meal: [{name}]} of the current menu."""
    named = (current_menus(menus).join(menus_meals, "menu_id", "left").join(meals, "meal_id", "left")
             .groupBy("restaurant_id", "menu_name").agg(F.sort_array(F.collect_list(F.struct(F.col("meal_name").alias("name")))).alias("meal")))
    return named.select("restaurant_id", F.struct(F.col("menu_name").alias("name"), "meal").alias("menu"))


def group_docs(rows: DataFrame, menus: DataFrame, order: Sequence[str], per_day_allowed: int = 3) -> DataFrame:
    """One document per group: weekday -> type -> the slot with its menu; of several rows in a slot the last by ``order`` wins.

    ``rows``: group_id, group_name, schedule_on, type_name, category_name,
    branch_id, branch_name, capacity, restaurant_id, schedule_status, orders.
    A document holds at most weekdays x types slots.
    """
    slot_keys = ["group_id", "group_name", "day", "type_name"]
    last = keep_one(rows.withColumn("day", day_name(F.col("schedule_on"))), slot_keys, order)
    slot = F.struct("branch_name", F.col("branch_id").cast("string").alias("branch_id"), F.coalesce("capacity", F.lit(-1)).alias("capacity"),
                    F.col("schedule_status").cast("string").alias("schedule_status"), F.col("category_name").alias("restaurant_category"), "orders", "menu")
    slots = last.join(menus, "restaurant_id", "left").select("group_id", "group_name", "day", "type_name", slot.alias("slot"))
    days = slots.groupBy("group_id", "group_name", "day").agg(
        F.map_from_entries(F.collect_list(F.struct(F.coalesce("type_name", F.lit("")), "slot"))).alias("slots"))
    return days.groupBy("group_id", "group_name").agg(F.map_from_entries(F.collect_list(F.struct("day", "slots"))).alias("days")).select(
        "group_id", "group_name", F.lit(per_day_allowed).alias("per_day_allowed"), F.struct("days").alias("schedules"))
