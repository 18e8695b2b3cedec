"""Which entities take part: active, non-test, classified, allowed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from schedlytics.functions.scalars import is_test

# Allowed restaurant types and categories.
TYPES = (1, 5, 6, 7, 9)
CATEGORIES = (1, 2, 8, 14, 17, 18, 21, 22, 23, 26, 27, 28)

# Type names and ids of the scheduling domain.
TYPE_NAMES = {
    "New_Healthy": 10, "Grilled": 11, "Italian": 12, "Pan_Asian": 13, "Other": 9, "Burgers_Sandwiches": 14,
}

# Category names and ids of the scheduling domain.
CATEGORY_NAMES = {
    "Warm_Bowls": 25, "Cold_Salads": 26, "Arabic_Grills": 1, "Mediterranean_Sandwiches_wraps": 21, "Pasta": 27,
    "Pizza": 22, "International": 17, "Thai": 24, "Chinese": 15, "Japanese": 19, "Korean": 20, "Indian": 8,
    "Mexican": 9, "Sushi": 11, "Mixed_Bag": 30, "Sandwiches": 28, "Burgers": 29,
}


def active_clients(companies: DataFrame, groups: DataFrame) -> DataFrame:
    """Active, grouped, non-test companies of active groups: company_id, group_id, area_id."""
    live = groups.where(F.col("status") == 1).select("group_id")
    keep = (F.col("status") == 1) & (F.col("is_active_virtual") == 0) & F.col("group_id").isNotNull() & ~is_test(F.col("company_name"))
    return companies.where(keep).join(live, "group_id", "left_semi").select("company_id", "group_id", "area_id")


def active_branches(branches: DataFrame) -> DataFrame:
    """Open, non-test branches: branch_id, restaurant_id."""
    return branches.where(F.col("status").isin(1, 2) & ~is_test(F.col("branch_name"))).select("branch_id", "restaurant_id")


def active_restaurants(restaurants: DataFrame) -> DataFrame:
    """Open, non-test restaurants with type and category: restaurant_id, type, category."""
    keep = F.col("status").isin(1, 2) & F.col("category_status").isin(1, 3) & ~is_test(F.col("restaurant_name"))
    return restaurants.where(keep & F.col("type").isNotNull() & F.col("category").isNotNull()).select("restaurant_id", "type", "category")


def candidate_restaurants(restaurants: DataFrame) -> DataFrame:
    """Restaurants allowed as candidates: listed type and category, open, not a test."""
    keep = F.col("type").isin(*TYPES) & F.col("category").isin(*CATEGORIES) & F.col("status").isin(1, 2)
    return restaurants.where(keep & ~is_test(F.col("restaurant_name"))).select("restaurant_id", "type", "category")


def restaurant_reject_rules() -> list[tuple[str, Column]]:
    """Reasons that take a restaurant out of the candidates; one restaurant can have several."""
    empty = F.col("type").isNull() | F.col("category").isNull()
    bad_type, bad_category = ~F.col("type").isin(*TYPES), ~F.col("category").isin(*CATEGORIES)
    return [
        ("empty type or category", empty),
        ("invalid type", ~empty & bad_type),
        ("invalid category", ~empty & bad_category),
        ("test restaurant", ~empty & ~bad_type & ~bad_category & is_test(F.col("restaurant_name"))),
    ]


def menu_is_open() -> Column:
    """Published, active lunch menu."""
    return (F.col("category_id") == 2) & (F.col("status") == 1) & (F.col("publish_status") == 1)
