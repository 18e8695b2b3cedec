"""Company clusters: the area's dominant group and the nearest cluster sample."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from schedlytics.operators.joins import nearest_label


def dominant_group(companies: DataFrame, areas: DataFrame) -> DataFrame:
    """In the given areas every company takes the group with most companies there (ties: the smallest id)."""
    sizes = companies.join(areas, "area_id", "left_semi").groupBy("area_id", "group_id").agg(F.count("*").alias("n"))
    top = sizes.groupBy("area_id").agg(F.max_by("group_id", F.struct("n", -F.col("group_id"))).alias("_top"))
    return companies.join(top, "area_id", "left").withColumn("group_id", F.coalesce("_top", "group_id")).drop("_top")


def cluster_groups(companies: DataFrame, samples: DataFrame) -> DataFrame:
    """(company_id, area_id, group_id as ``<group>_<cluster>``) of the active companies.

    The cluster is the company's own sample where it has one, else the nearest
    sample of its area, and 0 in areas without samples or for a company without coordinates.
    """
    areas = samples.select("area_id").distinct()
    live = companies.where(F.col("deleted_at").isNull() & F.col("group_id").isNotNull())
    active = (dominant_group(live, areas).where((F.col("status") == 1) & (F.col("is_active_virtual") == 0))
              .select("company_id", "area_id", "group_id", "latitude", "longitude"))
    near = nearest_label(active, samples, "area_id", ("latitude", "longitude"), "cluster_id", "company_id").drop("nearest_company_id")
    own = samples.select("company_id", "cluster_id")
    sampled = areas.withColumn("_sampled", F.lit(True))
    joined = near.join(own, "company_id", "left").join(sampled, "area_id", "left")
    cluster = F.when(F.col("_sampled").isNull(), F.lit(0)).otherwise(F.coalesce("cluster_id", "nearest_cluster_id", F.lit(0)))
    return joined.select("company_id", "area_id",
                         F.concat_ws("_", F.col("group_id").cast("string"), cluster.cast("string")).alias("group_id"))


def cluster_predictions(groups: DataFrame, predictions: DataFrame) -> DataFrame:
    """Predictions of the companies summed per cluster group, area, day, branch and restaurant.

    Predictions that took the ``member_labels`` of ``groups`` before they were multiplied need no join here; without days they hold for a whole period.
    """
    days = [c for c in ("schedule_on",) if c in predictions.columns]
    if set(LABELS) <= set(predictions.columns):
        named = predictions.drop("group_id", "area_id").withColumnsRenamed({label: c for label, c in LABELS.items()})
    else:
        named = groups.join(predictions, "company_id")
    return named.groupBy("group_id", "area_id", *days, "branch_id", "restaurant_id").agg(F.sum(F.coalesce("orders", F.lit(0))).alias("orders"))


LABELS = {"_cluster_group": "group_id", "_cluster_area": "area_id"}


def member_labels(groups: DataFrame) -> DataFrame:
    """Cluster group and area per company under names that clash with no others."""
    return groups.select("company_id", *[F.col(c).alias(label) for label, c in LABELS.items()])
