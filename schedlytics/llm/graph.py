"""Connected components of an edge table by alternating star contractions, all state in staged tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from schedlytics.llm.tables import staged
from schedlytics.session import work_dir


def _star(pairs: DataFrame) -> DataFrame:
    """Every row (u, v) with the smallest v of its u; a hub's rows stay spread, only its minimum is grouped."""
    return pairs.join(pairs.groupBy("u").agg(F.min("v").alias("m")), "u")


def components(edges: DataFrame, folder: str | None = None) -> DataFrame:
    """(node, root) for every node that has an edge (columns a, b); root is the smallest node reachable.

    Large-star and small-star steps alternate until the edge table stays the same; each result is written to the shared
    folder, so no lineage grows. The driver reads one row (count and checksum) per step. An empty table gives none.
    """
    folder = folder or work_dir(edges.sparkSession)
    now = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges0", folder)
    mark, step = None, 0
    while True:
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(seen) == mark:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        mark, step = tuple(seen), step + 1
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both).where("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct()
        large = staged(large, f"large{step}", folder)
        small = _star(large)
        small = small.select(F.col("u"), F.col("m").alias("v")).unionByName(small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct()
        now = staged(small, f"edges{step}", folder)
