"""Mixing sources to target weights by capped water-filling, and the seeded repetitions that reach the targets."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from schedlytics.llm.tables import staged
from schedlytics.operators.ranks import global_row_number
from schedlytics.session import work_dir

# Rows that one window group of the selection holds on average at most.
GROUP_ROWS = 20_000


def size_of(text: str = "text"):
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def row_key(seed: int):
    """The seeded digest of a row's id, source and whole text: the order of the selection."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce(F.col("source").cast("string"), F.lit("")), F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")))).cast("binary"))


def source_targets(sized: DataFrame, weights: Sequence[int], share: float, cap: float, folder: str) -> DataFrame:
    """(source, source_size, target): ``share`` of all sizes by weight, no source above ``cap`` times its size.

    Sources in code point order, null last, take the weights in turn. Water-filling: the level is what is left for the
    sources that are not full, per weight; sources that it overfills are clamped, until none is. Only sums go to the driver.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = global_row_number(sources, [F.col("source").asc_nulls_last()], folder, "place")
    turn = F.array(*[F.lit(int(w)) for w in weights])
    ranked = staged(ranked.select("source", "source_size", F.get(turn, F.pmod(F.col("place") - 1, F.lit(len(weights))).cast("int")).alias("weight")), "sources", folder)
    level = full = 0.0
    clamped = None
    while True:
        over = F.col("weight") * F.lit(level) > cap * F.col("source_size") if level else F.lit(False)
        row = ranked.agg(F.sum("source_size").alias("all"), F.sum(F.when(over, F.col("source_size"))).alias("full"), F.sum(F.when(~over, F.col("weight"))).alias("open"), F.count_if(over).alias("n")).first()
        if row.n == clamped or not row.open:
            break
        clamped, full = row.n, cap * (row.full or 0)
        level = (share * row["all"] - full) / row.open
    return ranked.select("source", "source_size", F.least(F.col("weight") * F.lit(level), cap * F.col("source_size")).cast("double").alias("target"))


def mix(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5, cap: float = 2.0, seed: int = 7, folder: str | None = None) -> DataFrame:
    """Per row of ``docs`` (doc_id, text, source): doc_id, source, size, source_size, target, copies, taken, row_key.

    A source at e epochs repeats every document floor(e) times, and once more those that come first by a seeded digest of id,
    source and text, up to the words still wanted; the last one is taken if most of it fits. So a source ends within half a document
    of its target and a rerun agrees. Null text: no words; null source: a source of its own, the last; rows that are equal in
    all columns are separate documents. An empty table gives none.
    """
    folder = folder or work_dir(docs.sparkSession)
    sized = staged(docs.select("doc_id", F.col("source").cast("string").alias("source"), size_of().alias("size"), row_key(seed).alias("row_key")), "sized", folder)
    targets = staged(source_targets(sized, weights, share, cap, folder), "targets", folder)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    rows = sized.join(targets.withColumn("whole", whole), sized["source"].eqNullSafe(targets["source"])).drop(targets["source"])
    digits = max(1, math.ceil(math.log(max(1, sized.count() / GROUP_ROWS), 16)) + 1)
    rows = rows.withColumn("bucket", F.substring("row_key", 1, digits))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    held = rows.groupBy("source", "bucket").agg(F.sum("size").alias("held")).select(
        F.col("source").alias("s"), F.col("bucket").alias("b"), F.coalesce(F.sum("held").over(before), F.lit(0)).alias("earlier"))
    rows = rows.join(held, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b"))).drop("s", "b")
    inside = Window.partitionBy("source", "bucket").orderBy("row_key", "size").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("earlier") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    wanted = F.col("target") - F.col("whole") * F.col("source_size")
    copies = F.col("whole") + F.when((F.col("size") > 0) & (2 * start + F.col("size") <= 2 * wanted), 1).otherwise(0)
    rows = rows.withColumn("copies", copies.cast("long"))
    return rows.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"), "row_key")


MIX_SQL = """
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
         md5('7:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(source, '') || ':' || md5(coalesce(text, ''))) AS row_key
  FROM {docs}),
sources AS (
  SELECT source, sum(size) AS source_size, [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight FROM sized GROUP BY source),
levels AS (
  SELECT CAST(CAST(1.5 AS DOUBLE) * sum(source_size) OVER () - 2 * coalesce(sum(source_size) OVER earlier, 0) AS DOUBLE) / sum(weight) OVER later AS level,
         source_size, weight
  FROM sources WINDOW earlier AS (ORDER BY source_size / CAST(weight AS DOUBLE), source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                      later AS (ORDER BY source_size / CAST(weight AS DOUBLE), source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
targets AS (
  SELECT source, source_size,
         least(weight * (SELECT max(level) FROM levels), CAST(2 * source_size AS DOUBLE)) AS target
  FROM sources),
epochs AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM targets),
placed AS (
  SELECT doc_id, s.source, size, source_size, target, whole, row_key,
         coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY row_key, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM sized s JOIN epochs e ON s.source IS NOT DISTINCT FROM e.source),
mixed AS (
  SELECT *, whole + CASE WHEN size > 0 AND 2 * start + size <= 2 * (target - whole * source_size) THEN 1 ELSE 0 END AS copies FROM placed)
"""


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, in all their columns; rows equal in id, source and text are interchangeable."""
    seed = options.get("seed", 7)
    copies = mix(docs, **options).groupBy("row_key").agg(F.sum("copies").alias("mix_copies")).where("mix_copies > 0")
    rows = docs.select(F.struct(*docs.columns).alias("row"), row_key(seed).alias("row_key")).join(copies, "row_key").dropDuplicates(["row_key"])
    return rows.select("row", F.explode(F.sequence(F.lit(1).cast("long"), "mix_copies"))).select("row.*")
