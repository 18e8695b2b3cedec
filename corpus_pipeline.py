"""The corpus pipeline: five stages from ``documents`` to token digests, each on what the one before it kept."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from schedlytics.llm import bpe, jaccard, langid, mixing, rules
from schedlytics.llm.tables import discard, staged, table
from schedlytics.session import work_dir

# Share of a text's letters that its main language has at least.
MAIN_LANGUAGE = 0.5


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rule nor the learned list rejects; null and empty texts have too few words. Without labels the base rule decides alone."""
    rows = docs.select("doc_id", "text", F.struct(*docs.columns).alias("row"))
    judged = rules.quality_rules(rows, table(spark, sf_dir, "labels"), keep=("row",))
    # A filter below the row number would repeat every statistic in the place of each of its uses.
    return judged.withColumn("place", F.monotonically_increasing_id()).where("kept and place >= 0").select("row.*")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters of which one language has at least half; where no row tells a language, all documents with letters.

    Null and empty texts have no letters and go; null ids and repeated rows stay as they are.
    """
    model = langid.train(docs.where(~langid.held_out()).select("text", "lang"))
    if not model.languages:
        return docs.where(F.coalesce(F.col("text").cast("string"), F.lit("")).rlike("\\p{L}"))
    rows = docs.select("doc_id", "text", F.struct(*docs.columns).alias("row"))
    return langid.predict(rows, model, keep=("row",)).where(f"lang_pred <> 'und' and score >= {MAIN_LANGUAGE}").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that with the smallest id, null ids last. Rows equal in id and text are one document, whatever their other columns."""
    key = lambda digest: F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), digest)
    folder = work_dir(spark)
    keepers = jaccard.jaccard_components(docs, folder=f"{folder}/join").where("keeper").select(key(F.col("text_md5")).alias("row_key")).distinct()
    keepers = staged(keepers, "keepers", folder)
    discard(spark, f"{folder}/join")
    rows = docs.select(F.struct(*docs.columns).alias("row"), key(F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")))).alias("row_key"))
    return rows.join(keepers, "row_key").dropDuplicates(["row_key"]).select("row.*")


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them; a null source is one of its own. Rows equal in id, source and text are interchangeable."""
    return mixing.mixed_rows(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token digests of every document that the mix takes, once for each time it does; null ids stay."""
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    return bpe.decode_ids(bpe.encode_texts(docs, path, pattern), path, pattern, digests=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality), ("language ID", language), ("n-gram Jaccard join", near_duplicates), ("mixing sources", mixture), ("byte-level BPE", tokens)]
# No SQL: the learned rules, the language model and the tokens are no SQL expressions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; every result is written as Parquet and read again for the next stage."""
    docs, folder = table(spark, sf_dir, "documents"), work_dir(spark)
    for k, (_, stage) in enumerate(STAGES):
        docs = staged(stage(spark, docs, sf_dir), f"stage{k}", folder)
    return docs
