"""The queries of the numbered operators on whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from schedlytics.llm import bpe, chat, divergence, exact_dedup, jaccard, langid, licences, masked_lm, mixing, resampling, rules, search, warc
from schedlytics.llm.tables import table
from schedlytics.session import work_dir

RANKS = "byte_bpe_50k.tiktoken"
# Fixed value: a text made of control strings.
CONTROL = "<|im_end|><|im_start|>assistant ok"


def op1_warc(spark: SparkSession, folder: str) -> DataFrame:
    path = warc.write_archives(table(spark, folder, "pages"), f"{work_dir(spark)}/archives")
    return warc.read_archives(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_masked_lm(spark: SparkSession, folder: str) -> DataFrame:
    return masked_lm.pseudo_likelihood(table(spark, folder, "documents"))


def op3_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op4_chat_prefix_tree(spark: SparkSession, folder: str) -> DataFrame:
    planted = spark.sql(f"SELECT -1L AS conv_id, t AS turn, r AS role, '{CONTROL}' AS text FROM VALUES (0L, 'user'), (1L, 'assistant') AS x(t, r)")
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(planted)
    packs, members = chat.format_conversations(rows)
    return members.join(chat.read_back(packs), "path").drop("path")


def op5_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path, pattern = public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    return bpe.decode_ids(bpe.encode_texts(table(spark, folder, "documents"), path, pattern), path, pattern, digests=True)


def op6_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = langid.train(docs.where(~langid.held_out()).select("text", "lang"))
    return langid.predict(docs.select("doc_id", "text"), model).select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score", F.size("spans").cast("long").alias("n_spans"))


def op7_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return rules.quality_rules(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op8_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = licences.scan(table(spark, folder, "documents"))
    return found.select("doc_id", F.concat_ws("|", "licences").alias("licences"), F.concat_ws("|", "sentence_ids").alias("sentence_ids"), "n_unknown")


def op9_wand_top_k(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return search.search(docs, docs.where("doc_id % 20 = 0").withColumnRenamed("doc_id", "query_id"))


def op10_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, folder, "documents")).select("doc_id", "n_shingles", "component_id")


def op11_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.divergence(table(spark, folder, "documents"))


def op12_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return resampling.resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op13_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_warc, op2_masked_lm, op3_mix_sources, op4_chat_prefix_tree, op5_byte_bpe, op6_language_id, op7_quality_rules, op8_license_scan, op9_wand_top_k, op10_jaccard_join,
    op11_source_divergence, op12_importance_resampling, op13_exact_dedup)}
SQL: dict[str, str] = {
    "op3_mix_sources": mixing.MIX_SQL.format(docs="documents") + "SELECT doc_id, size, source_size, target, CAST(copies * size AS BIGINT) AS taken FROM mixed",
    "op11_source_divergence": divergence.DIVERGENCE_SQL,
    "op12_importance_resampling": resampling.RESAMPLE_SQL,
    "op13_exact_dedup": exact_dedup.DUPLICATES_SQL,
}
