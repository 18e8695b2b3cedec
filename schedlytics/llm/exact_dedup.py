"""Exact duplicates by an exchange of Golomb-coded fingerprints.

Rows are read in chunks, which are written once to a table bucketed by chunk. A chunk sends the distinct fingerprints of its
texts, sorted, to their owners: one message per owner, gaps Golomb-coded with a power of two as parameter. A fingerprint has
only so many bits that about one in 256 meets a different text. An owner answers each message with a bitmap of the fingerprints
that other chunks sent too. A row whose fingerprint is marked, or repeated inside its chunk, is a suspect; all others are
unique and move no further. Only suspects are shuffled with their texts, where grouping by the bytes decides.

The answer meets the rows of its chunk by the buckets, so that no text moves for it. An owner's group is its share of the
fingerprints, at most one per chunk and fingerprint, whatever the number of copies.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from schedlytics.llm.tables import blocks, discard, small_batches, staged, text_column
from schedlytics.llm.terms import raw_bytes
from schedlytics.llm.words import LOWER
from schedlytics.session import work_dir

# Rows of a chunk at most: what one message round holds in memory for it.
CHUNK_ROWS = 1 << 16
# Bits of a fingerprint beyond those that number the rows: one in 2^8 unique texts is a false suspect.
SPARE_BITS = 8
# Fingerprints that one owner has about, and the least number of owners, as a power of two.
OWNER_PRINTS, LEAST_OWNER_BITS = 1 << 16, 8
# Bytes of texts in one Arrow batch of a chunk; a longer text is a batch of its own.
BATCH_BYTES = 1 << 22
LEAST = -(1 << 63)
CHUNKS = "chunk long, place int, row long, doc_id long, digest binary, body binary, prints binary"
MESSAGES = "owner long, chunk long, n int, shift int, unary binary, low binary"


def digest_of(body: bytes) -> bytes:
    return hashlib.sha256(body).digest()


def golomb(values: np.ndarray, low: int, width: int) -> tuple[int, bytes, bytes]:
    """Sorted distinct values of [low, low + width) as (shift, unary, rest): gaps by 2^shift in unary, remainders in ``shift`` bits."""
    gaps = np.diff(values.astype(np.int64), prepend=low - 1) - 1
    shift = max(0, int(0.69 * width / len(values)).bit_length() - 1)
    quotient = gaps >> shift
    ends = np.cumsum(quotient + 1) - 1
    unary = np.ones(int(ends[-1]) + 1, dtype=np.uint8)
    unary[ends] = 0
    bits = (gaps[:, None] >> np.arange(shift - 1, -1, -1)) & 1
    return shift, np.packbits(unary).tobytes(), np.packbits(bits.astype(np.uint8)).tobytes()


def golomb_decode(n: int, shift: int, unary: bytes, rest: bytes, low: int) -> np.ndarray:
    """The values that ``golomb`` coded."""
    ends = np.flatnonzero(np.unpackbits(np.frombuffer(unary, dtype=np.uint8)) == 0)[:n]
    gaps = (np.diff(ends, prepend=-1) - 1).astype(np.int64) << shift
    if shift:
        bits = np.unpackbits(np.frombuffer(rest, dtype=np.uint8), count=n * shift).reshape(n, shift)
        gaps += bits @ (np.int64(1) << np.arange(shift - 1, -1, -1, dtype=np.int64))
    return np.cumsum(gaps + 1) + low - 1


def _chunks(docs: DataFrame) -> DataFrame:
    """A row per document with its lower-cased bytes and digest, and one per chunk (no place) with the first 8 bytes of all its digests."""

    def run(batches):
        task = TaskContext.get().partitionId()
        number, prints, row = 0, [], 0

        def head():
            nulls = [pa.nulls(1, k) for k in (pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary())]
            return pa.RecordBatch.from_arrays([pa.array([task << 32 | number]), *nulls, pa.array([b"".join(prints)], pa.binary())], names)

        names = [c.split()[0] for c in CHUNKS.split(", ")]
        for batch in batches:
            texts, ids = text_column(batch, "text"), batch.column("doc_id")
            for low, high in blocks(texts, BATCH_BYTES):
                data, offsets = raw_bytes(texts.slice(low, high - low))
                body = LOWER[data].tobytes()
                digests = [digest_of(body[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
                n = high - low
                place = np.arange(len(prints), len(prints) + n, dtype=np.int32)
                bodies = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(body)])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, task << 32 | number)), pa.array(place), pa.array((task << 40) + row + np.arange(n)), ids.slice(low, n),
                                                  pa.array(digests, pa.binary()), bodies, pa.nulls(n, pa.binary())], names)
                prints += [d[:8] for d in digests]
                row += n
                if len(prints) >= CHUNK_ROWS:
                    yield head()
                    number, prints = number + 1, []
        if prints:
            yield head()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, CHUNKS)


def _bucketed(df: DataFrame, folder: str) -> str:
    """Write ``df`` to a table in the shared folder, bucketed by chunk, as it comes: a task holds few chunks and needs no sort for it."""
    spark, name, key = df.sparkSession, f"chunks_{uuid.uuid4().hex}", "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    spark.conf.set(key, "64")
    try:
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        df.write.format("parquet").bucketBy(buckets, "chunk").option("path", folder).saveAsTable(name)
    finally:
        spark.conf.set(key, before)
    return name


def _prints(raw: bytes, bits: int) -> np.ndarray:
    return (np.frombuffer(raw, dtype=">u8") >> np.uint64(64 - bits)).astype(np.int64)


def _messages(heads: DataFrame, bits: int, owner_bits: int) -> DataFrame:
    """The coded fingerprints of every chunk for every owner that has some of them."""
    inner = bits - owner_bits

    def run(batches):
        for batch in batches:
            for chunk, raw in zip(batch.column("chunk").to_pylist(), batch.column("prints").to_pylist(), strict=True):
                values = np.unique(_prints(raw, bits))
                owners, first = np.unique(values >> inner, return_index=True)
                parts = np.split(values, first[1:])
                coded = [golomb(v, o << inner, 1 << inner) for o, v in zip(owners.tolist(), parts, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(owners), pa.array(np.full(len(owners), chunk)), pa.array([len(v) for v in parts], pa.int32()), pa.array([c[0] for c in coded], pa.int32()),
                                                  pa.array([c[1] for c in coded], pa.binary()), pa.array([c[2] for c in coded], pa.binary())], [c.split()[0] for c in MESSAGES.split(", ")])

    return heads.mapInArrow(run, MESSAGES)


def _answers(messages: DataFrame, inner: int) -> DataFrame:
    """(owner, chunk, marks): for each fingerprint of a message, in its order, whether another chunk sent it too."""

    def mark(group: pd.DataFrame) -> pd.DataFrame:
        low = int(group["owner"].iloc[0]) << inner
        values = [golomb_decode(n, s, u, r, low) for n, s, u, r in zip(group["n"], group["shift"], group["unary"], group["low"], strict=True)]
        _, at, times = np.unique(np.concatenate(values), return_inverse=True, return_counts=True)
        marks = np.split((times > 1)[at], np.cumsum(group["n"].to_numpy())[:-1])
        return pd.DataFrame({"owner": group["owner"], "chunk": group["chunk"], "marks": [np.packbits(m).tobytes() for m in marks]})

    return messages.groupBy("owner").applyInPandas(mark, "owner long, chunk long, marks binary")


def _suspects(heads: DataFrame, answers: DataFrame, bits: int, inner: int) -> DataFrame:
    """(chunk, words): a bit for each place of a chunk, set for suspects. A chunk's answers hold a bit for each of its own rows."""
    marks = answers.groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("owner", "marks"))).alias("marks"))

    def run(batches):
        for batch in batches:
            words = []
            for raw, marks in zip(batch.column("prints").to_pylist(), batch.column("marks").to_pylist(), strict=True):
                values, at, times = np.unique(_prints(raw, bits), return_inverse=True, return_counts=True)
                _, sizes = np.unique(values >> inner, return_counts=True)
                shared = np.concatenate([np.unpackbits(np.frombuffer(m["marks"], dtype=np.uint8), count=n) for m, n in zip(marks, sizes.tolist(), strict=True)])
                packed = np.packbits(((shared > 0) | (times > 1))[at], bitorder="little")
                words.append(np.pad(packed, (0, -len(packed) % 8)).view("<i8"))
            yield pa.RecordBatch.from_arrays([batch.column("chunk"), pa.array(words, pa.list_(pa.int64()))], ["chunk", "words"])

    return heads.join(marks, "chunk").mapInArrow(run, "chunk long, words array<long>")


def exact_duplicates(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when their bytes are after lower-casing A-Z; null counts as empty. Of equal texts the row with the largest
    doc_id stays (a null id is the smallest; of rows that repeat the largest id exactly one stays), and keep_id is its id.
    text_sha256 is of the lower-cased bytes. An empty table gives no rows; further columns are not read.
    """
    spark = docs.sparkSession
    small_batches(spark)
    folder = folder or work_dir(spark)
    name = _bucketed(_chunks(docs), f"{folder}/chunks")
    try:
        return staged(_resolve(spark, name, folder), "result", folder)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        discard(spark, f"{folder}/chunks")


def _resolve(spark: SparkSession, name: str, folder: str) -> DataFrame:
    heads = spark.table(name).where("place is null").select("chunk", "prints")
    total = heads.agg(F.sum(F.length("prints") / 8).cast("long")).first()[0] or 0
    owner_bits = max(LEAST_OWNER_BITS, (total // OWNER_PRINTS).bit_length())
    bits = min(62, total.bit_length() + SPARE_BITS)
    inner = bits - owner_bits
    answers = _answers(_messages(heads, bits, owner_bits), inner)
    words = staged(_suspects(heads, answers, bits, inner), "suspects", folder)

    marked = F.expr("bit_get(words[shiftright(place, 6)], place & 63) = 1")
    rows = spark.table(name).where("place is not null").join(words.hint("shuffle_hash"), "chunk")
    suspects = rows.where(marked)
    same = suspects.groupBy("digest", "body").agg(
        F.count("*").alias("size"), F.max("doc_id").alias("keep_id"), F.max_by("row", F.coalesce("doc_id", F.lit(LEAST))).alias("keep_row"))
    # One body for a digest is the rule; should two bodies share one, they are told apart below.
    groups = staged(same.groupBy("digest").agg(
        F.count("*").alias("bodies"), F.sum("size").alias("size"), F.max("keep_id").alias("keep_id"), F.max("keep_row").alias("keep_row")).where("size > 1"), "groups", folder)

    def shown(df: DataFrame) -> DataFrame:
        size = F.coalesce(F.col("size"), F.lit(1)).cast("long")
        return df.select("doc_id", F.when(size > 1, F.col("keep_id")).otherwise(F.col("doc_id")).alias("keep_id"), size.alias("group_size"),
                         ((size == 1) | (F.col("row") == F.col("keep_row"))).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))

    none = [F.lit(None).cast("long").alias(c) for c in ("size", "keep_id", "keep_row")]
    unique = rows.where(~marked).select("doc_id", "row", "digest", *none)
    several = groups.where("bodies > 1").select("digest")
    found = suspects.select("doc_id", "row", "digest")
    if several.isEmpty():
        return shown(unique).unionByName(shown(found.join(groups.drop("bodies"), "digest", "left")))
    clear = found.join(several, "digest", "left_anti").join(groups.drop("bodies"), "digest", "left")
    mixed = suspects.select("doc_id", "row", "digest", "body").join(several, "digest", "left_semi").join(same.join(several, "digest", "left_semi"), ["digest", "body"])
    return shown(unique).unionByName(shown(clear)).unionByName(shown(mixed))


LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
DUPLICATES_SQL = f"""
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       row_number() OVER (PARTITION BY body ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(body) AS text_sha256
FROM (SELECT doc_id, {LOWERED} AS body FROM documents) AS t WINDOW w AS (PARTITION BY body)
"""
