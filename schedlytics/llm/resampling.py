"""Importance resampling towards a target corpus: array-scored weights, seeded Gumbel keys, and an exact cutoff without a sort.

Each text becomes the buckets of its features. Bucket counts of corpus and target give one gain per bucket, an array of fixed
size, and a text's weight is the mean gain of its features. The drawn rows are those with the highest keys (score, then
smaller id). Their cutoff key is found by weighted median-of-medians: every partition sends the median of its remaining keys
and their number, the weighted median of these is the pivot, and the side that cannot hold the cutoff goes. At least a quarter
of the remaining keys goes each round. Only the winners are sorted.
"""

from __future__ import annotations

import hashlib
import math
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from schedlytics.llm.tables import blocks, small_batches, staged, text_column
from schedlytics.llm.terms import LETTERS_DIGITS, runs_of, terms_of
from schedlytics.operators.ranks import global_row_number
from schedlytics.session import work_dir

# The parts of a key, largest first drawn: score, whether the id is known, its bitwise complement, then what tells rows of one id apart.
KEY = ("score", "known", "turned", "n_features", "weight")
# Remaining keys that the driver picks from instead of another round.
LAST_KEYS = 5_000
# The features of a text are buckets as unsigned 32-bit integers.
FEATURES = "doc_id long, n_words long, n_features long, features binary"


def features_of(docs: DataFrame, lengths: tuple[int, int] = (1, 1), buckets: int = 10_000) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): the numbers of its words and features, and the bucket of every feature."""

    def run(batches):
        for batch in batches:
            texts, ids = text_column(batch, "text"), batch.column("doc_id")
            for low, high in blocks(texts, 1 << 20):
                words = terms_of(texts.slice(low, high - low), LETTERS_DIGITS)
                owner, bucket = [], []
                for n in range(lengths[0], lengths[1] + 1):
                    grams = words if n == 1 else runs_of(words, n)
                    coded = pc.dictionary_encode(grams.strings)
                    table = np.array([zlib.crc32(w) % buckets for w in coded.dictionary.cast(pa.large_binary()).to_pylist()], dtype="<u4")
                    bucket.append(table[coded.indices.to_numpy()])
                    owner.append(grams.text)
                owner, bucket = np.concatenate(owner), np.concatenate(bucket)
                if lengths[1] > lengths[0]:
                    order = np.argsort(owner, kind="stable")
                    owner, bucket = owner[order], bucket[order]
                count = np.bincount(owner, minlength=high - low)
                offsets = np.append(0, np.cumsum(count) * 4).astype(np.int32)
                held = pa.Array.from_buffers(pa.binary(), high - low, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(bucket.tobytes())])
                yield pa.RecordBatch.from_arrays([ids.slice(low, high - low), pa.array(np.diff(words.bounds)), pa.array(count), held], ["doc_id", "n_words", "n_features", "features"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, FEATURES)


def _buckets_of(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<u4")


def bucket_counts(features: DataFrame, buckets: int) -> np.ndarray:
    """How many features each bucket holds; a task sends one row per bucket, the driver gets ``buckets`` rows."""

    def run(batches):
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            total += np.bincount(_buckets_of(batch.column("features")), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    out = np.zeros(buckets, dtype=np.int64)
    for r in features.select("features").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def gains_of(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The floored thousandfold logarithm of each bucket's smoothed share in the target over that in the corpus."""
    size, total, wanted = len(corpus), float(corpus.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1.0) * (total + size) / ((s + 1.0) * (wanted + size)))) for s, t in zip(corpus.tolist(), target.tolist(), strict=True)], dtype=np.int64)


def score(features: DataFrame, gains: np.ndarray, seed: int) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and the parts of the key."""

    def noise(doc_id: int | None) -> int:
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))

    def run(batches):
        for batch in batches:
            ids, count = batch.column("doc_id"), batch.column("n_features").to_numpy()
            ends = np.cumsum(count)
            sums = np.append(0, np.cumsum(gains[_buckets_of(batch.column("features"))]))
            weight = np.where(count > 0, (sums[ends] - sums[ends - count]) // np.maximum(count, 1), 0)
            points = weight + np.array([noise(d) for d in ids.to_pylist()], dtype=np.int64)
            known = np.array(ids.is_valid())
            turned = np.where(known, ~ids.fill_null(0).to_numpy(), 0)
            yield pa.RecordBatch.from_arrays([ids, batch.column("n_words"), batch.column("n_features"), *map(pa.array, (weight, points, known.astype(np.int64), turned))],
                                             ["doc_id", "n_words", "n_features", "weight", "score", "known", "turned"])

    return features.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long, score long, known long, turned long")


def _key() -> Column:
    return F.struct(*KEY)


def _literal(key: tuple[int, ...]) -> Column:
    return F.struct(*[F.lit(v).cast("long").alias(c) for c, v in zip(KEY, key, strict=True)])


def _medians(rows: DataFrame, pivot: tuple[int, ...] | None) -> list[tuple[int, int, tuple[int, ...]]]:
    """(side, size, median) of every partition's keys above (1), equal to (0) and below (-1) the pivot; without one all are below."""

    def run(batches):
        held = [np.stack([batch.column(c).to_numpy() for c in KEY]) for batch in batches if len(batch)]
        if not held:
            return
        keys = np.concatenate(held, axis=1)
        side = np.full(keys.shape[1], 0 if pivot else -1, dtype=np.int8)
        for values, own in zip(keys, pivot or (), strict=False):
            side = np.where(side == 0, (values > own).astype(np.int8) - (values < own), side)
        for which in (1, 0, -1):
            mine = keys[:, side == which]
            if n := mine.shape[1]:
                middle = mine[:, np.lexsort(mine[::-1])[n // 2]].tolist()
                yield pa.RecordBatch.from_arrays([pa.array([which]), pa.array([n]), *[pa.array([v]) for v in middle]], ["side", "size", *KEY])

    found = rows.mapInArrow(run, "side long, size long, " + ", ".join(f"{c} long" for c in KEY)).collect()
    return [(r[0], r[1], tuple(r[2:])) for r in found]


def cutoff_key(rows: DataFrame, k: int) -> tuple[int, ...] | None:
    """The k-th largest key of ``rows``, from 1; None if there are fewer.

    A round reads the remaining keys of staged ``rows`` once: it splits them at the pivot and brings the medians of both sides,
    three rows per partition at most, so that the next pivot is known whichever side stays.
    """
    low = high = pivot = None
    while True:
        left = rows.select(*KEY)
        if low is not None:
            left = left.where((F.col("score") >= low[0]) & (_key() > _literal(low)))
        if high is not None:
            left = left.where((F.col("score") <= high[0]) & (_key() < _literal(high)))
        cells, side = _medians(left, pivot), -1
        if pivot is not None:
            above, equal = (sum(n for s, n, _ in cells if s == which) for which in (1, 0))
            if above < k <= above + equal:
                return pivot
            low, high, side, k = (pivot, high, 1, k) if k <= above else (low, pivot, -1, k - above - equal)
        cells = sorted((key, n) for s, n, key in cells if s == side)
        size = sum(n for _, n in cells)
        if not 1 <= k <= size:
            return None
        if size <= LAST_KEYS:
            left = left.where(_key() > _literal(low)) if low is not None else left
            left = left.where(_key() < _literal(high)) if high is not None else left
            return sorted((tuple(r) for r in left.collect()), reverse=True)[k - 1]
        pivot = cells[int(np.searchsorted(np.cumsum([n for _, n in cells]), (size + 1) // 2))][0]


def resample(docs: DataFrame, target: DataFrame, lengths: tuple[int, int] = (1, 1), buckets: int = 10_000, percent: int = 10, least_words: int = 20,
             seed: int = 2024, folder: str | None = None) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_features, weight, score, rank; all long.

    Features are the runs of ``lengths`` consecutive words, repeats counted. Of the rows with at least ``least_words`` words the
    floor of ``percent`` per cent with the highest scores are drawn and ranked from 1, ties by smaller doc_id (null last), then by
    more features and the larger weight; rows equal in all of these are interchangeable. All others have no rank. A null or
    wordless text has no features and weight 0; a null doc_id seeds as an empty one; repeated rows are rows of their own. Null
    texts of ``target`` have no features, and an empty target leaves smoothed shares. An empty table gives no rows. Of further
    columns none is read.
    """
    small_batches(docs.sparkSession)
    folder = folder or work_dir(docs.sparkSession)
    features = staged(features_of(docs, lengths, buckets), "features", folder)
    wanted = target.select(F.lit(None).cast("long").alias("doc_id"), "text")
    gains = gains_of(bucket_counts(features, buckets), bucket_counts(features_of(wanted, lengths, buckets), buckets))
    scored = staged(score(features, gains, seed), "scored", folder)
    fit = scored.where(F.col("n_words") >= least_words)
    draws = percent * fit.count() // 100
    shown = ["doc_id", "n_features", "weight", "score"]
    cut = cutoff_key(fit, draws) if draws else None
    if cut is None:
        return scored.select(*shown, F.lit(None).cast("long").alias("rank"))
    drawn = (F.col("n_words") >= least_words) & (F.col("score") >= cut[0]) & (_key() >= _literal(cut))
    ranked = global_row_number(scored.where(drawn), [F.col(c).desc() for c in KEY], folder, "rank")
    # Only rows that equal the cutoff key can lie beyond the last place.
    ranked = ranked.select(*shown, F.when(F.col("rank") <= draws, F.col("rank")).alias("rank"))
    return scored.where(~drawn).select(*shown, F.lit(None).cast("long").alias("rank")).unionByName(ranked)


WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
# The remainders of all bytes come from the polynomial in eight steps, and a word's checksum from its bytes in turn.
RESAMPLE_SQL = f"""
WITH steps AS (
  SELECT list(list_reduce(list_prepend(x, [0, 0, 0, 0, 0, 0, 0, 0]), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY x) AS step
  FROM (SELECT unnest(range(256)) AS x) AS t),
words AS (SELECT doc_id, {WORDS} AS words FROM documents),
wanted AS (SELECT unnest({WORDS}) AS word FROM benchmark),
uses AS (SELECT doc_id, unnest(words) AS word FROM words),
known AS (
  SELECT word, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, CAST(octet_length(encode(word)) AS BIGINT) + 1),
           lambda i: CAST(16 * (instr('0123456789ABCDEF', substr(hex(encode(word)), 2 * i - 1, 1)) - 1) + instr('0123456789ABCDEF', substr(hex(encode(word)), 2 * i, 1)) - 1 AS BIGINT))),
           lambda c, b: xor(c >> 8, step[xor(c, b) % 256 + 1])), 4294967295) % 10000 AS bucket
  FROM (SELECT word FROM uses UNION SELECT word FROM wanted) AS t, steps),
held AS (SELECT bucket, count(*) AS s FROM uses JOIN known USING (word) GROUP BY bucket),
asked AS (SELECT bucket, count(*) AS t FROM wanted JOIN known USING (word) GROUP BY bucket),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0) + CAST(1 AS DOUBLE)) * ((SELECT count(*) FROM uses) + CAST(10000 AS DOUBLE))
           / ((s + CAST(1 AS DOUBLE)) * ((SELECT count(*) FROM wanted) + CAST(10000 AS DOUBLE))))) AS BIGINT) AS gain
  FROM held LEFT JOIN asked USING (bucket)),
weights AS (
  SELECT doc_id, count(*) AS n_features, CAST(floor(sum(gain) / CAST(count(*) AS DOUBLE)) AS BIGINT) AS weight
  FROM uses JOIN known USING (word) JOIN gains USING (bucket) GROUP BY doc_id),
scored AS (
  SELECT w.doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((h + CAST(0.5 AS DOUBLE)) / 4294967296))) AS BIGINT) AS score
  FROM (SELECT doc_id, list_reduce(list_prepend(0, list_transform(range(1, 9), lambda i: CAST(instr('0123456789abcdef', substr(sha256('2024:' || doc_id), i, 1)) - 1 AS BIGINT))), lambda a, x: 16 * a + x) AS h FROM words) AS w
  LEFT JOIN weights USING (doc_id)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place, count(*) FILTER (WHERE n_features >= 20) OVER () AS n FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= 10 * n // 100 THEN place END AS rank FROM placed
"""
