"""Importance resampling against plain Python: features, weights, the cutoff key by rounds, ties, awkward rows."""

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from schedlytics.llm import resampling
from test_llm import DOCS, rows

COLUMNS = ("doc_id", "n_features", "weight", "score", "rank")
ASKED = [(1, "Alpha beta gamma one two"), (2, None), (3, "the same line, the SAME line")]


def brute(table, target, lengths=(1, 1), buckets=10_000, percent=10, least=20, seed=2024):
    lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))

    def features(t):
        w = words(t)
        return [zlib.crc32(" ".join(w[i:i + n]).encode()) % buckets for n in range(lengths[0], lengths[1] + 1) for i in range(len(w) - n + 1)]

    s, t = (Counter(f for _, x in side for f in features(x)) for side in (table, target))
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s.total() + buckets) / ((s[b] + 1) * (t.total() + buckets)))) for b in range(buckets)]
    out = []
    for d, x in table:
        f = features(x)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        out.append([d, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None, len(words(x))])
    fit = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, -r[1], -r[2]))
    for place, r in enumerate(fit[:percent * len(fit) // 100], 1):
        r[4] = place
    return sorted((tuple(r[:5]) for r in out), key=repr)


def frames(spark, table, target):
    docs = spark.createDataFrame([(*r, 1, "x") for r in table], "doc_id long, text string, weight int, rank string").repartition(5)
    return docs, spark.createDataFrame(target, "item_id long, text string")


def test_awkward_rows(spark):
    table = [d[:2] for d in DOCS]
    docs, target = frames(spark, table, ASKED)
    for options in ({}, {"percent": 100, "least_words": 0}, {"lengths": (1, 3), "buckets": 64, "percent": 50, "least_words": 1}):
        got = resampling.resample(docs, target, **options)
        own = {"least" if k == "least_words" else k: v for k, v in options.items()}
        assert tuple(got.columns) == COLUMNS and rows(got, *COLUMNS) == brute(table, ASKED, **own)
    assert resampling.resample(docs.where("false"), target).count() == 0
    assert rows(resampling.resample(docs, target.where("false")), *COLUMNS) == brute(table, [])


def test_rounds_with_repeated_rows(spark, monkeypatch):
    """Many rows of one id and text tie at every key, the cutoff among them; the driver never gets more than a few."""
    monkeypatch.setattr(resampling, "LAST_KEYS", 3)
    words = "one two three four five six seven eight nine ten".split()
    table = [(k, " ".join(words[(k * j) % 10] for j in range(1, 20 + k % 5))) for k in range(700)] + [(77, "one two " * 12)] * 300 + [(None, "ten " * 30)] * 20
    docs, target = frames(spark, table, ASKED)
    for percent in (1, 10, 33, 100):
        assert rows(resampling.resample(docs, target, percent=percent), *COLUMNS) == brute(table, ASKED, percent=percent)


@pytest.mark.parametrize("k", [1, 2, 250, 499, 500, 501])
def test_cutoff_key(spark, monkeypatch, k):
    monkeypatch.setattr(resampling, "LAST_KEYS", 1)
    big = 1 << 62
    keys = [((i * 37) % 50, 1, big - (i % 3), i % 2, -(i % 7)) for i in range(500)]
    df = spark.createDataFrame(keys, ", ".join(f"{c} long" for c in resampling.KEY)).repartition(6, F.col("score"))
    assert resampling.cutoff_key(df, k) == (sorted(keys, reverse=True)[k - 1] if k <= 500 else None)
