"""The fingerprint exchange against plain grouping, with awkward rows, many chunks and digests that collide."""

import hashlib

import numpy as np
import pytest

from schedlytics.llm import exact_dedup
from test_llm import DOCS, rows

COLUMNS = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def brute(table, digest=lambda b: hashlib.sha256(b).digest()):
    norm = lambda t: bytes(c + 32 if 65 <= c <= 90 else c for c in (t or "").encode())
    groups = {}
    for doc_id, text in table:
        groups.setdefault(norm(text), []).append(doc_id)
    out = []
    for body, ids in groups.items():
        ids.sort(key=lambda d: (d is not None, d or 0), reverse=True)
        out += [(d, ids[0], len(ids), k == 0, digest(body).hex()) for k, d in enumerate(ids)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("low, width, n", [(0, 1, 1), (0, 8, 8), (1 << 40, 1 << 30, 500), (5 << 20, 1 << 20, 1), (0, 1 << 44, 3)])
def test_golomb_round_trip(low, width, n):
    values = np.sort(low + np.random.default_rng(n).choice(min(width, 1 << 20), n, replace=False) * max(1, width >> 20))
    shift, unary, rest = exact_dedup.golomb(values, low, width)
    assert exact_dedup.golomb_decode(n, shift, unary, rest, low).tolist() == values.tolist()
    if n == 500:
        assert len(unary) + len(rest) < n * (np.log2(width / n) + 2) / 8


def test_awkward_rows(spark):
    df = spark.createDataFrame([(*d, "x") for d in DOCS], "doc_id long, text string, lang string, source string, group_size string").repartition(3)
    got = exact_dedup.exact_duplicates(df)
    assert tuple(got.columns) == COLUMNS and rows(got, *COLUMNS) == brute([d[:2] for d in DOCS])
    assert exact_dedup.exact_duplicates(df.where("false")).count() == 0


def copies():
    rng = np.random.default_rng(4)
    table = [(int(k), f"Text {'A' if k % 3 else 'a'} {rng.integers(0, 300)}") for k in range(900)]
    return table + [(2000 + k, "The hot one") for k in range(500)] + [(None, "The HOT one"), (7, "the hot one"), (None, "alone")]


def test_many_chunks_and_a_hot_group(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "CHUNK_ROWS", 40)
    table = copies()
    df = spark.createDataFrame(table, "doc_id long, text string").repartition(7)
    assert rows(exact_dedup.exact_duplicates(df), *COLUMNS) == brute(table)


def test_bytes_decide_when_digests_collide(spark, monkeypatch):
    """With digests that only tell lengths apart every fingerprint is a false suspect."""
    weak = lambda body: len(body).to_bytes(1, "big") * 32
    monkeypatch.setattr(exact_dedup, "digest_of", weak)
    table = copies()
    df = spark.createDataFrame(table, "doc_id long, text string").repartition(5)
    assert rows(exact_dedup.exact_duplicates(df), *COLUMNS) == brute(table, weak)
