"""The corpus pipeline, stage by stage and as a whole, against plain Python versions of its stages on a small fixture."""

import base64
import hashlib
import re
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from schedlytics.llm import mixing
from test_llm import WORD, brute_components, rows

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, row string"
RNG = np.random.default_rng(21)
LEXICON = [f"{a}{b}{c}" for a in ("ka", "lo", "mi", "ter", "sun") for b in ("ra", "ne", "", "vol") for c in ("n", "st", "o", "que")]


def prose(n):
    return " ".join(RNG.choice(LEXICON, n))


def documents():
    base = [prose(int(RNG.integers(30, 90))) for _ in range(24)]
    out = [(k, t, "en", f"s{k % 3}" if k % 5 else None, len(t), "x") for k, t in enumerate(base, 10)]
    out += [(100 + k, base[k] + " " + prose(1), "en", "s1", 1, "copy") for k in range(6)] + [(200 + k, base[k], None, "s2", 1, "exact") for k in range(4)]
    out += [(300, None, None, None, None, None), (301, "", "en", "s0", 0, None), (302, "12 34 " * 20, "en", "s0", 1, "digits"), (303, "too few words", "en", "s1", 1, ""),
            (304, " ".join(["the same five words again"] * 12), "en", "s1", 1, ""), (None, base[7], "en", "s0", 1, "null id"), (None, prose(40), None, None, None, None),
            (305, prose(30_000), "en", "s2", 1, "long"), (10, base[0], "en", "s0", 5, "again")]
    return out


def brute_quality(table):
    def kept(text):
        w = WORD.findall(text or "")
        seen = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
        covered = {k for i in range(len(w) - 4) if seen[tuple(w[i:i + 5])] > 1 for k in range(i, i + 5)}
        return len(w) >= 10 and 100 * len(covered) <= 20 * len(w)

    return [r for r in table if kept(r[1])]


def brute_near(table):
    """One row per (id, text) of those whose id is the least of its component, the least text of several."""
    once = sorted({(r[0], r[1]) for r in table}, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    return once, {(d, c) for d, _, c in brute_components(once)}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(documents(), COLUMNS).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_stages_take_and_return_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    table = [tuple(r) for r in docs.collect()]
    stages = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "language ID", "n-gram Jaccard join", "mixing sources", "byte-level BPE"]

    good = stages["quality rules"](spark, docs, folder)
    assert good.columns == docs.columns and rows(good, *docs.columns) == sorted(brute_quality(table), key=repr)

    spoken = stages["language ID"](spark, docs, folder)
    assert rows(spoken, *docs.columns) == sorted((r for r in table if re.search("[a-z]", r[1] or "")), key=repr)
    unknown = stages["language ID"](spark, docs.withColumn("lang", docs.lang.substr(9, 1)).replace("", None, "lang"), folder)
    assert unknown.count() == spoken.count()

    alone = stages["n-gram Jaccard join"](spark, docs, folder)
    assert alone.columns == docs.columns
    once, links = brute_near(table)
    got = [(r.doc_id, r.text) for r in alone.collect()]
    # A component with ids keeps exactly the row of its least id; texts that link with nothing all stay.
    want_ids = sorted(c for d, c in links if d is not None and d == c)
    assert sorted(d for d, _ in got if d is not None) == want_ids and len(got) == len(set(got))

    mixed = stages["mixing sources"](spark, docs, folder)
    con = duckdb.connect()
    con.execute("CREATE TABLE documents AS SELECT * FROM read_parquet(?)", [f"{folder}/documents.parquet/*.parquet"])
    taken = con.execute(mixing.MIX_SQL.format(docs="documents") + "SELECT doc_id, source, sum(copies) FROM mixed GROUP BY 1, 2 HAVING sum(copies) > 0").fetchall()
    assert sorted(Counter((r.doc_id, r.source) for r in mixed.collect()).items(), key=repr) == sorted((((d, s), int(n)) for d, s, n in taken), key=repr)

    digests = stages["byte-level BPE"](spark, docs, folder)
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    codec = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = [(r[0], len(ids), sha(np.array(ids, dtype="<u4").tobytes()), sha((r[1] or "").encode())) for r in table for ids in [codec.encode_ordinary(r[1] or "")]]
    assert rows(digests, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(want, key=repr)


def test_run_applies_all_stages_in_order(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    by_hand = docs
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        by_hand = stage(spark, by_hand, folder)
        by_hand.write.mode("overwrite").parquet(f"{folder}/hand{k}")
        by_hand = spark.read.parquet(f"{folder}/hand{k}")
    got = corpus_pipeline.run(spark, folder)
    assert got.count() > 20 and rows(got, *got.columns) == rows(by_hand, *got.columns)
    bodies = {hashlib.sha256((r.text or "").encode()).hexdigest() for r in docs.collect()}
    assert {r.decoded_sha256 for r in got.collect()} <= bodies


def test_an_empty_table_runs_through(spark, folder, tmp_path):
    spark.createDataFrame([], COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
