"""Source divergence against plain Python: distances, ranks, the skyband, awkward rows and counts beyond 64 bits."""

import re
from collections import Counter, defaultdict

import numpy as np

from schedlytics.llm import divergence
from test_llm import DOCS, rows

COLUMNS = ("lang", "source", "part", "item", "value", "rank")


def brute(table, least=30, k=50):
    texts = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))) for text, lang, source in table]
    df, n, groups = defaultdict(Counter), defaultdict(Counter), sorted({t[:2] for t in texts})
    for lang, source, terms in texts:
        df[lang].update(set(terms))
        n[lang, source].update(terms)
        n[lang].update(terms)
    out = []
    for lang in {g for g, _ in groups}:
        kept = [t for t, c in df[lang].items() if c >= least]
        p = {}
        for g in [lang, *[g for g in groups if g[0] == lang]]:
            total = sum(n[g][t] for t in kept)
            p[g] = {t: 1 + 10**9 * (n[g][t] + 5) // (total + 5 * len(kept)) for t in kept}
        own = [s for g, s in groups if g == lang]
        for s in own:
            pairs = [(x, sum(abs(p[lang, s][t] - p[lang, x][t]) for t in kept)) for x in own if x != s]
            terms = [(t, p[lang, s][t] - p[lang][t]) for t in kept if n[lang, s][t] and p[lang, s][t] > p[lang][t]]
            for part, found, last in (("pair", pairs, len(pairs)), ("term", terms, k)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, rank) for rank, (item, value) in enumerate(found[:last], 1)]
    return sorted(out, key=repr)


def frame(spark, table):
    return spark.createDataFrame([(*r, "x", 1) for r in table], "text string, lang string, source string, item string, n int").repartition(4)


def test_awkward_rows(spark):
    table = [(t, lang, source) for _, t, lang, source in DOCS] * 2
    for least in (1, 2, 30):
        got = divergence.divergence(frame(spark, table), least_docs=least)
        assert tuple(got.columns) == COLUMNS and rows(got, *COLUMNS) == brute(table, least)
    assert divergence.divergence(frame(spark, table).where("false")).count() == 0


def test_skewed_sources(spark, monkeypatch):
    """A hot source, ties of whole shares, terms outside ASCII; skybands are reduced and merged many times."""
    monkeypatch.setattr(divergence, "HELD_ROWS", 40)
    monkeypatch.setattr(divergence, "MERGE_ROWS", 60)
    rng = np.random.default_rng(8)
    names = [f"{a}{b}" for a in "aázжλ" for b in ("", "b", "é", "日", "Z")] + [f"w{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(300)]
    table = []
    for k in range(700):
        source = "hot" if k % 3 == 0 else f"s{k % 7}"
        picked = rng.zipf(1.3, 40) % len(names) if k % 3 else (rng.zipf(1.15, 90) * 7) % len(names)
        table.append((" 1,".join(names[i] for i in picked), "en" if k % 5 else None, source))
    docs = frame(spark, table)
    for least, k in ((3, 5), (10, 50)):
        assert rows(divergence.divergence(docs, least_docs=least, k=k), *COLUMNS) == brute(table, least, k)


def test_skyband_keeps_what_few_dominate():
    rng = np.random.default_rng(2)
    for size, k in ((1, 1), (300, 3), (900, 50)):
        n, lang_n = rng.integers(0, 12, size), rng.integers(0, 12, size)
        place = rng.permutation(size)
        over = [((n >= n[i]) & (lang_n <= lang_n[i]) & (place < place[i])).sum() for i in range(size)]
        assert sorted(divergence.skyband(n, lang_n, place, k).tolist()) == [i for i in range(size) if over[i] < k]


def test_shares_are_exact_beyond_64_bits(spark):
    n, total, terms = 123_456_789_012_345, 987_654_321_098_765, 1_234_567
    want = 1 + 10**9 * (n + 5) // (total + 5 * terms)
    df = spark.createDataFrame([(n, total, terms)], "n long, total long, terms long")
    assert df.select(divergence.share("n", "total", "terms")).first()[0] == want
    assert divergence.shares(np.array([n]), np.array([total + 5 * terms])).tolist() == [want]
