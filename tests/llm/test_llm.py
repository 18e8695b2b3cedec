"""Operators of the training-data subpackage against brute force, exact round trips and held-out accuracy, with the awkward rows."""

import base64
import hashlib
import math
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from conftest import SMALL
from schedlytics.llm import bpe, chat, jaccard, langid, licences, masked_lm, mixing, queries, rules, search, warc
from schedlytics.llm.words import words_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = "lorem ipsum dolor sit amet " * 4000 + "x" * 20000
DOCS = [
    (1, "one two three four five six seven eight nine ten eleven twelve", "en", "b"), (1, "one two three four five six seven eight nine ten eleven twelve", "en", "b"),
    (2, None, None, None), (3, "", "en", "a"), (4, " \n\t ", "en", "a"), (None, "alpha beta gamma", None, "b"), (None, None, None, None), (5, "Alpha Beta GAMMA", "en", None),
    (6, LONG, "fr", "a"), (7, "the same line\nthe same line\nthe same line here\n# $ | <>", "en", "b"), (8, "日本語 текст mixed 12 ' s", None, "c"), (9, "ß" * 50, "de", "c"),
]


@pytest.fixture(scope="module")
def docs(spark):
    """Nulls in every column, empty and long texts, repeated rows, and an extra column named like an output."""
    return spark.createDataFrame([(*d, "x") for d in DOCS], "doc_id long, text string, lang string, source string, score string").repartition(3)


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("false")


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def brute_components(docs, words=4, percent=85):
    sets = []
    for _, text in docs:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append({tuple(w[k:k + words]) for k in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} if w else set())
    group = list(range(len(docs)))
    for i, x in enumerate(sets):
        for j in range(i):
            common = len(x & sets[j])
            if x and 100 * common >= percent * (len(x) + len(sets[j]) - common):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    low = {}
    for g, (doc_id, _) in zip(group, docs, strict=True):
        if doc_id is not None:
            low[g] = min(low.get(g, doc_id), doc_id)
    return sorted(((d, len(s), low.get(g)) for (d, _), s, g in zip(docs, sets, group, strict=True)), key=repr)


def test_words_are_the_regular_expression():
    texts = [t or "" for _, t, _, _ in DOCS]
    cut = words_of(pa.array(texts, pa.large_string()))
    assert cut.strings() == [w for t in texts for w in WORD.findall(t)]
    assert len(set(cut.hashes().tolist())) == len(set(cut.strings()))


def test_jaccard_components(spark, docs, none):
    assert rows(jaccard.jaccard_components(docs), "doc_id", "n_shingles", "component_id") == brute_components([d[:2] for d in DOCS])
    assert jaccard.jaccard_components(none).count() == 0


def test_jaccard_joins_a_group_through_its_hub(spark, monkeypatch):
    """Copies that link with their base but not with each other, in a group above the crowd limit; the hub's pairs share several copies of its set."""
    monkeypatch.setattr(jaccard, "HUB_PAIRS", 7)
    rng = np.random.default_rng(3)
    base = [f"w{k}" for k in range(120)]
    texts = [" ".join(base)]
    for k in range(40):
        own = list(base)
        for at in rng.choice(120, 2, replace=False):
            own[at] = f"u{k}_{at}"
        texts.append(" ".join(own))
    texts += [" ".join(f"z{k}_{i}" for i in range(50)) for k in range(20)] + [" ".join([*base[:60], *[f"y{k}_{i}" for i in range(60)]]) for k in range(10)]
    table = list(enumerate(texts, 100))
    got = rows(jaccard.jaccard_components(spark.createDataFrame(table, "doc_id long, text string")), "doc_id", "n_shingles", "component_id")
    assert got == brute_components(table)


def test_jaccard_links_around_a_pivot_that_joins_neither(spark):
    """Families with edits of their own: too far from the pivot, near each other; and lone copies that link with nothing."""
    rng = np.random.default_rng(11)
    base = [f"w{k}" for k in range(150)]

    def edited(words, count, name, drop=False):
        own = list(words)
        for at in rng.choice(150, count, replace=False):
            own[at] = None if drop else f"{name}_{at}"
        return [w for w in own if w]

    texts = [base, *[edited(base, 2, f"n{k}") for k in range(25)], *[edited(base, 7, f"far{k}") for k in range(25)]]
    for family in range(4):
        head = edited(base, 6, f"f{family}", drop=family % 2 == 0)
        head += [None] * (150 - len(head))
        texts += [edited(head, k % 3, f"f{family}_{k}") for k in range(9)]
    table = [(k, " ".join(t)) for k, t in enumerate(texts, 100)]
    got = rows(jaccard.jaccard_components(spark.createDataFrame(table, "doc_id long, text string")), "doc_id", "n_shingles", "component_id")
    assert got == brute_components(table)
    assert len({c for _, _, c in got}) > 20


def test_quality_statistics_and_rules(spark, docs, none):
    def brute(text):
        w = WORD.findall(text or "")
        lines = [x for x in (text or "").split("\n") if WORD.search(x)]
        seen = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
        covered = {k for i in range(len(w) - 4) if seen[tuple(w[i:i + 5])] > 1 for k in range(i, i + 5)}
        return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)

    labels = spark.createDataFrame([(1, 1, 0), (None, 0, 0), (7, None, 0)], "doc_id long, quality int, toxic int")
    got = rows(rules.quality_rules(docs, labels), "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "kept")
    want = []
    for doc_id, text, _, _ in DOCS:
        s = brute(text)
        want.append((doc_id, *s, not (s[0] < 10 or 100 * s[4] > 20 * s[0])))
    assert got == sorted(want, key=repr)
    assert rules.quality_rules(none, labels.where("false")).count() == 0


def test_quality_rules_learn_symbols(spark):
    table = [(k, "clean words in a row without any sign at all here " + str(k) if k % 2 else "bad ### words $$$ in a *** row with many signs at all " + str(k)) for k in range(60)]
    got = rules.quality_rules(spark.createDataFrame(table, "doc_id long, text string"), spark.createDataFrame([(k, k % 2) for k in range(60)], "doc_id long, quality int"))
    assert all(r.kept == bool(r.doc_id % 2) for r in got.collect())


def test_bpe_round_trip(docs, none):
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    codec = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    got = rows(bpe.decode_ids(bpe.encode_texts(docs, path, pattern), path, pattern, digests=True), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    sha = lambda x: hashlib.sha256(x).hexdigest()
    want = []
    for doc_id, text, _, _ in DOCS:
        ids = codec.encode_ordinary(text or "")
        want.append((doc_id, len(ids), sha(np.array(ids, dtype="<u4").tobytes()), sha((text or "").encode())))
    assert got == sorted(want, key=repr)
    assert bpe.encode_texts(none, path, pattern).count() == 0
    text = "it's a test 12ab,,  \n\n x" * 200 + "ü1" * 500
    assert np.concatenate([codec.encode_to_numpy(p) for p in bpe.pieces(text, 50)]).tolist() == codec.encode_ordinary(text)


def test_mixing_reaches_targets(docs, none):
    got = mixing.mix(docs).collect()
    assert len(got) == len(DOCS) and all(r.taken <= 2 * r.size and r.size == len(WORD.findall(next(t or "" for d, t, _, s in DOCS if d == r.doc_id and s == r.source))) for r in got)
    assert sorted(map(tuple, got), key=repr) == rows(mixing.mix(docs), *got[0].__fields__)
    for source in {r.source for r in got}:
        own = [r for r in got if r.source == source]
        assert own[0].source_size == sum(r.size for r in own) and own[0].target <= 2 * own[0].source_size
        assert abs(sum(r.taken for r in own) - own[0].target) <= max(r.size for r in own)
    assert math.isclose(sum({r.source: r.target for r in got}.values()), 1.5 * sum(r.size for r in got))
    assert mixing.mix(none).count() == 0
    assert mixing.mixed_rows(docs).columns == docs.columns


def test_language_id_on_held_out_documents(spark, docs, none):
    table = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = langid.train(table.where(~langid.held_out()))
    found = langid.predict(table.select("doc_id", "text"), model).join(table.select("doc_id", "lang"), "doc_id").where(langid.held_out())
    got = found.selectExpr("avg(cast(lang = lang_pred as int)) as share").first().share
    assert got > 0.95
    english, german = (table.where(f"lang = '{x}' and length(text) > 800").orderBy("doc_id").first().text[:600] for x in ("en", "de"))
    mixed = spark.createDataFrame([(1, english + " " + german)], "doc_id long, text string")
    spans = langid.predict(mixed, model).first().spans
    assert [s.lang for s in spans if s.letters > 100] == ["en", "de"] and abs(spans[0].end - 600) < 60
    by_id = {(r.doc_id, i): r for i, r in enumerate(langid.predict(docs, model).collect())}
    assert all((r.lang_pred == "und") == (r.doc_id in (2, 3, 4) or (r.doc_id is None and r.score == 0)) and 0 <= r.score <= 1 for r in by_id.values())
    assert langid.predict(none, model).count() == 0 and langid.train(none).languages == []
    assert {r.lang_pred for r in langid.predict(docs, langid.train(none)).collect()} == {"und"}


def test_viterbi_pays_for_changes():
    scores = np.array([[0, -1], [-1, 0], [0, -1], [-9, 0], [-9, 0]], dtype=np.float32)
    assert langid.viterbi(scores, np.zeros(5, dtype=int), 3.0).tolist() == [1, 1, 1, 1, 1] or langid.viterbi(scores, np.zeros(5, dtype=int), 3.0).tolist() == [0, 0, 0, 1, 1]
    best = max(((sum(scores[i, x] for i, x in enumerate(p)) - 3 * sum(a != b for a, b in zip(p, p[1:]))), p) for p in np.ndindex(2, 2, 2, 2, 2))
    assert tuple(langid.viterbi(scores, np.zeros(5, dtype=int), 3.0).tolist()) == best[1]


def test_warc_round_trip(spark, tmp_path):
    table = [(3, "u3", "<p>same</p>"), (1, "u1", "<p>same</p>"), (1, "u1", "<p>same</p>"), (2, None, None), (4, "a b\n", ""), (None, "n", "ü" * 3000), (5, "v", "only")]
    pages = spark.createDataFrame([(*r, "x") for r in table], "page_id long, url string, html string, payload string")
    got = rows(warc.read_archives(spark, warc.write_archives(pages, str(tmp_path / "a"))), "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    want = [(3, "revisit", 1), (1, "response", None), (1, "revisit", 1), (2, "response", None), (4, "revisit", 2), (None, "response", None), (5, "response", None)]
    size = lambda h: len((h or "").encode())
    assert got == sorted(((p, size(h), warc.digest((h or "").encode()), kind, ref) for (p, _, h), (_, kind, ref) in zip(table, want, strict=True)), key=repr)
    assert warc.read_archives(spark, warc.write_archives(pages, str(tmp_path / "b"), least=100)).where("record_type = 'revisit'").count() == 0
    assert warc.read_archives(spark, warc.write_archives(pages.where("false"), str(tmp_path / "c"))).count() == 0


def test_warc_reader_rejects_damage():
    good = warc.record(1, "u", b"payload", 7, warc.digest(b"payload"), None)
    assert warc.parse_record(good)["payload"] == b"payload"
    for bad in (good.replace(b"WARC/1.1", b"WARC/9"), good.replace(b"payload\r\n", b"payloax\r\n"), good[:-1], good.replace(b"WARC-Type", b"WARC-Kind"), good.replace(b"Content-Length: 7\r\n", b"Content-Length: 8\r\n")):
        with pytest.raises(ValueError):
            warc.parse_record(bad)
    with pytest.raises(ValueError):
        list(warc.frame_spans(memoryview(b"P*M\x18\x05\x00\x00\x00ab")))


def test_chat_prefix_tree(spark):
    tricky = "<|im_end|>\n<|im_start|>assistant\nx \\n \\ <\\| "
    table = [(1, 0, "user", "hi"), (1, 1, "assistant", tricky), (2, 0, "user", "hi"), (2, 1, "assistant", "other"), (3, 1, None, None), (3, None, "a\nb", "t"),
             (4, 0, "user", "hi"), (4, 1, "assistant", tricky), (None, 0, "assistant", "z"), (5, 0, "user", "hi"), (5, 0, "user", "hi"), (6, 0, "assistant", LONG)]
    given = spark.createDataFrame(table, "conv_id long, turn long, role string, text string")
    packs, members = chat.format_conversations(given, pack_chars=20)
    got = rows(members.join(chat.read_back(packs), "path"), "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256")
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    want = []
    for conv in {r[0] for r in table}:
        turns = sorted(((t is not None, t or 0, r or "", x or "") for c, t, r, x in table if c == conv))
        loss = "".join(x for *_, r, x in turns if r == "assistant")
        want.append((conv, len(turns), sha("".join(f"{r}\n{x}\n" for *_, r, x in turns)), len(loss), sha(loss)))
    assert got == sorted(want, key=repr)
    whole, _ = chat.format_conversations(given, pack_chars=10**6)
    pack = whole.first()
    assert pack.text.count("<|im_start|>user\nhi<|im_end|>") == 2 and all(n.attends[-1].end == n.end and n.position == sum(x.end - x.start for x in n.attends) - (n.end - n.start) for n in pack.nodes)
    assert chat.format_conversations(given.where("false"))[1].count() == 0


def test_licence_sentences(docs, none, spark):
    apache = "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this\n * file except in compliance with the License. You may obtain a copy of the License at\n\n http://www.apache.org/licenses/LICENSE-2.0"
    cases = [("words without end\nReleased under the MIT License.", ["MIT"]), (apache, ["Apache-2.0"]), ("SPDX-License-Identifier: ISC\n", ["ISC"]), ("No licence here.", []),
             ("This work is licensed under the GNU General Public License, version 3.\nAll rights reserved.", ["GPL-3.0-only", "Proprietary"])]
    found = licences.scan(spark.createDataFrame([(k, t) for k, (t, _) in enumerate(cases)], "doc_id long, text string")).orderBy("doc_id").collect()
    assert [r.licences for r in found] == [want for _, want in cases]
    assert all(licences.marked(v) for variants in licences.SENTENCES.values() for v in variants)
    assert licences.scan(docs).count() == len(DOCS) and licences.scan(none).count() == 0


GPL = """    {name} is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY; without even the implied warranty of
    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
    GNU General Public License for more details.

    You should have received a copy of the GNU General Public License{end}"""
NOTICES = {
    "GPL-3.0-or-later": """    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version.

""" + GPL.format(name="This program", end="\n    along with this program.  If not, see <https://www.gnu.org/licenses/>."),
    "GPL-2.0-or-later": """    This program is free software; you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation; either version 2 of the License, or
    (at your option) any later version.

""" + GPL.format(name="This program", end=" along\n    with this program; if not, write to the Free Software Foundation, Inc.,\n    51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA."),
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
}


def test_licence_notices_as_published():
    for name, notice in NOTICES.items():
        assert licences.licences(licences.sentence_ids(notice)[0]) == [name]
        commented = "\n".join(f" * {line}" if line else "" for line in notice.split("\n"))
        assert licences.licences(licences.sentence_ids(commented)[0]) == [name]
    ids = {name: licences.sentence_ids(notice)[0] for name, notice in NOTICES.items()}
    assert ids["MPL-2.0"][-1] == "mpl2-copy" and ids["GPL-3.0-or-later"][-1] == ids["GPL-2.0-or-later"][-1] == "gpl-copy"


def test_licence_runs_at_every_length_and_place():
    found = lambda text: licences.licences(licences.sentence_ids(text)[0])
    wrapped = "This work is licensed under the GNU General\nPublic License, version 3"
    for n in (1, 61, 62, 63, 64, 500, 20_000):
        entries = "\n".join(f"entry {k}" for k in range(n))
        assert found(f"{entries}\n{wrapped}") == found(f"{wrapped}\n{entries}") == found(f"{entries}\n{wrapped}\n{entries}") == ["GPL-3.0-only"]
    assert found("Released under the MIT License\nLicensed under CC BY 4.0") == ["MIT", "CC-BY-4.0"]
    assert found("SPDX-License-Identifier: MIT\nSPDX-License-Identifier: ISC\nAll rights reserved") == ["MIT", "ISC", "Proprietary"]
    assert found("Licensed under CC BY 4.0\nSPDX-License-Identifier: MIT") == ["CC-BY-4.0", "MIT"]


def test_every_licence_rule_is_met_by_its_own_sentences():
    for name, names in licences.RULES:
        for k in range(max(len(licences.SENTENCES[n]) for n in names)):
            variants = [licences.SENTENCES[n][k % len(licences.SENTENCES[n])] for n in names]
            assert licences.licences(licences.sentence_ids(". ".join(variants) + ".")[0]) == [name], (name, names)


def test_search_of_awkward_rows(docs, none):
    assert search.search(docs, docs.selectExpr("doc_id as query_id", "text")).count() > 0
    assert search.search(none, none.selectExpr("doc_id as query_id", "text")).count() == 0


def test_search_scores_every_word_of_a_query_text(spark):
    table = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    terms = {d: Counter(words_of(pa.array([t], pa.large_string()), True).hashes().view(np.int64).tolist()) for d, t in table}
    df = Counter(t for c in terms.values() for t in c)
    mean = sum(sum(c.values()) for c in terms.values()) / len(terms)
    idf = {t: math.log1p((len(terms) - n + 0.5) / (n + 0.5)) for t, n in df.items()}
    impact = {d: {t: int(np.rint(1e6 * idf[t] * n * 2.2 / (n + 1.2 * (0.25 + 0.75 * sum(c.values()) / mean)))) for t, n in c.items()} for d, c in terms.items()}
    got = {}
    for r in queries.op9_wand_top_k(spark, SMALL).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.doc_id, r.score))
    asked = [d for d in terms if d % 20 == 0]
    assert any(df[t] == 1 for q in asked for t in terms[q]) and max(len(terms[q]) for q in asked) > 100
    for q in asked:
        score = {d: sum(own[t] for t in terms[q] if t in own) for d, own in impact.items()}
        assert got.get(q, []) == [(d, s / 1e6) for d, s in sorted(score.items(), key=lambda x: (-x[1], x[0])) if s > 0][:10]


def segment_of(lists):
    return search.Segment(np.concatenate([d for d, _ in lists]), np.concatenate([v for _, v in lists]), np.array([len(d) for d, _ in lists]))


def test_wand_is_exact_with_few_and_many_lists_and_ties():
    rng = np.random.default_rng(6)
    for turn in range(60):
        lists = []
        for _ in range(rng.integers(1, 6) if turn % 2 else rng.integers(50, 200)):
            at = np.unique(rng.integers(0, 700, rng.integers(1, [40, 400, 700][turn % 3]))).astype(np.int64)
            lists.append((at, rng.integers(1, 3 + 2000 // len(at), len(at)).astype(np.int64)))
        asked = np.sort(rng.choice(len(lists), rng.integers(1, len(lists) + 1), replace=False))
        total = Counter()
        for t in asked:
            for d, v in zip(*(x.tolist() for x in lists[t]), strict=True):
                total[d] += v
        for k in (1, 7, 2000):
            assert segment_of(lists).wand(asked, k) == sorted(((v, d) for d, v in total.items()), key=lambda x: (-x[0], x[1]))[:k]
    assert segment_of(lists).wand(np.zeros(0, dtype=np.int64), 3) == []


def test_wand_skips_blocks_that_cannot_reach_the_floor():
    """Most of the impact lies in few docs: most blocks are never read, and what is read decides the same as everything."""
    rng, seen = np.random.default_rng(7), {}
    strong = np.sort(rng.choice(20_000, 60, replace=False))
    lists = [(at := np.unique(np.append(rng.choice(20_000, 300), strong)), np.where(np.isin(at, strong), 900, 10) + rng.integers(0, 9, len(at))) for _ in range(40)]
    total = np.zeros(20_000, dtype=np.int64)
    for at, impact in lists:
        total[at] += impact
    assert segment_of(lists).wand(np.arange(40), 10, seen) == [(int(total[d]), int(d)) for d in np.lexsort((np.arange(20_000), -total))[:10]]
    assert seen["skipped"] > 10 * seen["scored"] > 0


def test_wand_of_many_queries_keeps_their_best_from_segment_to_segment():
    """Segments before raise the floor of those behind; ties go by doc_id, null last, wherever the docs are."""
    rng, best, totals, seen = np.random.default_rng(8), search.Best(70, 5), [Counter() for _ in range(70)], {}
    asked = [np.sort(rng.choice(90, rng.integers(0, 60), replace=False)) for _ in range(70)]
    bounds, terms = np.append(0, np.cumsum([len(t) for t in asked])), np.concatenate(asked)
    for turn, block in enumerate((16, 512, 16, 512)):
        n, strength = 700, [3000, 2, 2, 3000][turn]
        lists = [(at := np.unique(rng.integers(0, n, rng.integers(1, [400, 30][k % 2]))), rng.integers(1, strength, len(at))) for k in range(90)]
        ids, unknown = 4 * rng.permutation(n) + turn, rng.random(n) < 0.1
        one = search.Segment(np.concatenate([d for d, _ in lists]), np.concatenate([v for _, v in lists]), np.array([len(d) for d, _ in lists]), block, ids, unknown)
        before = dict(seen)
        one.wand_all(bounds, terms, best, seen)
        assert turn != 2 or seen["scored"] == before["scored"]
        for total, own in zip(totals, asked, strict=True):
            for t in own:
                for d, v in zip(*(x.tolist() for x in lists[t]), strict=True):
                    total[(bool(unknown[d]), int(ids[d]))] += v
    for q, total in enumerate(totals):
        expected = sorted(((-v, *d) for d, v in total.items()))[:5]
        assert [(-s, u, d) for s, u, d in zip(best.scores[q], best.unknown[q], best.ids[q], strict=True) if s] == expected


def test_masked_lm_beats_word_frequencies(spark, docs, none, tmp_path):
    table = spark.read.parquet(f"{SMALL.replace('sf0.001', 'sf0.01')}/documents.parquet")
    words = masked_lm.vocabulary(table, str(tmp_path))
    encoded = masked_lm.encode(table, words).collect()
    inside = sum(r.inside for r in encoded)
    share = np.bincount(np.frombuffer(b"".join(r.tokens for r in encoded), dtype=np.uint8), minlength=masked_lm.CLASSES)
    plain = float((share[share > 0] * np.log(share[share > 0] / share.sum())).sum()) + inside
    got = masked_lm.pseudo_likelihood(table).selectExpr("sum(pll) as pll").first().pll
    assert got > plain
    assert len(masked_lm.pseudo_likelihood(docs).collect()) == len(DOCS) and masked_lm.pseudo_likelihood(none).count() == 0


def test_masked_lm_scores_equal_the_formula(spark, tmp_path):
    """Plain Python over words and counts: class by softmax of the tanh of the embeddings beside, word by its share of the class."""
    texts = ["the cat sat on the mat", "a cat", "The mat the mat the mat", None, "", "one"] * 9
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    words = masked_lm.vocabulary(table, str(tmp_path))
    encoded = masked_lm.encode(table, words)
    model = masked_lm.train(encoded, str(tmp_path))
    hashed = lambda w: int(words_of(pa.array([w], pa.large_string())).hashes()[0])
    count = Counter(hashed(w) for t in texts for w in (t or "").lower().split())
    frequent = [w for w, _ in sorted(count.items(), key=lambda x: (-x[1], x[0] - (1 << 64) if x[0] >> 63 else x[0]))][:masked_lm.TOP]
    assert [int(w) for w in words.frequent] == frequent
    got = {r.doc_id: (r.n_tokens, r.pll) for r in masked_lm.score(encoded, model).collect()}
    for k, t in enumerate(texts):
        line = [0, 0, *[1 + frequent.index(hashed(w)) for w in (t or "").lower().split()], 0, 0]
        total = 0.0
        for i in range(2, len(line) - 2):
            hidden = np.tanh(model.bias + sum(model.into[p][line[i + at]] for p, at in enumerate(masked_lm.PLACES)))
            logits = hidden @ model.out + model.prior
            total += logits[line[i]] - np.log(np.exp(logits).sum())
        assert got[k][0] == len(line) - 4 and math.isclose(got[k][1], total, rel_tol=1e-4, abs_tol=1e-4)


def test_masked_lm_tells_order_and_rare_words_from_a_real_text(spark):
    rng = np.random.default_rng(12)
    table = spark.read.parquet(f"{SMALL.replace('sf0.001', 'sf0.01')}/documents.parquet").where("length(text) > 400 and lang = 'en'").select("text").limit(300)
    texts = [r.text for r in table.collect()]
    shuffled = [" ".join(rng.permutation(t.split())) for t in texts[:40]]
    rare = [" ".join(w if rng.random() < 0.5 else f"q{rng.integers(1 << 40):x}" for w in t.split()) for t in texts[:40]]
    rows_ = [*enumerate(texts), *enumerate(shuffled, 1000), *enumerate(rare, 2000)]
    got = {r.doc_id: r.pll_mean for r in masked_lm.pseudo_likelihood(spark.createDataFrame(rows_, "doc_id long, text string").repartition(4)).collect()}
    # By chance alone 30 of 40 come out in less than one of 500 runs.
    assert sum(got[k] > got[k + 1000] for k in range(40)) >= 30 and all(got[k] > got[k + 2000] for k in range(40))


def test_masked_lm_trains_on_every_token(spark, tmp_path):
    """The words at one place in five of a text are not all that the network learns."""
    text = " ".join("x" if k in (0, 5, 10) else "y" for k in range(16))
    table = spark.createDataFrame([(k, text) for k in range(50)], "doc_id long, text string").coalesce(1)
    encoded = masked_lm.encode(table, masked_lm.vocabulary(table, str(tmp_path)))
    line = np.frombuffer(bytes(2) + encoded.first().tokens + bytes(2), dtype=np.uint8).astype(np.intp)
    logs = masked_lm.train(encoded, str(tmp_path)).log_probability(line, np.arange(2, 18), masked_lm.Room())
    assert logs.min() > -np.log(masked_lm.CLASSES)


def test_masked_lm_counts_every_word_by_itself(spark, tmp_path, monkeypatch):
    """Words whose hashes agree in their last 20 bits have counts of their own, carried or joined; a text that occurs twice scores above one of as rare words."""
    seen, pair = {}, None
    for k in range(20_000):
        name = f"w{k}"
        bits = int(words_of(pa.array([name], pa.large_string())).hashes()[0]) % (1 << 20)
        if bits in seen:
            pair = seen[bits], name
            break
        seen[bits] = name
    common = " ".join(f"c{k} " * 40 for k in range(masked_lm.TOP))
    texts = [common, " ".join([pair[0]] * 30), pair[1], *[" ".join(f"t{k}x{i}" for i in range(30)) for k in range(20)] * 2, *[" ".join(f"o{k}x{i}" for i in range(30)) for k in range(20)], None, ""]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    count = Counter(w for t in texts for w in (t or "").split())
    hashed = {w: int(words_of(pa.array([w], pa.large_string())).hashes()[0]) for w in count}
    frequent = {w for w in count if w[0] == "c"}
    total, kinds = Counter(), Counter()
    for w in count.keys() - frequent:
        total[hashed[w] % masked_lm.HASHED] += count[w]
        kinds[hashed[w] % masked_lm.HASHED] += 1
    log = lambda w: 0 if w in frequent else math.log((count[w] - 0.5) / (total[hashed[w] % masked_lm.HASHED] - 1 + 0.5 * kinds[hashed[w] % masked_lm.HASHED]))
    for carried in (masked_lm.CARRIED, 700, 0):
        monkeypatch.setattr(masked_lm, "CARRIED", carried)
        words = masked_lm.vocabulary(table, str(tmp_path / str(carried)))
        assert len(words.carried) + words.rest.count() == len(count) - masked_lm.TOP and len(words.carried) <= carried
        got = {r.doc_id: r.inside for r in masked_lm.encode(table, words).collect()}
        assert all(math.isclose(got[k], sum(map(log, (t or "").split())), rel_tol=1e-9, abs_tol=1e-9) for k, t in enumerate(texts))
    assert not math.isclose(log(pair[0]), log(pair[1]), abs_tol=1)
    score = {r.doc_id: r.pll_mean for r in masked_lm.pseudo_likelihood(table).collect()}
    assert min(score[k] for k in range(3, 43)) > max(score[k] for k in range(43, 63))


@pytest.mark.parametrize("scale", [1, 400])
def test_descent_follows_the_plain_gradient(scale):
    """One-hot matrices and a shifted softmax give the same gradients, with small weights and with ones that need the shift."""
    rng = np.random.default_rng(1)
    line = np.concatenate([np.zeros(2), rng.integers(1, masked_lm.CLASSES, 900), np.zeros(2)]).astype(np.intp)
    at = np.arange(2, 902)
    model = masked_lm.Network.fresh()
    model.out *= scale
    into, out = model.into.astype(np.float64), model.out.astype(np.float64)
    hidden = np.tanh(model.bias + sum(into[p][line[at + k]] for p, k in enumerate(masked_lm.PLACES)))
    logits = hidden @ out + model.prior
    slope = np.exp(logits - logits.max(axis=1, keepdims=True))
    slope /= slope.sum(axis=1, keepdims=True)
    logs = logits[np.arange(900), line[at]] - logits.max(axis=1) - np.log(np.exp(logits - logits.max(axis=1, keepdims=True)).sum(axis=1))
    assert np.allclose(model.log_probability(line, at, masked_lm.Room()), logs, rtol=1e-3, atol=1e-3)
    slope[np.arange(900), line[at]] -= 1
    slope /= 900
    back = (slope @ out.T) * (1 - hidden * hidden)
    squares = [np.zeros_like(x) for x in (model.into, model.bias, model.out, model.prior)]
    model.descend(line, at, squares, masked_lm.Room())
    want = [np.stack([np.eye(masked_lm.CLASSES)[line[at + k]].T @ back for k in masked_lm.PLACES]), back.sum(axis=0), hidden.T @ slope, slope.sum(axis=0)]
    for got, grad in zip(squares, want, strict=True):
        assert np.allclose(np.sqrt(got), np.abs(grad), rtol=1e-3, atol=1e-5 * scale)


def test_bpe_takes_long_white_space(spark):
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    codec = bpe.encoding(path, pattern)
    for size in (50_000, 65_536, 65_537, 200_000):
        for text in ("a" + " " * size + "b", " " * size, "x1" + "\n \t" * (size // 3) + "\u3000.", " " * size + "\n" + "q " * 9, "w " * size, "\n" * size + " " * size):
            assert bpe.encode(codec, text).tolist() == codec.encode_ordinary(text)
    wide = spark.createDataFrame([(1, "a" + " " * 3_000_000 + "b" + "\n" * 2_000_000)], "doc_id long, text string")
    got = bpe.decode_ids(bpe.encode_texts(wide, path, pattern), path, pattern).first().decoded
    assert bytes(got).decode() == wide.first().text


def test_letters_are_those_of_unicode():
    import unicodedata

    for low in range(0, 0x110000, 0x1000):
        marks = [chr(c) for c in range(low, low + 0x1000) if not 0xD800 <= c < 0xE000]
        runs = langid.letter_runs([f" {c} " for c in marks])
        spelt = set(runs.text.tolist())
        assert [k in spelt for k in range(len(marks))] == [any(unicodedata.category(x)[0] == "L" for x in c.lower()) for c in marks]


def test_wrapped_marks_expressions_and_further_notices():
    found = lambda text: licences.licences(licences.sentence_ids(text)[0])
    assert found("All rights\nreserved.") == ["Proprietary"] and found("// This is free and unencumbered software released into the public\n// domain.") == ["Unlicense"]
    tag = "SPDX-License-Identifier: "
    assert found(f"# {tag}MIT OR Apache-2.0\ncode") == ["MIT", "Apache-2.0"] and found(f"/* {tag}(MIT AND ISC) */") == ["MIT", "ISC"]
    assert found(f"{tag}GPL-2.0-only WITH Classpath-exception-2.0") == ["GPL-2.0-only WITH Classpath-exception-2.0"]
    assert found(f"{tag}(LGPL-2.1-only or (MIT and BSD-3-Clause)).") == ["LGPL-2.1-only", "MIT", "BSD-3-Clause"]
    assert found("Copyright 2021 The Authors All rights reserved.") == ["Proprietary"]
    assert found("GNU LESSER GENERAL PUBLIC LICENSE\n   Version 2.1, February 1999\n\nPreamble") == ["LGPL-2.1-only"]
    assert found("accept cc everything under the public road and the domain") == []


def test_index_packs_terms_and_cells_join_segments(spark, monkeypatch):
    docs = spark.createDataFrame([(59 - i, f"word{i % 7} word{i % 5} common only{i}") for i in range(60)], "doc_id long, text string").repartition(6, "doc_id").cache()
    # Every segment has a row of doc ids and one of lists.
    assert search.build_index(docs).count() <= 12
    asked = docs.where("doc_id % 4 = 0").selectExpr("doc_id as query_id", "text")
    found = lambda: sorted(tuple(r) for r in search.search(docs, asked, k=5).collect())
    whole = found()
    monkeypatch.setattr(search, "CELL_WORDS", 1)
    monkeypatch.setattr(search, "PACKED", 3)
    assert len(whole) == 15 * 5 and found() == whole
