"""How the sources of a language differ: distances between their term shares, and the terms each source has too much of.

A term's excess in a group falls with its count in the language and rises with its count in the group, and ties go to the
earlier term. So a term that k others dominate (at least its group count, at most its language count, earlier in UTF-8) is not
among the first k. Every partition keeps the k-skyband of its own terms for each group, those with fewer than k dominators;
skybands of partitions are merged to the skyband of their union, and only what is left is ranked, exactly.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from schedlytics.llm.tables import blocks, small_batches, staged, text_column
from schedlytics.llm.terms import LETTERS, terms_of
from schedlytics.session import work_dir

# A share in thousand millionths is 1 + floor(SCALE * (count + 5) / (N + 5 * V)).
SCALE, PRIOR = 1_000_000_000, 5
# Rows of a group that are held before they are reduced to their skyband, and rows of a group that meet in one merge.
HELD_ROWS, MERGE_ROWS = 8_192, 50_000
COUNTS = "lang string, source string, term string, n long, docs long"
BAND = "lang string, source string, term string, n long, lang_n long"


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and rows with the term, summed by block; a row without term for each group."""

    def run(batches):
        for batch in batches:
            texts = text_column(batch, "text")
            langs, sources = (pc.dictionary_encode(text_column(batch, c)) for c in ("lang", "source"))
            wide = max(1, len(sources.dictionary))
            group = langs.indices.to_numpy().astype(np.int64) * wide + sources.indices.to_numpy()
            shown = lambda g, term, n, docs: pa.RecordBatch.from_arrays(
                [langs.dictionary.take(pa.array(g // wide)).cast(pa.string()), sources.dictionary.take(pa.array(g % wide)).cast(pa.string()), term, pa.array(n), pa.array(docs)],
                ["lang", "source", "term", "n", "docs"])
            there = np.unique(group)
            yield shown(there, pa.nulls(len(there), pa.string()), np.zeros(len(there), np.int64), np.zeros(len(there), np.int64))
            for low, high in blocks(texts, 1 << 23):
                terms = terms_of(texts.slice(low, high - low), LETTERS)
                if not len(terms.strings):
                    continue
                coded = pc.dictionary_encode(terms.strings)
                many = len(coded.dictionary)
                # Terms of a text first, then of a group.
                at, n = np.unique(terms.text * many + coded.indices.to_numpy(), return_counts=True)
                cell, own = np.unique(group[low:high][at // many] * many + at % many, return_inverse=True)
                yield shown(cell // many, coded.dictionary.take(pa.array(cell % many)).cast(pa.string()), np.bincount(own, n).astype(np.int64), np.bincount(own))

    return docs.select(*[F.col(c).cast("string").alias(c) for c in ("text", "lang", "source")]).mapInArrow(run, COUNTS)


def skyband(n: np.ndarray, lang_n: np.ndarray, place: np.ndarray, k: int) -> np.ndarray:
    """Which points have fewer than ``k`` dominators: at least their ``n``, at most their ``lang_n``, and a smaller ``place``.

    In the order of n every dominator comes first. Dominators of a dropped point dominate what it does, so that comparing with
    the points kept so far is enough.
    """
    order = np.lexsort((place, lang_n, -n))
    lang_n, place = lang_n[order], place[order]
    kept = np.zeros(0, dtype=np.int64)
    for low in range(0, len(order), 256):
        block = np.arange(low, min(low + 256, len(order)))
        over = np.zeros(len(block), dtype=np.int64)
        for part in (*np.array_split(kept, len(kept) // 4096 + 1), block):
            open_ = np.flatnonzero(over < k)
            mine = block[open_, None]
            over[open_] += ((lang_n[part] <= lang_n[mine]) & (place[part] < place[mine]) & (part < mine)).sum(axis=1)
        kept = np.append(kept, block[over < k])
    return order[kept]


def _reduced(cells: pa.Table, k: int) -> pa.Table:
    place = pc.rank(cells["term"].combine_chunks(), sort_keys="ascending", tiebreaker="first").to_numpy()
    return cells.take(pa.array(np.sort(skyband(cells["n"].to_numpy(), cells["lang_n"].to_numpy(), place, k))))


def local_skybands(rows: DataFrame, k: int) -> DataFrame:
    """The k-skyband of each (lang, source) over its rows of each partition; a group is reduced whenever it has gathered enough."""

    def run(batches):
        groups: dict[tuple[str, str], tuple[list[pa.Table], int, int]] = {}
        for batch in batches:
            table = pa.Table.from_batches([batch])
            keys = pc.dictionary_encode(pc.binary_join_element_wise(table["lang"], table["source"], "\0")).combine_chunks()
            order = np.argsort(keys.indices.to_numpy(), kind="stable")
            edges = np.flatnonzero(np.diff(keys.indices.to_numpy()[order], prepend=-1))
            for own in np.split(order, edges[1:]):
                if not len(own):
                    continue
                part = table.take(pa.array(own))
                name = (part["lang"][0].as_py(), part["source"][0].as_py())
                held, size, limit = groups.get(name, ([], 0, HELD_ROWS))
                held, size = [*held, part], size + len(own)
                if size > limit:
                    band = _reduced(pa.concat_tables(held), k)
                    held, size, limit = [band], len(band), 2 * len(band) + HELD_ROWS
                groups[name] = held, size, limit
        for held, _, _ in groups.values():
            yield from _reduced(pa.concat_tables(held), k).combine_chunks().to_batches()

    return rows.select(*[c.split()[0] for c in BAND.split(", ")]).mapInArrow(run, BAND)


def share(n: str, total: str, terms: str) -> Column:
    """1 + floor(SCALE * (n + 5) / (total + 5 * terms)), exact in decimals."""
    return F.expr(f"CAST(1 + (CAST({SCALE} AS DECIMAL(10, 0)) * CAST({n} + {PRIOR} AS DECIMAL(20, 0))) div CAST({total} + {PRIOR} * {terms} AS DECIMAL(20, 0)) AS BIGINT)")


def shares(n: np.ndarray, total: np.ndarray | int) -> np.ndarray:
    """``share`` of arrays, ``total`` with its prior: SCALE / total by long division, three digits at a time, exact below 9e15."""
    whole, rest = np.divmod(n + PRIOR, total)
    for _ in range(3):
        digits, rest = np.divmod(rest * 1000, total)
        whole = whole * 1000 + digits
    return whole + 1


def _distances(kept: DataFrame, totals: dict[str, tuple[list[str], np.ndarray]]) -> DataFrame:
    """(lang, source, item, value): summed differences of shares over all kept terms, for each pair of sources in code point order."""

    def run(batches):
        sums = {lang: np.zeros((len(names),) * 2, dtype=np.int64) for lang, (names, _) in totals.items()}
        column = {lang: {s: i for i, s in enumerate(names)} for lang, (names, _) in totals.items()}
        for batch in batches:
            langs, uses = np.array(batch.column("lang").to_pylist(), dtype=object), batch.column("uses")
            row = np.repeat(np.arange(len(langs)), pc.list_value_length(uses).to_numpy())
            flat = uses.flatten()
            sources, n = np.array(flat.field("source").to_pylist(), dtype=object), flat.field("n").to_numpy()
            for lang in set(langs.tolist()):
                mine, (names, total) = np.flatnonzero(langs == lang), totals[lang]
                cells = np.repeat(shares(np.zeros(len(names), dtype=np.int64), total)[None], len(mine), axis=0)
                at = np.flatnonzero(langs[row] == lang)
                where = np.array([column[lang][s] for s in sources[at].tolist()], dtype=np.int64)
                cells[np.searchsorted(mine, row[at]), where] = shares(n[at], total[where])
                for i in range(len(names)):
                    sums[lang][i] += np.abs(cells - cells[:, i:i + 1]).sum(axis=0)
        for lang, (names, _) in totals.items():
            i, j = np.nonzero(np.triu(sums[lang], 1))
            named = np.array(names, dtype=object)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(i), pa.string()), pa.array(named[i], pa.string()), pa.array(named[j], pa.string()), pa.array(sums[lang][i, j])], ["lang", "source", "item", "value"])

    return kept.select("lang", "uses").mapInArrow(run, "lang string, source string, item string, value long").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def divergence(docs: DataFrame, least_docs: int = 30, k: int = 50, folder: str | None = None) -> DataFrame:
    """(lang, source, part, item, value, rank) of all sources of ``docs`` (text, lang, source).

    A language keeps the terms in at least ``least_docs`` of its rows. Part ``pair``: each other source of the language, by the
    summed difference of shares over its kept terms (0 without any). Part ``term``: the ``k`` kept terms of the source whose share
    exceeds that in the language most. Ranks count from 1, ties by UTF-8. Null text, lang or source: an empty one. Repeated rows
    count each; a group whose texts have no term takes part with counts of 0. An empty table gives no rows. The driver reads one
    row per (lang, source); the result has the square of a language's sources.
    """
    small_batches(docs.sparkSession)
    folder = folder or work_dir(docs.sparkSession)
    counts = staged(term_counts(docs).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "counts", folder)
    kept = counts.where("term is not null").groupBy("lang", "term").agg(
        F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("uses")).where(F.col("docs") >= least_docs)
    kept = staged(kept.drop("docs"), "kept", folder)
    uses = kept.select("lang", "term", "lang_n", F.explode("uses").alias("use")).select("lang", "use.source", "term", "use.n", "lang_n")
    sized = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("lang_n").alias("lang_total"))
    totals = (counts.select("lang", "source").distinct().join(uses.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left")
              .join(sized, "lang", "left").fillna(0, ["total", "terms", "lang_total"]))
    totals = staged(totals, "totals", folder)

    bands = staged(local_skybands(uses, k), "bands", folder)
    largest = bands.groupBy("lang", "source").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    slot = F.pmod(F.xxhash64("term"), F.lit(-(-largest // MERGE_ROWS) or 1))
    merged = local_skybands(bands.repartition("lang", "source", slot), k)
    excess = merged.join(totals, ["lang", "source"]).withColumn("value", share("n", "total", "terms") - share("lang_n", "lang_total", "terms"))
    ranked = lambda item: F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.col(item)))
    terms = excess.where("value > 0").withColumn("rank", ranked("term")).where(F.col("rank") <= k)

    known: dict[str, tuple[list[str], np.ndarray]] = {}
    for r in totals.where("terms > 0").orderBy("lang", "source").collect():
        names, sums = known.setdefault(r.lang, ([], []))
        names.append(r.source)
        sums.append(r.total + PRIOR * r.terms)
    known = {lang: (names, np.array(sums, dtype=np.int64)) for lang, (names, sums) in known.items()}
    half = staged(_distances(kept, known), "distances", folder)
    both = half.unionByName(half.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))
    names = totals.select("lang", "source")
    pairs = names.join(names.select("lang", F.col("source").alias("item")), "lang").where("source <> item").join(both, ["lang", "source", "item"], "left")
    pairs = pairs.fillna(0, ["value"]).withColumn("rank", ranked("item"))
    shown = lambda df, part, item: df.select("lang", "source", F.lit(part).alias("part"), F.col(item).alias("item"), "value", F.col("rank").cast("int").alias("rank"))
    return shown(pairs, "pair", "item").unionByName(shown(terms, "term", "term"))


CUT = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
DIVERGENCE_SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source, {CUT} AS terms FROM documents),
uses AS (SELECT doc, lang, source, unnest(terms) AS term FROM docs),
names AS (SELECT DISTINCT lang, source FROM docs),
kept AS (SELECT lang, term, count(*) AS n FROM uses GROUP BY lang, term HAVING count(DISTINCT doc) >= 30),
sized AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
counted AS (SELECT lang, source, term, count(*) AS n FROM uses GROUP BY lang, source, term),
cells AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.n AS lang_n
  FROM names AS g JOIN kept AS k ON g.lang = k.lang LEFT JOIN counted AS c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
shares AS (
  SELECT c.lang, source, term, n, 1 + (CAST(1000000000 AS HUGEINT) * (n + 5)) // (sum(n) OVER (PARTITION BY c.lang, source) + 5 * v) AS p,
         1 + (CAST(1000000000 AS HUGEINT) * (lang_n + 5)) // (total + 5 * v) AS q
  FROM cells AS c JOIN sized AS s ON c.lang = s.lang),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(value, 0) AS value
  FROM names AS a JOIN names AS b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value FROM shares AS x JOIN shares AS y ON x.lang = y.lang AND x.term = y.term GROUP BY 1, 2, 3) AS d
    ON d.lang = a.lang AND d.source = a.source AND d.item = b.source),
result AS (
  SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM pairs
  UNION ALL
  SELECT * FROM (SELECT lang, source, 'term', term, p - q, row_number() OVER (PARTITION BY lang, source ORDER BY p - q DESC, term) AS place FROM shares WHERE n > 0 AND p > q) AS t WHERE place <= 50)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM result
"""
