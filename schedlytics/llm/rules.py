"""Quality rules on whole texts: base statistics as column expressions, and a decision list learned from labelled statistics.

The list is grown by sequential covering. A rule is a conjunction of thresholds on per-word ratios; it grows on two thirds of the
labelled rows by information gain, loses its last conditions where the other third is better without them, and is taken if it is
precise on both. What it covers is removed and the next rule is looked for. The result is an ordered conditional expression.
Everything runs as DataFrame expressions; the driver sees histograms of a fixed size.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from schedlytics.llm.tables import staged

SPACES = " \t\n\x0b\f\r"
WINDOW = 5
# Labelled rows that the list is learned from at most; their ids are broadcast.
LABEL_ROWS = 20_000
# The characters that count as symbols.
SYMBOLS = "#*$%&|<>"
# Learned features: how many of something there are for 1000 words.
FEATURES = {
    "word_length": "word_chars * 1000 div n_words",
    "symbols": "n_symbols * 1000 div n_words",
    "shouts": "n_shouts * 1000 div n_words",
    "repeats": "n_repeat_words * 1000 div n_words",
    "dup_lines": "n_dup_lines * 1000 div n_words",
    "words": "n_words",
}


def _without(text: Column, chars: str) -> Column:
    for c in chars:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def _with_repeats(df: DataFrame) -> DataFrame:
    """n_repeat_words from the hashes of a text's windows: sort (hash, position), keep equal neighbours, join their spans.

    Each step is a column of its own, as it is read several times; all stay null for a text whose windows differ.
    """
    pairs = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = df.withColumn("pairs", F.when(F.size(F.array_distinct("windows")) < F.size("windows"), pairs)).drop("windows")
    none = F.array(F.lit(None).cast("struct<h:bigint,i:int>"))
    trio = F.arrays_zip(F.col("pairs").alias("own"), F.concat(none, "pairs").alias("before"), F.slice("pairs", 2, 1 << 30).alias("after"))
    repeated = F.filter(trio, lambda x: x["own"].isNotNull() & (x["own"]["h"].eqNullSafe(x["before"]["h"]) | x["own"]["h"].eqNullSafe(x["after"]["h"])))
    df = df.withColumn("places", F.sort_array(F.transform(repeated, lambda x: x["own"]["i"]))).drop("pairs")
    steps = F.arrays_zip(F.col("places").alias("here"), F.slice("places", 2, 1 << 30).alias("next"))
    spans = F.aggregate(steps, F.lit(0).cast("long"), lambda total, x: total + F.least(F.lit(WINDOW), F.coalesce(x["next"] - x["here"], F.lit(WINDOW))))
    return df.withColumn("n_repeat_words", F.coalesce(spans, F.lit(0).cast("long"))).drop("places")


def text_stats(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the columns ``keep`` and the statistics of each whole text; a null text has no words. Other columns are not read.

    Windows are compared by the 64-bit hash of their words. Positions are only sorted for texts in which a window repeats.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    df = docs.select("doc_id", *keep, text.alias("text"))
    trimmed = F.btrim("text", F.lit(SPACES))
    df = df.select("doc_id", *keep, "text", F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, "[\\x20\\x09-\\x0D]+")).alias("words"))
    lines = F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    df = df.select("doc_id", *keep, "text", "words", lines.alias("lines"), F.transform("words", lambda x: F.xxhash64(x)).alias("hashes"))
    window = F.transform("hashes", lambda x, i: F.xxhash64(x, *[F.get("hashes", i + k) for k in range(1, WINDOW)]))
    windows = F.slice(window, F.lit(1), F.greatest(F.size("hashes") - (WINDOW - 1), F.lit(0)))
    df = df.select("doc_id", *keep, "text", "words", "lines", windows.alias("windows"))
    count = lambda chars: (F.octet_length("text") - F.octet_length(_without(F.col("text"), chars))).cast("long")
    df = df.select(
        "doc_id", *keep, F.size("words").cast("long").alias("n_words"), F.length(F.array_join("words", "")).cast("long").alias("word_chars"), count(SYMBOLS).alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"), count("!").alias("n_shouts"), "windows",
    )
    return _with_repeats(df).withColumn("base_failed", F.expr("n_words < 10 or 100 * n_repeat_words > 20 * n_words"))


@dataclass
class DecisionList:
    """Ordered rules, each a list of (feature, at_least, threshold); the first that holds names the verdict."""

    rules: list[list[tuple[str, bool, int]]] = field(default_factory=list)

    @staticmethod
    def holds(rule: list[tuple[str, bool, int]]) -> Column:
        out = F.lit(True)
        for name, at_least, value in rule:
            out = out & (F.expr(FEATURES[name]) >= value if at_least else F.expr(FEATURES[name]) < value)
        return out

    def verdict(self) -> Column:
        """The name of the first rule that holds, else null."""
        out = F.lit(None).cast("string")
        for k, rule in reversed(list(enumerate(self.rules, 1))):
            text = " and ".join(f"{name} {'>=' if at_least else '<'} {value}" for name, at_least, value in rule)
            out = F.when(self.holds(rule), F.lit(f"{k}: {text}")).otherwise(out)
        return out


def _reached(feature: str):
    return lambda cut: cut <= F.expr(feature)


def _gain(p: float, n: float, all_p: float, all_n: float) -> float:
    return p * (math.log2(p / (p + n)) - math.log2(all_p / (all_p + all_n))) if p else 0.0


def learn_list(labelled: DataFrame, cuts: int = 24, conditions: int = 4, rules: int = 8, precision: float = 0.95, least: int = 3) -> DecisionList:
    """Learn rules for bad rows from statistics with columns ``bad`` (boolean) and ``doc_id``; base-failed rows are left out.

    ``cuts`` thresholds per feature lie at quantiles of the bad and of the good rows. A rule covers at least ``least`` bad
    rows and is ``precision`` pure. Without labelled rows of both kinds the list is empty.
    """
    rows = labelled.where("not base_failed").withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(3)))
    share = [k / (cuts + 1) for k in range(1, cuts + 1)]
    found = rows.groupBy("bad").agg(*[F.percentile_approx(F.expr(v), share, 1000).alias(k) for k, v in FEATURES.items()]).collect()
    values = {k: sorted({int(x) + up for r in found for x in r[k] or [] for up in (0, 1)}) for k in FEATURES}
    if len(found) < 2:
        return DecisionList()
    bins = F.array(*[F.size(F.filter(F.array(*[F.lit(x).cast("long") for x in values[k]]), _reached(v))) for k, v in FEATURES.items()])
    rows = staged(rows.withColumn("bins", bins), "labelled")
    good, bad = F.count_if(~F.col("bad")), F.count_if(F.col("bad"))
    out = DecisionList()
    left = rows
    while len(out.rules) < rules:
        rule: list[tuple[str, bool, int]] = []
        while len(rule) < conditions:
            inside = left.where((F.col("part") < 2) & out.holds(rule))
            cells = inside.select("bad", F.posexplode("bins").alias("feature", "bin")).groupBy("feature", "bin").agg(bad.alias("p"), good.alias("n")).collect()
            sums: dict[int, dict[int, tuple[int, int]]] = {}
            for r in cells:
                sums.setdefault(r.feature, {})[r.bin] = (r.p, r.n)
            total = [sum(x[k] for x in sums.get(0, {}).values()) for k in (0, 1)]
            if total[0] < least or (rule and total[1] == 0):
                break
            best = (0.0, "", False, 0, (0, 0))
            for k, name in enumerate(FEATURES):
                low = [0, 0]
                for b, value in enumerate(values[name]):
                    cell = sums[k].get(b, (0, 0))
                    low = [low[0] + cell[0], low[1] + cell[1]]
                    for at_least, (p, n) in ((True, (total[0] - low[0], total[1] - low[1])), (False, tuple(low))):
                        if p >= least and p + n < sum(total) and (gain := _gain(p, n, *total)) > best[0] + 1e-9:
                            best = (gain, name, at_least, value, (p, n))
            if not best[1]:
                break
            rule.append(best[1:4])
            if best[4][1] == 0:
                break
        if not rule:
            break
        prefixes = [rule[:k] for k in range(1, len(rule) + 1)]
        measured = left.agg(*[F.count_if(out.holds(p) & F.col("bad") & t).alias(f"p{i}_{j}") for i, p in enumerate(prefixes) for j, t in enumerate((F.lit(True), F.col("part") == 2))],
                            *[F.count_if(out.holds(p) & ~F.col("bad") & t).alias(f"n{i}_{j}") for i, p in enumerate(prefixes) for j, t in enumerate((F.lit(True), F.col("part") == 2))]).first()
        worth = lambda i: (measured[f"p{i}_1"] - measured[f"n{i}_1"]) / max(1, measured[f"p{i}_1"] + measured[f"n{i}_1"])
        keep = max(range(len(prefixes)), key=lambda i: (worth(i), -i))
        p, n = measured[f"p{keep}_0"], measured[f"n{keep}_0"]
        if p < least or p < precision * (p + n):
            break
        out.rules.append(prefixes[keep])
        left = left.where(~out.holds(prefixes[keep]))
    return out


def learned_rules(docs: DataFrame, labels: DataFrame) -> DecisionList:
    """Learn from the rows of ``docs`` with a label; of the labels, the ``LABEL_ROWS`` first by a hash of the id are used.

    Null ids and qualities are ignored; of several labels of one id the lowest holds.
    """
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg((F.min("quality") < 1).alias("bad"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(LABEL_ROWS)
    rows = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
    return learn_list(staged(text_stats(rows, ("bad",)), "labelled_stats"))


def quality_rules(docs: DataFrame, labels: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the columns ``keep``, the statistics, base_failed, the rule that rejects (null: none) and kept, for every row of ``docs``.

    ``labels`` (doc_id, quality) teaches the list; without labels of both kinds only the base rule rejects. Null doc_ids keep
    their rows. An empty table gives no rows.
    """
    learned = learned_rules(docs, labels)
    out = text_stats(docs, keep).withColumn("rule", F.when(~F.col("base_failed"), learned.verdict()))
    return out.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull()).drop("n_shouts")
