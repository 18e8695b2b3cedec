"""N-gram Jaccard self-join with adaptive multi-match prefixes.

Texts are sets of 64-bit hashes of their word n-grams, in one order for all: shingles that repeat across documents last,
the others by hash. Two sets with 100 * common >= percent * union share at least L shingles of their prefixes of length
n - ceil(percent * n / 100) + L, for every L up to their needed overlap. Every set publishes its longest prefix; a cost
estimate per set (rows its prefix tokens meet, and candidates those can make) picks its own L, a pair uses the larger of
both, and only pairs with that many common prefix tokens are verified on whole sets. Sizes that are close ask for more: the
overlap that a link needs leaves few other tokens in the prefix that ends first, all the rest of that prefix must be common.

Rows of one token are never paired with each other wholesale. Equal sets are one node from the start. Sets of crowded tokens
are first verified against a token's most central set, their pivot; what that joins is contracted, and only pairs of
different contracted components are made afterwards. So components are exact while a large group of copies costs a few rows
per copy. Sets around one pivot that it does not join (copies edited too much) share nearly all tokens, but their differences
from the pivot (shingles added or missing) are few: if x does not link with the pivot and shares no difference with y, then
similarity(x, y) <= similarity(x, pivot), so x and y do not link. Pairs around one pivot are therefore found by a second
prefix join, on the differences, where a pair needs as many common ones as its sizes demand.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from schedlytics.llm.graph import components
from schedlytics.llm.tables import blocks, discard, small_batches, staged, text_column
from schedlytics.llm.words import shingles, words_of
from schedlytics.session import work_dir

# Longest multi-match prefix: common prefix tokens that a pair may be asked for.
LEVELS = 4
# Shingles with a place of their own at the end of the order: a table of the most repeated ones, of 16 bytes each. It only orders
# tokens, and is wide so that the shared shingles of a larger corpus do not crowd the prefixes either.
ORDER_TOKENS = 1_000_000
# A shingle is reported for that table from so many documents of one working set on.
LOCAL_REPEATS = 3
WORKING_SET = 2_000_000
# Documents of a token from which on they are first compared with its most central one.
CROWD = 8
# Rows met by a token that weigh as much as verifying one candidate.
VERIFY_WEIGHT = 8.0
# Sets around a pivot are described by their differences from it if their similarity in percent is at least this.
AROUND = 50
# Pairs of one hub that share a copy of its set while pairs are verified.
HUB_PAIRS = 500
# Bits of the filter that keeps texts without candidates from being cut again.
SLOTS = 1 << 23


def _sets(column: pa.Array, words: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For blocks of rows: the first row, the distinct shingles row by row in hash order, and the bounds of the rows."""
    for low, high in blocks(column):
        cut = words_of(column.slice(low, high - low), lower=True)
        values, bounds = shingles(cut.hashes(), cut.bounds, words)
        row = np.repeat(np.arange(high - low), np.diff(bounds))
        order = np.lexsort((values, row))
        values, row = values[order], row[order]
        new = np.ones(len(values), dtype=bool)
        new[1:] = (values[1:] != values[:-1]) | (row[1:] != row[:-1])
        values, row = values[new], row[new]
        yield low, values, np.searchsorted(row, np.arange(high - low + 1))


def _frequent(docs: DataFrame, words: int, folder: str) -> tuple[np.ndarray, np.ndarray]:
    """The most repeated shingles and their document counts, sorted by hash: all from that count on from which ``ORDER_TOKENS`` suffice."""

    def count(batches):
        held, size = [], 0

        def flush():
            values, copies = np.unique(np.concatenate(held), return_counts=True)
            keep = copies >= LOCAL_REPEATS
            return pa.RecordBatch.from_arrays([pa.array(values[keep].view(np.int64)), pa.array(copies[keep].astype(np.int64))], ["token", "copies"])

        for batch in batches:
            for _, values, _ in _sets(text_column(batch, "text"), words):
                held.append(values)
                size += len(values)
                if size >= WORKING_SET:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    rows = docs.select("text").mapInArrow(count, "token long, copies long")
    rows = staged(rows.groupBy("token").agg(F.sum("copies").alias("copies")), "repeated", folder)
    sizes = rows.groupBy("copies").agg(F.count("*").alias("n")).toArrow().sort_by([("copies", "descending")])
    few = np.cumsum(sizes["n"].to_numpy()) <= ORDER_TOKENS
    top = rows.where(F.col("copies") >= int(sizes["copies"].to_numpy()[few].min(initial=1 << 62))).toArrow()
    tokens = top["token"].to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(tokens)
    return tokens[order], top["copies"].to_numpy().astype(np.float64)[order]


def _prefixes(docs: DataFrame, words: int, percent: int, order_by: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """One row per document: a row number, its set's size and digest, how repeated its shingles are, and its longest prefix."""
    known, copies = order_by

    def run(batches):
        uid = TaskContext.get().partitionId() << 33
        for batch in batches:
            sizes, digests, central, prefix, lengths = [], [], [], [], []
            texts = text_column(batch, "text")
            for _, values, bounds in _sets(texts, words):
                weight = np.zeros(len(values))
                if len(known) and len(values):
                    at = np.minimum(np.searchsorted(known, values), len(known) - 1)
                    weight = np.where(known[at] == values, copies[at], 0.0)
                for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                    own, w, n = values[a:b], weight[a:b], b - a
                    sizes.append(n)
                    digests.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest() if n else None)
                    central.append(float(np.log1p(w).mean()) if n else 0.0)
                    if w.any():
                        own = own[np.lexsort((own, w))]
                    own = own[:max(0, n - (percent * n + 99) // 100 + LEVELS)] if n else own
                    prefix.append(own)
                    lengths.append(len(own))
            offsets = np.zeros(len(lengths) + 1, dtype=np.int32)
            np.cumsum(lengths, out=offsets[1:])
            flat = np.concatenate(prefix) if prefix else np.zeros(0, dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(uid, uid + len(sizes))), batch.column("doc_id").cast(pa.int64()), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                 pa.array([hashlib.md5(x.as_buffer()).hexdigest() for x in texts], pa.string()), pa.array(central, pa.float64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64)))],
                ["uid", "doc_id", "n", "digest", "text_md5", "central", "prefix"])
            uid += len(sizes)

    return docs.mapInArrow(run, "uid long, doc_id long, n long, digest binary, text_md5 string, central double, prefix array<long>")


def _slot():
    return F.pmod(F.xxhash64("doc_id"), F.lit(SLOTS)).cast("long")


def _with_sets(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, words: int, folder: str) -> DataFrame:
    """The pairs (a, b) of nodes with their whole sets (left, right, either way round); only texts of nodes in pairs are cut again.

    The bit table has a fixed size and is collected as such; it may let other texts through, the join on the digest does not.
    A set moves once to the place of its digest, where it meets the pairs in which it has fewer partners than the other side;
    with those it moves on to that side, the hub. A hub's pairs are spread over as many keys as they need, its set goes to each.
    """
    ends = pairs.select(F.explode(F.array("a", "b")).alias("uid")).groupBy("uid").agg(F.count("*").alias("c")).join(nodes.select("uid", "digest", "first_doc"), "uid")
    ends = staged(ends.select("uid", F.struct("c", "uid", "digest").alias("end"), F.pmod(F.xxhash64("first_doc"), F.lit(SLOTS)).cast("long").alias("slot")), "ends", folder)
    spots = ends.groupBy(F.shiftright("slot", 5).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(slot & 31 as int))")).alias("bits")).collect()
    table = np.zeros(SLOTS >> 5, dtype=np.int64)
    if spots:
        table[[r.word for r in spots]] = [r.bits for r in spots]

    def cut(batches):
        for batch in batches:
            slot = batch.column("slot").to_numpy()
            keep = (table[slot >> 5] >> (slot & 31)) & 1 == 1
            if not keep.any():
                continue
            column = text_column(batch.select(["text"]).filter(pa.array(keep)), "text")
            for _, values, bounds in _sets(column, words):
                parts = [values[a:b].tobytes() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True) if b > a]
                yield pa.RecordBatch.from_arrays([pa.array([hashlib.blake2b(p, digest_size=16).digest() for p in parts], pa.binary()), pa.array(parts, pa.binary())], ["digest", "members"])

    sets = docs.select("text", _slot().alias("slot")).mapInArrow(cut, "digest binary, members binary").dropDuplicates(["digest"])
    side = lambda name: ends.select(F.col("uid").alias(name), F.col("end").alias(f"{name}_end"))
    sided = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b").withColumn("hub", F.greatest("a_end", "b_end")).withColumn("leaf", F.least("a_end", "b_end"))
    share = F.pmod(F.xxhash64("leaf.uid"), F.ceil(F.col("hub.c") / HUB_PAIRS).cast("long"))
    sided = staged(sided.select("a", "b", F.col("leaf.digest").alias("leaf"), F.col("hub.digest").alias("hub"), share.alias("share")), "sided", folder)
    left = sided.join(sets.select(F.col("digest").alias("leaf"), F.col("members").alias("left")), "leaf").select("a", "b", "hub", "share", "left")
    right = sided.select("hub", "share").distinct().join(sets.select(F.col("digest").alias("hub"), F.col("members").alias("right")), "hub")
    return left.join(right, ["hub", "share"]).select("a", "b", "left", "right")


def _members(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for left, right in zip(batch.column("left"), batch.column("right"), strict=True):
        yield np.frombuffer(left.as_buffer(), dtype=np.uint64), np.frombuffer(right.as_buffer(), dtype=np.uint64)


def _verified(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, words: int, percent: int, folder: str) -> DataFrame:
    """The pairs (a, b) of nodes that link, on whole sets."""

    def check(batches):
        for batch in batches:
            keep = []
            for x, y in _members(batch):
                if len(x) > len(y):
                    x, y = y, x
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                common = int((y[at] == x).sum())
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return _with_sets(docs, nodes, pairs, words, folder).mapInArrow(check, "a long, b long")


def _around(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, words: int, percent: int, folder: str) -> DataFrame:
    """Pairs of a set (a) and its pivot (b): whether they link, and their differences (null if too many to be of use)."""

    def compare(batches):
        for batch in batches:
            linked, apart = [], []
            for x, y in _members(batch):
                other = np.setxor1d(x, y, assume_unique=True)
                common = (len(x) + len(y) - len(other)) // 2
                union = common + len(other)
                linked.append(100 * common >= percent * union)
                apart.append(other.view(np.int64) if 100 * common >= AROUND * union else None)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(linked, pa.bool_()), pa.array(apart, pa.list_(pa.int64()))], ["a", "b", "linked", "differences"])

    return _with_sets(docs, nodes, pairs, words, folder).mapInArrow(compare, "a long, b long, linked boolean, differences array<long>")


def _sided(rows: DataFrame, keys: list[str], classes: list[str]) -> DataFrame:
    """Rows of keys that hold pairs apart in all ``classes``, with the class column that has the largest class (cls) and that class (major).

    A pair apart in cls has a side outside the major class, so pairs are made from those rows only.
    """
    most = None
    for name in classes:
        of = rows.groupBy(*keys, name).count().groupBy(*keys).agg(F.max(F.struct("count", F.col(name).alias("cls"))).alias(f"most_{name}"), F.count("*").alias("classes")).where("classes > 1").drop("classes")
        most = of if most is None else most.join(of, keys)
    best = F.greatest(*[F.struct(F.col(f"most_{name}.count").alias("count"), F.lit(k).alias("k"), F.col(f"most_{name}.cls").alias("cls")) for k, name in enumerate(classes)]) if len(classes) > 1 else F.struct(F.lit(0).alias("k"), F.col(f"most_{classes[0]}.cls").alias("cls"))
    most = most.select(*keys, best.alias("best")).select(*keys, F.col("best.k").alias("k"), F.col("best.cls").alias("major"))
    return rows.join(most, keys).withColumn("cls", F.element_at(F.array(*classes), F.col("k") + 1)).drop("k")


def _crossing(rows: DataFrame, keys: list[str], classes: list[str], condition) -> DataFrame:
    """Pairs x, y of rows of one key that are apart in all ``classes`` and meet ``condition``, each once."""
    rows = _sided(rows, keys, classes)
    apart = (F.col("y.cls") == F.col("y.major")) | (F.col("x.uid") < F.col("y.uid"))
    for name in classes:
        apart = apart & (F.col(f"x.{name}") != F.col(f"y.{name}"))
    same = [F.col(f"x.{k}") == F.col(f"y.{k}") for k in keys]
    on = same[0] if len(same) == 1 else same[0] & same[1]
    return rows.where("cls <> major").alias("x").join(rows.alias("y"), on & (F.col("x.cls") != F.col("y.cls")) & apart & condition)


def jaccard_components(docs: DataFrame, words: int = 4, percent: int = 85, folder: str | None = None) -> DataFrame:
    """Per row of ``docs`` (doc_id, text; other columns are not read): doc_id, n_shingles, component_id, text_md5, keeper.

    keeper marks the row that stays if one of each component does: the smallest doc_id (null last), then the smallest text_md5.
    A null or wordless text has an empty set and links with nothing (its component is itself). Fewer words than ``words`` are one
    shingle. Equal rows are in one component; rows that share a doc_id stay rows of their own. component_id is the smallest
    non-null doc_id of the component (null if it has none). An empty table gives no rows.
    """
    spark = docs.sparkSession
    small_batches(spark)
    folder = folder or work_dir(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = staged(_prefixes(docs, words, percent, _frequent(docs, words, folder)), "prefixes", folder)
    head = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_md5")
    nodes = rows.where("n > 0").groupBy("digest").agg(F.min("uid").alias("uid"), F.min(head).alias("head"), F.min("doc_id").alias("first_doc"), F.first("n").alias("n"), F.first("central").alias("central"))
    nodes = staged(nodes, "nodes", folder)
    # What only leads to the links goes there and is removed once the components are written.
    steps = f"{folder}/steps"

    token = rows.where("n > 0").select("uid", "n", F.posexplode("prefix").alias("pos", "token"))
    spare = F.expr(f"n - (n * {percent} + 99) div 100")
    token = token.select("token", "uid", F.greatest(F.lit(1), F.col("pos") - spare + 1).cast("int").alias("level"))
    shared = token.groupBy("token").agg(F.count("*").alias("c")).where("c > 1").select("token")
    met = token.join(shared, "token").join(nodes.select("uid", "n", "central"), "uid")
    met = staged(met, "met", steps)
    about = met.groupBy("token").agg(F.count("*").alias("c"), F.max_by("uid", F.struct("central", -F.col("uid"))).alias("pivot")).where("c > 1")
    met = staged(met.join(about, "token"), "tokens", steps)
    discard(spark, f"{steps}/met")

    costs = [F.sum(F.when(F.col("level") <= k, F.col("c")).otherwise(0)).cast("double").alias(f"s{k}") for k in range(1, LEVELS + 1)]
    total = lambda k: F.col(f"s{k}") + F.col(f"s{k}") / k * VERIFY_WEIGHT
    choice = F.least(*[F.struct(total(k).alias("cost"), F.lit(k).alias("k")) for k in range(1, LEVELS + 1)])["k"]
    depth = met.groupBy("uid").agg(*costs).select("uid", choice.alias("ell"))

    near = lambda x, y: 100 * F.least(x, y) >= percent * F.greatest(x, y)
    pivot = nodes.select(F.col("uid").alias("pivot"), F.col("n").alias("pivot_n"))
    star = met.where(f"c >= {CROWD} and uid <> pivot").groupBy("uid", "n", "pivot").count().join(pivot, "pivot").where(f"100 * least(n, pivot_n) >= {AROUND} * greatest(n, pivot_n)")
    star = star.groupBy("uid").agg(F.max_by("pivot", F.struct("count", "pivot")).alias("pivot"))
    star = staged(star.select(F.col("uid").alias("a"), F.col("pivot").alias("b")), "star", steps)
    around = staged(_around(docs, nodes, star, words, percent, f"{steps}/first"), "around", steps)
    first = staged(around.where("linked").select("a", "b"), "star_links", steps)
    part = components(first, f"{steps}/part").select(F.col("node").alias("uid"), "root")
    group = around.where("differences is not null").select(F.col("a").alias("uid"), F.col("b").alias("grp"), "differences")

    met = met.drop("pivot", "central", "c").join(depth, "uid").join(part, "uid", "left").join(group.select("uid", "grp"), "uid", "left")
    met = staged(met.withColumn("part", F.coalesce("root", "uid")).withColumn("grp", F.coalesce("grp", "uid")).drop("root"), "parts", steps)
    discard(spark, f"{steps}/tokens")
    floor = lambda n: F.expr(f"({n} * {percent} + 99) div 100")
    need = lambda: F.least(F.greatest("x.ell", "y.ell"), floor("x.n"), floor("y.n"))
    edge = [F.least("x.uid", "y.uid").alias("a"), F.greatest("x.uid", "y.uid").alias("b")]
    cross = _crossing(met, ["token"], ["part", "grp"], near(F.col("x.n"), F.col("y.n")) & (F.col("x.level") <= need()) & (F.col("y.level") <= need()))
    # Of the two prefixes the one that ends first holds only common tokens of both prefixes and at most n - overlap others.
    overlap = F.expr(f"((x.n + y.n) * {percent} + {99 + percent}) div {100 + percent}")
    least = need() + F.greatest(F.lit(0), overlap - F.greatest(floor("x.n"), floor("y.n")))
    pairs = cross.select(*edge, least.alias("least")).groupBy("a", "b", "least").count().where("count >= least").select("a", "b")

    # Differences around one pivot: |x ^ y| <= (100 - percent) / (100 + percent) * (|x| + |y|) for a link, and what exceeds it must be common.
    most = F.expr(f"s - n * {100 - percent} div {percent}")
    tokens = group.join(nodes.select("uid", "n"), "uid").join(part, "uid", "left")
    tokens = tokens.select("uid", "n", "grp", F.coalesce("root", "uid").alias("part"), F.size("differences").alias("s"), F.explode("differences").alias("token"))
    tokens = staged(tokens, "differences", steps)
    counts = tokens.groupBy("grp", "token").agg(F.count("*").alias("c"))
    place = F.row_number().over(Window.partitionBy("uid").orderBy("c", "token")) - 1
    tokens = tokens.join(counts, ["grp", "token"]).withColumn("pos", place).where((F.col("c") > 1) & (F.col("pos") <= F.col("s") - F.greatest(F.lit(1), most)))
    tokens = staged(tokens.drop("c"), "difference_prefixes", steps)
    common = F.greatest(F.lit(1), F.expr(f"(x.s + y.s - (x.n + y.n) * {100 - percent} div {100 + percent} + 1) div 2"))
    close = _crossing(tokens, ["grp", "token"], ["part"], near(F.col("x.n"), F.col("y.n")) & (F.col("x.pos") <= F.col("x.s") - common) & (F.col("y.pos") <= F.col("y.s") - common))
    pairs = pairs.unionByName(close.select(*edge).distinct())
    second = _verified(docs, nodes, staged(pairs, "pairs", steps), words, percent, f"{steps}/second")
    whole = components(staged(first.unionByName(second), "links", steps), f"{folder}/whole")
    discard(spark, steps)

    named = nodes.join(whole.select(F.col("node").alias("uid"), "root"), "uid", "left").withColumn("root", F.coalesce("root", "uid"))
    named = named.join(named.groupBy("root").agg(F.min("head").alias("first")), "root").select("digest", "first")
    shape = lambda first, keeper: ["doc_id", F.col("n").alias("n_shingles"), first.alias("component_id"), "text_md5", keeper.alias("keeper")]
    joined = rows.where("n > 0").join(named, "digest")
    return joined.select(*shape(F.col("first.doc_id"), head == F.col("first"))).unionByName(rows.where("n = 0").select(*shape(F.col("doc_id"), F.lit(True))))
