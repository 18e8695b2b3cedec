"""Joins beyond the built-in equi joins.

No join here carries a broadcast hint: sides that grow with the data are left
to the optimizer's size threshold and to adaptive execution. Only the week
calendar and literal rule tables, bounded by construction, are hinted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from schedlytics.operators.ranks import row_numbers
from schedlytics.session import work_dir
from schedlytics.sources.sinks import stage


def join_natural(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Join on all shared column names."""
    shared = [c for c in left.columns if c in right.columns]
    if not shared:
        raise ValueError("no shared columns to join on")
    return left.join(right, shared, how)


def join_indicator(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "full", name: str = "found_in") -> DataFrame:
    """Join with the origin of each row: both, left_only or right_only."""
    joined = left.withColumn("_l", F.lit(True)).join(right.withColumn("_r", F.lit(True)), list(keys), how)
    origin = (F.when(F.col("_l").isNotNull() & F.col("_r").isNotNull(), "both")
              .when(F.col("_l").isNotNull(), "left_only").otherwise("right_only"))
    return joined.withColumn(name, origin).drop("_l", "_r")


def prefixed(df: DataFrame, prefix: str, keys: Sequence[str]) -> DataFrame:
    """Prefix every column that is not a key, so that later joins cannot clash."""
    return df.toDF(*[c if c in keys else f"{prefix}{c}" for c in df.columns])


# Lists of right rows that a left row meets in one cell at most, and cells of a key at least where it has as many lists.
LISTS, KEY_CELLS = 64, 6


def expanding_join(left: DataFrame, right: DataFrame, key: str, left_size: DataFrame | None = None, right_size: DataFrame | None = None,
                   left_rows: int = 20_000, right_rows: int = 1024, how: str = "inner", facts: DataFrame | None = None,
                   on: tuple[str, str] | None = None) -> DataFrame:
    """Equi join on ``key`` (inner or left) whose output is many times its input, however skewed the key.

    Input size says nothing about the work here, so size-based partitioning
    would leave it to a few tasks, and one hot key to a single one. Each key is
    laid out as a grid of cells of at most about ``left_rows`` rows by ``LISTS`` lists of
    ``right_rows``: a left row visits every column of the grid and a list every line, so
    each pair meets in exactly one cell, where a left row is repeated for the lists
    after the last shuffle: what is moved and sorted of the left is 1 / (``LISTS`` x
    ``right_rows``) of the output, and of the right 1 / ``left_rows``. The cells are spread over the
    session's shuffle partitions; the merge hint keeps that layout, where a
    broadcast would put the output on the other side's few partitions.

    ``left_size`` and ``right_size`` are cheaper frames with the same keys to
    count rows on. ``facts`` hold what is known of single pairs, one row at most
    for each value of the two ``on`` columns (one of ``left``, one of ``right``);
    their other columns are attached as a left join would. Those of a left row's own key go to
    it, list by list, so that no pair is shuffled for them.
    """
    tasks = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    count = lambda df, rows, name: df.groupBy(key).agg(F.ceil(F.count("*") / rows).alias(name))
    grid = (count(left if left_size is None else left_size, left_rows, "_lines")
            .join(count(right if right_size is None else right_size, right_rows, "_lists"), key)
            .withColumn("_columns", F.expr(f"least(_lists, greatest(ceil(_lists / {LISTS}), ceil({KEY_CELLS} / _lines)))")))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
    mine, theirs = [c for c in left.columns if c != key], [c for c in right.columns if c != key]
    # Equal right rows are numbered by their count, so that they spread over the lists like all others.
    copies = right.groupBy(*right.columns).agg(F.count("*").alias("_n")).withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_n"))))
    placed = copies.join(grid, key).withColumn("_part", F.pmod(F.xxhash64(*right.columns, "_copy"), F.col("_lists"))).withColumn("_column", F.expr("_part % _columns")).drop("_n", "_copy", "_lists", "_columns")
    cell = [key, "_line", "_column"]
    a = (left.join(grid, key).withColumn("_line", F.pmod(F.xxhash64(*left.columns), F.col("_lines"))).withColumn("_column", every("_columns"))
         .drop("_lines", "_lists", "_columns"))
    lists = placed.groupBy(key, "_part", "_column", "_lines").agg(F.collect_list(F.struct(*theirs, key)).alias("_list"))
    b = lists.withColumn("_line", every("_lines")).drop("_lines")
    more = []
    if facts is not None:
        mkey, tkey = on
        more = [c for c in facts.columns if c not in on]
        own = facts.join(left.select(mkey, key).distinct(), mkey)
        known = own.join(placed.select(tkey, key, "_part", "_column").distinct(), [tkey, key]).groupBy(key, "_column", mkey)
        entries = known.agg(F.collect_list(F.struct("_part", tkey, F.struct(*more).alias("fact"))).alias("_entries"))
        of_list = lambda n: F.map_from_entries(F.transform(F.filter("_entries", lambda x: x["_part"] == n), lambda x: F.struct(x[tkey], x["fact"])))
        by_list = F.map_from_entries(F.transform(F.array_distinct(F.col("_entries._part")), lambda n: F.struct(n, of_list(n))))
        a = a.join(entries.select(key, "_column", mkey, by_list.alias("_facts")), [key, "_column", mkey], "left")
        held = [F.try_element_at("_facts", F.col("_part")).alias("_facts")]
    else:
        held = []
    entry = a.repartition(tasks, *cell).join(b.hint("merge"), cell).select(key, *mine, *held, F.explode("_list").alias("_entry"))
    pairs = entry.select(key, *mine, *[F.col(f"_entry.{c}").alias(c) for c in theirs], *(["_facts"] if more else []))
    if more:
        pairs = pairs.withColumn("_fact", F.try_element_at("_facts", F.col(tkey))).select(key, *mine, *theirs, *[F.col(f"_fact.{c}").alias(c) for c in more])
    if how == "inner":
        return pairs
    alone = left.join((right if right_size is None else right_size).select(key).distinct(), key, "left_anti")
    return pairs.unionByName(alone, allowMissingColumns=True)


def expanding_counts(left: DataFrame, right: DataFrame, key: str, by: Sequence[str], name: str = "n") -> DataFrame:
    """How many pairs ``expanding_join`` has per columns ``by`` of the right, null being a value: rows of a key are counted before the sides multiply."""
    mine, theirs = left.groupBy(key).agg(F.count("*").alias("_left")), right.groupBy(key, *by).agg(F.count("*").alias("_right"))
    return mine.join(theirs, key).groupBy(*by).agg(F.sum(F.col("_left") * F.col("_right")).alias(name))


def serving_pairs(clients: DataFrame, branches: DataFrame, branch_area: DataFrame) -> DataFrame:
    """Client and branch pairs where the branch serves the client's area.

    Membership in the branch's area list is an equality on ``area_id``, so this
    is two equi joins and never a product. Each pair appears once.
    """
    served = branch_area.select("branch_id", "area_id").distinct()
    return expanding_join(clients, branches.join(served, "branch_id"), "area_id")


# References of a leaf, and children of an inner node, of the tree that nearest references are searched in.
LEAF, FAN = 16, 16


def _curve(x: Column, y: Column) -> Column:
    """Place on the Z-order curve of two whole numbers below 2^31: their bits in turn."""

    def spread(v: Column) -> Column:
        for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
            v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(mask))
        return v

    return F.shiftleft(spread(x), 1).bitwiseOR(spread(y))


def _reference_tree(ref: DataFrame, part: str, x: str, y: str, folder: str) -> tuple[DataFrame, list[int]]:
    """``ref`` numbered along the curve inside each part (``_row`` from 0), staged, and the sizes of nodes from leaves up.

    The curve runs through the places of the references by x and by y, not through their values, and a node is a run of
    numbers: neither dense spots nor far outliers make large nodes.
    """
    by_x = row_numbers(ref, [part], [F.col(x), F.col(y)], folder, "_px")
    by_y = row_numbers(by_x, [part], [F.col(y), F.col(x)], folder, "_py")
    placed = by_y.withColumn("_z", _curve(F.col("_px"), F.col("_py"))).drop("_px", "_py")
    numbered = stage(row_numbers(placed, [part], [F.col("_z"), F.col(x), F.col(y)], folder, "_row").withColumn("_row", F.col("_row") - 1).drop("_z"), folder, "references")
    largest = numbered.agg(F.max("_row")).first()[0] or 0
    sizes = [LEAF]
    while largest // sizes[-1] >= FAN:
        sizes.append(sizes[-1] * FAN)
    return numbered, sizes


def nearest_candidates(points: DataFrame, refs: DataFrame, part: str, coords: tuple[str, str], label: str, ref_id: str, folder: str) -> DataFrame:
    """Pairs of a distinct place (part, x, y) and a reference (_rx, _ry, _ref, _label) among which each place's nearest is.

    References hang in a balanced tree. Level by level, from the root down, a place keeps the nodes that may hold its nearest: a
    node goes when its box is farther than the distance within which the best box must hold a reference. Boxes and places meet by
    (part, node), a place with a handful of nodes. Places with a null coordinate have no pairs.
    """
    x, y = coords
    known = F.col(x).isNotNull() & F.col(y).isNotNull()
    ref = refs.where(known).groupBy(part, x, y).agg(F.min(ref_id).alias("_ref"), F.min_by(label, ref_id).alias("_label"))
    tree, sizes = _reference_tree(ref, part, x, y, folder)

    def boxes(size: int) -> DataFrame:
        node = F.expr(f"_row div {size}").alias("_node")
        return tree.groupBy(part, node).agg(F.min(x).alias("_x0"), F.max(x).alias("_x1"), F.min(y).alias("_y0"), F.max(y).alias("_y1"))

    def kept(pairs: DataFrame) -> DataFrame:
        gap = lambda v, low, high: F.greatest(F.col(low) - F.col(v), F.col(v) - F.col(high), F.lit(0.0))
        sides = lambda v, low, high: (F.abs(F.col(v) - F.col(low)), F.abs(F.col(high) - F.col(v)))
        square = lambda f: f * f
        near = square(gap(x, "_x0", "_x1")) + square(gap(y, "_y0", "_y1"))
        across, along = sides(x, "_x0", "_x1"), sides(y, "_y0", "_y1")
        # Every side of a tight box has a reference on it, so the nearer side of either direction holds one no farther than its far end.
        bound = F.least(square(F.least(*across)) + square(F.greatest(*along)), square(F.greatest(*across)) + square(F.least(*along)))
        return pairs.withColumns({"_near": near, "_bound": F.min(bound).over(Window.partitionBy(part, x, y))}).where(F.col("_near") <= F.col("_bound")).select(part, x, y, "_node")

    places = points.where(known).select(part, x, y).distinct()
    at = kept(places.join(boxes(sizes[-1]), part))
    for size in reversed(sizes[:-1]):
        children = boxes(size).withColumns({"_child": F.col("_node"), "_node": F.expr(f"_node div {FAN}")})
        at = kept(at.join(children, [part, "_node"]).withColumn("_node", F.col("_child")))
    leaves = tree.select(part, F.expr(f"_row div {LEAF}").alias("_node"), F.col(x).alias("_rx"), F.col(y).alias("_ry"), "_ref", "_label")
    return at.join(leaves, [part, "_node"]).drop("_node")


def nearest_label(points: DataFrame, refs: DataFrame, part: str, coords: tuple[str, str], label: str, ref_id: str, folder: str | None = None) -> DataFrame:
    """Exact 1-nearest-neighbour label inside ``part``, ties to the smallest reference id; equal coordinates count once."""
    x, y = coords
    pairs = nearest_candidates(points, refs, part, coords, label, ref_id, folder or work_dir(points.sparkSession))
    square = (F.col(x) - F.col("_rx")) * (F.col(x) - F.col("_rx")) + (F.col(y) - F.col("_ry")) * (F.col(y) - F.col("_ry"))
    best = pairs.groupBy(part, x, y).agg(F.min_by(F.struct("_label", "_ref"), F.struct(square.alias("d"), F.col("_ref").alias("r"))).alias("_best"))
    return (points.join(best, [part, x, y], "left")
            .select(*points.columns, F.col("_best._label").alias(f"nearest_{label}"), F.col("_best._ref").alias(f"nearest_{ref_id}")))


def fill_latest_known(df: DataFrame, history: DataFrame, keys: Sequence[str], order: str, value: str, history_value: str) -> DataFrame:
    """Fill a missing ``value`` with the key's last known one on rows past its last ``order``."""
    last = history.groupBy(*keys).agg(
        F.max(order).alias("_last_order"), F.max_by(history_value, order).alias("_last_value"))
    joined = df.join(last, list(keys), "left")
    past = F.col(value).isNull() & (F.col(order) > F.col("_last_order"))
    return joined.withColumn(value, F.when(past, F.col("_last_value")).otherwise(F.col(value))).drop("_last_order", "_last_value")
