"""Edge rules on small hand-made frames."""

import json
import math
import random
from datetime import date

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from schedlytics.functions import arrays
from schedlytics.functions import calendar as cal
from schedlytics.functions import moments
from schedlytics.functions import scalars as S
from schedlytics.operators import aggregates, dedupe, joins, publish, ranks, rejects
from schedlytics.plans import candidates, documents, history, lateness, model, panels, publishing, rules, scheduling
from schedlytics.sources import sinks

FEW = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def rows(df):
    return sorted(tuple(r) for r in df.collect())


# ---- calendar ----


def test_months_are_clamped_and_weeks_start_on_sunday():
    assert cal.add_months(date(2021, 5, 31), -3) == date(2021, 2, 28)
    assert cal.add_months(date(2021, 1, 15), -13) == date(2019, 12, 15)
    assert cal.sunday_on_or_before(date(2024, 1, 21)) == date(2024, 1, 21)
    assert cal.sunday_on_or_before(date(2024, 1, 20)) == date(2024, 1, 14)


def test_ratio_window_stretches_only_when_the_period_starts_inside():
    assert cal.ratio_window(date(2021, 6, 24), date(2021, 4, 12)) == (date(2021, 2, 10), date(2021, 6, 10))
    assert cal.ratio_window(date(2021, 6, 24), date(2021, 3, 10)) == (date(2021, 3, 10), date(2021, 6, 10))
    assert cal.ratio_window(date(2021, 6, 24), None) == (date(2021, 3, 10), date(2021, 6, 10))


def test_split_dates_never_overlap():
    for day in range(1, 29):
        train_end, start, end = cal.split_dates(date(2024, 2, day))
        assert start.weekday() == 6 and (start - train_end).days == 1 and start <= end


def test_year_week_keys(spark):
    df = spark.createDataFrame([(date(2018, 12, 31),), (date(2021, 1, 1),), (date(2021, 1, 3),)], "d date")
    got = df.orderBy("d").select(cal.year_week(F.col("d")), cal.year_week_text(F.col("d")), cal.week_label(F.col("d")), cal.snap_sunday(F.col("d"))).collect()
    assert [tuple(r) for r in got] == [
        (201801, "2018_01", "W_2", date(2018, 12, 30)), (202053, "2020_53", "W_54", date(2020, 12, 27)), (202053, "2020_53", "W_2", date(2021, 1, 3))]


# ---- scalars ----


def test_half_even_counts_and_ratios(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (-0.5,)], "x double")
    assert [r[0] for r in df.select(S.round_half_even(F.col("x"))).collect()] == [0.0, 2.0, 2.0, 0.0]
    assert [r[0] for r in df.select(S.as_count(F.col("x"))).collect()] == [0, 2, 2, 0]
    assert spark.range(1).select(S.safe_ratio(F.lit(1), F.lit(0))).first()[0] is None
    xs = [2.675, 1.005, 0.125, 0.135, 7.0 / 3, -1.115]
    cents = spark.createDataFrame([(x,) for x in xs], "x double").select(S.round_half_even(F.col("x"), 2)).collect()
    assert [r[0] for r in cents] == [float(np.round(x, 2)) for x in xs]


def test_client_ids(spark):
    df = spark.createDataFrame([(7, None), (7, 9)], "c long, b long")
    assert rows(df.select(S.client_id(F.col("c"), F.col("b")))) == [("7_C",), ("9_B",)]
    one = spark.createDataFrame([("12_C",)], "id string")
    assert tuple(one.select(S.client_number(F.col("id")), S.client_kind(F.col("id")), S.client_type(F.col("id"))).first()) == (12, "C", 0)
    assert spark.range(1).select(S.pack_group(F.lit("31_2"))).first()[0] == 3100002


def test_a_missing_name_is_not_a_test(spark):
    df = spark.createDataFrame([("My TEST place",), ("Best",), (None,)], "n string")
    assert [r[0] for r in df.select(S.is_test(F.col("n"))).collect()] == [True, False, False]


# ---- moments and quantiles ----


def test_moment_rules(spark):
    df = spark.createDataFrame([("null", 1.0), ("null", None), ("null", 3.0), ("flat", 2.0), ("flat", 2.0), ("one", 5.0)], "k string, x double")
    got = {r.k: r for r in df.groupBy("k").agg(*moments.seven("x")).collect()}
    assert got["null"].x_kurtosis is None and got["null"].x_skew is None and got["null"].x_mean == 2.0 and got["null"].x_median == 2.0
    assert (got["flat"].x_kurtosis, got["flat"].x_skew, got["flat"].x_std) == (-3.0, 0.0, 0.0)
    assert (got["one"].x_kurtosis, got["one"].x_skew, got["one"].x_std) == (-3.0, 0.0, None)


@FEW
@given(st.lists(st.integers(-50, 50), min_size=1, max_size=30))
def test_quantiles_take_the_higher_element(spark, xs):
    df = spark.createDataFrame([(x,) for x in xs], "x long")
    got = aggregates.quantiles_higher(df, "x", (0.25, 0.5, 0.75)).first()
    want = [sorted(xs)[math.ceil(q * (len(xs) - 1))] for q in (0.25, 0.5, 0.75)]
    assert [got.q1, got.q2, got.q3, got.top] == want + [max(xs)]


def test_distinct_counts_null_once(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,), (2,)], "u long")
    assert df.agg(aggregates.distinct_with_null(F.col("u"))).first()[0] == 3
    assert df.where("u is not null").agg(aggregates.distinct_with_null(F.col("u"))).first()[0] == 2


# ---- panels ----


def test_panel_of_a_key_with_a_gap(spark):
    data = [("a", 1, 10.0), ("a", 2, 20.0), ("a", 4, 40.0), ("b", 6, 1.0)]
    df = spark.createDataFrame([(c, 5, w, o) for c, w, o in data], "client_id string, restaurant_id long, week_no int, orders double")
    got = {(r.client_id, r.week_no): r for r in panels.pair_panel(df).collect()}
    assert [k for k in sorted(got)] == [("a", w) for w in range(1, 7)] + [("b", 6)]
    assert [got["a", w].orders_mean for w in range(1, 7)] == [10.0, 20.0, 20.0, 40.0, 40.0, 40.0]
    assert [got["a", w].pair_rank for w in range(1, 7)] == [2, 3, 3, 4, 4, 4]
    assert not any(got["a", w].is_first_time_pair for w in range(1, 7))
    assert got["b", 6].pair_rank is None
    assert got["a", 4].exp_orders_mean == pytest.approx(70 / 3)


@FEW
@given(st.lists(st.tuples(st.sampled_from("abc"), st.integers(1, 9), st.integers(0, 9)), min_size=1, max_size=25))
def test_panel_properties(spark, data):
    df = spark.createDataFrame([(c, w, float(o), float(o) if o % 3 else None) for c, w, o in data], "client_id string, week_no int, orders double, rating double")
    got = panels.client_panel(df).collect()
    top = max(w for _, w, _ in data)
    firsts = {}
    for c, w, _ in data:
        firsts[c] = min(w, firsts.get(c, w))
    assert len(got) == sum(top - f + 1 for f in firsts.values())
    for c in firsts:
        weekly = {}
        for k, w, o in data:
            if k == c:
                weekly.setdefault(w, []).append(o)
        means = [sum(v) / len(v) for v in weekly.values()]
        last = next(r for r in got if r.client_id == c and r.week_no == top)
        assert last.exp_orders_mean == pytest.approx(sum(means) / len(means)) and last.exp_orders_max == pytest.approx(max(means))


def test_previous_orders_look_at_observed_weeks(spark):
    df = spark.createDataFrame([("a", 1, 1, date(2024, 1, 1), 1, 5.0), ("a", 1, 1, date(2024, 1, 3), 2, 7.0), ("a", 1, 4, date(2024, 1, 22), 3, 9.0)],
                               "client_id string, restaurant_id long, week_no int, schedule_on date, event_id long, orders double")
    assert rows(panels.previous_orders(df).select("week_no", "previous_orders")) == [(1, 0.0), (4, 7.0)]


# ---- nearest references ----


def test_nearest_on_uneven_density_with_an_outlier(spark, tmp_path):
    """Dense clusters, an outlier that stretches the box, equal places, ties, a part without references, null coordinates."""
    rng = random.Random(17)
    spots = [(rng.uniform(-5, 5), rng.uniform(-5, 5)) for _ in range(4)]
    near = lambda scale: [round(c + rng.gauss(0, scale), 9) for c in rng.choice(spots)]
    refs = [(i, rng.choice("ab"), *near(1e-4), f"l{i % 9}") for i in range(1500)] + [(1500, "a", 1e7, -1e7, "far"), (1501, "a", 0.0, 0.0, "z"), (1502, "a", 0.0, 0.0, "y"), (1503, "b", 1.0, 1.0, "q")]
    points = [(i, rng.choice("ab"), *near(10 ** rng.uniform(-5, 1))) for i in range(600)] + [(600, "a", 5e6, -5e6), (601, "a", 0.0, 0.0), (602, "c", 1.0, 1.0), (603, "a", None, 1.0), (604, "a", 0.0, 0.0)]
    p = spark.createDataFrame(points, "point_id long, part string, x double, y double").repartition(3)
    r = spark.createDataFrame(refs, "ref_id long, part string, x double, y double, label string").repartition(3)
    got = {g.point_id: (g.nearest_label, g.nearest_ref_id) for g in joins.nearest_label(p, r, "part", ("x", "y"), "label", "ref_id", str(tmp_path)).collect()}
    for i, part, x, y in points:
        own = [((x - rx) * (x - rx) + (y - ry) * (y - ry), k, name) for k, rpart, rx, ry, name in refs if rpart == part and x is not None]
        assert got[i] == ((min(own)[2], min(own)[1]) if own else (None, None))
    pairs = joins.nearest_candidates(p, r, "part", ("x", "y"), "label", "ref_id", str(tmp_path)).count()
    assert pairs <= 8 * joins.LEAF * len(points)  # all pairs of a part would be 750 for each point


# ---- panels by intervals ----


def test_interval_join_equals_the_panel_of_every_week(spark):
    rng = random.Random(3)
    history = spark.createDataFrame([(f"c{rng.randint(0, 5)}", rng.choice([1, 2, 5, 6, 9, 14]), float(rng.randint(0, 9)), None if rng.random() < 0.2 else float(rng.randint(1, 5)))
                                     for _ in range(90)], "client_id string, week_no int, orders double, rating double")
    base = spark.createDataFrame([(f"c{k % 7}", k % 17, k) for k in range(140)], "client_id string, week_no int, i int")
    wide = base.join(panels.client_panel(history), ["client_id", "week_no"], "left")
    merged = panels.holding_at(base, panels.panel_intervals(history, *panels.CLIENT), ["client_id"])
    assert sorted(wide.columns) == sorted(merged.columns)
    assert sorted(map(repr, wide.select(merged.columns).collect())) == sorted(map(repr, merged.collect()))
    last = panels.latest(panels.client_panel(history), ["client_id"]).drop("week_no")
    assert sorted(map(repr, panels.latest_panel(history, *panels.CLIENT).collect())) == sorted(map(repr, last.collect()))


# ---- sinks ----


def test_publish_replace_keeps_the_old_rows_until_the_new_ones_are_complete(spark, tmp_path):
    path = f"{tmp_path}/table"
    with pytest.raises(FileNotFoundError):
        sinks.read_published(spark, path)
    for n in (3, 4, 5):
        assert sinks.publish_replace(spark.range(n), path).count() == n
    old = sinks.read_published(spark, path)
    broken = spark.range(100).repartition(4).withColumn("id", F.when(F.col("id") == 99, F.raise_error(F.lit("lost"))).otherwise(F.col("id")))
    with pytest.raises(Exception, match="lost"):
        sinks.publish_replace(broken, path)
    assert sinks.read_published(spark, path).count() == 5
    assert sinks.publish_replace(spark.range(2), path).count() == 2
    assert old.count() == 5 and sinks.read_published(spark, path).count() == 2  # a reader of the version before is not disturbed
    assert len([p for p in (tmp_path / "table").iterdir() if p.name.startswith("version-")]) <= 3


# ---- ranks and selection by ranges ----


def spread_rows(n=3000):
    """A hot key with distinct doubles, a hot value, small keys, a null key and null values."""
    rng = random.Random(5)
    out = [("hot", rng.uniform(-1, 1) * 10 ** rng.randint(-3, 6)) for _ in range(n)] + [("flat", 2.5)] * 400 + [("flat", float(i)) for i in range(7)]
    out += [(None, float(i % 5)) for i in range(31)] + [(f"k{i % 40}", float(i * 7 % 11)) for i in range(300)] + [("hot", None), ("void", None), ("one", -3.0)]
    rng.shuffle(out)
    return out


def by_key(data):
    groups = {}
    for k, x in data:
        groups.setdefault(k, []).append(x)
    return groups


def test_row_numbers_of_spread_keys(spark, tmp_path):
    data = [(k, x, i) for i, (k, x) in enumerate(spread_rows(1500))]
    df = spark.createDataFrame(data, "k string, x double, i int").repartition(5)
    got = {r.i: r.place for r in ranks.row_numbers(df, ["k"], [F.desc("x"), F.col("i")], str(tmp_path), "place").collect()}
    for k in by_key([d[:2] for d in data]):
        own = sorted((d for d in data if d[0] == k), key=lambda d: (d[1] is None, -(d[1] or 0), d[2]))
        assert [got[i] for _, _, i in own] == list(range(1, len(own) + 1))


def test_average_ranks_share_the_mean_across_ranges(spark, tmp_path):
    data = spread_rows(800)
    df = spark.createDataFrame(data, "k string, x double").repartition(6)
    got = sorted((tuple(r) for r in ranks.average_ranks(df, ["k"], "x", str(tmp_path), "rank").collect()), key=repr)
    groups = {k: [x for x in v if x is not None] for k, v in by_key(data).items()}
    want = [(k, x, None if x is None else sum(y < x for y in groups[k]) + (sum(y == x for y in groups[k]) + 1) / 2) for k, x in data]
    assert got == sorted(want, key=repr)


def test_selection_equals_sorting(spark, tmp_path, monkeypatch):
    data = spread_rows()
    df = spark.createDataFrame(data, "k string, x double").repartition(4)
    got = {r.k: r.m for r in ranks.medians(df, ["k"], "x", str(tmp_path), "m").collect()}
    assert got == {k: float(np.median([x for x in v if x is not None])) for k, v in by_key(data).items() if any(x is not None for x in v)}
    monkeypatch.setattr(ranks, "HEAVY", 100)
    xs = sorted(x for _, x in data if x is not None)
    cut = aggregates.quantiles_higher(df, "x", (0.0, 0.25, 0.5, 0.9), str(tmp_path)).first()
    assert tuple(cut) == (*[xs[math.ceil(q * (len(xs) - 1))] for q in (0.0, 0.25, 0.5, 0.9)], xs[-1])


def test_weekly_stats_of_heavy_groups(spark, tmp_path, monkeypatch):
    """Groups above the limit give what one aggregate gives, with all-distinct doubles, null keys and null values."""
    data = [(k, 1 + i % 2, x, None if i % 9 == 0 else float(i % 4)) for i, (k, x) in enumerate(spread_rows(1200))]
    df = spark.createDataFrame(data, "k string, week_no int, x double, y double").repartition(4)
    key = lambda r: (str(r[0]), r[1])
    want = sorted((tuple(r) for r in panels.weekly_stats(df, ["k"], ["x", "y"]).collect()), key=key)
    monkeypatch.setattr(ranks, "HEAVY", 12)
    got = sorted((tuple(r) for r in panels.weekly_stats(df, ["k"], ["x", "y"], str(tmp_path)).collect()), key=key)
    assert len(got) == len(want)
    for a, b in zip(got, want, strict=True):
        assert a[:2] == b[:2] and all((x is None and y is None) or x == pytest.approx(y, rel=1e-9) for x, y in zip(a[2:], b[2:], strict=True))


# ---- dedupe, joins, spreading ----


def test_keep_one_and_flag_repeats_on_a_hot_key(spark):
    rng = random.Random(1)
    data = [(1 if rng.random() < 0.7 else rng.randint(2, 9), i, rng.randint(0, 99)) for i in range(400)]
    df = spark.createDataFrame(data, "k long, i long, x long")
    last, first = {}, {}
    for k, i, x in data:
        last[k] = (k, i, x)
        first.setdefault(k, (k, i, x))
    assert rows(dedupe.keep_one(df, ["k"], ["i"])) == sorted(last.values())
    assert rows(dedupe.keep_one(df, ["k"], ["i"], last=False)) == sorted(first.values())
    flagged = dedupe.flag_repeats(df, ["k"], ["i"]).collect()
    assert {(r.k, r.i, r.x) for r in flagged if not r.is_repeat} == set(first.values()) and len(flagged) == 400


def test_flag_repeats_counts_rows_equal_in_every_column(spark):
    df = spark.createDataFrame([(1, 5, "x"), (1, 5, "x"), (1, 5, "y"), (2, 5, "x"), (None, 1, "z"), (None, 1, "z")], "k int, i int, other string").repartition(3)
    flagged = sorted((tuple(r) for r in dedupe.flag_repeats(df, ["k"], ["i"]).collect()), key=repr)
    assert flagged == sorted([(1, 5, "x", False), (1, 5, "x", True), (1, 5, "y", True), (2, 5, "x", False), (None, 1, "z", False), (None, 1, "z", True)], key=repr)


def test_flag_repeats_treats_null_as_a_key(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (3, 3)], "k long, i long")
    assert rows(dedupe.flag_repeats(df, ["k"], ["i"]).select("i", "is_repeat")) == [(1, False), (2, True), (3, False)]


def test_expanding_join_equals_the_plain_join(spark):
    left = spark.createDataFrame([(i, 0 if i % 3 else i % 5) for i in range(120)] + [(5, 0), (5, 0)], "c long, area_id long")
    right = spark.createDataFrame([(i, 0 if i % 3 else i % 7) for i in range(90)] + [(7, 0)], "b long, area_id long")
    got = joins.expanding_join(left, right, "area_id", left_rows=20, right_rows=8).select("area_id", "c", "b")
    assert rows(got) == rows(left.join(right, "area_id").select("area_id", "c", "b"))


@FEW
@given(st.integers(0, 10_000))
def test_nearest_label_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    def point():
        # Clusters of very different density, far outliers and repeated coordinates.
        scale = rng.choice([0.001, 1.0, 50.0])
        return round(rng.gauss(0, scale), 3), round(rng.gauss(5, scale), 3)
    refs = [(i, rng.randint(0, 2), *point(), rng.randint(0, 9)) for i in range(60)]
    pts = [(i, rng.randint(0, 3), *(point() if rng.random() < 0.8 else refs[i % 60][2:4])) for i in range(50)]
    r = spark.createDataFrame(refs, "rid long, part long, x double, y double, label long")
    p = spark.createDataFrame(pts, "pid long, part long, x double, y double")
    got = {t.pid: (t.nearest_label, t.nearest_rid) for t in joins.nearest_label(p, r, "part", ("x", "y"), "label", "rid").collect()}
    for pid, part, x, y in pts:
        near = min((((x - q[2]) * (x - q[2]) + (y - q[3]) * (y - q[3]), q[0], q[4]) for q in refs if q[1] == part), default=None)
        assert got[pid] == ((near[2], near[1]) if near else (None, None))


def test_fill_latest_known_only_past_the_last_week(spark):
    hist = spark.createDataFrame([("a", 1, 10.0), ("a", 3, 30.0)], "k string, w long, m double")
    df = spark.createDataFrame([("a", 2, None), ("a", 4, None), ("a", 5, 1.0), ("b", 9, None)], "k string, w long, v double")
    assert rows(joins.fill_latest_known(df, hist, ["k"], "w", "v", "m").select("w", F.coalesce("v", F.lit(-1.0)))) == [(2, -1.0), (4, 30.0), (5, 1.0), (9, -1.0)]


def test_join_indicator(spark):
    a, b = spark.createDataFrame([(1,), (2,)], "k long"), spark.createDataFrame([(2,), (3,)], "k long")
    assert rows(joins.join_indicator(a, b, ["k"])) == [(1, "left_only"), (2, "both"), (3, "right_only")]


# ---- rejects and appends ----


def test_rejects_and_kept_rows_add_up(spark):
    df = spark.createDataFrame([(1, "x"), (2, None), (None, "test y")], "a long, n string")
    kept, dropped = rejects.split_rejects(df, [("no number", F.col("a").isNull()), ("no name", F.col("n").isNull())])
    assert kept.count() + dropped.count() == df.count()
    assert sorted(r.reason for r in dropped.collect()) == ["no name", "no number"]


def test_append_missing_is_idempotent_and_null_rules_differ(spark):
    schema = "c long, m long, b long"
    have = spark.createDataFrame([(1, 1, 1), (None, 2, 2)], schema)
    new = spark.createDataFrame([(1, 1, 1), (None, 2, 2), (3, None, 3), (4, 4, 4)], schema)
    keys = ["c", "m", "b"]
    assert rows(publish.missing_rows(new, have, keys, required=["m"]).na.fill(-1)) == [(-1, 2, 2), (4, 4, 4)]
    assert rows(publish.missing_rows(new, have, keys, required=["m"], null_safe=["c", "m"])) == [(4, 4, 4)]
    once = publish.append_missing(new.where("c is not null"), have, keys, required=["m"])
    assert publish.append_missing(new.where("c is not null"), once, keys, required=["m"]).count() == once.count() == 3


# ---- guards and history ----


def test_guards_raise(spark):
    df = spark.createDataFrame([(date(2024, 1, 1), 1)], "d date, schedule_status int")
    assert history.require_date(df, "d", date(2024, 1, 1)) is df
    with pytest.raises(ValueError):
        history.require_date(df, "d", date(2024, 1, 2))
    with pytest.raises(ValueError):
        rules.require_scheduled(df)


def test_holidays_and_off_days(spark):
    df = spark.createDataFrame([(date(2020, 12, 5), "1_C"), (date(2020, 7, 30), "1_C"), (date(2020, 7, 31), "1_C"), (date(2020, 7, 31), "2_B"), (date(2020, 8, 2), "1_C")],
                               "d date, client_id string")
    assert history.exclude_holidays(df, "d", [date(2020, 7, 30)], [12]).count() == 3
    assert history.exclude_holidays(df, "d", [], [12]).count() == 4
    assert history.exclude_holidays(df, "d", [date(2020, 7, 30)]).count() == 4
    assert rows(history.working_days(df.where("d = '2020-07-31'"), "d").select("client_id")) == [("2_B",)]


def test_missing_last_schedule_counts_from_ninety_days_before(spark):
    df = spark.createDataFrame([(date(2024, 4, 1), None), (date(2024, 4, 3), date(2024, 4, 1))], "p_date date, last date")
    assert sorted(r.days_diff for r in history.days_since(df, "p_date", "last").collect()) == [2, 90]


def test_clients_of_buildings_and_companies(spark):
    c = spark.createDataFrame([(1, 10)], "company_id long, branch_id long")
    b = spark.createDataFrame([(2, 20)], "building_id long, branch_id long")
    assert rows(history.with_buildings(c, b).select("client_id", "branch_id")) == [("1_C", 10), ("2_B", 20)]


def test_history_with_buildings(spark, tmp_path):
    d, anchor = date(2024, 3, 4), date(2024, 3, 10)
    plan = "menu_id long, {} long, branch_id long, schedule_on date, deleted_at date"
    companies = spark.createDataFrame([(1, "One"), (2, "Test two")], "company_id long, company_name string")
    buildings = spark.createDataFrame([(9, "Tower"), (8, "test tower")], "building_id long, building_name string")
    by_company = spark.createDataFrame([(5, 1, 10, d, None), (5, 1, 10, d, None), (6, 1, 10, date(2024, 3, 5), None), (5, 2, 10, d, d)], plan.format("company_id"))
    by_building = spark.createDataFrame([(5, 9, 10, d, None), (5, 8, 11, d, None)], plan.format("building_id"))
    menus = spark.createDataFrame([(5, 2), (6, 1)], "menu_id long, category_id int")
    branches = spark.createDataFrame([(10, 100), (11, 101)], "branch_id long, restaurant_id long")
    orders = spark.createDataFrame(
        [(1, None, 10, d, 4, 3.0, 2, d), (1, 9, 10, d, 6, None, 2, d), (1, 9, 10, d, 1, 5.0, 2, date(2024, 3, 6)), (1, 8, 11, d, 9, 1.0, 2, d), (1, None, 10, d, 50, 1.0, 1, d)],
        "company_id long, building_id long, branch_id long, schedule_on date, quantity long, rating double, category_id int, created_at date")
    known = history.known_by(orders, "created_at", d)
    assert known.count() == 4
    with pytest.raises(ValueError):
        history.known_by(orders, "created_at", date(2024, 3, 5))
    args = (by_company, orders, menus, branches, companies, anchor)
    guarded = lambda until, table=orders: rows(history.prepared_history(by_company, table, *args[2:], str(tmp_path), by_building, buildings, until, "created_at").select("schedule_on", "restaurant_id", "client_id", "rating", "quantity"))
    assert guarded(d) == [(d, 100, "1_C", 3.0, 4), (d, 100, "9_B", None, 6)]
    for empty in (orders, orders.where("false")):
        with pytest.raises(ValueError, match="2024-03-05"):
            guarded(date(2024, 3, 5), empty)
        assert not list(tmp_path.iterdir())
    both = history.prepared_history(*args, building_schedules=by_building, buildings=buildings)
    assert rows(both.select("client_id", "restaurant_id", "quantity", "rating")) == [("1_C", 100, 4, 3.0), ("9_B", 100, 7, 5.0)]
    assert history.prepared_history(*args, building_schedules=by_building, buildings=buildings, until=date(2024, 3, 3)).isEmpty()
    alone = history.prepared_history(*args)
    assert rows(alone.select("client_id", "quantity")) == [("1_C", 11)]


# ---- scheduling ----


def test_bins_follow_the_formula(spark):
    for n in (3, 4, 5):
        df = spark.createDataFrame([("g", i, float(i // 2), n) for i in range(11)] + [("solo", 1, 1.0, n)], "g string, r long, s double, n int")
        got = {(t.g, t["rank"]): t.bin for t in scheduling.quantile_bins(df, "g", "s", "r", "n").collect()}
        assert got == {**{("g", r): max(1, math.ceil(n * (r - 1) / 10)) for r in range(1, 12)}, ("solo", 1): 1}


def test_average_rank_shares_ties(spark):
    df = spark.createDataFrame([("k", d) for d in (1, 2, 2, 3)], "k string, d long")
    assert rows(scheduling.average_rank(df, ["k"], "d", "p").select("p")) == [(1.0,), (2.5,), (2.5,), (4.0,)]


def test_weights_and_novelty(spark):
    df = spark.createDataFrame([(None, 5), (0, 5), (1, 13), (1, 14), (1, 45), (2, 45)], "c2r_count long, days_diff int")
    got = scheduling.schedule_weight(df).select("novelty", "weight").collect()
    assert [tuple(r) for r in got] == [(1, 200), (1, 200), (0, 100), (0, 0), (2, 50), (0, 0)]
    flags = rules.with_novelty(spark.createDataFrame([(d,) for d in (45, 46, 89, 90, 91, None)], "days_diff int")).collect()
    assert [(r.is_new, r.is_partly_new) for r in flags] == [(False, False), (False, True), (False, True), (False, False), (True, False), (True, False)]


def test_capacity_is_never_exceeded(spark):
    rng = random.Random(3)
    df = spark.createDataFrame([(1 if i % 3 else 2, 7, i, rng.randint(0, 9), 2) for i in range(60)], "p_date int, branch_id long, group_id long, orders long, delivery_capacity int")
    got = scheduling.assign_capacity(df, [F.desc("orders"), F.asc("group_id")], 2)
    assert rows(got.groupBy("p_date").agg(F.count("*"), F.max("slot"))) == [(1, 2, 2), (2, 2, 2)]


def test_branch_without_capacity_is_never_full(spark):
    df = spark.createDataFrame([(1, 7, i, i, None) for i in range(5)] + [(1, 8, i, i, 1) for i in range(5)], "p_date int, branch_id long, group_id long, orders long, delivery_capacity int")
    got = scheduling.assign_capacity(df, [F.desc("orders")], 1)
    assert rows(got.groupBy("branch_id").agg(F.count("*"), F.max("slot"))) == [(7, 5, None), (8, 1, 1)]
    assert scheduling.assign_capacity(df.where("branch_id = 7"), [F.desc("orders")], None).count() == 5


def test_relevance_share_is_per_branch(spark):
    df = spark.createDataFrame([(1, "c", 4, 10, 1, 10, 1), (1, "c", 4, 10, 2, 10, 1), (1, "c", 4, 11, 3, 20, 1)],
                               "schedule_on int, client_id string, group_id long, restaurant_id long, branch_id long, delivered long, y_week_no int")
    assert rows(scheduling.relevance_share(df, 1, 1)) == [(4, 10, 0.25), (4, 11, 0.5)]


def test_publish_rows_by_drop_off_point_and_building(spark):
    d = date(2024, 3, 4)
    companies = spark.createDataFrame([(1, "A", 1, 0, 7), (2, "B", 1, 0, 7), (3, "C", 2, 0, 7)], "company_id long, company_name string, status int, is_active_virtual int, drop_off_point_id long")
    menus = spark.createDataFrame([(50, "old", 100, 2, 1, 1), (51, "new", 100, 2, 1, 1), (52, "off", 100, 2, 0, 1)],
                                  "menu_id long, menu_name string, restaurant_id long, category_id int, status int, publish_status int")
    schedule = spark.createDataFrame([(d, "7_CD", 10, 100), (d, "4_B", 10, 100)], "schedule_on date, client_code string, branch_id long, restaurant_id long")
    predictions = spark.createDataFrame([(10, 100, d, 1, 12), (10, 100, d, 2, 13)], "branch_id long, restaurant_id long, schedule_on date, n long, orders long")
    got = publishing.publish_rows(publishing.drop_off_points(schedule), companies, menus, predictions, ["n"], "drop_off_point_id", drop_tests=False)
    assert rows(got.select("company_id", "menu_id", "ots")) == [(1, 51, 12), (2, 51, 12)]
    got = publishing.building_rows(schedule.withColumnRenamed("client_code", "client_id"), menus, predictions, ["n"])
    assert rows(got.select("building_id", "menu_id", "ots")) == [(4, 51, 12)]


def test_latest_lateness_of_candidates(spark):
    late = spark.createDataFrame([("1_C", 100, "2024_01", 10.0), ("1_C", 100, "2024_03", 30.0), ("1_C", 101, "2024_02", -5.0), ("2_C", 100, "2023_40", 99.0)],
                                 "client_id string, restaurant_id long, week string, minutes double")
    pairs = spark.createDataFrame([("1_C", 100), ("1_C", 102), ("2_C", 101)], "client_id string, restaurant_id long")
    got = lateness.attach_latest(pairs, late, "2023_44").select("client_id", "restaurant_id", "p_lateness", "c_lateness", "r_lateness")
    assert rows(got) == [("1_C", 100, 30.0, 30.0, 30.0), ("1_C", 102, 0.0, 30.0, 0.0), ("2_C", 101, 0.0, 0.0, -5.0)]


# ---- rules ----


def pool(spark, data):
    cols = ("p_date date, group_id long, branch_id long, restaurant_id long, area_id long, type int, type2 int, category int, is_premium int, perday_resto int, orders long, "
            "days_diff int, is_not_blackout int, delivery_capacity int, schedule_status int")
    base = dict(p_date=date(2024, 1, 7), group_id=1, branch_id=1, restaurant_id=1, area_id=1, type=1, type2=10, category=1, is_premium=0, perday_resto=3, orders=1,
                days_diff=50, is_not_blackout=1, delivery_capacity=9, schedule_status=0)
    return spark.createDataFrame([tuple({**base, **d}.values()) for d in data], cols)


@pytest.mark.parametrize("size,types,categories,valid", [
    (3, [10], [1], True), (3, [10, 10], [1, 2], False), (3, [11, 9], [1, 2], False), (4, [10, 11, 9, 9], [1, 2, 3, 4], True),
    (5, [10, 11, 10, 9, 9], [1, 2, 3, 4, 5], True), (5, [10, 11, 10, 9, 9], [1, 2, 3, 4, 4], False), (4, [12, 13], [1, 2], False),
    (4, [10, 11, 12, 12], [1, 2, 3, 4], False), (4, [10, 11, 12], [1, 1, 1], True)])
def test_type_list_rule(spark, size, types, categories, valid):
    rows_ = pool(spark, [dict(type2=t, category=c, perday_resto=size) for t, c in zip(types, categories)])
    assert rules.type_list(rules.group_days(rows_)).isEmpty() == valid


def test_planted_violations_are_found(spark):
    data = [
        dict(group_id=1, is_not_blackout=0), dict(group_id=1, is_not_blackout=0, schedule_status=1),
        dict(group_id=2, branch_id=5, delivery_capacity=1, area_id=1, type=5), dict(group_id=3, branch_id=5, delivery_capacity=1, area_id=2, type=6),
        dict(group_id=4, days_diff=None, branch_id=6), dict(group_id=4, days_diff=99, branch_id=7, type=7, is_premium=1, restaurant_id=4),
        dict(group_id=4, days_diff=60, branch_id=8, type=9, is_premium=1, restaurant_id=5), dict(group_id=4, branch_id=9, type=9, restaurant_id=6),
    ]
    p = pool(spark, data)
    days = rules.group_days(p)
    assert rows(rules.blackout(p).select("group_id")) == [(1,)]
    assert rows(rules.branch_areas(p).select("group_id")) == [(2,), (3,)]
    assert rows(rules.branch_capacity(p).select("branch_id", "times_scheduled")) == [(5, 2)]
    assert rows(rules.new_per_day(days).select("group_id", "n_new")) == [(4, 2)]
    assert rows(rules.new_and_partial(days).select("group_id")) == [(4,)]
    assert rows(rules.premium_share(days).select("group_id", "n_premium")) == [(4, 2)]
    assert rows(rules.type_mismatch(days).select("group_id", "scheduled")) == [(1, 1), (2, 1), (3, 1), (4, 4)]
    assert rows(rules.type_duplicate(p, "type", ["branch_id"]).select("group_id", "branch_id")) == [(4, 9)]
    top = spark.createDataFrame([(4, r) for r in (1, 4, 5, 6)], "group_id long, restaurant_id long")
    assert rules.top_overlap(p, top).first().top_count == 4


def test_category_limit_treats_unlisted_and_empty_limits(spark):
    many = [dict(category=22, branch_id=i) for i in range(3)] + [dict(category=99, branch_id=i) for i in range(150)] + [dict(category=23, branch_id=i) for i in range(101)]
    got = rules.category_limit(pool(spark, many), rules.CATEGORY_LIMITS, weekdays_only=True)
    assert rows(got.select("category", "times_scheduled", "max_schedules")) == [(22, 3, 2), (23, 101, 100)]


def test_type_sets(spark):
    got = rules.type_sets(rules.group_days(pool(spark, [dict(type=5), dict(type=6), dict(type=1)])))
    assert rows(got.select("found", "allowed")) == [(2, 1)]


def test_report_counts_what_the_rules_return(spark):
    rng = random.Random(9)
    data = [dict(p_date=date(2024, 1, 5 + rng.randint(0, 5)), group_id=rng.choice([1, 2, 3, None]) if i % 50 == 0 else rng.randint(1, 4), branch_id=rng.randint(1, 9), restaurant_id=rng.randint(1, 6),
                 area_id=rng.randint(1, 3), type=rng.choice([1, 5, 6, 7, 9]), type2=rng.randint(9, 12), category=rng.choice([1, 2, 8, 17, 22, 99]), is_premium=rng.choice([0, 1, None]),
                 perday_resto=rng.choice([3, 3, 4, 5]), days_diff=rng.choice([None, 10, 50, 89, 90, 200]), is_not_blackout=rng.randint(0, 1), delivery_capacity=rng.choice([1, 2, 40]),
                 schedule_status=rng.choice([0, 0, 0, 1, None])) for i in range(400)]
    df, top = pool(spark, data + data[:40]), spark.createDataFrame([(g, r) for g in (1, 2, 3) for r in (1, 2, 3, 4)], "group_id long, restaurant_id long")
    days = rules.group_days(df)
    want = {r.name: r.value for r in rules.descriptive(df).unionByName(rules.pair_coverage(df)).collect()}
    counted = {"blackout": rules.blackout(df), "branch_areas": rules.branch_areas(df), "branch_capacity": rules.branch_capacity(df), "category_limit": rules.category_limit(df, rules.CATEGORY_LIMITS, True),
               "category_limit_2": rules.category_limit(df, rules.CATEGORY_LIMITS_2, False), "type_sets": rules.type_sets(days), "type_mismatch": rules.type_mismatch(days),
               "type_list": rules.type_list(days), "top_overlap": rules.top_overlap(df, top), "new_per_day": rules.new_per_day(days), "partial_per_group": rules.partial_per_group(days),
               "new_and_partial": rules.new_and_partial(days), "premium_share": rules.premium_share(days), "type_duplicate": rules.type_duplicate(df, "type", ["branch_id", "orders"])}
    want |= {name: float(rows_.count()) for name, rows_ in counted.items()}
    got = {r.name: r.value for r in rules.report(df, days, top).collect()}
    assert got == pytest.approx(want) and min(got[n] for n in counted) > 0


# ---- documents, arrays, metrics ----


def test_one_document_per_branch_and_week(spark, tmp_path):
    days = [date(2024, 1, 6), date(2024, 1, 7), date(2024, 1, 13), date(2024, 1, 14)]
    df = spark.createDataFrame([(1, "b", 2, 3, "r", d, g, "g", 0, 5) for d in days for g in (8, 9)], "branch_id long, branch_name string, capacity int, restaurant_id long, "
                               "restaurant_name string, schedule_on date, group_id long, group_name string, schedule_status int, orders long")
    lines = spark.read.text(documents.write_branch_docs(df, str(tmp_path))).where("length(trim(value)) > 0").collect()
    docs = {r["week"]: r["schedules"] for r in (json.loads(x.value) for x in lines)}
    assert {w: sorted(x) for w, x in docs.items()} == {"2023-12-31": ["Saturday"], "2024-01-07": ["Saturday", "Sunday"], "2024-01-14": ["Sunday"]}
    assert [e["group_id"] for e in docs["2024-01-14"]["Sunday"]] == [8, 9]


def test_a_document_of_any_length_is_written_row_by_row(spark, tmp_path):
    """A branch without capacity, with names that need escapes and nulls: more entries than a window keeps in memory."""
    many = spark.range(20_000).selectExpr("1L AS branch_id", "'a \"b\" \\\\ c' AS branch_name", "CAST(NULL AS INT) AS capacity", "3L AS restaurant_id", "CAST(NULL AS STRING) AS restaurant_name",
                                          "DATE '2024-01-07' + CAST(id % 3 AS INT) AS schedule_on", "id AS group_id", "IF(id % 7 = 0, NULL, 'g\n' || id) AS group_name", "0 AS schedule_status", "id % 5 AS orders")
    small = many.where("group_id < 4").withColumn("branch_id", F.col("group_id") + 10)
    df = many.unionByName(small).repartition(6)
    lines = spark.read.text(documents.write_branch_docs(df, str(tmp_path))).where("length(trim(value)) > 0").collect()
    docs = {d["branch_id"]: d for d in (json.loads(r.value) for r in lines)}
    assert len(lines) == len(docs) == 5 and docs[1]["branch_name"] == 'a "b" \\ c' and "capacity" not in docs[1]
    entries = [e for day in docs[1]["schedules"].values() for e in day]
    assert sorted(e["group_id"] for e in entries) == list(range(20_000)) and sorted(docs[1]["schedules"]) == ["Monday", "Sunday", "Tuesday"]
    assert all([e["group_id"] for e in day] == sorted(e["group_id"] for e in day) for day in docs[1]["schedules"].values())
    assert entries[1] == {"group_id": entries[1]["group_id"], "group_name": f"g\n{entries[1]['group_id']}", "schedule_status": 0, "orders": entries[1]["group_id"] % 5}


def test_array_rules(spark):
    one = spark.range(1).select(F.array(*[F.lit(x) for x in (3, 1, 3, 2, 1)]).alias("a"), F.array(F.lit(1), F.lit(3)).alias("b"))
    assert tuple(one.select(arrays.has_repeats(F.col("a")), arrays.text(arrays.repeated(F.col("a"))), arrays.overlap_size(F.col("a"), F.col("b"))).first()) == (True, "1,3", 2)


def test_metrics_against_hand_values(spark):
    df = spark.createDataFrame([(0.0, -1.0), (1.0, 1.4), (2.0, 0.6), (3.0, 3.0)], "y double, predictions double")
    r = model.regression_report(df).first()
    assert (r.mean_abs_error, r.mse, r.diff_records, r.diff_adj1_records) == (0.25, 0.25, 1, 0)
    assert r.r2 == pytest.approx(1 - 1 / 5) and r.overall_acc == pytest.approx(4 / 6)
    f1 = model.macro_f1(df).first()
    assert f1.classes == 4 and f1.macro_f1 == pytest.approx((1 + 2 / 3 + 0 + 1) / 4)


def test_training_scores_new_rows(spark):
    data = [(i % 7, float(i % 5), "ab"[i % 2], "k", float(2 * (i % 5) + i % 2)) for i in range(80)]
    df = spark.createDataFrame(data, "day long, x double, kind string, fixed string, orders double")
    spec = model.FeatureSpec(["x"], ["kind", "fixed"])
    fitted = model.train(df, spec, trees=5, depth=3)
    out = model.score(fitted, df, spec, ["day"]).collect()
    assert len(out) == 80 and all(r.orders >= 0 for r in out)
    odd = spark.createDataFrame([(1, 1.0, "z", "k", 0.0), (1, 1.0, "a", "q", 0.0), (1, 1.0, None, "k", 0.0)], df.schema)
    known, rejected = model.split_unseen(odd.union(df), df, ["kind", "fixed"])
    assert known.columns == df.columns and known.count() == 80
    assert sorted(r.reason for r in rejected.collect()) == ["unseen fixed", "unseen kind", "unseen kind"]


def test_fit_reports_of_a_saved_model(spark, tmp_path):
    """The loaded model scores like the one in memory, and every report equals plain Python over the staged predictions."""
    days = [date(2024, 1, d) for d in range(1, 29)]
    data = [(days[i % 28], float(i % 5), "abc"[i % 3] if days[i % 28] < date(2024, 1, 15) else "abz"[i % 3], float(2 * (i % 5) + i % 2)) for i in range(300)]
    df = spark.createDataFrame(data, "day date, x double, kind string, orders double")
    spec = model.FeatureSpec(["x"], ["kind"])
    predictions, report, rejected = model.fit_reports(df, spec, "day", date(2024, 1, 22), ["kind"], str(tmp_path), ["day"], trees=6, depth=3)
    training, validation = history.time_split(df, "day", date(2024, 1, 22))
    unseen = validation.where("kind = 'z'").count()
    counts = {r.dataset: r.records for r in report.collect()}
    assert counts == {"train": training.count(), "validation": validation.count() - unseen, "complete": 300} and rejected.count() == unseen > 0
    for r in report.collect():
        pairs = [(p.y, p.predictions, p.orders) for p in predictions.where(F.col("dataset") == r.dataset).collect()]
        y, p, whole = map(np.array, zip(*pairs, strict=True))
        assert np.array_equal(whole, np.maximum(0, np.round(p)))
        assert r.mean_abs_error == pytest.approx(np.abs(y - whole).mean()) and r.actual_r2 == pytest.approx(1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum())
        f1 = [2 * ((y == k) & (whole == k)).sum() / ((y == k).sum() + (whole == k).sum()) for k in set(y) | set(whole)]
        assert r.macro_f1 == pytest.approx(np.mean(f1)) and r.acc == pytest.approx((y == whole).mean())
    from pyspark.ml import PipelineModel

    first, again = model.train(training, spec, trees=6, depth=3), PipelineModel.load(f"{tmp_path}/split_model")
    assert rows(model.score(first, training, spec, ["day"])) == rows(model.score(again, training, spec, ["day"]))


def test_candidates_equal_the_naive_product(spark):
    from conftest import SMALL
    from schedlytics.sources.views import Views

    v = Views(spark, SMALL)
    got = candidates.candidate_rows(v.companies, v.restaurants, v.branches, v.branch_area, date(1998, 12, 20), date(1998, 12, 26))
    clients = candidates.candidate_clients(v.companies).collect()
    serving = candidates.serving_restaurants(v.restaurants, v.branches, v.branch_area).collect()
    pairs = {(c.client_id, s.restaurant_id) for c in clients for s in serving if c.area_id == s.area_id}
    assert got.count() == 5 * len(pairs)
    assert {(r.client_id, r.restaurant_id) for r in got.select("client_id", "restaurant_id").distinct().collect()} == pairs
