"""Joins whose output is many times their input: what is known of a pair, a client or a day comes before or into the pairs, never by a shuffle of them."""

import re
from datetime import date

import pytest

from conftest import SMALL
from pyspark.sql import functions as F
from schedlytics import contract
from schedlytics.functions import calendar as cal
from schedlytics.operators import joins
from schedlytics.operators.dedupe import keep_one
from schedlytics.plans import candidates, clusters, lateness, model, ratio
from schedlytics.queries import load, pipelines
from schedlytics.sources.views import Views

QUERIES = load()


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_expanding_join_with_facts_equals_two_plain_joins(spark, how):
    left = spark.createDataFrame([(i % 40, 0 if i % 3 else i % 5) for i in range(90)] + [(None, 0), (3, None), (1, 99)], "c long, area_id long")
    right = spark.createDataFrame([(i % 30, i, 0 if i % 3 else i % 7) for i in range(70)] + [(7, 1, 0)] * 20 + [(None, 5, 0), (4, 4, None)], "b long, n int, area_id long")
    facts = spark.createDataFrame([(c, b, c * 100 + b, None if b % 4 == 0 else "x") for c in range(0, 60, 3) for b in range(0, 40, 2)] + [(None, 3, 1, "n"), (3, None, 1, "n")], "c long, b long, v long, t string")
    got = joins.expanding_join(left, right, "area_id", left_rows=10, right_rows=4, how=how, facts=facts, on=("c", "b"))
    want = left.join(right, "area_id", how).join(facts, ["c", "b"], "left")
    assert rows(got.select("area_id", "c", "b", "n", "v", "t")) == rows(want.select("area_id", "c", "b", "n", "v", "t"))


@pytest.mark.parametrize(("lists", "cells"), [(64, 16), (4, 4), (2, 1)])
def test_a_left_row_is_moved_once_for_many_lists(spark, monkeypatch, lists, cells):
    """Rows that are dealt out to cells, and pairs with their facts however the lists are cut into cells."""
    monkeypatch.setattr(joins, "LISTS", lists)
    monkeypatch.setattr(joins, "KEY_CELLS", cells)
    left = spark.createDataFrame([(i, i % 2) for i in range(400)], "c long, area_id long")
    right = spark.createDataFrame([(i, i % 2) for i in range(200)] + [(3, 0), (7, None)], "b long, area_id long")
    facts = spark.createDataFrame([(c, b, c * 1000 + b) for c in range(0, 400, 7) for b in range(0, 200, 3)], "c long, b long, v long")
    dealt, deal = [], type(left).repartition
    monkeypatch.setattr(type(left), "repartition", lambda df, *how: dealt.append(df) or deal(df, *how))
    for known in (None, facts):
        got = joins.expanding_join(left, right, "area_id", left_rows=50, right_rows=10, facts=known, on=("c", "b"))
        want = left.join(right, "area_id")
        want = want if known is None else want.join(facts, ["c", "b"], "left")
        assert rows(got.select(want.columns)) == rows(want)
    # A key has 4 lines and 10 or 11 lists.
    columns = max(-(-11 // lists), -(-cells // 4))
    assert all(df.count() <= 400 * columns < 4000 * max(1, columns // 10) for df in dealt) and len(dealt) == 2


def test_equal_right_rows_spread_over_lists(spark):
    left = spark.createDataFrame([(1, 0)], "c long, area_id long")
    right = spark.createDataFrame([(7, 0)] * 4000, "b long, area_id long")
    got = joins.expanding_join(left, right, "area_id", right_rows=100)
    assert got.count() == 4000
    assert max(r.n for r in got.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()) < 3000


@pytest.mark.parametrize("name", ["latest_lateness", "scoring_candidates", "score_attach_branch", "order_schedule_ratio"])
def test_no_join_follows_the_pairs(spark, name):
    lines = QUERIES[name].run(spark, SMALL)._jdf.queryExecution().executedPlan().toString().splitlines()
    pairs = next(i for i, line in enumerate(lines) if "Generate explode(_list" in line)
    assert not [line for line in lines[:pairs] if re.search("Join|Exchange", line)]


def test_hybrid_writes_no_pairs(spark, monkeypatch):
    written = []
    monkeypatch.setattr(pipelines, "stage", lambda df, folder, name, keep=pipelines.stage: written.append(name) or keep(df, folder, name))
    QUERIES["hybrid_predictions"].run(spark, SMALL)
    assert not {"ratio_rows", "model_rows"} & set(written)


def test_scores_depend_on_all_features():
    sql = QUERIES["score_attach_branch"].check_sql()
    score = sql[sql.index("branch_scores AS"):]
    assert all(c in score for c in ("c_orders_mean", "r_orders_median", "p_orders_max", "p_pair_rank"))


def test_latest_means_of_sides_equal_those_of_pairs(spark):
    clients = spark.createDataFrame([("1_C", 1), ("2_C", 1), ("3_C", 2)], "client_id string, area_id long")
    serving = spark.createDataFrame([(5, 1), (6, 1), (6, 2)], "restaurant_id long, area_id long")
    late = spark.createDataFrame([("1_C", 5, "1997_02", 3.0), ("1_C", 5, "1997_03", 9.0), ("2_C", 6, "1997_01", -4.0), ("9_C", 6, "1997_09", 8.0)], "client_id string, restaurant_id long, week string, minutes double")
    pairs = clients.join(serving, "area_id")
    columns = ["client_id", "restaurant_id", "p_lateness", "c_lateness", "r_lateness"]
    assert rows(lateness.latest_of_candidates(clients, serving, late, "1996_44").select(columns)) == rows(lateness.attach_latest(pairs, late, "1996_44").select(columns))


def test_cluster_sums_of_labelled_predictions(spark):
    groups = spark.createDataFrame([(1, 7, "1_0"), (2, 7, "1_0"), (3, 8, "2_1")], "company_id long, area_id long, group_id string")
    orders = spark.createDataFrame([(1, 4, 40, 2.0), (2, 4, 40, 3.0), (3, 4, 40, None), (9, 4, 40, 5.0)], "company_id long, branch_id long, restaurant_id long, orders double")
    dated = orders.withColumn("schedule_on", F.lit(date(2024, 1, 1)))
    want = [(7, "1_0", 4, 5.0), (8, "2_1", 4, 0.0)]
    columns = ["area_id", "group_id", "branch_id", "orders"]
    labelled = orders.join(clusters.member_labels(groups), "company_id")
    assert rows(clusters.cluster_predictions(groups, dated).select(columns)) == want == rows(clusters.cluster_predictions(groups, labelled).select(columns))


def test_branches_from_lists_and_reasons(spark):
    branches = spark.createDataFrame([(1, 5, 1), (2, 5, 2), (3, 5, 3), (4, 6, 1)], "branch_id long, restaurant_id long, status int")
    areas = spark.createDataFrame([(1, 9), (1, 9), (2, 9), (3, 9), (4, 8)], "branch_id long, area_id long")
    scored = spark.createDataFrame([(date(2024, 1, 1), "1_C", 5, 9, 2), (date(2024, 1, 1), "1_C", 6, 9, 2)], "schedule_on date, client_id string, restaurant_id long, area_id long, orders long")
    want = [(date(2024, 1, 8), "1_C", 5, b, 2) for b in (1, 1, 2)]
    lists = model.branch_lists(scored, branches, areas)
    assert rows(model.attach_branches(scored, branches, areas)) == want == rows(model.attach_branches(lists, branches, areas))
    seen = spark.createDataFrame([(1, 2)], "category int, type int")
    tagged = model.tag_unseen(spark.createDataFrame([(1, 2), (3, 2), (1, 4), (None, 2)], "category int, type int"), seen, ["category", "type"])
    assert rows(tagged) == sorted([(1, 2, None), (3, 2, "unseen category"), (1, 4, "unseen type"), (None, 2, "unseen category")], key=repr)


def test_shaped_columns_stay_as_they_are(spark):
    columns = contract.parse("d d, x f, n i")
    df = spark.createDataFrame([(date(2024, 1, 2), 1.23456789, 3)], "d date, x double, n int")
    plain = contract.conform(df, columns)
    early = contract.conform(contract.shaped(df, columns), columns)
    assert rows(plain) == rows(early) and [f.dataType for f in plain.schema] == [f.dataType for f in early.schema]
    days = cal.date_spine(spark.range(1), date(2024, 2, 28), date(2024, 3, 2))
    assert [r[0] for r in days.select(cal.day_text(F.col("schedule_on"), date(2024, 2, 28), date(2024, 3, 2))).collect()] == ["2024-02-28", "2024-02-29", "2024-03-01", "2024-03-02"]


def test_one_row_per_key_moves_its_order_once(spark):
    df = spark.createDataFrame([(1, 5, None, "a"), (1, 5, 2, "b"), (1, None, 9, "c"), (None, 1, 1, None), (2, 3, 3, "x")], "k long, a long, b long, t string")
    plan = lambda frame: frame._jdf.queryExecution().executedPlan().toString()
    for last, want in ((True, [(1, 5, 2), (2, 3, 3), (None, 1, 1)]), (False, [(1, None, 9), (2, 3, 3), (None, 1, 1)])):
        one = keep_one(df.select("k", "a", "b"), ["k"], ["a", "b"], last)
        assert rows(one) == sorted(want, key=repr) and "_by(" not in plan(one)
        assert rows(one) == rows(keep_one(df, ["k"], ["a", "b"], last).drop("t")) and "_by(" in plan(keep_one(df, ["k"], ["a", "b"], last))


def test_first_orders_are_those_of_the_days_that_are_scheduled(spark):
    v = Views(spark, SMALL)
    scheduled = pipelines.client_schedules(v).select("schedule_on").distinct()
    first = pipelines.first_orders(v)
    assert first.count() == v.order_rows.join(scheduled, "schedule_on").count() < v.order_rows.count()


def test_label_sums_equal_those_of_the_pairs(spark):
    clients = spark.createDataFrame([(1, 7, "a"), (2, 7, "a"), (3, 7, None), (3, 7, None), (4, 8, "b"), (5, None, "b")], "company_id long, area_id long, label string")
    offers = spark.createDataFrame([(7, 10, 1, 2.0), (7, 11, 1, 2.0), (7, 11, 1, 2.0), (7, 20, 2, 0.0), (8, 20, 2, 5.0), (None, 30, 3, 1.0)], "area_id long, branch_id long, restaurant_id long, fallback double")
    history = spark.createDataFrame([(1, 1, 9.0), (3, 1, 0.0), (3, 2, 4.0), (4, 1, 8.0), (9, 2, 6.0)], "company_id long, restaurant_id long, own double")
    pairs = clients.join(offers, "area_id").join(history, ["company_id", "restaurant_id"], "left")
    want = pairs.groupBy("label", "branch_id", "restaurant_id").agg(F.sum(F.coalesce("own", "fallback")).alias("ots"))
    assert rows(ratio.label_sums(clients, offers, history, ["label"]).select(want.columns)) == rows(want)


def test_counts_equal_those_of_the_pairs(spark):
    left = spark.createDataFrame([(i, i % 3 if i % 4 else None) for i in range(50)], "c long, area_id long")
    right = spark.createDataFrame([(i, i % 3 if i % 7 else None, "x" if i % 2 else None) for i in range(40)] * 2 + [(1, 9, "z")], "b long, area_id long, reason string")
    want = left.join(right, "area_id").groupBy("reason").agg(F.count("*").alias("n"))
    assert rows(joins.expanding_counts(left, right, "area_id", ["reason"])) == rows(want)


@pytest.mark.parametrize("name", ["cluster_predictions", "model_rejects"])
def test_sums_and_counts_do_not_repeat_clients(spark, monkeypatch, name):
    """No client row is repeated for the branches of its area: where sides are expanded, they hold groups."""
    expanded, keep = [], joins.expanding_join
    for module in (ratio, candidates):
        monkeypatch.setattr(module, "expanding_join", lambda left, right, key, **how: expanded.append(left.columns) or keep(left, right, key, **how))
    QUERIES[name].run(spark, SMALL)
    assert not [c for c in expanded if {"company_id", "client_id"} & set(c)]
