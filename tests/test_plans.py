"""Plan shape: no products, no Python rows, no un-partitioned windows over facts, filters and columns at the scan."""

import re

import pytest

from conftest import SMALL
from schedlytics.queries import load

QUERIES = load()
CHECKED = """cross_join candidate_grid area_membership area_contains nearest_cluster cluster_groups order_schedule_ratio client_routing
    prepared_history panel_client panel_pair training_features lateness_features scoring_candidates schedule_input relevance_share capacity_assign
    publish_rows duplicate_flag window_broadcast recency_weighted rule_perday_matrix rule_top_overlap rule_type_list rule_report""".split()


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", CHECKED)
def test_plan_shape(spark, name):
    text = plan(QUERIES[name].run(spark, SMALL))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "BatchEvalPython", "MapInPandas", "FlatMapGroups"):
        assert node not in text
    # A window without partition keys may only number the distinct weeks.
    for line in re.findall(r"Window \[.*", text):
        brackets = re.findall(r", \[([^\[\]]*)\]", line)
        if len(brackets) == 1 and (" ASC" in brackets[0] or " DESC" in brackets[0]):
            assert brackets[0].startswith("iso_week"), line


def test_scan_reads_only_needed_columns(spark):
    text = plan(QUERIES["delivered_lunch"].run(spark, SMALL))
    assert "l_extendedprice" not in text and "l_comment" not in text
    assert "Not(EqualTo(l_returnflag" not in text and "PushedFilters: [IsNotNull(o_orderkey)" in text.replace("l_orderkey", "o_orderkey")


def test_date_window_reaches_the_scan(spark):
    from datetime import date

    from pyspark.sql import functions as F

    from schedlytics.functions import calendar as cal
    from schedlytics.sources.sinks import stage
    from schedlytics.session import work_dir

    days = stage(spark.range(100).select(F.date_add(F.lit(date(2024, 1, 1)), F.col("id").cast("int")).alias("d")), work_dir(spark), "days")
    assert "GreaterThanOrEqual(d,2024-01-10)" in plan(days.where(cal.in_window(F.col("d"), date(2024, 1, 10), date(2024, 1, 20))))


def test_top_n_is_limited_before_the_shuffle(spark):
    assert "WindowGroupLimit" in plan(QUERIES["top5_per_group"].run(spark, SMALL))
    assert "WindowGroupLimit" in plan(QUERIES["capacity_assign"].run(spark, SMALL))


def test_expanding_join_keeps_its_layout(spark):
    assert "REPARTITION_BY_NUM" in plan(QUERIES["area_membership"].run(spark, SMALL))


def test_relevance_reads_the_order_lines_once(spark):
    assert "l_orderkey" not in plan(QUERIES["relevance_share"].run(spark, SMALL))


def test_earliest_day_does_not_join_the_pool_again(spark, monkeypatch):
    from schedlytics.plans import scheduling

    seen, days = [], scheduling.days_since
    monkeypatch.setattr(scheduling, "days_since", lambda df, *args: seen.append(plan(df)) or days(df, *args))
    QUERIES["schedule_input"].run(spark, SMALL)
    assert len(seen) == 1 and "l_orderkey" not in seen[0]


def test_rule_report_looks_at_the_written_pool(spark, monkeypatch):
    from schedlytics.plans import rules

    seen, check = [], rules.require_scheduled
    monkeypatch.setattr(rules, "require_scheduled", lambda df: seen.append(plan(df)) or check(df))
    QUERIES["rule_report"].run(spark, SMALL)
    assert len(seen) == 1 and "l_orderkey" not in seen[0]


def test_pool_report_counts_restaurants_of_a_group_day_by_top_ones_only(spark):
    from schedlytics.plans import rules

    pool = spark.sql("""SELECT date'1998-12-20' AS p_date, id % 2 AS branch_id, 1L AS group_id, id AS restaurant_id, 1L AS area_id, 5 AS type, 1 AS category, 3 AS perday_resto,
                               0 AS schedule_status, 1 AS is_not_blackout, 1 AS delivery_capacity FROM range(20)""")
    top = spark.sql("SELECT 1L AS group_id, id AS restaurant_id FROM range(3)")
    report = rules._pool_report(pool, top, "type")
    lines = str(report._jdf.queryExecution().optimizedPlan().toString()).splitlines()
    expand = next(i for i, line in enumerate(lines) if "Expand" in line)
    assert any("Join LeftOuter" in line for line in lines[expand:])
    assert report.first().top_overlap == 1 and report.first().restaurants == 20


def test_recomputed_report_has_no_window_over_a_dataset(spark):
    from schedlytics.queries.pipelines import recomputed

    predictions = spark.createDataFrame([("train", 1.0, 1.2), ("train", 3.0, 1.8), ("validation", 2.0, 2.0)], "dataset string, y double, predictions double")
    report = recomputed(predictions)
    assert "Window" not in plan(report)
    assert {r.dataset: (r.records, round(r.mse, 6), r.actual_r2 and round(r.actual_r2, 6)) for r in report.where("dataset = 'train'").collect()} == {"train": (2, 0.5, 0.26)}
