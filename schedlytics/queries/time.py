"""Calendar and date-window queries."""

from datetime import date

from pyspark.sql import functions as F

from schedlytics.functions import calendar as cal
from schedlytics.functions import scalars as S
from schedlytics.plans import history
from schedlytics.registry import check_step, query

ANCHOR = date(1998, 12, 20)
SPECIAL = (date(1998, 10, 1), date(1998, 10, 31))
HOLIDAYS = (date(1998, 7, 30), date(1998, 8, 2), date(1998, 8, 23), date(1999, 1, 1))

check_step("placed", "SELECT o_orderkey AS order_id, o_custkey AS company_id, CAST(o_orderdate AS DATE) AS d FROM orders")


def placed(v):
    return v.orders.select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("company_id"), F.to_date("o_orderdate").alias("d"))


@query("lookback_window", "order_id i, d d, in_months b, in_weeks b, in_days b", """
    SELECT order_id, d, d BETWEEN DATE '1998-09-20' AND DATE '1998-12-20' AS in_months,
           d BETWEEN DATE '1998-11-15' AND DATE '1998-12-20' AS in_weeks, d BETWEEN DATE '1998-12-13' AND DATE '1998-12-20' AS in_days
    FROM placed WHERE d BETWEEN DATE '1998-06-20' AND DATE '1998-12-20'""")
def lookback_window(v):
    d = F.col("d")
    return placed(v).where(cal.in_window(d, cal.lookback(ANCHOR, months=6), ANCHOR)).select(
        "order_id", "d", cal.in_window(d, cal.lookback(ANCHOR, months=3), ANCHOR).alias("in_months"),
        cal.in_window(d, cal.lookback(ANCHOR, weeks=5), ANCHOR).alias("in_weeks"),
        cal.in_window(d, cal.lookback(ANCHOR, days=7), ANCHOR).alias("in_days"))


@query("snap_sunday", "d d, sunday d, n i", """
    SELECT d, d - CAST(isodow(d) % 7 AS INTEGER) AS sunday, count(*) AS n FROM placed GROUP BY 1, 2""")
def snap_sunday(v):
    return placed(v).groupBy("d").agg(F.count("*").alias("n")).withColumn("sunday", cal.snap_sunday(F.col("d")))


@query("adaptive_window", "order_id i, d d", """
    SELECT order_id, d FROM placed WHERE d BETWEEN DATE '1998-08-10' AND DATE '1998-12-10'""")
def adaptive_window(v):
    return placed(v).where(cal.in_window(F.col("d"), *cal.ratio_window(date(1998, 12, 24), SPECIAL[0])))


@query("exclude_period", "d d, n i", """
    SELECT d, count(*) AS n FROM placed WHERE NOT (d >= DATE '1998-10-01' AND d < DATE '1998-10-31') GROUP BY 1""")
def exclude_period(v):
    return placed(v).where(cal.outside_period(F.col("d"), *SPECIAL)).groupBy("d").agg(F.count("*").alias("n"))


@query("exclude_holidays", "d d, n i", """
    SELECT d, count(*) AS n FROM placed
    WHERE d NOT IN (DATE '1998-07-30', DATE '1998-08-02', DATE '1998-08-23', DATE '1999-01-01') AND month(d) <> 12 GROUP BY 1""")
def exclude_holidays(v):
    return history.exclude_holidays(placed(v), "d", HOLIDAYS, months=(12,)).groupBy("d").agg(F.count("*").alias("n"))


@query("sunday_week_shift", "order_id i, shifted d, iso_week i", """
    SELECT order_id, d + 1 AS shifted, isoyear(d + 1) * 100 + week(d + 1) AS iso_week FROM placed""")
def sunday_week_shift(v):
    shifted = cal.sunday_shift(F.col("d"))
    return placed(v).select("order_id", shifted.alias("shifted"), cal.iso_year_week(shifted).alias("iso_week"))


@query("dense_week_index", "order_id i, d d, week_no i", """
    SELECT order_id, d, dense_rank() OVER (ORDER BY isoyear(d + 1) * 100 + week(d + 1)) AS week_no FROM placed""")
def dense_week_index(v):
    return cal.with_week_index(placed(v), "d")


@query("year_week_key", "d d, y_week_no i, n i", """
    SELECT d, (year(d) - CASE WHEN week(d) >= 51 AND month(d) = 1 THEN 1 ELSE 0 END) * 100 + week(d) AS y_week_no, count(*) AS n
    FROM placed GROUP BY 1, 2""")
def year_week_key(v):
    return placed(v).groupBy("d", cal.year_week(F.col("d")).alias("y_week_no")).agg(F.count("*").alias("n"))


@query("year_week_text", "d d, week s, n i", """
    SELECT d, CAST(year(d) - CASE WHEN week(d) > 45 AND month(d) = 1 THEN 1 ELSE 0 END AS VARCHAR) || '_'
              || lpad(CAST(week(d) AS VARCHAR), 2, '0') AS week, count(*) AS n
    FROM placed GROUP BY 1, 2""")
def year_week_text(v):
    return placed(v).groupBy("d", cal.year_week_text(F.col("d")).alias("week")).agg(F.count("*").alias("n"))


@query("week_label", "d d, label s, n i", """
    SELECT d, 'W_' || CAST(week(d + 1) + 1 AS VARCHAR) AS label, count(*) AS n FROM placed GROUP BY 1, 2""")
def week_label(v):
    return placed(v).groupBy("d", cal.week_label(F.col("d")).alias("label")).agg(F.count("*").alias("n"))


@query("day_of_week", "weekday i, name s, n i", """
    SELECT isodow(d) - 1 AS weekday, dayname(d) AS name, count(*) AS n FROM placed GROUP BY 1, 2""")
def day_of_week(v):
    return placed(v).groupBy(cal.weekday(F.col("d")).alias("weekday"), cal.day_name(F.col("d")).alias("name")).agg(F.count("*").alias("n"))


@query("working_days", "client_id s, schedule_on d, quantity i", """
    SELECT CASE WHEN building_id IS NULL THEN company_id || '_C' ELSE building_id || '_B' END AS client_id, schedule_on, sum(quantity) AS quantity
    FROM order_rows WHERE NOT (building_id IS NULL AND isodow(schedule_on) IN (5, 6)) GROUP BY 1, 2""")
def working_days(v):
    rows = v.order_rows.withColumn("client_id", S.client_id(F.col("company_id"), F.col("building_id")))
    return history.working_days(rows, "schedule_on").groupBy("client_id", "schedule_on").agg(F.sum("quantity").alias("quantity"))


@query("date_spine", "company_id i, area_id i, schedule_on d", """
    SELECT company_id, area_id, CAST(d AS DATE) AS schedule_on
    FROM companies, generate_series(DATE '1998-12-20', DATE '1998-12-24', INTERVAL 1 DAY) AS s(d)""")
def date_spine(v):
    return cal.date_spine(v.companies.select("company_id", "area_id"), ANCHOR, date(1998, 12, 24))


@query("last_n_weeks", "d d, week_start d, y_week_no i", """
    SELECT d, w AS week_start, (year(w) - CASE WHEN week(w) >= 51 AND month(w) = 1 THEN 1 ELSE 0 END) * 100 + week(w) AS y_week_no
    FROM (SELECT d, CAST(unnest(generate_series(d - 35, d, INTERVAL 1 DAY)) AS DATE) AS w FROM (SELECT DISTINCT d FROM placed) AS days) AS spread
    WHERE isodow(w) = 7""")
def last_n_weeks(v):
    weeks = cal.last_n_weeks(placed(v).select("d").distinct(), "d", 5)
    return weeks.withColumn("y_week_no", cal.year_week(F.col("week_start")))


check_step("last_schedules", """
    SELECT company_id, branch_id, max(CASE WHEN deleted_at IS NULL AND schedule_on BETWEEN DATE '1998-09-19' AND DATE '1998-12-19'
                                           THEN schedule_on END) AS last_schedule_on
    FROM menu_schedules GROUP BY 1, 2""")


@query("days_since_last", "company_id i, branch_id i, last_schedule_on d, days_diff i", """
    SELECT company_id, branch_id, coalesce(last_schedule_on, DATE '1998-12-20' - 90) AS last_schedule_on,
           DATE '1998-12-20' - coalesce(last_schedule_on, DATE '1998-12-20' - 90) AS days_diff
    FROM last_schedules""")
def days_since_last(v):
    pairs = v.menu_schedules.groupBy("company_id", "branch_id").agg(F.lit(ANCHOR).alias("p_date"))
    last = history.last_schedules(v.menu_schedules, ["company_id", "branch_id"], cal.lookback(ANCHOR, months=3, days=1), cal.lookback(ANCHOR, days=1))
    return history.days_since(pairs.join(last, ["company_id", "branch_id"], "left"), "p_date", "last_schedule_on")


@query("lateness_clamped", "order_id i, minutes f, clamped f", """
    SELECT order_id, minutes, CASE WHEN minutes < -120 THEN -120 WHEN minutes > 120 THEN 120 ELSE minutes END AS clamped
    FROM (SELECT order_id, date_diff('second', expected_time, coalesce(delivered_at, history_created_at)) / 60.0 AS minutes FROM deliveries) AS t""")
def lateness_clamped(v):
    minutes = cal.minutes_between(F.coalesce("delivered_at", "history_created_at"), F.col("expected_time"))
    return v.deliveries.select("order_id", minutes.alias("minutes"), S.clamp(minutes, -120.0, 120.0).alias("clamped"))


@query("normalize_day", "day d, n i, first_event i", """
    SELECT CAST(ts AS DATE) AS day, count(*) AS n, min(event_id) AS first_event FROM events GROUP BY 1""")
def normalize_day(v):
    return v.events.groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("n"), F.min("event_id").alias("first_event"))


@query("time_split", "event_id i, part s", """
    SELECT event_id, CASE WHEN schedule_on <= DATE '2024-01-20' THEN 'train' ELSE 'validation' END AS part
    FROM visits WHERE schedule_on <= DATE '2024-01-27'""")
def time_split(v):
    train, valid = history.time_split(v.visits, "schedule_on", date(2024, 1, 28))
    return train.select("event_id", F.lit("train").alias("part")).unionByName(valid.select("event_id", F.lit("validation").alias("part")))
