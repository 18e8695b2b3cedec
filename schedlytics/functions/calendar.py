"""Calendar expressions and the date windows of the jobs. Weeks start on Sunday."""

from __future__ import annotations

import calendar as _cal
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


# ---- driver-side date arithmetic: plain literals that Catalyst pushes to the scan ----


def add_months(day: date, months: int) -> date:
    """Shift by whole months, clamped to the end of the target month."""
    years, month0 = divmod(day.month - 1 + months, 12)
    year, month = day.year + years, month0 + 1
    return date(year, month, min(day.day, _cal.monthrange(year, month)[1]))


def sunday_on_or_before(day: date) -> date:
    return day - timedelta(days=(day.weekday() + 1) % 7)


def lookback(anchor: date, months: int = 0, weeks: int = 0, days: int = 0) -> date:
    """The day ``months``, ``weeks`` and ``days`` before ``anchor``."""
    return add_months(anchor, -months) - timedelta(weeks=weeks, days=days)


def ratio_window(end: date, special_start: date | None, gap_weeks: int = 2, months: int = 3) -> tuple[date, date]:
    """Closed window ending ``gap_weeks`` before ``end``; one month longer when a special period starts inside it."""
    hi = end - timedelta(weeks=gap_weeks)
    lo = add_months(hi, -months)
    if special_start is not None and lo < special_start < hi:
        lo = add_months(hi, -(months + 1))
    return lo, hi


def split_dates(prediction_start: date) -> tuple[date, date, date]:
    """(train end, validation start, validation end); validation starts on a Sunday and training ends the day before."""
    start = sunday_on_or_before(prediction_start - timedelta(days=7))
    return start - timedelta(days=1), start, prediction_start - timedelta(days=1)


# ---- column expressions ----


def in_window(day: Column, lo: date, hi: date) -> Column:
    """Closed interval test."""
    return day.between(F.lit(lo), F.lit(hi))


def outside_period(day: Column, start: date, end: date) -> Column:
    """True outside the half-open special period [start, end)."""
    return ~((day >= F.lit(start)) & (day < F.lit(end)))


def snap_sunday(day: Column) -> Column:
    return F.date_sub(day, F.dayofweek(day) - 1)


def sunday_shift(day: Column) -> Column:
    """Move one day ahead so that ISO (Monday) weeks cut on Sunday."""
    return F.date_add(day, 1)


def iso_year_week(day: Column) -> Column:
    """ISO year * 100 + ISO week."""
    return F.extract(F.lit("YEAROFWEEK"), day) * 100 + F.weekofyear(day)


def year_week(day: Column, january_from: int = 51) -> Column:
    """Calendar year * 100 + ISO week; a late week in January counts to the year before."""
    late = (F.month(day) == 1) & (F.weekofyear(day) >= january_from)
    return (F.year(day) - late.cast("int")) * 100 + F.weekofyear(day)


def year_week_text(day: Column, january_above: int = 45) -> Column:
    """``YYYY_WW`` text of ``year_week``; sorts in time order."""
    key = year_week(day, january_above + 1)
    return F.concat_ws("_", F.floor(key / 100).cast("int").cast("string"), F.lpad((key % 100).cast("string"), 2, "0"))


def week_label(day: Column) -> Column:
    """``W_n`` of the Sunday week, numbered one above its ISO week."""
    return F.concat(F.lit("W_"), (F.weekofyear(sunday_shift(day)) + 1).cast("string"))


def weekday(day: Column) -> Column:
    """Monday = 0."""
    return F.weekday(day)


def day_name(day: Column) -> Column:
    return F.date_format(day, "EEEE")


def day_text(day: Column, start: date, end: date) -> Column:
    """A day of the closed range as ``yyyy-MM-dd``, looked up in a literal list instead of being formatted row by row."""
    days = [start + timedelta(n) for n in range((end - start).days + 1)]
    return F.get(F.array(*[F.lit(d.isoformat()) for d in days]), F.datediff(day, F.lit(start)))


def is_off_day(day: Column) -> Column:
    """Friday or Saturday."""
    return F.weekday(day).isin(4, 5)


def minutes_between(actual: Column, expected: Column) -> Column:
    """Signed minutes from ``expected`` to ``actual``."""
    return F.timestamp_diff("SECOND", expected, actual) / F.lit(60.0)


# ---- frames ----


def week_index(df: DataFrame, day_col: str, name: str = "week_no") -> DataFrame:
    """Calendar dimension (iso_week, week_no): the distinct Sunday weeks of ``df`` numbered 1..n.

    Only the distinct weeks reach the un-partitioned window: about 52 rows per
    year of data, whatever the size of ``df``.
    """
    weeks = df.select(iso_year_week(sunday_shift(F.col(day_col))).alias("iso_week")).distinct()
    return weeks.select("iso_week", F.row_number().over(Window.orderBy("iso_week")).alias(name))


def with_week_index(df: DataFrame, day_col: str, name: str = "week_no", calendar: DataFrame | None = None) -> DataFrame:
    """Attach the dense week number through the (bounded, hence broadcast) calendar."""
    cal = calendar if calendar is not None else week_index(df, day_col, name)
    keyed = df.withColumn("iso_week", iso_year_week(sunday_shift(F.col(day_col))))
    return keyed.join(F.broadcast(cal), "iso_week").drop("iso_week")


def date_spine(df: DataFrame, start: date, end: date, name: str = "schedule_on") -> DataFrame:
    """Repeat every row for each day of the closed range."""
    return df.withColumn(name, F.explode(F.sequence(F.lit(start), F.lit(end))))


def last_n_weeks(df: DataFrame, day_col: str, weeks: int, name: str = "week_start") -> DataFrame:
    """One row per Sunday between ``day - weeks`` and ``day``, both ends included."""
    first = F.date_sub(F.col(day_col), 7 * weeks)
    first_sunday = F.date_add(first, F.pmod(8 - F.dayofweek(first), F.lit(7)).cast("int"))
    return df.withColumn(name, F.explode(F.sequence(first_sunday, F.col(day_col), F.expr("interval 7 days"))))
