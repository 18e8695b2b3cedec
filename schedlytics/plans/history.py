"""Order and schedule history: windows, exclusions, the schedule-versus-order table."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from schedlytics.functions import calendar as cal
from schedlytics.functions import scalars as S
from schedlytics.sources.sinks import remove, stage


def exclude_holidays(df: DataFrame, day: str, dates: Sequence[date], months: Sequence[int] = ()) -> DataFrame:
    """Drop listed days and whole months; literals, so the filter reaches the scan."""
    keep = ~F.col(day).isin(*[F.lit(d) for d in dates]) if dates else F.lit(True)
    return df.where(keep & ~F.month(day).isin(*months) if months else keep)


def working_days(df: DataFrame, day: str, client: str = "client_id") -> DataFrame:
    """Companies have no Friday or Saturday; buildings keep every day."""
    return df.where(~(cal.is_off_day(F.col(day)) & F.col(client).endswith("_C")))


def time_split(df: DataFrame, day: str, prediction_start: date) -> tuple[DataFrame, DataFrame]:
    """(training rows, validation rows) before ``prediction_start``; the two never overlap."""
    train_end, start, end = cal.split_dates(prediction_start)
    return df.where(F.col(day) <= F.lit(train_end)), df.where(cal.in_window(F.col(day), start, end))


def last_schedules(schedules: DataFrame, keys: Sequence[str], lo: date, hi: date, name: str = "last_schedule_on") -> DataFrame:
    """Date of the last live schedule per key inside [lo, hi]."""
    live = schedules.where(F.col("deleted_at").isNull() & cal.in_window(F.col("schedule_on"), lo, hi))
    return live.groupBy(*keys).agg(F.max("schedule_on").alias(name))


def days_since(df: DataFrame, day: str, last: str, name: str = "days_diff", default_days: int = 90) -> DataFrame:
    """Days from ``last`` to ``day``; a missing last date is set ``default_days`` before the earliest day."""
    earliest = df.select(F.min(day)).scalar()
    filled = df.withColumn(last, F.coalesce(F.col(last), F.date_sub(earliest, default_days)))
    return filled.withColumn(name, F.datediff(day, last))


def require_date(df: DataFrame, day: str, wanted: date) -> DataFrame:
    """Fail when no row carries ``wanted``; stops at the first hit."""
    if df.where(F.col(day) == F.lit(wanted)).limit(1).isEmpty():
        raise ValueError(f"no rows with {day} = {wanted.isoformat()}")
    return df


def lunch_schedules(schedules: DataFrame, menus: DataFrame, since: date, client: str = "company_id", until: date | None = None) -> DataFrame:
    """Live lunch schedules from ``since``, one per (client, day, branch)."""
    window = F.col("schedule_on") >= F.lit(since)
    if until is not None:
        window = window & (F.col("schedule_on") <= F.lit(until))
    lunch = menus.where(F.col("category_id") == 2).select("menu_id")
    live = schedules.where(window & F.col("deleted_at").isNull())
    return live.join(lunch, "menu_id", "left_semi").select(client, "schedule_on", "branch_id").distinct()


def order_totals(orders: DataFrame, branches: DataFrame, tests: DataFrame, since: date, buildings: bool = False,
                 test_buildings: DataFrame | None = None) -> DataFrame:
    """Mean rating and summed quantity of lunch orders, any status, per (day, client, restaurant)."""
    rows = orders.where((F.col("schedule_on") >= F.lit(since)) & (F.col("category_id") == 2)).join(tests, "company_id", "left_anti")
    if buildings and test_buildings is not None:
        rows = rows.join(test_buildings, "building_id", "left_anti")
    cid = S.client_id(F.col("company_id"), F.col("building_id") if buildings else None)
    return (rows.select("schedule_on", cid.alias("client_id"), "branch_id", "rating", "quantity")
            .join(branches, "branch_id")
            .groupBy("schedule_on", "client_id", "restaurant_id")
            .agg(F.avg("rating").alias("rating"), F.sum("quantity").alias("quantity")))


def vital_clients(history: DataFrame, anchor: date, months: int = 2, client: str = "client_id") -> DataFrame:
    """Clients with a positive order total in the ``months`` before the anchor."""
    recent = history.where(cal.in_window(F.col("schedule_on"), cal.lookback(anchor, months=months), anchor))
    return recent.groupBy(client).agg(F.sum("quantity").alias("_q")).where(F.col("_q") > 0).select(client)


def schedules_vs_orders(schedules: DataFrame, orders: DataFrame, menus: DataFrame, branches: DataFrame, companies: DataFrame,
                        anchor: date, months: int = 6, building_schedules: DataFrame | None = None, buildings: DataFrame | None = None) -> DataFrame:
    """Every distinct (day, restaurant, client) schedule with its order rating and quantity (0 when nothing was ordered).

    With ``building_schedules`` and ``buildings`` the clients are companies and
    buildings, and an order with a building belongs to the building.
    """
    since = cal.sunday_on_or_before(cal.lookback(anchor, months=months))
    tests = companies.where(S.is_test(F.col("company_name"))).select("company_id")
    planned = lunch_schedules(schedules, menus, since)
    if building_schedules is None:
        planned = planned.withColumn("client_id", S.client_id(F.col("company_id")))
        totals = order_totals(orders, branches, tests, since)
    else:
        planned = with_buildings(planned, lunch_schedules(building_schedules, menus, since, "building_id"))
        test_buildings = buildings.where(S.is_test(F.col("building_name"))).select("building_id")
        totals = order_totals(orders, branches, tests, since, True, test_buildings)
    placed = planned.join(branches, "branch_id").select("schedule_on", "restaurant_id", "client_id").distinct()
    return (placed.join(totals, ["schedule_on", "restaurant_id", "client_id"], "left")
            .withColumn("quantity", F.coalesce("quantity", F.lit(0))))


def known_by(orders: DataFrame, created: str, until: date) -> DataFrame:
    """Orders created up to ``until``; fails when that day has none, because the extract is then incomplete."""
    day = orders.withColumn("_day", F.to_date(created))
    return require_date(day, "_day", until).where(F.col("_day") <= F.lit(until)).drop("_day")


def observed(guard: Observation, name: str) -> int:
    """The observed number; 0 when no row came by, for then the plan drops the observing step with the empty rows."""
    try:
        return guard.get.get(name) or 0
    except Py4JJavaError:
        return 0


def prepared_history(schedules: DataFrame, orders: DataFrame, menus: DataFrame, branches: DataFrame, companies: DataFrame,
                     anchor: date, folder: str | None = None, building_schedules: DataFrame | None = None,
                     buildings: DataFrame | None = None, until: date | None = None, created: str | None = None) -> DataFrame:
    """The schedule-versus-order table of the clients that still order, up to ``until`` when given.

    With a ``folder`` the unfiltered table is written there once, since both the
    client filter and the result read it. With ``created`` only orders created up
    to ``until`` count, and the job fails when that day has none, because the
    extract is then incomplete. The guard observes the orders while that table is
    written, so it costs no pass of its own.
    """
    guard = None
    if created is not None:
        if folder is None or until is None:
            raise ValueError("the guard needs a last day and a folder to write to")
        day, guard = F.to_date(created), Observation()
        orders = orders.where(day <= F.lit(until)).observe(guard, F.count_if(day == F.lit(until)).alias("newest"))
    table = schedules_vs_orders(schedules, orders, menus, branches, companies, anchor, building_schedules=building_schedules, buildings=buildings)
    if folder is not None:
        table = stage(table, folder, "schedules_vs_orders")
    if guard is not None and not observed(guard, "newest"):
        remove(table.sparkSession, f"{folder.rstrip('/')}/schedules_vs_orders")
        raise ValueError(f"no orders created on {until.isoformat()}")
    kept = table.join(vital_clients(table, anchor), "client_id", "left_semi")
    return kept if until is None else kept.where(F.col("schedule_on") <= F.lit(until))


def with_buildings(company_rows: DataFrame, building_rows: DataFrame) -> DataFrame:
    """Company and building schedules as one client table."""
    left = company_rows.withColumn("client_id", S.client_id(F.col("company_id"))).drop("company_id")
    right = building_rows.withColumn("client_id", F.concat(F.col("building_id").cast("string"), F.lit("_B"))).drop("building_id")
    return left.unionByName(right)


