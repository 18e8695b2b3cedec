"""The seven statistics, as group aggregates or over a window.

Kurtosis and skew follow the population definition with two edge rules: any
NULL in the group makes them NULL, and zero variance gives kurtosis -3 and skew
0. The other five skip NULLs.

As a group aggregate the median keeps one counter per distinct value, merged
map side; ``panels.weekly_stats`` takes groups that are too large for that to a
selection by ranges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

STATS = ("min", "max", "mean", "median", "std", "kurtosis", "skew")


def seven(value: str, over: str = "", prefix: str = "", skip: Sequence[str] = ()) -> list[Column]:
    """Columns ``{prefix}_{stat}`` of ``value``; ``over`` is an OVER clause for the window form."""
    shape = lambda fn, at_zero: (f"CASE WHEN count({value}) {over} < count(1) {over} THEN NULL "
                                 f"WHEN var_pop({value}) {over} = 0 THEN {at_zero} ELSE {fn}({value}) {over} END")
    made = {
        "min": f"min({value}) {over}", "max": f"max({value}) {over}", "mean": f"avg({value}) {over}",
        "median": f"percentile({value}, 0.5) {over}", "std": f"stddev_samp({value}) {over}",
        "kurtosis": shape("kurtosis", -3), "skew": shape("skewness", 0),
    }
    return [F.expr(f"CAST({made[s]} AS DOUBLE) AS {prefix or value}_{s}") for s in STATS if s not in skip]


def running(keys: Sequence[str], order: str) -> str:
    """OVER clause from a key's first row to the current one."""
    return f"OVER (PARTITION BY {', '.join(keys)} ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


def names(value: str, expanding: bool = False) -> list[str]:
    return [f"{'exp_' if expanding else ''}{value}_{s}" for s in STATS]


def seven_sql(value: str, prefix: str) -> str:
    """Check SQL over a list column ``{value}_xs`` of the non-null values and ``{value}_nulls``; central two-pass moments."""
    xs = f"{value}_xs"
    m = f"list_avg({xs})"
    power = lambda p: f"list_avg(list_transform({xs}, lambda v: pow(v - {m}, {p})))"
    flat = f"list_max({xs}) = list_min({xs})"
    return ",\n".join([
        f"list_min({xs}) AS {prefix}_min",
        f"list_max({xs}) AS {prefix}_max",
        f"{m} AS {prefix}_mean",
        f"list_median({xs}) AS {prefix}_median",
        f"CASE WHEN len({xs}) > 1 THEN sqrt({power(2)} * len({xs}) / (len({xs}) - 1)) END AS {prefix}_std",
        f"CASE WHEN {value}_nulls > 0 THEN NULL WHEN {flat} THEN -3 ELSE {power(4)} / pow({power(2)}, 2) - 3 END AS {prefix}_kurtosis",
        f"CASE WHEN {value}_nulls > 0 THEN NULL WHEN {flat} THEN 0 ELSE {power(3)} / pow({power(2)}, 1.5) END AS {prefix}_skew",
    ])
