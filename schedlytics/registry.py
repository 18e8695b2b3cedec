"""Named queries: a Spark builder, an output contract and the SQL it is checked with."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from schedlytics import contract
from schedlytics.sources.views import Views, check_views


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Views], DataFrame]
    columns: contract.Columns
    check: str | None

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        return contract.conform(self.build(Views(spark, folder)), self.columns)

    def check_sql(self) -> str | None:
        return None if self.check is None else expand(contract.conform_sql(self.check, self.columns))


QUERIES: dict[str, Query] = {}
# Shared steps of the check SQL, next to the entity views.
CHECK_STEPS: dict[str, str] = {}


def query(name: str, columns: str, check: str | None = None):
    """Register a builder under ``name``."""

    def wrap(build):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = Query(name, build, contract.parse(columns), check)
        return build

    return wrap


def contract_of(name: str) -> contract.Columns:
    return QUERIES[name].columns


def check_step(name: str, sql: str) -> None:
    CHECK_STEPS[name] = sql


def expand(sql: str) -> str:
    """Prefix the text with the views and steps it mentions, dependencies first."""
    known = {**check_views(), **CHECK_STEPS}
    order: list[str] = []

    def visit(text: str, trail: tuple[str, ...]) -> None:
        for name in dict.fromkeys(re.findall(r"\b(?:FROM|JOIN|,)\s*\(?\s*(\w+)", text, re.IGNORECASE)):
            if name in known and name not in order and name not in trail:
                visit(known[name], trail + (name,))
                order.append(name)

    visit(sql, ())
    if not order:
        return sql
    steps = ",\n".join(f"{n} AS ({known[n].strip()})" for n in order)
    return f"WITH {steps}\n{sql}"
