"""Literal tables as inline VALUES relations: bounded by the source text, safe to broadcast."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def values_sql(rows: Sequence[Sequence]) -> str:
    def lit(v) -> str:
        if v is None:
            return "NULL"
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        if isinstance(v, (list, tuple)):
            return "array(" + ", ".join(map(lit, v)) + ")"
        return str(v)

    return ", ".join("(" + ", ".join(map(lit, r)) + ")" for r in rows)


def inline_table(spark: SparkSession, columns: str, rows: Sequence[Sequence]) -> DataFrame:
    return spark.sql(f"SELECT * FROM VALUES {values_sql(rows)} AS t({columns})")
