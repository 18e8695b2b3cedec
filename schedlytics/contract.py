"""Output contracts: one column list drives the Spark result and the check SQL.

A contract is text such as ``"schedule_on d, client_id s, n i, share f, ok b"``.
Kinds: ``i`` long, ``f`` double rounded to 6 digits, ``s`` string, ``b`` boolean,
``d`` day as ``yyyy-MM-dd`` text. Sums of doubles depend on the order of
addition in their last bits; a nudge well below the 6th digit keeps exact
halves from rounding both ways.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Columns = list[tuple[str, str]]
NUDGE = 3.3e-9


def parse(text: str) -> Columns:
    out = []
    for item in text.split(","):
        name, kind = item.split()
        if kind not in "ifsbd":
            raise ValueError(f"unknown column kind {kind!r} for {name}")
        out.append((name, kind))
    return out


SHAPES = {
    "i": lambda c: F.col(c).cast("bigint"),
    "f": lambda c: F.round(F.col(c).cast("double") + F.lit(NUDGE), 6) + F.lit(0.0),
    "s": lambda c: F.col(c).cast("string"),
    "b": lambda c: F.col(c).cast("boolean"),
    "d": lambda c: F.date_format(F.col(c).cast("date"), "yyyy-MM-dd"),
}
SHAPED = "shaped"


def shaped(df: DataFrame, columns: Columns) -> DataFrame:
    """``df`` with the shape of those contract columns that it has, marked so that ``conform`` leaves them.

    For sides of a join with a large output: a value is rounded or written as text once, not once per output row.
    """
    return df.withColumns({c: SHAPES[kind](c) for c, kind in columns if c in df.columns}).transform(marked, columns)


def marked(df: DataFrame, columns: Columns) -> DataFrame:
    """Mark contract columns whose values have their shape already."""
    for c, kind in columns:
        if c in df.columns:
            df = df.withMetadata(c, {SHAPED: kind})
    return df


def conform(df: DataFrame, columns: Columns) -> DataFrame:
    """Select exactly the contract's columns with their declared types."""
    done = {f.name: (f.metadata or {}).get(SHAPED) for f in df.schema}
    shape: dict[str, Column] = {name: F.col(name) if done.get(name) == kind else SHAPES[kind](name).alias(name) for name, kind in columns}
    return df.select(*shape.values())


def conform_sql(inner: str, columns: Columns) -> str:
    """The same shaping as text for the checking engine."""
    shapes = {
        "i": "CAST({c} AS BIGINT)",
        "f": f"round(CAST({{c}} AS DOUBLE) + CAST({NUDGE} AS DOUBLE), 6) + CAST(0 AS DOUBLE)",
        "s": "CAST({c} AS VARCHAR)",
        "b": "CAST({c} AS BOOLEAN)",
        "d": "strftime(CAST({c} AS DATE), '%Y-%m-%d')",
    }
    body = ", ".join(f"{shapes[kind].format(c=name)} AS {name}" for name, kind in columns)
    return f"SELECT {body} FROM (\n{inner.strip()}\n) AS result"
