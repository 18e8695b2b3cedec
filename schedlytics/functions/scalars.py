"""Scalar rules as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def round_half_even(col: Column, digits: int = 0) -> Column:
    """Half-even on the binary value, as array libraries round: scale, round to the even neighbour, scale back."""
    return F.rint(col) if digits == 0 else F.rint(col * 10.0**digits) / 10.0**digits


def as_count(prediction: Column) -> Column:
    """A prediction as a whole count: negatives become 0, halves round to even."""
    return F.when(prediction <= 0, F.lit(0)).otherwise(F.rint(prediction)).cast("bigint")


def safe_ratio(num: Column, den: Column) -> Column:
    """NULL instead of a division error."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def clamp(col: Column, lo, hi) -> Column:
    """Limit to [lo, hi]; NULL stays NULL."""
    return F.when(col < lo, F.lit(lo)).when(col > hi, F.lit(hi)).otherwise(col)


def is_test(name: Column) -> Column:
    """Case-insensitive 'test' in the name; a missing name is not a test."""
    return F.coalesce(F.lower(name).contains("test"), F.lit(False))


def client_id(company: Column, building: Column | None = None) -> Column:
    """``<n>_C`` for companies, ``<n>_B`` when a building is given."""
    as_company = F.concat(company.cast("string"), F.lit("_C"))
    if building is None:
        return as_company
    return F.when(building.isNull(), as_company).otherwise(F.concat(building.cast("string"), F.lit("_B")))


def client_number(cid: Column) -> Column:
    return F.split_part(cid, F.lit("_"), F.lit(1)).cast("bigint")


def client_kind(cid: Column) -> Column:
    """The suffix: C for company, B for building."""
    return F.split_part(cid, F.lit("_"), F.lit(2))


def client_type(cid: Column) -> Column:
    """0 for companies, 1 otherwise."""
    return F.when(cid.contains("C"), 0).otherwise(1)


def pack_group(group_text: Column) -> Column:
    """``<group>_<cluster>`` as the number ``<group>0000<cluster>``."""
    part = lambda i: F.split_part(group_text, F.lit("_"), F.lit(i))
    return F.concat(part(1), F.lit("0000"), part(2).cast("bigint").cast("string")).cast("bigint")


def fill_by_family(df: DataFrame, skip: Sequence[str] = ()) -> DataFrame:
    """Fill feature nulls by column family: kurtosis -3, first-time flags true, ranks 1, other numbers 0."""
    fills = {}
    for field in df.schema:
        kind, name = field.dataType.typeName(), field.name
        if name in skip:
            continue
        if kind == "boolean":
            fills[name] = True if "first_time" in name else False
        elif kind in ("double", "float", "long", "integer", "short", "byte"):
            fills[name] = -3 if "kurtosis" in name else 1 if name.endswith("rank") else 0
    return df.na.fill(fills)


def floats_to_longs(df: DataFrame) -> DataFrame:
    """Truncate every float column to a whole number in one projection."""
    return df.select(*[
        F.col(f.name).cast("bigint").alias(f.name) if f.dataType.typeName() in ("double", "float") else F.col(f.name)
        for f in df.schema
    ])
