"""Appending to a published table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def missing_rows(new: DataFrame, existing: DataFrame, keys: Sequence[str], required: Sequence[str] = (),
                 null_safe: Sequence[str] = ()) -> DataFrame:
    """Rows of ``new`` without a match in ``existing`` on ``keys``.

    Rows with a NULL in ``required`` are dropped first. A NULL key matches
    nothing, unless the key is listed in ``null_safe``.
    """
    rows = new.dropna(subset=list(required)) if required else new
    have = existing.select(*[F.col(k).alias(f"_e_{k}") for k in keys])
    same: Column | None = None
    for k in keys:
        left, right = F.col(k), F.col(f"_e_{k}")
        test = left.eqNullSafe(right) if k in null_safe else left == right
        same = test if same is None else same & test
    return rows.join(have, same, "left_anti")


def append_missing(new: DataFrame, existing: DataFrame, keys: Sequence[str], required: Sequence[str] = (),
                   null_safe: Sequence[str] = (), stamp: Column | None = None) -> DataFrame:
    """``existing`` plus the missing rows, stamped created and updated. Applying it twice adds nothing."""
    now = stamp if stamp is not None else F.current_timestamp()
    added = missing_rows(new, existing, keys, required, null_safe).withColumns({"created_at": now, "updated_at": now})
    return existing.unionByName(added, allowMissingColumns=True)
