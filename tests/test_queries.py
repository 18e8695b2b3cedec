"""All registered queries against their check SQL on the smallest data, compared as whole multisets."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest

from conftest import SMALL
from schedlytics.queries import load, pipelines

QUERIES = load()
NAMES = [n for n in QUERIES if QUERIES[n].check]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in sorted(Path(SMALL).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def cells(row):
    return tuple(f"{type(v).__name__}:{v}" for v in row)


@pytest.mark.parametrize("name", NAMES)
def test_matches_check_sql(spark, duck, name, monkeypatch):
    monkeypatch.setattr(pipelines, "TREES", 2)  # the checks hold for any number of trees
    query = QUERIES[name]
    df = query.run(spark, SMALL)
    assert df.columns == [c for c, _ in query.columns]
    got = Counter(cells(r) for r in df.collect())
    want = Counter(cells(r) for r in duck.execute(query.check_sql()).fetchall())
    assert got == want


def test_entry_has_rows(spark):
    import __spark_entry__ as contract

    df = contract.entry(spark)
    assert not df.limit(1).isEmpty()
    assert set(contract.oracle_sql()) <= set(contract.queries())
