"""Every registered query against its DuckDB statement on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as contract
from netwatch.plans import catalog, oracle
from tools.parity import TABLES, compare

ROOT = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{ROOT}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) == set(oracle.SQL)
    assert set(catalog.QUERIES) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = contract.queries()[name](spark, ROOT)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(contract.oracle_sql()[name])
    err = compare(rows, df.columns, res.fetchall(), [d[0] for d in res.description])
    assert err is None, err


def test_entry_runs(spark):
    df = contract.entry(spark)
    assert df.columns == ["window_start", "window_end", "prefix", "origin_as", "event_count",
                          "alert_type", "severity", "detected_at"]
    assert df.count() == 28


def test_oracle_uses_nothing_of_the_library():
    with open(oracle.__file__) as f:
        assert "import" not in f.read().split('"""', 2)[2].replace("from __future__ import annotations", "").split("SQL:")[0].replace("not imported", "")
