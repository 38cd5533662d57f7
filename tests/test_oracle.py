"""Every registered query key against its independent DuckDB oracle (sf0.001)."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))

import __spark_entry__ as E  # noqa: E402
from check_oracle import rows_of  # noqa: E402
from tallyframe.plans.oracle import ORACLE  # noqa: E402
from tallyframe.plans.proxy import TABLES  # noqa: E402
from tallyframe.plans.queries import QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF)
    rel = con.sql(E.oracle_sql()[key])
    assert sorted(df.columns) == sorted(rel.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(rel.columns, rel.fetchall())


@pytest.mark.parametrize("key", sorted(set(QUERIES) - set(ORACLE)))
def test_rows_only_queries_run(spark, key):
    assert E.queries()[key](spark, SF).count() > 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "micro_share" in df.columns
