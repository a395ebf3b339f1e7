"""Every registered query against its DuckDB oracle SQL (sf0.001)."""

import pytest

import __spark_entry__ as E
from oracle_compare import compare, duck

SF = "/root/testdata/sf0.001"
QUERIES = {k: v for k, v in E.queries().items() if k not in E.CORPUS_QUERIES}  # those have tests of their own
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    if name not in ORACLE:
        assert df.count() >= 0
        return
    ok, msg = compare(df, con, ORACLE[name])
    assert ok, msg


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["l_orderkey", "l_linenumber", "l_partkey", "p_name", "p_brand", "total_sales"]
    assert df.count() > 0


def test_every_query_has_sql_or_is_listed():
    rows_only = set(QUERIES) - set(ORACLE)
    assert not rows_only
