"""Every registered query against its DuckDB SQL on the smallest tables,
the same comparison the driver makes at sf0.01."""

import pytest

import __spark_entry__ as entry_mod
from tests.oracle_harness import compare, duck

SF = "/root/testdata/sf0.001"
SQL = {k: v for k, v in entry_mod.oracle_sql().items() if k in entry_mod.QUERIES}
QUERIES = entry_mod.queries()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_registry_is_complete():
    # the optional queries are held against SQL or brute force by tests of their own
    missing = set(entry_mod.QUERIES) - set(SQL) - entry_mod.ROWS_ONLY
    assert not missing, f"queries without oracle: {missing}"
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, QUERIES[name], SQL[name], SF, con)
    assert r["ok"], r


@pytest.mark.parametrize("name", sorted(entry_mod.ROWS_ONLY))
def test_rows_only_queries_run(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert len(rows) == 12 and df.columns[0] == "hours_lag"
    assert sum(r.n_rows for r in rows) == 9420
    assert sum(r.origin_matches for r in rows) == 36 and sum(r.dest_matches for r in rows) == 10
