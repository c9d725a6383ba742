"""Oracle equality: every registered query against its DuckDB SQL (sf0.001),
and a rows-only smoke run for the rest."""

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from tools.check_oracle import TABLES, canon

QUERIES = E.queries()
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "delay_category" in df.columns


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_matches_oracle(spark, con, key):
    got = canon(QUERIES[key](spark, SF_SMALL).toPandas())
    want = canon(con.execute(ORACLE[key]).df())
    assert got[0] == want[0], "columns differ"
    assert len(got[1]) == len(want[1]), "row counts differ"
    assert got[1] == want[1], "values differ"


@pytest.mark.parametrize("key", sorted(set(QUERIES) - set(ORACLE)))
def test_rows_only_queries_run(spark, key):
    assert QUERIES[key](spark, SF_SMALL).count() >= 0
