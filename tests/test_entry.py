"""Driver contract: entry runs on sf0.001; every SQL-checkable query has an oracle."""

import duckdb

import __spark_entry__ as E
from reelrank.plans.oracle import ORACLE
from reelrank.plans.queries import REGISTRY
from conftest import SF_SMALL

ROWS_ONLY: set[str] = set()


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and "test_rmse" in df.columns


def test_oracle_coverage():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    missing = set(REGISTRY) - set(o) - ROWS_ONLY
    assert not missing, missing


def test_oracle_sql_parses():
    con = duckdb.connect()
    for t in ("part orders lineitem embeddings events").split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    for sql in ORACLE.values():
        con.execute(f"EXPLAIN {sql}")
