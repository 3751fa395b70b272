"""Queries with SQL against DuckDB over whole small tables, and the registration guard."""

import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

from reelrank.llm.queries import QUERIES
from reelrank.llm.sql import ORACLE

SF = "/root/testdata/sf0.001"
REPO = Path(__file__).resolve().parents[2]


def shape(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(str(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    res = con.execute(ORACLE[name])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)
    assert shape(df.collect(), df.columns) == shape(res.fetchall(), cols)


def test_entry_without_these_modules(tmp_path):
    """The rest registers its queries when these folders are gone."""
    code = ("import sys\n"
            "class Gone:\n"
            "    def find_spec(self, name, path=None, target=None):\n"
            "        if name == 'corpus_pipeline' or name.startswith('reelrank.llm'):\n"
            "            raise ModuleNotFoundError(name, name=name)\n"
            "sys.meta_path.insert(0, Gone())\n"
            "import __spark_entry__ as e\n"
            "q = e.queries(); assert q and not [k for k in q if k.startswith('op')]\n"
            "assert 'pipeline' not in q and set(e.oracle_sql()) <= set(q)\n")
    subprocess.run([sys.executable, "-c", code], cwd=REPO, check=True)
