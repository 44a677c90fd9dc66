"""Driver contract: entry smoke check, one oracle per query, and every
registered query equal to its DuckDB oracle on the smallest tables."""

import math
import os
import shutil
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as E
from strata.plans.oracle import SQL
from strata.sources.tables import TABLES

SF = "/root/testdata/sf0.001"
QUERIES = E.QUERIES


def test_entry_smoke(spark, duck):
    df = E.entry(spark)
    assert df.columns == ["term", "n"]
    want = duck.sql(SQL["term_rank"]).fetchall()
    assert [tuple(r) for r in df.collect()] == want and len(want) == 8


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(E.queries()) and set(SQL) <= set(E.oracle_sql())


def test_entry_without_the_optional_modules(tmp_path):
    """A checkout without the corpus operators still imports and registers the rest."""
    root = os.path.dirname(os.path.abspath(E.__file__))
    skip = shutil.ignore_patterns("llm", "__pycache__")
    shutil.copytree(os.path.join(root, "strata"), tmp_path / "strata", ignore=skip)
    shutil.copy(E.__file__, tmp_path)
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True,
                         env={**os.environ, "PYTHONPATH": str(tmp_path)}, check=True)
    assert out.stdout.split() == [str(len(QUERIES))] * 2


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    def norm(v):
        if isinstance(v, float) and math.isnan(v):
            return "nan"
        return v
    return sorted(repr(tuple(norm(r[i]) for i in order)) for r in rows)


@pytest.mark.parametrize("key", sorted(SQL))
def test_query_matches_oracle(spark, duck, key):
    df = QUERIES[key](spark, SF)
    rel = duck.sql(SQL[key])
    assert sorted(df.columns) == sorted(rel.columns)
    assert _canon(df.columns, [tuple(r) for r in df.collect()]) == \
        _canon(rel.columns, rel.fetchall())
