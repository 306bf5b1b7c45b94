"""Every registered query with SQL against DuckDB over whole tables; every one without against its schema."""

import pytest

import __spark_entry__ as entry
from foliospark.plans import queries as core
from foliospark.plans import run_queries as _runs  # noqa: F401  registers more
from foliospark.plans import source_queries as _sources  # noqa: F401  registers more
from tests.conftest import SMALL, TINY, rows


@pytest.mark.parametrize("name", sorted(core.SQL))
def test_against_sql(spark, duck, name):
    df = core.QUERIES[name](spark, SMALL)
    names = sorted(df.columns)
    want = duck.sql(f"SELECT {', '.join(names)} FROM ({core.SQL[name]})").fetchall()
    assert rows(df) == sorted(tuple(map(str, r)) for r in want)


@pytest.mark.parametrize("name", sorted(set(core.QUERIES) - set(core.SQL)))
def test_runs(spark, name):
    assert core.QUERIES[name](spark, TINY).count() > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["doc_id", "chunk_index", "text", "tokens"] and df.count() >= 100


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
