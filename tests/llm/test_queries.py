"""Queries with SQL over whole tables; all of them over empty tables, and twice for equal results."""

import os
import shutil

import pyarrow.parquet as pq
import pytest

from foliospark.llm.queries import QUERIES, SQL
from tests.conftest import SMALL, TINY, rows


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    names = sorted(df.columns)
    want = duck.sql(f"SELECT {', '.join(names)} FROM ({SQL[name]})").fetchall()
    assert rows(df) == sorted(tuple(map(str, r)) for r in want)


@pytest.fixture(scope="session")
def hollow(tmp_path_factory):
    """The tables without rows; those of settings stay."""
    d = tmp_path_factory.mktemp("hollow")
    for f in os.listdir(TINY):
        if f.split(".")[0] in ("run_metadata", "container_specs", "mix_targets", "common_words"):
            shutil.copy(f"{TINY}/{f}", d / f)
        else:
            pq.write_table(pq.read_table(f"{TINY}/{f}").slice(0, 0), d / f)
    return str(d)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, hollow, name):
    df = QUERIES[name](spark, hollow)
    got = df.collect()
    assert all(r["copies"] == 0 for r in got) if name == "p8_shares" else got == []


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n.endswith("_found") or n.startswith(("p7_c", "p8_sel"))))
def test_partitioning_changes_nothing(spark, name):
    """Other splits of the input give the same cases. How items are packed may depend on the split, what is packed may not."""
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    a = rows(QUERIES[name](spark, TINY))
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
        spark.conf.set("spark.sql.shuffle.partitions", "7")
        b = rows(QUERIES[name](spark, TINY))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    if name.startswith("p7"):
        a, b = (sorted(r[:1] + r[2:] for r in x) for x in (a, b))
    assert a == b and a


def test_columns_of_found(spark):
    want = {
        "p1_found": [("fragment_id", "bigint")], "p2_found": [("fragment_id", "bigint")], "p4_found": [("fragment_id", "bigint"), ("line_no", "int")], "p5_found": [("record_id", "bigint"), ("defect", "string")],
        "p6_found": [("fragment_id", "bigint")], "p9_found": [("doc_id", "bigint"), ("kind", "string")],
    }
    assert {n: QUERIES[n](spark, TINY).dtypes for n in want} == want
