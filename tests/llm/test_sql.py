"""Queries of the corpus operators against their SQL, on whole tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as driver
from daysync.llm import queries, sql

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def test_all_are_registered():
    assert len(queries.queries()) == 13
    assert set(queries.queries()) | {"pipeline"} <= set(driver.queries())
    assert set(sql.STATEMENTS) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(sql.STATEMENTS))
def test_query_equals_sql(spark, duck, name):
    df = queries.queries()[name](spark, SF_DIR)
    relation = duck.sql(sql.STATEMENTS[name])
    columns = sorted(df.columns)
    assert columns == sorted(relation.columns)
    expected = relation.project(", ".join(f'"{c}"' for c in columns)).fetchall()
    assert sorted(map(str, (tuple(r) for r in df.select(columns).collect()))) == sorted(map(str, expected))
    assert expected
