"""Every query against its SQL, on whole tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as driver

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES = driver.table_queries()
SQL = driver.oracle.statements()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def _sorted(rows):
    return sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))


def test_only_the_random_query_has_no_sql():
    assert set(QUERIES) - set(SQL) == {"generate_events_random"}
    assert not set(SQL) - set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    relation = duck.sql(SQL[name])
    assert sorted(df.columns) == sorted(relation.columns)
    columns = sorted(df.columns)
    expected = relation.project(", ".join(f'"{c}"' for c in columns)).fetchall()
    assert _sorted(tuple(r) for r in df.select(columns).collect()) == _sorted(expected)
    assert expected


def test_random_events(spark):
    rows = QUERIES["generate_events_random"](spark, SF_DIR)
    events = spark.read.parquet(f"{SF_DIR}/events.parquet").count()
    ids = rows.selectExpr("count(*) n", "count(distinct id) ids", "min(event_type_id) lo", "max(event_type_id) hi")
    assert ids.first() == (events * 5, events * 5, 0, 4)


def test_entry(spark):
    actions = {r["shard"]: r["action"] for r in driver.entry(spark).collect()}
    assert actions == {
        "20240130": "direct_transfer",
        "20240129": "skipped",
        "20240128": "merge",
        "20240127": "backfill_copy",
        "20240126": "missing_source",
        "20240125": "merge",
        "20240124": "skipped",
    }
