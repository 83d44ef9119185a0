"""Merges into bucketed tables against the general merge, and what they shuffle."""

import glob
import random
import re

import pytest

from daysync.operators.merge import upsert
from daysync.plans.bucketed import bucketing_of, merge_into_bucketed, upsert_bucketed, write_bucketed

SCHEMA = "k long, day string, v string, w int"


def _rows(df):
    return sorted((str(tuple(r)) for r in df.select(*sorted(df.columns)).collect()))


def _above(plan: str, what: str) -> list[str]:
    """For each line with ``what``, the lines it is an input of."""
    out, path = [], []
    for line in plan.splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        path = [(d, text) for d, text in path if d < depth]
        if what in line:
            out.append("\n".join(text for _, text in path))
        path.append((depth, line))
    assert out
    return out


@pytest.fixture
def table(spark, tmp_path):
    rng = random.Random(5)
    rows = [(rng.choice([None, *range(60)]), rng.choice(["a", "b"]), f"t{i}", i) for i in range(150)]
    df = spark.createDataFrame(rows, SCHEMA)
    write_bucketed(df, "bucketed_t", ["day", "k"], 6, str(tmp_path / "t"))
    yield "bucketed_t", df
    spark.sql("DROP TABLE bucketed_t")


@pytest.fixture
def source(spark):
    rows = [(k, day, f"s{k}", None, 0.5) for k in range(40, 90) for day in "ab"] + [(None, "a", "s", 1, 0.5)] * 2
    return spark.createDataFrame([*rows, (99, "a", "x", 1, 0.0), (99, "a", "y", 2, 0.0)], f"{SCHEMA}, extra double")


@pytest.mark.parametrize("options", [
    {}, {"update_columns": ["v"]}, {"update_columns": []}, {"on_duplicate": "latest", "order_by": ["w", "v"]},
])
def test_same_as_the_general_merge(spark, table, source, options):
    name, target = table
    merged = upsert_bucketed(spark.table(name), source, ["day", "k"], 6, **options)
    expected = upsert(target, source, ["day", "k"], **options)
    if options.get("on_duplicate"):  # rows with NULL keys are reduced like any other there
        expected, merged = (df.where("k is not null") for df in (expected, merged))
    assert _rows(merged) == _rows(expected)


def test_a_key_twice_in_the_source_fails_if_the_target_has_it(spark, table, source):
    twice = source.unionByName(source.where("k = 45"))
    present = spark.table(table[0]).where("k = 45").count()
    assert present
    with pytest.raises(Exception, match="several source rows"):
        upsert_bucketed(spark.table(table[0]), twice, ["day", "k"], 6).collect()


def test_only_the_source_is_shuffled(spark, table, source):
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for options in ({}, {"update_columns": []}):
            merged = upsert_bucketed(spark.table(table[0]), source, ["day", "k"], 6, **options)
            plan = merged._jdf.queryExecution().executedPlan().toString()
            assert re.findall(r"Exchange hashpartitioning\(.*, (\d+)\)", plan) == ["6"]
            assert all("Exchange" not in above for above in _above(plan, "FileScan"))
            assert "SelectedBucketsCount: 6 out of 6" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def test_the_table_is_pointed_at_its_new_buckets(spark, table, source, tmp_path):
    name, target = table
    source = source.where("k is null or k < 99")
    assert bucketing_of(spark, name) == (6, ["day", "k"])
    for _ in range(2):
        merge_into_bucketed(spark, name, source.where("k is not null"), folder=str(tmp_path / "new"))
    assert _rows(spark.table(name)) == _rows(upsert(target, source.where("k is not null"), ["day", "k"]))
    assert bucketing_of(spark, name) == (6, ["day", "k"])
    assert len(glob.glob(f"{tmp_path}/new/*/rows/*.parquet")) <= 2 * 6
    merge_into_bucketed(spark, name, source.limit(0), folder=str(tmp_path / "new"))
    assert len(glob.glob(f"{tmp_path}/new/*/rows/*.parquet")) <= 2 * 6  # replaced files went at the next start
    assert not spark.catalog.tableExists(f"{name}__staged")


def test_odd_tables(spark, table, tmp_path):
    empty = spark.createDataFrame([], SCHEMA)
    assert _rows(upsert_bucketed(spark.table(table[0]), empty, ["day", "k"], 6)) == _rows(table[1])
    with pytest.raises(ValueError, match="not on both sides"):
        upsert_bucketed(spark.table(table[0]), empty.drop("k"), ["day", "k"], 6)
    table[1].write.option("path", str(tmp_path / "plain")).saveAsTable("plain_t")
    try:
        with pytest.raises(ValueError, match="not bucketed"):
            merge_into_bucketed(spark, "plain_t", empty, folder=str(tmp_path / "new"))
    finally:
        spark.sql("DROP TABLE plain_t")
