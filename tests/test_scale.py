"""The plans are the ones large tables need, and hot keys are split."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from daysync import session, snapshots
from daysync.operators.dedupe import latest
from daysync.operators import merge
from daysync.operators.merge import incremental, insert_new_rows, newer_than, upsert
from daysync.operators.update import update_matching
from daysync.plans.apply import merge_days
from daysync.plans.policies import sync_plan
from daysync.sinks.write import write_day_table
from daysync.sources.shards import lookback_shards, missing_shards
from daysync.sources.tables import read_day_table

SF_DIR = "/root/testdata/sf0.001"


def planned(df):
    return df._jdf.queryExecution().executedPlan().toString()


def ran(df):
    """The rows, and the plan as it was adapted while running."""
    execution = df._jdf.queryExecution()
    rows = execution.executedPlan().execute().count()
    text = execution.executedPlan().toString()
    return rows, text.split("== Initial Plan ==")[0]


@pytest.fixture
def conf(spark):
    kept = {}

    def put(**settings):
        for name, value in settings.items():
            key = name.replace("__", ".")
            kept.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield put
    for key, value in kept.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture
def skewed(conf):
    """Broadcast off, and limits at which a few thousand rows count as a hot key."""
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="8KB",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="16KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__shuffle__partitions="8",
    )


def table(spark, path, hot, rows=6000):
    """``rows`` rows, a third of them with the key ``hot``."""
    df = spark.range(0, rows, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(hot)).otherwise(F.col("id") + 1000).alias("id"),
        F.md5(F.col("id").cast("string")).alias("v"),
    )
    df.write.parquet(path)
    return spark.read.parquet(path)


def test_hot_target_key_is_split(spark, tmp_path, skewed):
    target = table(spark, f"{tmp_path}/t", -1)
    source = table(spark, f"{tmp_path}/s", -1).dropDuplicates(["id"])
    rows, plan = ran(upsert(target, source, ["id"]))
    assert rows == 6000
    assert "Join(skew=true)" in plan and "LeftOuter" in plan


def test_hot_new_key_is_split(spark, tmp_path, skewed):
    target = table(spark, f"{tmp_path}/t", -1)
    source = table(spark, f"{tmp_path}/s", -2)
    rows, plan = ran(upsert(target, source, ["id"]))
    assert rows == 6000 + 2000
    assert "Join(skew=true)" in plan


def test_hot_key_in_row_comparison_and_update_is_split(spark, tmp_path, skewed):
    target, source = table(spark, f"{tmp_path}/t", -1), table(spark, f"{tmp_path}/s", -2)
    hot = source.select("id", F.when(F.col("id") != -2, F.col("v")).alias("v"), F.col("v").alias("modified"))
    rows, plan = ran(insert_new_rows(target, hot, ignore=["modified"]))
    assert rows == 6000 + 2000 and "Join(skew=true)" in plan
    rows, plan = ran(update_matching(target, "id", source.select("id"), {"v": F.lit("x")}))
    assert rows == 6000 and "Join(skew=true)" in plan


def test_null_keys_do_not_enter_the_joins(spark, tmp_path, skewed):
    target, source = table(spark, f"{tmp_path}/t", None), table(spark, f"{tmp_path}/s", None)
    rows, plan = ran(upsert(target, source, ["id"]))
    assert rows == 6000 + 2000 and "skew=true" not in plan
    pushed = re.findall(r"PushedFilters: \[([^\]]*)", plan)
    assert sum("IsNull(id)" in p for p in pushed) == 2


def test_dedupe_limits_each_task_before_the_shuffle(spark, tmp_path):
    rows, plan = ran(latest(table(spark, f"{tmp_path}/t", -1), ["id"], ["v"]))
    assert rows == 4001
    below = plan[plan.index("Exchange hashpartitioning(id"):]
    assert re.search(r"WindowGroupLimit .*Partial", below)


def test_merge_shares_the_source_shuffle(spark, tmp_path, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    target, source = table(spark, f"{tmp_path}/t", -1), table(spark, f"{tmp_path}/s", -2)
    _, plan = ran(upsert(target, source, ["id"]))
    assert len(re.findall(r"ReusedExchange \[__key_0", plan)) == 1
    assert len(re.findall(r"ReusedExchange \[id", plan)) == 1


def test_merged_days_share_the_source_shuffle(spark, tmp_path, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    sides = []
    for name, hot in (("t", -1), ("s", -2)):
        day = F.when(F.col("id") % 2 == 0, "20260411").otherwise("20260412")
        write_day_table(table(spark, f"{tmp_path}/{name}0", hot).withColumn("shard", day), f"{tmp_path}/{name}")
        sides.append(read_day_table(spark, f"{tmp_path}/{name}"))
    target, source = sides
    for days in (["20260411", "20260412"], ["20260412"]):
        _, plan = ran(merge_days(source, target, days, ["id"]))
        assert len(re.findall(r"ReusedExchange \[__key_0", plan)) == 1
    rows, plan = ran(upsert(target, source, ["id"], within=["shard"]))
    assert rows == 8000
    assert len(re.findall(r"ReusedExchange \[__key_0", plan)) == 1


def test_marks_of_an_incremental_merge_reach_the_reader(spark, tmp_path, conf, monkeypatch):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    sides = []
    for name, hot in (("t", -1), ("s", -2)):
        day = F.when(F.col("id") % 2 == 0, "20260411").otherwise("20260412")
        at = F.timestamp_seconds(F.abs("id") % 1000 + (0 if name == "t" else 500)).cast("timestamp_ntz")
        df = table(spark, f"{tmp_path}/{name}0", hot).withColumn("shard", day).withColumn("modified", at)
        write_day_table(df, f"{tmp_path}/{name}")
        sides.append(read_day_table(spark, f"{tmp_path}/{name}"))
    target, source = sides
    days = ["20260411", "20260412"]
    staged = []
    keep = merge.kept
    monkeypatch.setattr(merge, "kept", lambda df: staged.append(planned(df)) or keep(df))
    merged = merge_days(source, target, days, ["id"], incremental_by="modified")
    rows, plan = ran(merged)
    assert rows >= 6000
    # The source is read once, for what is staged, and the merge reads that.
    assert len(staged) == 1 and "GreaterThan(modified" in staged[0]
    assert f"{tmp_path}/s/" not in plan and f"{tmp_path}/s]" not in plan


def test_small_source_leaves_the_target_unshuffled(spark, tmp_path):
    target = table(spark, f"{tmp_path}/t", -1)
    source = table(spark, f"{tmp_path}/s", -2, 30)
    plan = planned(upsert(target, source, ["id"]))
    assert "SortMergeJoin" not in plan and "BroadcastNestedLoopJoin" not in plan
    shuffled = re.findall(r"\+- Exchange hashpartitioning\(([^)]*)\)[^\n]*\n[^\n]*HashAggregate", plan)
    assert len(shuffled) == plan.count("Exchange hashpartitioning")
    assert re.search(r"BroadcastHashJoin .*LeftSemi, BuildRight", plan)


def test_known_marks_reach_the_reader(spark, tmp_path):
    df = spark.range(10).select(
        F.lit("20260411").alias("shard"), "id", F.timestamp_seconds("id").cast("timestamp_ntz").alias("modified")
    )
    write_day_table(df, f"{tmp_path}/t")
    source = read_day_table(spark, f"{tmp_path}/t", df.schema)
    plan = planned(newer_than(source, "modified", {"20260411": "1970-01-01 00:00:05", "20260410": None}))
    assert "GreaterThan(modified,1970-01-01T00:00:05)" in plan
    assert "shard#" in re.search(r"PartitionFilters: \[([^\]]*)", plan)[1]


def test_plan_reads_two_columns_of_the_window(spark, tmp_path):
    df = spark.range(10).select(
        F.lit("20260411").alias("shard"), "id", F.lit("x").alias("v"), F.lit("2026-04-11").cast("timestamp_ntz").alias("modified")
    )
    write_day_table(df, f"{tmp_path}/t")
    side = read_day_table(spark, f"{tmp_path}/t", df.schema)
    plan = planned(sync_plan(side, side, "hybrid", "2026-04-13"))
    assert re.findall(r"ReadSchema: (\S+)", plan) == ["struct<modified:timestamp_ntz>"] * 2
    assert all("20260412" in p for p in re.findall(r"PartitionFilters: \[([^\]]*)", plan))


def test_hot_day_is_written_by_many_tasks(spark, tmp_path, conf):
    conf(spark__sql__adaptive__advisoryPartitionSizeInBytes="16KB")
    df = table(spark, f"{tmp_path}/t", -1).withColumn("shard", F.lit("20260411"))
    write_day_table(df, f"{tmp_path}/out")
    assert len(spark.read.parquet(f"{tmp_path}/out").inputFiles()) >= 4
    conf(spark__sql__adaptive__advisoryPartitionSizeInBytes="64MB")
    write_day_table(df, f"{tmp_path}/out2")
    assert len(spark.read.parquet(f"{tmp_path}/out2").inputFiles()) == 1


def test_shuffles_start_with_enough_parts(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with session.shuffles_for(spark, 1000 * session.PART_BYTES + 1) as parts:
        assert parts == 1001
        assert ", 1001)" in planned(spark.range(9).groupBy(F.col("id") % 3).count())
    with session.shuffles_for(spark, 1) as parts:
        assert parts == 4
    with session.shuffles_for(spark, 10**15) as parts:
        assert parts == -(-(10**15) // session.PART_BYTES)
    spark.conf.set(session.MOST_PARTS, "5000")
    with session.shuffles_for(spark, 10**15) as parts:
        assert parts == 5000
    spark.conf.unset(session.MOST_PARTS)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_windows_are_joined_as_spark_chooses(spark, conf):
    events = spark.read.parquet(f"{SF_DIR}/events.parquet")
    source, target = snapshots.source_events(events), snapshots.target_events(events)
    days = lookback_shards(snapshots.LOGICAL_DATE, snapshots.ALL_DAYS)

    def run():
        plan = sync_plan(source, target, "hybrid", snapshots.LOGICAL_DATE, snapshots.ALL_DAYS)
        staged = incremental(source, target, "modified", days)
        gaps = missing_shards(source, snapshots.LOGICAL_DATE, snapshots.ALL_DAYS)
        return [sorted(map(str, df.collect())) for df in (plan, staged, gaps)], planned(staged)

    chosen, _ = run()
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    plain, plan = run()
    assert plain == chosen
    assert "Broadcast" not in plan and "SortMergeJoin" in plan


def test_flat_tables_are_filtered_by_time_range(spark):
    plan = planned(driver.queries()["lookback_scan"](spark, SF_DIR))
    assert "GreaterThanOrEqual(ts,2024-01-24T00:00), LessThan(ts,2024-01-31T00:00)" in plan


# Totals over a plan of one row per day.
ONE_TASK = {"report_buckets", "report_transfers"}


@pytest.mark.parametrize("name", sorted(n for n in driver.table_queries() if "sync_" not in n or "plan" in n))
def test_no_query_needs_a_cross_join_python_rows_or_one_task(spark, name):
    plan = planned(driver.queries()[name](spark, SF_DIR))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert bad not in plan
    if name not in ONE_TASK:
        assert "Exchange SinglePartition" not in plan
