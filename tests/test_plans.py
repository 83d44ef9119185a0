import datetime as dt

import pytest
from pyspark.sql import functions as F

from daysync.operators.schema import drift
from daysync.plans import report
from daysync.plans.apply import apply_plan, replace_days
from daysync.plans.policies import POLICIES, plan_profiles, sync_plan
from daysync.sources.shards import expected_shards, lookback_shards, missing_shards, profile

T1, T2 = dt.datetime(2026, 4, 1), dt.datetime(2026, 4, 2)
PROFILE = "shard string, rows long, max_modified timestamp_ntz, fingerprint string"
D1, D2 = "20260412", "20260411"

# (day, source (rows, modified, columns) or None, target likewise) and the action per policy
CASES = [
    ("no source", D2, None, (1, T1, "a"), dict.fromkeys(POLICIES, "missing_source")),
    ("no source at D-1", D1, None, None, dict.fromkeys(POLICIES, "missing_source")),
    ("no target", D2, (1, T1, "a"), None, {
        "incremental": "merge", "modified": "merge", "d1_replace": "merge", "rowcount": "merge", "both": "merge",
        "hybrid": "backfill_copy", "replicate": "sync_done", "replicate_brief": "sync_done"}),
    ("no target at D-1", D1, (1, T1, "a"), None, {
        "incremental": "merge", "modified": "merge", "d1_replace": "direct_transfer", "rowcount": "direct_transfer",
        "both": "direct_transfer", "hybrid": "direct_transfer", "replicate": "sync_done",
        "replicate_brief": "sync_done"}),
    ("alike", D2, (1, T1, "a"), (1, T1, "a"), {
        **dict.fromkeys(POLICIES, "skipped"), "incremental": "merge"}),
    ("alike at D-1", D1, (1, T1, "a"), (1, T1, "a"), {
        "incremental": "merge", "modified": "merge", "d1_replace": "direct_transfer", "rowcount": "skipped",
        "both": "skipped", "hybrid": "direct_transfer", "replicate": "sync_done", "replicate_brief": "sync_done"}),
    ("newer, same count", D2, (1, T2, "a"), (1, T1, "a"), {
        "incremental": "merge", "modified": "merge", "d1_replace": "merge", "rowcount": "skipped", "both": "skipped",
        "hybrid": "merge", "replicate": "data_change", "replicate_brief": "sync_done"}),
    ("newer, more rows", D2, (2, T2, "a"), (1, T1, "a"), {
        **dict.fromkeys(POLICIES, "merge"), "replicate": "data_change", "replicate_brief": "sync_done"}),
    ("more rows, not newer", D2, (2, T1, "a"), (1, T1, "a"), {
        **dict.fromkeys(POLICIES, "skipped"), "incremental": "merge", "rowcount": "merge"}),
    ("more rows, not newer, at D-1", D1, (2, T1, "a"), (1, T1, "a"), {
        "incremental": "merge", "modified": "merge", "d1_replace": "direct_transfer", "rowcount": "direct_transfer",
        "both": "skipped", "hybrid": "direct_transfer", "replicate": "sync_done", "replicate_brief": "sync_done"}),
    ("other columns", D2, (1, T1, "a|b"), (1, T1, "a"), {
        **dict.fromkeys(POLICIES, "skipped"), "incremental": "merge", "replicate": "schema_change",
        "replicate_brief": "sync_done"}),
    ("other columns and newer", D2, (2, T2, "a|b"), (1, T1, "a"), {
        **dict.fromkeys(POLICIES, "merge"), "replicate": "schema_change", "replicate_brief": "sync_done"}),
    ("target time unknown", D2, (2, T1, "a"), (1, None, "a"), {
        **dict.fromkeys(POLICIES, "merge"), "replicate": "data_change", "replicate_brief": "sync_done"}),
    ("source time unknown", D2, (2, None, "a"), (1, T1, "a"), {
        "incremental": "merge", "modified": "skipped", "d1_replace": "skipped", "rowcount": "merge", "both": "merge",
        "hybrid": "merge", "replicate": "skipped", "replicate_brief": "skipped"}),
]


@pytest.fixture(scope="module")
def sides(spark):
    """Each case as a pair of profiles, one day each."""
    return lambda day, state: spark.createDataFrame([(day, *state)] if state else [], PROFILE)


@pytest.mark.parametrize("case", CASES, ids=[c[0] for c in CASES])
def test_rule_chains(sides, case):
    _, day, source, target, expected = case
    plans = {
        p: plan_profiles(sides(day, source), sides(day, target), p, "2026-04-13", 2).where(f"shard = {day}")
        for p in POLICIES
    }
    first, *rest = [df.selectExpr(f"'{p}' AS policy", "action") for p, df in plans.items()]
    for df in rest:
        first = first.union(df)
    assert {r["policy"]: r["action"] for r in first.collect()} == expected


def test_unknown_policy(sides):
    with pytest.raises(ValueError, match="policy is one of"):
        plan_profiles(sides(D1, None), sides(D1, None), "other", "2026-04-13")


def test_window(spark):
    assert lookback_shards("2024-03-02", 3) == ["20240301", "20240229", "20240228"]
    due = expected_shards(spark, dt.date(2024, 3, 2), 3).collect()
    assert [(r["shard"], r["offset"]) for r in due] == [("20240301", 1), ("20240229", 2), ("20240228", 3)]
    with pytest.raises(ValueError, match="lookback"):
        lookback_shards("2024-03-02", 0)


def test_day_outside_the_window_is_untouched(spark):
    schema = "shard string, id long, v string, modified timestamp_ntz"
    source = spark.createDataFrame([("20260413", 1, "s", T2), (D1, 2, "s", T2), (None, 9, "s", T2)], schema)
    target = spark.createDataFrame([("20260413", 1, "t", T1), ("20260301", 3, "t", T1), (None, 8, "t", T1)], schema)
    plan = sync_plan(source, target, "hybrid", "2026-04-13")
    assert plan.count() == 4
    got = {(r["shard"], r["id"], r["v"]) for r in apply_plan(source, target, plan, ["id"]).collect()}
    assert got == {("20260413", 1, "t"), (D1, 2, "s"), ("20260301", 3, "t"), (None, 8, "t")}
    assert {r["shard"] for r in missing_shards(source, "2026-04-13", 2).collect()} == {D2}


def test_merge_of_a_day_the_target_lacks_is_a_copy(spark):
    schema = "shard string, id long, modified timestamp_ntz"
    source = spark.createDataFrame([(D2, 1, T1), (D2, 1, T1)], schema)
    target = spark.createDataFrame([], schema)
    plan = sync_plan(source, target, "rowcount", "2026-04-13")
    assert apply_plan(source, target, plan, ["id"]).count() == 2
    with pytest.raises(ValueError, match="key columns"):
        apply_plan(source, source.limit(1), sync_plan(source, source.limit(1), "rowcount", "2026-04-13"))


def test_profile_of_columns(spark):
    df = spark.createDataFrame([(D1, 1, None), (D1, 2, None), (D2, 3, "x")], "shard string, a int, b string")
    both = "a:int|b:string"
    got = {r["shard"]: r["fingerprint"] for r in profile(df, "a", with_schema=True).collect()}
    assert got == {D1: both, D2: both}  # a column without values is declared all the same
    found = profile(df, "a", with_schema=True, schemas={D1: df.select("a").schema})
    assert {r["shard"]: r["fingerprint"] for r in found.collect()} == {D1: "a:int", D2: both}


PLAN = "shard string, offset int, source_rows long, action string"


def test_reports_of_an_idle_run(spark):
    plan = spark.createDataFrame([(D1, 1, None, "missing_source"), (D2, 2, 5, "skipped")], PLAN)
    assert report.transfers(plan).first() == ("No transfers", "No merges")
    assert {r["bucket"]: (r["days"], r["shards"]) for r in report.by_bucket(plan).collect()} == {
        "direct_transfer": (0, "None"),
        "backfill_copy": (0, "None"),
        "merge": (0, "None"),
        "skipped": (2, f"{D2}, {D1}"),
    }
    three = report.by_bucket(plan, ["sync_done", "skipped", "missing_source"]).collect()
    assert [(r["bucket"], r["shards"]) for r in three] == [
        ("sync_done", "None"), ("skipped", D2), ("missing_source", D1)
    ]
    assert {tuple(r) for r in report.ready(plan).collect()} == {
        (D1, "SKIPPED", "SKIPPED (no changes or source missing)"),
        (D2, "READY", "SKIPPED (no changes)"),
    }


def test_drift_names_every_kind_of_change(spark):
    source = spark.createDataFrame([(D1, 1, "x", 2.0), ("20260401", 1, "x", 2.0)], "shard string, a int, new string, v double")
    target = spark.createDataFrame([(D1, 1, "x", 2)], "shard string, a int, old string, v long")
    changes = drift(source, target).collect()
    assert {(r["shard"], r["name"], r["change"]) for r in changes} == {
        (D1, "new", "added"), (D1, "old", "removed"), (D1, "v", "type_changed")
    }
    # A column that is NULL for the whole day has not gone.
    empty = source.withColumn("new", F.lit(None).cast("string"))
    assert drift(empty, source).collect() == []
    older = {D1: source.drop("new").schema}
    assert [(r["name"], r["change"]) for r in drift(empty, source, target_schemas=older).collect()] == [("new", "added")]
    plan = drift(source, target)._jdf.queryExecution().optimizedPlan().toString()
    assert "count" not in plan


def test_replacement_drops_columns_no_other_day_declares(spark):
    source = spark.createDataFrame([("20260412", 1, "a")], "shard string, id long, v string")
    target = spark.createDataFrame(
        [("20260412", 1, "x", "y"), ("20260411", 2, None, "z"), (None, 3, None, None)], "shard string, id long, old string, note string"
    )
    columns = {"20260412": target.schema, "20260411": target.drop("old").schema}

    def names(days, rows, schemas):
        return replace_days(source, rows, days, target_schemas=schemas).columns

    dated = target.where("shard IS NOT NULL")
    assert names(["20260412"], dated, columns) == ["shard", "id", "note", "v"]
    assert names(["20260412", "20260411"], dated, columns) == ["shard", "id", "v"]
    # Days that nothing is known of, and rows without a day, keep the columns of the frame.
    assert names(["20260412"], target, columns) == names(["20260412"], dated, {}) == ["shard", "id", "old", "note", "v"]
    assert names(["20260412"], dated, None) == ["shard", "id", "old", "note", "v"]
    kept = replace_days(source, dated, ["20260412"], target_schemas=columns).collect()
    assert sorted(map(tuple, kept)) == [("20260411", 2, "z", None), ("20260412", 1, None, "a")]
    assert replace_days(source, target.drop("old", "note"), ["20260412"], target_schemas={}).columns == ["shard", "id", "v"]
