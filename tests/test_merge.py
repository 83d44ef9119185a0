import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from daysync.operators.dedupe import latest
from daysync.operators.merge import (
    choose_keys,
    incremental,
    insert_new_rows,
    mark_text,
    merge_incremental,
    newer_than,
    upsert,
)
from daysync.operators.schema import empty_clone
from daysync.operators.update import update_first


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is not None, str(v)) for v in r))


def frame(spark, data, schema):
    return spark.createDataFrame(data, schema)


def test_every_cell_of_the_contract(spark):
    target = frame(spark, [(1, "t1", "k1", "only1"), (2, "t2", "k2", "only2")], "id long, a string, keep string, old string")
    source = frame(spark, [(2, None, "s2", "new2"), (3, "s3", "s3", "new3")], "id long, a string, keep string, extra string")
    merged = upsert(target, source, ["id"], update_columns=["a", "extra"])
    assert merged.columns == ["id", "a", "keep", "old", "extra"]
    assert rows(merged) == [
        (1, "t1", "k1", "only1", None),
        (2, None, "k2", "only2", "new2"),
        (3, "s3", "s3", None, "new3"),
    ]


def test_new_column_outside_the_update_list_is_set_on_insert_only(spark):
    target = frame(spark, [(1, "t")], "id long, a string")
    source = frame(spark, [(1, "s", "x"), (2, "s", "y")], "id long, a string, extra string")
    assert rows(upsert(target, source, ["id"], update_columns=["a"])) == [(1, "s", None), (2, "s", "y")]


def test_nothing_to_update_only_inserts_and_tolerates_repeated_matches(spark):
    target = frame(spark, [(1,), (2,)], "id long")
    source = frame(spark, [(2,), (2,), (3,)], "id long")
    assert rows(upsert(target, source, ["id"])) == [(1,), (2,), (3,)]


def test_null_keys_match_nothing(spark):
    target = frame(spark, [(None, "t"), (1, "t")], "id long, a string")
    source = frame(spark, [(None, "s"), (None, "s"), (1, "s")], "id long, a string")
    assert rows(upsert(target, source, ["id"])) == [(None, "s"), (None, "s"), (None, "t"), (1, "s")]


def test_null_keys_match_when_null_safe(spark):
    target = frame(spark, [(None, 1, "t"), (1, None, "t")], "a long, b long, c string")
    source = frame(spark, [(None, 1, "s"), (None, None, "s")], "a long, b long, c string")
    merged = upsert(target, source, ["a", "b"], null_safe=True)
    assert rows(merged) == [(None, None, "s"), (None, 1, "s"), (1, None, "t")]


def test_null_is_a_value_of_the_columns_merged_within(spark):
    schema = "shard string, id long, v string"
    target = frame(spark, [(None, 1, "t"), ("d", 1, "t"), (None, None, "t")], schema)
    source = frame(spark, [(None, 1, "s"), ("e", 1, "s"), (None, None, "s")], schema)
    assert rows(upsert(target, source, ["id"], within=["shard"])) == [
        (None, None, "s"), (None, None, "t"), (None, 1, "s"), ("d", 1, "t"), ("e", 1, "s"),
    ]
    with pytest.raises(Exception, match="merge key"):
        upsert(target, source.union(source), ["id"], within=["shard"]).collect()


def test_latest_keeps_one_row_of_null_keys_too(spark):
    target = frame(spark, [(None, "t", 1)], "id long, a string, seq int")
    source = frame(spark, [(None, "old", 1), (None, "new", 2)], "id long, a string, seq int")
    merged = upsert(target, source, ["id"], on_duplicate="latest", order_by=["seq"])
    assert rows(merged) == [(None, "new", 2), (None, "t", 1)]


def test_repeated_source_key_fails_if_it_matches(spark):
    target = frame(spark, [(1, "t")], "id long, a string")
    source = frame(spark, [(1, "s"), (1, "s")], "id long, a string")
    merged = upsert(target, source, ["id"])
    for use in (
        lambda d: d,
        lambda d: d.groupBy().count(),
        lambda d: d.select("id"),
        lambda d: d.where("a = 's'"),
        lambda d: d.where("a IS NOT NULL"),
        lambda d: d.where("a IS NULL OR id = 1"),
        lambda d: d.where("id IN (1, 2)"),
        lambda d: d.where("id = 1").select("a").distinct(),
        lambda d: d.dropDuplicates(["a"]),
    ):
        with pytest.raises(Exception, match="in 2 source rows and 1 target rows"):
            use(merged).collect()
    assert merged.where("id = 2").collect() == []


def test_repeated_source_key_is_inserted_whole_if_it_does_not_match(spark):
    target = frame(spark, [(1, "t")], "id long, a string")
    source = frame(spark, [(2, "s"), (2, "s"), (2, "u")], "id long, a string")
    assert rows(upsert(target, source, ["id"])) == [(1, "t"), (2, "s"), (2, "s"), (2, "u")]


def test_one_source_row_updates_all_its_target_rows(spark):
    target = frame(spark, [(1, "a"), (1, "b"), (2, "c")], "id long, a string")
    source = frame(spark, [(1, "s")], "id long, a string")
    assert rows(upsert(target, source, ["id"])) == [(1, "s"), (1, "s"), (2, "c")]


def test_odd_column_names(spark):
    target = frame(spark, [(1, "t")], "`my id` long, `a.b` string")
    source = frame(spark, [(1, "s"), (2, "s")], "`my id` long, `a.b` string")
    assert rows(upsert(target, source, ["my id"])) == [(1, "s"), (2, "s")]


def test_nested_columns_travel_whole(spark):
    schema = "id long, m map<string,int>, s struct<x:int,y:array<string>>"
    target = frame(spark, [(1, {"a": 1}, (1, ["p"]))], schema)
    source = frame(spark, [(1, {"b": 2}, (2, ["q"])), (2, None, None)], schema)
    got = sorted(upsert(target, source, ["id"]).collect())
    assert got[0]["m"] == {"b": 2} and got[0]["s"]["y"] == ["q"] and got[1]["m"] is None


def test_types_widen_but_never_narrow(spark):
    target = frame(spark, [(1, 1.5)], "id long, v double")
    merged = upsert(target, frame(spark, [(1, 7), (2, 8)], "id int, v int"), ["id"])
    assert merged.dtypes == [("id", "bigint"), ("v", "double")]
    assert rows(merged) == [(1, 7.0), (2, 8.0)]
    with pytest.raises(ValueError, match="column v"):
        upsert(target, frame(spark, [(1, "x")], "id long, v string"), ["id"])


def test_bad_arguments(spark):
    t = frame(spark, [(1, "t")], "id long, a string")
    for call, text in [
        (lambda: upsert(t, t, []), "at least one key"),
        (lambda: upsert(t, t, ["nope"]), "not on both sides"),
        (lambda: upsert(t, t, ["id"], update_columns=["nope"]), "not in the source"),
        (lambda: upsert(t, t, ["id"], on_duplicate="any"), "on_duplicate"),
        (lambda: upsert(t, t.withColumnRenamed("a", "A"), ["id"]), "case only"),
        (lambda: upsert(t, t.withColumnRenamed("id", "ID"), ["id"]), "names differ in case only"),
        (lambda: upsert(t, t, ["id"], on_duplicate="latest"), "needs order_by"),
        (lambda: insert_new_rows(t, t, ignore=["id", "a"]), "no column left"),
        (lambda: latest(t, ["id"], ["nope"]), "no column"),
    ]:
        with pytest.raises(ValueError, match=text):
            call()


def test_key_choice():
    key = ("user_pseudo_id", "event_timestamp", "event_name")
    assert choose_keys(["id", *key]) == ["id"]
    assert choose_keys([*key, "x"]) == list(key)
    assert choose_keys(["event_name", "x"], present_only=True) == ["event_name"]
    assert choose_keys(["event_name", "event_time", "value"]) == ["event_time", "event_name"]
    for columns, loose in ((["event_name"], False), (["x"], True)):
        with pytest.raises(ValueError, match="no key columns"):
            choose_keys(columns, present_only=loose)


KEY = st.one_of(st.none(), st.integers(0, 3))
VALUE = st.one_of(st.none(), st.integers(0, 9))
TABLE = st.lists(st.tuples(KEY, KEY, VALUE), max_size=12)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(target=TABLE, source=TABLE, null_safe=st.booleans())
def test_upsert_equals_a_row_by_row_merge(spark, target, source, null_safe):
    schema = "a int, b int, v int"

    def same(x, y):
        return x[:2] == y[:2] and (null_safe or None not in x[:2])

    expected = []
    ambiguous = False
    for t in target:
        hits = [s for s in source if same(t, s)]
        ambiguous |= len(hits) > 1
        expected.append(hits[0] if hits else t)
    expected += [s for s in source if not any(same(t, s) for t in target)]

    merged = upsert(
        frame(spark, target, schema), frame(spark, source, schema), ["a", "b"],
        null_safe=null_safe,
    )
    if ambiguous:
        with pytest.raises(Exception, match="merge key"):
            merged.collect()
    else:
        assert sorted(map(str, map(tuple, merged.collect()))) == sorted(map(str, expected))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(target=TABLE, source=TABLE)
def test_insert_new_rows_equals_brute_force(spark, target, source):
    schema = "a int, b int, modified int"
    merged = insert_new_rows(frame(spark, target, schema), frame(spark, source, schema), ignore=["modified"])
    known = {t[:2] for t in target}
    expected = target + [s for s in source if s[:2] not in known]
    assert sorted(map(str, map(tuple, merged.collect()))) == sorted(map(str, expected))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(table=TABLE)
def test_latest_equals_brute_force(spark, table):
    best = {}
    for r in table:
        rank = tuple((v is not None, v or 0) for v in (r[2], r[1]))
        if r[0] not in best or rank > best[r[0]][0]:
            best[r[0]] = (rank, r)
    got = latest(frame(spark, table, "a int, b int, v int"), ["a"], ["v"])
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(str(r) for _, r in best.values())


S2 = "event_time timestamp, event_name string, value string, seq int"


def at(day, clock):
    return dt.datetime.fromisoformat(f"2026-04-{day:02d} {clock}")


@pytest.mark.parametrize(
    ("data", "left"),
    [
        ([("09:00", "click", "A"), ("09:05", "view", "B"), ("09:00", "click", "A_UPDATED")], {"A_UPDATED", "B"}),
        ([("08:00", "click", "X1"), ("08:00", "click", "X2"), ("08:10", "view", "Y")], {"X2", "Y"}),
        ([("05:00", "click", "OLD"), ("05:00", "click", "UPDATED"), ("05:05", "view", "B")], {"UPDATED", "B"}),
        ([("05:00", "click", "OLD"), ("05:00", "click", "UPDATED"), ("05:00", "click", "UPDATED_2")], {"UPDATED_2"}),
        (
            [("03:00", "click", "A1"), ("03:00", "click", "A2"), ("03:00", "click", "A3"), ("03:05", "view", "B")],
            {"A3", "B"},
        ),
        ([("04:00", "click", "A"), ("04:10", "view", "B")], {"A", "B"}),
    ],
)
def test_event_key_merge_keeps_the_latest(spark, data, left):
    source = frame(spark, [(at(11, c), n, v, i) for i, (c, n, v) in enumerate(data)], S2)
    target = frame(spark, [(at(11, data[0][0]), data[0][1], "STALE", -1)], S2)
    merged = upsert(target, source, ["event_time", "event_name"], on_duplicate="latest", order_by=["seq"])
    assert {r["value"] for r in merged.collect()} == left
    assert merged.count() == len(left)


def test_drift_with_update(spark):
    source = frame(
        spark,
        [(at(9, "07:00"), "click", "OLD_VALUE", 0, "EXTRA_FIELD_1"), (at(9, "07:00"), "click", "NEW_VALUE", 1, "EXTRA_FIELD_1")],
        S2 + ", new_col string",
    )
    target = frame(spark, [(at(9, "07:00"), "click", "STALE", -1), (at(9, "07:30"), "view", "KEPT", -1)], S2)
    merged = upsert(target, source, ["event_time", "event_name"], on_duplicate="latest", order_by=["seq"])
    got = {(r["value"], r["new_col"]) for r in merged.collect()}
    assert got == {("NEW_VALUE", "EXTRA_FIELD_1"), ("KEPT", None)}


def test_merge_into_empty_clone_takes_every_row(spark):
    source = frame(spark, [(at(10, "08:00"), "click", "X1", 0), (at(10, "08:00"), "click", "X2", 1)], S2)
    merged = upsert(empty_clone(source), source, ["event_time", "event_name"])
    assert merged.schema == source.schema
    assert rows(merged) == rows(source)


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_rows_at_or_below_the_high_water_mark_stay_out(spark, kind):
    def table(data):
        df = frame(spark, data, "shard string, id long, at string")
        return df.select("shard", "id", F.col("at").cast(kind).alias("modified"))

    target = table([("20260410", 1, "2026-04-10 08:00:00.000001"), ("20260409", 9, "2026-04-09 01:00:00")])
    source = table(
        [
            ("20260410", 1, "2026-04-10 08:00:00.000001"),
            ("20260410", 2, "2026-04-10 08:00:02.000002"),
            ("20260410", 3, "2026-03-31 08:00:00"),
            ("20260410", 4, None),
            ("20260408", 5, "2026-03-31 08:00:00"),
            ("20260401", 6, "2026-04-11 00:00:00"),
        ]
    )
    days = ["20260410", "20260409", "20260408"]
    staged = incremental(source, target, "modified", days)
    assert {r["id"] for r in staged.collect()} == {2, 5}

    mark = mark_text(F.max("modified"), target.schema["modified"].dataType)
    marks = {r[0]: r[1] for r in target.groupBy("shard").agg(mark).collect()}
    known = newer_than(source, "modified", {d: marks.get(d) for d in days})
    assert {r["id"] for r in known.collect()} == {2, 5}

    merged = merge_incremental(target, source, "modified", days, keys=["id"], within=["shard"])
    assert sorted(r["id"] for r in merged.collect()) == [1, 2, 5, 9]


def test_incremental_update_leaves_the_modified_column(spark):
    schema = "shard string, id long, v string, modified timestamp_ntz"
    target = frame(spark, [("20260410", 1, "t", at(10, "08:00"))], schema)
    source = frame(spark, [("20260410", 1, "s", at(10, "09:00"))], schema)
    merged = merge_incremental(target, source, "modified", ["20260410"], keys=["id"], within=["shard"])
    assert rows(merged) == [("20260410", 1, "s", at(10, "08:00"))]


def test_incremental_merge_without_keys_compares_rows(spark):
    schema = "shard string, v string, modified timestamp_ntz"
    target = frame(spark, [("20260410", None, at(10, "08:00"))], schema)
    source = frame(spark, [("20260410", None, at(10, "09:00")), ("20260410", "x", at(10, "09:00"))], schema)
    merged = merge_incremental(target, source, "modified", ["20260410"], keys=None)
    assert rows(merged) == [("20260410", None, at(10, "08:00")), ("20260410", "x", at(10, "09:00"))]


ODD = "id int, m map<string,int>, x double, s string, l array<double>, at timestamp_ntz, n struct<a:int,b:map<int,timestamp>>"


def _odd(at="2026-01-01 00:00:00.000001", **changes):
    inner = {1: dt.datetime(2026, 1, 1, tzinfo=dt.UTC), 2: None}
    row = {"id": 1, "m": {"a": 1, "b": None}, "x": 0.0, "s": None, "l": [1.5, None], "at": dt.datetime.fromisoformat(at), "n": (1, inner)}
    return tuple((row | changes).values())


def test_rows_with_maps_are_compared_whatever_their_order(spark):
    turned = {2: None, 1: dt.datetime(2026, 1, 1, tzinfo=dt.UTC)}
    target = spark.createDataFrame([_odd(), _odd(id=2, x=float("nan"))], ODD)
    same = [_odd(m={"b": None, "a": 1}), _odd(x=-0.0), _odd(n=(1, turned)), _odd(id=2, x=float("nan"))]
    other = [
        _odd(m={"a": 1, "b": 0}), _odd(s="null"), _odd(s=""), _odd(at="2026-01-01 00:00:00.000002"), _odd(l=[1.5]), _odd(m=None), _odd(n=None),
    ]
    merged = insert_new_rows(target, spark.createDataFrame(same + other, ODD))
    assert merged.count() == 2 + len(other)
    assert insert_new_rows(merged, spark.createDataFrame(same + other, ODD)).count() == 2 + len(other)


def test_no_column_of_the_target_is_shuffled_to_compare_rows(spark):
    target = spark.createDataFrame([(k, "x" * 50) for k in range(50)], "id int, payload string")
    source = spark.createDataFrame([(k, "x" * 50) for k in range(40, 60)], "id int, payload string")
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = insert_new_rows(target, source)
        plan = merged._jdf.queryExecution().executedPlan().toString()
        assert merged.count() == 60
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    moved = [line for line in plan.splitlines() if "Exchange" in line]
    assert len(moved) >= 2 and "payload" not in "".join(line for line in moved if "digest" in line and "hash" not in line)


def test_marks_of_days_are_looked_up_and_the_least_is_pushed(spark, tmp_path):
    rows = [(k, f"2026010{k % 3 + 1}", dt.datetime(2026, 1, 1) + dt.timedelta(hours=k)) for k in range(60)]
    spark.createDataFrame(rows, "id int, shard string, modified timestamp_ntz").write.parquet(str(tmp_path / "t"))
    source = spark.read.parquet(str(tmp_path / "t"))
    marks = {"20260101": "2026-01-02 00:00:00", "20260102": "2026-01-01 12:00:00.5"}
    found = {r["id"] for r in newer_than(source, "modified", marks).collect()}
    bound = {d: dt.datetime.fromisoformat(m) for d, m in marks.items()}
    assert found == {k for k, d, at in rows if d in bound and at > bound[d]}
    plan = newer_than(source, "modified", marks)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(modified,2026" in plan
    assert newer_than(source, "modified", {}).count() == 0


def test_update_first_changes_exactly_so_many_of_the_rows_that_tie(spark, tmp_path):
    rows = [(1, "a")] * 5 + [(2, "a"), (None, "a")]
    spark.createDataFrame(rows, "id int, v string").repartition(3).write.parquet(str(tmp_path / "t"))
    for df in (spark.read.parquet(str(tmp_path / "t")), spark.createDataFrame(rows, "id int, v string")):
        for count in (0, 1, 3, 5, 6, 9):
            changed = [r["id"] for r in update_first(df, "id", count, {"v": F.lit("b")}).collect() if r["v"] == "b"]
            assert sorted(changed) == ([1] * 5 + [2])[:count]
