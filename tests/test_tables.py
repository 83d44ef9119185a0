"""Tables on disk: writing, replacing, syncing."""

import os
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daysync.functions.rows import checksum
from daysync.operators.joins import merge_on
from daysync.operators.schema import widens
from daysync.plans.run import sync_table
from daysync.session import work_folder
from daysync.sinks import write
from daysync.sources.files import Folder
from daysync.sources.shards import in_shards
from daysync.sources.tables import (
    file_profile,
    merged_schema,
    read_day_table,
    read_day_tables,
    read_named,
    shard_schemas,
)

DAY = "shard string, id long, v string, modified timestamp_ntz"
TIMES = ["2026-04-12 10:00:00", "2026-04-12 11:00:00"]


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "table")


def days(spark, data, schema=DAY):
    df = spark.createDataFrame(data, schema.replace("timestamp_ntz", "string"))
    return df.withColumn("modified", F.col("modified").cast("timestamp_ntz")) if "modified" in df.columns else df


def content(spark, path, *columns):
    return sorted((tuple(r) for r in read_day_table(spark, path).select(*columns).collect()), key=str)


def test_shard_is_text_again_and_old_days_read_new_columns_as_null(spark, path):
    write.write_day_table(days(spark, [("20260411", 1)], "shard string, id long"), path)
    newer = days(spark, [("20260412", 2, "x")], "shard string, id long, extra string")
    write.append_rows(spark, newer, path, newer.schema)
    assert content(spark, path, "shard", "id", "extra") == [("20260411", 1, None), ("20260412", 2, "x")]
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("extra", T.StringType())])
    assert read_day_table(spark, path, schema).dtypes == [("id", "bigint"), ("extra", "string"), ("shard", "string")]
    found = shard_schemas(spark, path, ["20260411", "20260412"])
    assert [f.names for f in found.values()] == [["id"], ["id", "extra"]]


def test_columns_of_all_days_come_from_one_job(spark, path):
    for part in ("id long, a int", "id long, a bigint, b string", "id long, c struct<x:int>", "id long, c struct<x:int,y:array<int>>"):
        df = spark.createDataFrame([], part).withColumn("n", F.lit(1))
        for day in ("20260411", "20260412"):
            if day == "20260411" or "c " not in part:
                rows = spark.range(1).select(F.lit(day).alias("shard"), *[F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema])
                rows.write.mode("append").partitionBy("shard").parquet(path)
    spark.range(3).write.parquet(f"{path}/shard=20260413")
    spark.sparkContext.setJobGroup("footers", "footers of three days")
    found = shard_schemas(spark, path, ["20260411", "20260412", "20260413"])
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("footers")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert {day: dict(sorted((f.name, f.dataType.simpleString()) for f in s)) for day, s in found.items()} == {
        "20260411": {"a": "bigint", "b": "string", "c": "struct<x:int,y:array<int>>", "id": "bigint", "n": "int"},
        "20260412": {"a": "bigint", "b": "string", "id": "bigint", "n": "int"},
        "20260413": {"id": "bigint"},
    }
    assert all(f.nullable for s in found.values() for f in s)
    # One action; adaptive execution runs its two stages as jobs of their own. Not a job for each day.
    assert len(jobs) <= 2
    assert shard_schemas(spark, path, []) == {}


def test_days_of_other_writers_are_left_to_spark(spark, path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    write.write_day_table(days(spark, [("20260411", 1)], "shard string, id long"), path)
    os.makedirs(f"{path}/shard=20260412")
    pq.write_table(pa.table({"id": pa.array([1], pa.int32()), "at": pa.array([0], pa.timestamp("us"))}), f"{path}/shard=20260412/x y%20.parquet")
    found = shard_schemas(spark, path, ["20260411", "20260412"])
    assert {day: [f.dataType.simpleString() for f in s] for day, s in found.items()} == {
        "20260411": ["bigint"], "20260412": ["int", "timestamp_ntz"],
    }
    for name in ("Id", "id"):  # one column to Spark, which takes either spelling
        spark.range(1).toDF(name).write.mode("append").parquet(f"{path}/shard=20260413")
    assert len(shard_schemas(spark, path, ["20260413"])["20260413"]) == 1


def test_append_fills_left_out_columns(spark, path):
    table = days(spark, [("20260412", 1, "a", TIMES[0])])
    write.write_day_table(table, path)
    write.append_rows(spark, days(spark, [("20260412", 2)], "shard string, id int"), path, table.schema)
    assert content(spark, path, "id", "v") == [(1, "a"), (2, None)]
    with pytest.raises(ValueError, match="not in the table"):
        write.append_rows(spark, table.withColumn("x", F.lit(1)), path, table.schema)


def test_replace_from_the_table_itself(spark, path):
    write.write_day_table(days(spark, [(f"2026041{d}", i, "a", TIMES[0]) for d in range(3) for i in range(4)]), path)
    table = read_day_table(spark, path)
    kept = {n: os.path.getmtime(f"{path}/shard=20260410/{n}") for n in os.listdir(f"{path}/shard=20260410")}
    changed = table.withColumn("v", F.lit("b")).where("shard = '20260411' AND id < 2")
    with pytest.raises(ValueError, match="other shards.*20260411"):
        write.replace_shards(spark, [changed], path, ["20260412"])
    assert len(content(spark, path, "id")) == 12
    write.replace_shards(spark, [changed], path, ["20260411", "20260412"])
    assert content(spark, path, "shard", "id", "v") == [
        ("20260410", i, "a") for i in range(4)
    ] + [("20260411", i, "b") for i in range(2)]
    assert kept == {n: os.path.getmtime(f"{path}/shard=20260410/{n}") for n in kept}
    assert Folder(spark, path).shards() == ["20260410", "20260411"]


def test_swap_goes_on_after_a_crash(spark, path, monkeypatch):
    write.write_day_table(days(spark, [(d, 1, "a", TIMES[0]) for d in ("20260411", "20260412")]), path)
    new = days(spark, [(d, 2, "b", TIMES[1]) for d in ("20260411", "20260412")])
    move, moved = Folder.move, []

    def dying(self, name, to):
        if moved:
            self.drop(to)
            raise KeyboardInterrupt
        moved.append(to)
        move(self, name, to)

    monkeypatch.setattr(Folder, "move", dying)
    with pytest.raises(KeyboardInterrupt):
        write.replace_shards(spark, [new], path, ["20260411", "20260412"])
    monkeypatch.undo()
    assert len(Folder(spark, path).shards()) == 1
    write.finish_replace(spark, path)
    assert content(spark, path, "shard", "v") == [("20260411", "b"), ("20260412", "b")]
    assert not [n for n in os.listdir(path) if n.startswith("_staged")]


def test_unfinished_staging_is_dropped(spark, path):
    write.write_day_table(days(spark, [("20260411", 1, "a", TIMES[0])]), path)
    write.write_day_table(days(spark, [("20260411", 2, "b", TIMES[0])]), f"{path}/_staged-x")
    write.finish_replace(spark, path)
    assert content(spark, path, "id") == [(1,)]
    assert not os.path.exists(f"{path}/_staged-x")


def test_export_overwrites(spark, path):
    df = spark.range(100).withColumns({"name": F.concat(F.lit("n"), "id"), "other": F.lit(1)})
    write.export_parquet(df.repartition(3), ["id", "name"], path)
    write.export_parquet(df.where("id < 10").repartition(3), ["id", "name"], path)
    back = spark.read.parquet(path)
    assert back.columns == ["id", "name"] and back.count() == 10
    assert len([n for n in os.listdir(path) if n.endswith(".parquet")]) == 3


def test_file_profile_opens_no_file(spark, path):
    write.write_day_table(days(spark, [(d, 1, "a", TIMES[0]) for d in ("20260411", "20260412")]), path)
    name = next(n for n in os.listdir(f"{path}/shard=20260412") if n.endswith(".parquet"))
    stamp = time.time() + 1000
    with open(f"{path}/shard=20260412/{name}", "r+b") as f:
        f.write(b"not parquet")
    os.utime(f"{path}/shard=20260412/{name}", (stamp, stamp))
    got = {r["shard"]: r for r in file_profile(spark, path).collect()}
    assert set(got) == {"20260411", "20260412"} and got["20260411"]["files"] == 1
    assert got["20260412"]["max_modified"] > got["20260411"]["max_modified"]


def test_schemas_of_days_are_merged_to_the_wider_type():
    def schema(**types):
        return T.StructType([T.StructField(n, t) for n, t in types.items()])

    a, b = schema(x=T.IntegerType()), schema(x=T.LongType(), y=T.StringType())
    assert merged_schema([a, b]) == merged_schema([b, a]) == schema(x=T.LongType(), y=T.StringType())
    with pytest.raises(ValueError, match="column x"):
        merged_schema([a, schema(x=T.StringType())])


def test_scratch_lies_in_the_shared_folder(spark):
    folder = work_folder(spark)
    assert folder.startswith(spark.conf.get("spark.checkpoint.dir") + "/") and folder != work_folder(spark)


def test_catalog_table(spark):
    spark.range(3).withColumn("w", F.lit("b")).write.mode("overwrite").saveAsTable("lake_b")
    spark.createDataFrame([(1, "a"), (None, "n")], "id long, w string").createOrReplaceTempView("lake_a")
    joined = merge_on(read_named(spark, "lake_a"), read_named(spark, "lake_b"), "id")
    assert joined.columns == ["id", "w_x", "w_y"]
    assert [tuple(r) for r in joined.collect()] == [(1, "a", "b")]


def test_tables_of_one_day_each(spark):
    for day, columns in (("20260411", {"v": "a"}), ("20260412", {"v": "b", "extra": "c"})):
        df = spark.range(2).withColumns({c: F.lit(v) for c, v in columns.items()})
        df.write.mode("overwrite").saveAsTable(f"day_events_{day}")
    shards = ["20260412", "20260411", "20260410"]
    events = read_day_tables(spark, "day_events", shards)
    assert sorted(tuple(r) for r in events.select("shard", "id", "v", "extra").collect()) == [
        ("20260411", 0, "a", None), ("20260411", 1, "a", None),
        ("20260412", 0, "b", "c"), ("20260412", 1, "b", "c"),
    ]
    plan = in_shards(events, ["20260412"])._jdf.queryExecution().executedPlan().toString()
    assert "day_events_20260412" in plan and "day_events_20260411" not in plan
    with pytest.raises(ValueError, match="no table"):
        read_day_tables(spark, "nothing", shards)


def test_joined_null_keys(spark):
    a = spark.createDataFrame([(None, "a"), (1, "b")], "id long, x string")
    assert merge_on(a, a, "id").count() == 1
    assert merge_on(a, a, "id", null_safe=True).count() == 2


# Syncs. Logical date 2026-04-13: D-1 is 20260412.

SOURCE = [
    ("20260412", 1, "new", TIMES[1]), ("20260412", 2, "new", TIMES[1]),
    ("20260411", 1, "late", TIMES[1]), ("20260411", 3, "late", TIMES[1]),
    ("20260410", 1, "same", TIMES[0]),
    ("20260409", 1, "fill", TIMES[0]),
]
TARGET = [
    ("20260412", 9, "old", TIMES[0]),
    ("20260411", 1, "old", TIMES[0]), ("20260411", 2, "own", TIMES[0]),
    ("20260410", 1, "same", TIMES[0]),
    ("20260408", 1, "aged", TIMES[0]),
]
HYBRID = [
    ("20260408", 1, "aged"),
    ("20260409", 1, "fill"),
    ("20260410", 1, "same"),
    ("20260411", 1, "late"), ("20260411", 2, "own"), ("20260411", 3, "late"),
    ("20260412", 1, "new"), ("20260412", 2, "new"),
]


@pytest.fixture
def pair(spark, tmp_path):
    source, target = str(tmp_path / "source"), str(tmp_path / "target")
    write.write_day_table(days(spark, SOURCE), source)
    write.write_day_table(days(spark, TARGET), target)
    return source, target


def sync(spark, pair, policy="hybrid", **options):
    done = sync_table(spark, *pair, policy, logical_date="2026-04-13", **options).collect()
    return {r["shard"]: (r["action"], r["written_rows"]) for r in done}


def test_hybrid_sync_by_column(spark, pair):
    done = sync(spark, pair, modified="modified")
    assert done == {
        "20260412": ("direct_transfer", 2),
        "20260411": ("merge", 3),
        "20260410": ("skipped", None),
        "20260409": ("backfill_copy", 1),
    }
    assert content(spark, pair[1], "shard", "id", "v") == HYBRID
    again = sync(spark, pair, keys=["id"], modified="modified")
    assert again["20260411"] == again["20260409"] == ("skipped", None)


def test_hybrid_sync_by_file_times(spark, pair):
    for side, stamp in ((0, 2000), (1, 1000)):
        for day in ("20260411", "20260410"):
            folder = f"{pair[side]}/shard={day}"
            for name in os.listdir(folder):
                when = 1000 if day == "20260410" else stamp
                os.utime(f"{folder}/{name}", (when, when))
    assert sync(spark, pair, keys=["id"])["20260410"] == ("skipped", None)
    assert content(spark, pair[1], "shard", "id", "v") == HYBRID
    assert sync(spark, pair, keys=["id"])["20260411"] == ("skipped", None)


def test_sync_into_nothing(spark, pair, tmp_path):
    target = str(tmp_path / "fresh")
    done = sync(spark, (pair[0], target), keys=["id"], modified="modified")
    assert {a for a, _ in done.values()} == {"direct_transfer", "backfill_copy"}
    assert content(spark, target, "shard", "id", "v") == content(spark, pair[0], "shard", "id", "v")


def test_sync_keeping_the_latest_of_a_key(spark, pair):
    source, target = pair
    write.append_rows(spark, days(spark, [("20260411", 1, "later", "2026-04-12 12:00:00")]), source, days(spark, SOURCE).schema)
    with pytest.raises(Exception, match="merge key"):
        sync(spark, pair, keys=["id"], modified="modified")
    done = sync(spark, pair, keys=["id"], modified="modified", on_duplicate="latest")
    assert done["20260411"] == ("merge", 3)
    assert ("20260411", 1, "later") in content(spark, target, "shard", "id", "v")


def test_incremental_sync_writes_only_days_with_newer_rows(spark, pair):
    done = sync(spark, pair, "incremental", keys=["id"], modified="modified")
    assert done == {
        "20260412": ("merge", 3),
        "20260411": ("merge", 3),
        "20260410": ("merge", None),
        "20260409": ("merge", 1),
    }
    assert content(spark, pair[1], "shard", "id", "v") == sorted([*HYBRID, ("20260412", 9, "old")])
    assert {r[0] for r in content(spark, pair[1], "modified") if r[0] is not None}
    with pytest.raises(ValueError, match="modified column"):
        sync(spark, pair, "incremental", keys=["id"])


def test_incremental_sync_without_an_id_compares_rows(spark, tmp_path):
    schema = "shard string, v string, modified timestamp_ntz"
    source, target = str(tmp_path / "source"), str(tmp_path / "target")
    write.write_day_table(days(spark, [("20260412", "a", TIMES[1]), ("20260412", "b", TIMES[1])], schema), source)
    write.write_day_table(days(spark, [("20260412", "a", TIMES[0])], schema), target)
    assert sync(spark, (source, target), "incremental", modified="modified")["20260412"] == ("merge", 2)
    assert {(r[0], str(r[1])) for r in content(spark, target, "v", "modified")} == {("a", TIMES[0]), ("b", TIMES[1])}


def test_modified_column_has_to_be_in_the_source(spark, pair):
    with pytest.raises(ValueError, match="no column changed"):
        sync(spark, pair, keys=["id"], modified="changed")


def test_nothing_due(spark, pair):
    for policy in ("incremental", "hybrid", "replicate"):
        done = sync_table(spark, *pair, policy, logical_date="2026-06-01", modified="modified").collect()
        assert {(r["action"], r["written_rows"]) for r in done} == {("missing_source", None)}


def test_failed_sync_leaves_the_table_and_no_scratch(spark, pair):
    before = content(spark, pair[1], "shard", "id", "v")
    shared = spark.conf.get("spark.checkpoint.dir")
    scratch = set(os.listdir(shared))
    source = days(spark, [("20260411", 1, "a", TIMES[1])] * 2)
    write.replace_shards(spark, [source], pair[0], ["20260411"])
    with pytest.raises(Exception, match="merge key"):
        sync(spark, pair, keys=["id"], modified="modified")
    assert content(spark, pair[1], "shard", "id", "v") == before
    sync(spark, pair, "incremental", keys=["id"], modified="modified", on_duplicate="latest", order_by=["modified"])
    assert set(os.listdir(shared)) == scratch
    assert not [n for n in os.listdir(pair[1]) if n.startswith("_staged")]


def test_replicated_days_have_exactly_the_columns_of_the_source(spark, pair):
    source, target = pair
    drifted = days(spark, [("20260410", 1, TIMES[0], "x")], "shard string, id long, modified string, extra string")
    write.replace_shards(spark, [drifted], source, ["20260410"])
    done = sync(spark, pair, "replicate", modified="modified")
    assert {d: a for d, (a, _) in done.items()} == {
        "20260412": "sync_done", "20260411": "data_change", "20260410": "schema_change", "20260409": "sync_done",
    }
    for day in ("20260412", "20260411", "20260410", "20260409"):
        assert shard_schemas(spark, target, [day]) == shard_schemas(spark, source, [day])
    again = sync(spark, pair, "replicate", modified="modified")
    assert {d: a for d, (a, _) in again.items() if d != "20260412"} == dict.fromkeys(
        ["20260411", "20260410", "20260409"], "skipped"
    )


def test_only_the_days_asked_for_are_listed(spark, pair):
    some = read_day_table(spark, pair[0], days(spark, SOURCE).schema, ["20260411", "20260410"])
    assert {f.split("shard=")[1][:8] for f in some.inputFiles()} == {"20260411", "20260410"}
    assert {r["shard"] for r in some.collect()} == {"20260411", "20260410"}
    assert [r["shard"] for r in file_profile(spark, pair[0], ["20260411"]).collect()] == ["20260411"]
    assert read_day_table(spark, pair[0], days(spark, SOURCE).schema, []).count() == 0


def test_event_key_is_complete_or_an_error(spark, tmp_path):
    """Rows that differ in their time only are different rows."""
    schema = "shard string, event_time string, event_name string, value string, modified timestamp_ntz"
    source, target = str(tmp_path / "source"), str(tmp_path / "target")
    own = [("20260412", "08:00", "click", "X1", TIMES[0]), ("20260412", "08:05", "click", "X2", TIMES[0])]
    write.write_day_table(days(spark, own, schema), target)
    new = [("20260412", "08:00", "click", "A", TIMES[1]), ("20260412", "09:00", "click", "B", TIMES[1]),
           ("20260412", "09:00", "click", "C", TIMES[0])]
    write.write_day_table(days(spark, new, schema), source)
    sync(spark, (source, target), "modified", modified="modified", on_duplicate="latest")
    assert content(spark, target, "event_time", "value") == [("08:00", "A"), ("08:05", "X2"), ("09:00", "B")]
    partial = str(tmp_path / "partial")
    write.write_day_table(days(spark, [r[:1] + r[2:] for r in new], schema.replace(" event_time string,", "")), partial)
    with pytest.raises(ValueError, match="no key columns.*event_timestamp"):
        sync(spark, (partial, target), "modified", modified="modified")


def test_latest_is_by_the_modified_column(spark, tmp_path):
    source, target = str(tmp_path / "source"), str(tmp_path / "target")
    write.write_day_table(days(spark, [("20260411", 1, "t", "2026-04-01 00:00:00")]), target)
    write.write_day_table(days(spark, [("20260411", 1, "z", TIMES[0]), ("20260411", 1, "a", TIMES[1])]), source)
    sync(spark, (source, target), modified="modified", on_duplicate="latest")
    assert content(spark, target, "id", "v") == [(1, "a")]
    with pytest.raises(ValueError, match="order_by"):
        sync(spark, (source, target), "rowcount", on_duplicate="latest", keys=["id"])


@pytest.mark.parametrize("other_days", [False, True])
def test_first_incremental_sync_with_an_id(spark, pair, tmp_path, other_days):
    target = str(tmp_path / "fresh")
    aged = [("20260301", 7, "aged", TIMES[0])]
    if other_days:
        write.write_day_table(days(spark, aged), target)
    sync(spark, (pair[0], target), "incremental", modified="modified")
    expected = [(d, i, v) for d, i, v, _ in SOURCE + (aged if other_days else [])]
    assert content(spark, target, "shard", "id", "v") == sorted(expected)


@pytest.mark.parametrize("side", [0, 1])
def test_empty_day_folder_is_an_absent_day(spark, pair, side):
    os.makedirs(f"{pair[side]}/shard=20260409", exist_ok=True)
    for name in os.listdir(f"{pair[side]}/shard=20260409"):
        os.unlink(f"{pair[side]}/shard=20260409/{name}")
    open(f"{pair[side]}/shard=20260409/_SUCCESS", "w").close()
    done = sync(spark, pair, modified="modified")
    assert done["20260409"] == (("missing_source", None) if side == 0 else ("backfill_copy", 1))


def test_source_is_never_made(spark, pair, tmp_path):
    wrong = str(tmp_path / "mistyped")
    with pytest.raises(ValueError, match="no source table"):
        sync(spark, (wrong, pair[1]), modified="modified")
    assert not os.path.exists(wrong)


def test_late_row_below_the_newest_is_taken(spark, pair):
    source, target = pair
    write.append_rows(spark, days(spark, [("20260410", 5, "late", "2026-04-01 00:00:00")]), source, days(spark, SOURCE).schema)
    assert sync(spark, pair, modified="modified")["20260410"] == ("merge", 2)
    assert ("20260410", 5, "late") in content(spark, target, "shard", "id", "v")
    assert sync(spark, pair, modified="modified")["20260410"] == ("skipped", None)


def test_swap_dies_at_every_step(spark, path, monkeypatch):
    """Each day holds its old or its new rows after the next start, whatever call failed."""
    table = days(spark, [(d, 1, "a", TIMES[0]) for d in ("20260410", "20260411", "20260412")])
    write.write_day_table(table, path)
    old = content(spark, path, "shard", "v")
    for step in range(1, 9):
        calls = 0
        kept = {name: getattr(Folder, name) for name in ("touch", "drop", "move")}

        def failing(name, step=step, kept=kept):
            def call(*args):
                nonlocal calls
                calls += 1
                if calls == step:
                    raise OSError("killed")
                return kept[name](*args)

            return call

        for name in kept:
            monkeypatch.setattr(Folder, name, failing(name))
        fresh = days(spark, [(d, 1, f"n{step}", TIMES[1]) for d in ("20260411", "20260412")])
        try:
            write.replace_shards(spark, [fresh], path, ["20260410", "20260411", "20260412"])
        except OSError:
            pass
        monkeypatch.undo()
        write.finish_replace(spark, path)
        now = content(spark, path, "shard", "v")
        assert now in (old, [("20260411", f"n{step}"), ("20260412", f"n{step}")])
        assert not [n for n in os.listdir(path) if n.startswith("_staged")]
        write.replace_shards(spark, [table], path, ["20260410", "20260411", "20260412"])


def test_decimals_widen():
    def fits(a, b):
        return widens(T.DecimalType(*a) if isinstance(a, tuple) else a, T.DecimalType(*b))

    assert fits((10, 2), (12, 2)) and fits((10, 2), (12, 4)) and fits(T.IntegerType(), (20, 0)) and fits(T.LongType(), (19, 0))
    assert not fits((10, 2), (10, 3)) and not fits((12, 2), (10, 2)) and not fits(T.LongType(), (18, 0)) and not fits(T.DoubleType(), (38, 5))


def test_a_sync_that_reduces_duplicates_comes_to_rest(spark, tmp_path):
    """The source always has more rows than the target then."""
    source, target = str(tmp_path / "source"), str(tmp_path / "target")
    twice = [(d, 1, v, t) for d in ("20260411", "20260410") for v, t in (("a", TIMES[0]), ("b", TIMES[1]))]
    write.write_day_table(days(spark, twice), source)
    write.write_day_table(days(spark, [(d, 1, "old", "2026-04-01 00:00:00") for d in ("20260411", "20260410")]), target)
    first = sync(spark, (source, target), modified="modified", on_duplicate="latest")
    assert {d: a for d, (a, _) in first.items() if d in ("20260411", "20260410")} == dict.fromkeys(("20260411", "20260410"), "merge")
    for _ in range(2):
        again = sync(spark, (source, target), modified="modified", on_duplicate="latest")
        assert {a for a, _ in again.values()} == {"skipped", "missing_source"}
    # One more late row is seen, and after it there is rest again.
    write.append_rows(spark, days(spark, [("20260410", 2, "late", "2026-03-01 00:00:00")]), source, days(spark, SOURCE).schema)
    assert sync(spark, (source, target), modified="modified", on_duplicate="latest")["20260410"] == ("merge", 2)
    assert sync(spark, (source, target), modified="modified", on_duplicate="latest")["20260410"] == ("skipped", None)


def test_checksums_see_everything_and_rest(spark, pair):
    source, target = pair
    asked = {"modified": "modified", "checksums": True}
    sync(spark, pair, **asked)
    assert {a for a, _ in sync(spark, pair, **asked).values()} <= {"skipped", "missing_source"}
    old = read_day_table(spark, source).where("shard = '20260410'")
    changed = old.withColumn("v", F.lit("in place"))  # as many rows, as new
    write.replace_shards(spark, [changed], source, ["20260410"])
    done = sync(spark, pair, **asked)
    assert done["20260410"][0] == "merge" and {a for d, (a, _) in done.items() if d != "20260410"} <= {"skipped", "missing_source"}
    assert {v for d, v in content(spark, target, "shard", "v") if d == "20260410"} >= {"in place"}
    # Rows that someone else took from the target show too.
    write.replace_shards(spark, [read_day_table(spark, target).where("shard = '20260411'").limit(0)], target, ["20260411"])
    assert sync(spark, pair, **asked)["20260411"][0] == "backfill_copy"


def test_checksums_do_not_depend_on_order_or_parts(spark):
    rows = [("20260410", k % 7, f"v{k % 5}", {"a": k % 3, "b": None}) for k in range(50)]
    schema = "shard string, id long, v string, m map<string,int>"
    sums = lambda r, n: spark.createDataFrame(r, schema).repartition(n).groupBy("shard").agg(checksum(spark.createDataFrame(r, schema), ["id", "v", "m"]).alias("c")).first()["c"]
    assert sums(rows, 1) == sums(rows[::-1], 7)
    assert len({sums(rows, 2), sums(rows[1:], 2), sums(rows + rows[:1], 2), sums([*rows[1:], ("20260410", None, "v0", {})], 2)}) == 4
