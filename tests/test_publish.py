"""Catalog tables pointed at new files: nothing is lost, whatever step fails."""

import os

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from daysync.plans.run import sync_day_tables, sync_partitions
from daysync.sinks import publish
from daysync.sources.files import Folder

T0, T1 = "2026-04-11 09:00:00", "2026-04-11 10:00:00"
SCHEMA = "id long, v string, modified timestamp_ntz"
WINDOW = {"logical_date": "2026-04-13", "lookback": 4, "modified": "modified"}
#: By day: rows of the source and of the target; 12 is replaced, 11 merged, 10 alike, 09 filled.
SOURCE = {"20260412": [(1, "new", T1)], "20260411": [(1, "new", T1), (2, "new", T1)], "20260410": [(1, "old", T0)], "20260409": [(1, "new", T1)]}
TARGET = {"20260412": [(1, "old", T0), (9, "mine", T0)], "20260411": [(1, "old", T0), (9, "mine", T0)], "20260410": [(1, "old", T0)]}
AFTER = {
    "20260412": [(1, "new")], "20260411": [(1, "new"), (2, "new"), (9, "mine")], "20260410": [(1, "old")], "20260409": [(1, "new")],
}
BEFORE = {day: [r[:2] for r in rows] for day, rows in TARGET.items()}


def rows_of(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema.replace("timestamp_ntz", "string")).withColumn("modified", F.col("modified").cast("timestamp_ntz"))


def day_tables(spark, prefix, days, folder, schema=SCHEMA):
    for day in ("20260409", "20260410", "20260411", "20260412"):
        spark.sql(f"DROP TABLE IF EXISTS {prefix}_{day}")
    for day, rows in days.items():
        rows_of(spark, rows, schema).write.option("path", f"{folder}/{prefix}_{day}").saveAsTable(f"{prefix}_{day}")


def day_content(spark, prefix):
    out = {}
    for day in ("20260409", "20260410", "20260411", "20260412"):
        if spark.catalog.tableExists(f"{prefix}_{day}"):
            out[day] = sorted(tuple(r) for r in spark.table(f"{prefix}_{day}").select("id", "v").collect())
    return out


def partitioned(spark, name, days, folder):
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} (id bigint, v string, modified timestamp_ntz, shard string) USING parquet PARTITIONED BY (shard) LOCATION '{folder}'")
    for day, rows in days.items():
        rows_of(spark, rows).withColumn("shard", F.lit(day)).write.mode("append").insertInto(name)


def content(spark, name):
    out = {}
    for r in spark.table(name).collect():
        out.setdefault(r["shard"], []).append((r["id"], r["v"]))
    return {day: sorted(rows) for day, rows in out.items()}


class Killed(Exception):
    pass


def kill_at(monkeypatch, step):
    """The ``step``-th change of a file or of the catalog does not happen any more."""
    calls = 0

    def guarded(call, counts):
        def run(*args, **options):
            nonlocal calls
            if counts(args):
                calls += 1
                if calls >= step:
                    raise Killed
            return call(*args, **options)

        return run

    for name in ("touch", "drop", "move", "make"):
        monkeypatch.setattr(Folder, name, guarded(getattr(Folder, name), lambda _: True))
    changing = lambda a: a[1].split()[0] in ("ALTER", "CREATE", "DROP")
    monkeypatch.setattr(SparkSession, "sql", guarded(SparkSession.sql, changing))


def test_day_tables_with_a_failing_write_keep_all_rows(spark, tmp_path, monkeypatch):
    day_tables(spark, "failing_s", SOURCE, tmp_path)
    day_tables(spark, "failing_t", TARGET, tmp_path)
    blocked = tmp_path / "file"
    blocked.write_text("no folder can be made below a file")
    with pytest.raises(Exception):  # noqa: B017
        sync_day_tables(spark, "failing_s", "failing_t", keys=["id"], folder=str(blocked), **WINDOW)
    assert day_content(spark, "failing_t") == BEFORE
    sync_day_tables(spark, "failing_s", "failing_t", keys=["id"], folder=str(tmp_path), **WINDOW)
    assert day_content(spark, "failing_t") == AFTER


def test_day_tables_killed_at_every_step(spark, tmp_path, monkeypatch):
    day_tables(spark, "killed_s", SOURCE, tmp_path)
    step, done = 0, False
    while not done:
        step += 1
        day_tables(spark, "killed_t", TARGET, f"{tmp_path}/target{step}")
        folder = str(tmp_path / str(step))
        with monkeypatch.context() as patch:
            kill_at(patch, step)
            try:
                sync_day_tables(spark, "killed_s", "killed_t", keys=["id"], folder=folder, **WINDOW)
                done = True
            except Killed:
                pass
        now = day_content(spark, "killed_t")
        for day in AFTER:
            assert now.get(day) in (BEFORE.get(day), AFTER[day]), (step, day)
        publish.finish(spark, f"{folder}/_killed_t-days")
        assert day_content(spark, "killed_t") in (BEFORE, AFTER)
        if done or step % 6 == 0:
            sync_day_tables(spark, "killed_s", "killed_t", keys=["id"], folder=folder, **WINDOW)
            assert day_content(spark, "killed_t") == AFTER
    assert step > 8


def test_partitions_killed_at_every_step(spark, tmp_path, monkeypatch):
    partitioned(spark, "parts_s", SOURCE, f"{tmp_path}/source")
    step, done = 0, False
    while not done:
        step += 1
        partitioned(spark, "parts_t", TARGET, f"{tmp_path}/target{step}")
        folder = str(tmp_path / str(step))
        with monkeypatch.context() as patch:
            kill_at(patch, step)
            try:
                sync_partitions(spark, "parts_s", "parts_t", keys=["id"], folder=folder, **WINDOW)
                done = True
            except Killed:
                pass
        now = content(spark, "parts_t")
        for day in AFTER:
            assert now.get(day) in (BEFORE.get(day), AFTER[day]), (step, day)
        publish.finish(spark, f"{folder}/_parts_t-days")
        assert content(spark, "parts_t") in (BEFORE, AFTER)
        if done or step % 6 == 0:
            sync_partitions(spark, "parts_s", "parts_t", keys=["id"], folder=folder, **WINDOW)
            assert content(spark, "parts_t") == AFTER
    assert step > 8


def test_a_reader_from_before_the_change_still_reads(spark, tmp_path):
    partitioned(spark, "read_s", SOURCE, f"{tmp_path}/source")
    partitioned(spark, "read_t", TARGET, f"{tmp_path}/target")
    files = spark.table("read_t").inputFiles()
    before = spark.read.parquet(*files)
    sync_partitions(spark, "read_s", "read_t", keys=["id"], folder=str(tmp_path / "new"), **WINDOW)
    assert before.count() == sum(map(len, TARGET.values()))
    sync_partitions(spark, "read_s", "read_t", "rowcount", keys=["id"], folder=str(tmp_path / "new"), **WINDOW)
    assert content(spark, "read_t") == AFTER
    assert not any(os.path.exists(f.removeprefix("file://")) for f in files if "20260411" in f or "20260412" in f)
    # The note of what was synced stays there too.
    left = [n for n in os.listdir(tmp_path / "new" / "_read_t-days") if n.startswith("_") and n != "_daysync_state"]
    assert len(left) <= 1 and all(n.startswith("_old-") for n in left)


def test_a_target_that_is_not_there_is_made(spark, tmp_path):
    partitioned(spark, "first_s", SOURCE, f"{tmp_path}/source")
    spark.sql("DROP TABLE IF EXISTS first_t")
    done = sync_partitions(spark, "first_s", "first_t", keys=["id"], folder=str(tmp_path), **WINDOW)
    assert {r["shard"]: r["action"] for r in done.collect()}["20260409"] == "backfill_copy"
    assert content(spark, "first_t") == {day: sorted(r[:2] for r in rows) for day, rows in SOURCE.items()}


def test_columns_are_added_without_touching_files(spark, tmp_path):
    partitioned(spark, "wide_t", TARGET, f"{tmp_path}/target")
    files = {f: os.stat(f.removeprefix("file://")).st_mtime_ns for f in spark.table("wide_t").inputFiles()}
    wide = rows_of(spark, [(1, "x", T0, "e")], SCHEMA + ", `new col` string")
    assert publish.add_columns(spark, "wide_t", wide.schema) == ["new col"]
    assert publish.add_columns(spark, "wide_t", wide.schema) == []
    assert spark.table("wide_t").columns == ["id", "v", "modified", "new col", "shard"]
    assert {f: os.stat(f.removeprefix("file://")).st_mtime_ns for f in spark.table("wide_t").inputFiles()} == files
    assert content(spark, "wide_t") == BEFORE


def test_a_replaced_day_table_loses_columns(spark, tmp_path):
    day_tables(spark, "lose_s", SOURCE, tmp_path)
    day_tables(spark, "lose_t", {"20260412": [(1, "old", T0, "e")]}, tmp_path, SCHEMA + ", extra string")
    sync_day_tables(spark, "lose_s", "lose_t", keys=["id"], folder=str(tmp_path), **WINDOW)
    assert spark.table("lose_t_20260412").columns == ["id", "v", "modified"]
    assert day_content(spark, "lose_t")["20260412"] == [(1, "new")]
