"""Columns within columns: how they differ, how they are widened, and syncs that meet them."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daysync.functions.shapes import alike, changes, fits, reshaped, united
from daysync.operators.append import append_by_name
from daysync.operators.merge import insert_new_rows, upsert
from daysync.plans.run import sync_partitions, sync_table
from daysync.sinks.publish import ddl
from daysync.sinks.write import write_day_table
from daysync.sources.tables import merged_schema, read_day_table


pytestmark = pytest.mark.usefixtures("spark")  # types are parsed by it


def kind(text: str) -> T.DataType:
    return T.DataType.fromDDL(text)


OLD = "struct<a:int,b:array<struct<x:int>>,m:map<string,struct<k:string>>>"
NEW = "struct<c:string,m:map<string,struct<k:string,l:int>>,b:array<struct<x:int,y:struct<z:date>>>,a:int>"


def test_changes_by_path():
    assert changes(kind(NEW), kind(OLD)) == [
        ("c", "string", None, "added"),
        ("m.value.l", "int", None, "added"),
        ("b.element.y", "struct<z:date>", None, "added"),
    ]
    assert [c[0] for c in changes(kind(OLD), kind(NEW))] == ["b.element.y", "m.value.l", "c"]
    assert changes(kind("struct<a:struct<x:int>>"), kind("struct<a:string>")) == [("a", "struct<x:int>", "string", "type_changed")]
    assert changes(kind("struct<`a.b`:struct<`c d`:int>>"), kind("struct<`a.b`:struct<e:int>>"))[0][0] == "`a.b`.`c d`"
    assert changes(kind("map<int,int>"), kind("map<bigint,int>")) == [("key", "int", "bigint", "type_changed")]
    assert changes(kind(OLD), kind(OLD)) == []


def test_united_shapes():
    wide = united(kind(OLD), kind(NEW))
    assert wide.simpleString() == "struct<a:int,b:array<struct<x:int,y:struct<z:date>>>,m:map<string,struct<k:string,l:int>>,c:string>"
    assert fits(kind(OLD), wide) and fits(kind(NEW), wide) and not fits(kind(NEW), kind(OLD))
    assert united(kind("struct<a:int>"), kind("struct<a:bigint>")) == kind("struct<a:int>")
    assert united(kind("struct<a:int>"), kind("struct<a:bigint>"), widen=True) == kind("struct<a:bigint>")
    with pytest.raises(ValueError, match="do not fit"):
        united(kind("array<int>"), kind("array<string>"), widen=True)
    with pytest.raises(ValueError, match="case"):
        united(kind("struct<a:int>"), kind("struct<A:int>"))
    assert alike(T.ArrayType(T.LongType(), False), T.ArrayType(T.LongType(), True))
    assert not alike(kind("struct<a:int,b:int>"), kind("struct<b:int,a:int>"))


def test_reshaped_values_keep_nulls(spark):
    have, want = kind(OLD), united(kind(OLD), kind(NEW))
    rows = [(1, (1, [(1,), None], {"p": ("q",), "n": None})), (2, None), (3, (None, None, {})), (4, (None, [], None))]
    df = spark.createDataFrame(rows, T.StructType([T.StructField("id", T.IntegerType()), T.StructField("v", have)]))
    got = {r["id"]: r["v"] for r in df.select("id", reshaped(F.col("v"), have, want).alias("v")).collect()}
    assert got[1].asDict(True) == {
        "a": 1, "b": [{"x": 1, "y": None}, None], "m": {"p": {"k": "q", "l": None}, "n": None}, "c": None,
    }
    assert got[2] is None
    assert got[3].asDict(True) == {"a": None, "b": None, "m": {}, "c": None}
    assert got[4].asDict(True) == {"a": None, "b": [], "m": None, "c": None}


def test_wider_map_keys(spark):
    df = spark.createDataFrame([({1: 2},)], "m map<int,int>")
    out = df.select(reshaped(F.col("m"), kind("map<int,int>"), kind("map<bigint,double>")).alias("m"))
    assert out.schema["m"].dataType.simpleString() == "map<bigint,double>" and out.first()["m"] == {1: 2.0}


def test_a_struct_that_gained_a_field_merges(spark):
    target = spark.createDataFrame([(1, (1, [])), (2, (2, [(1,)]))], "id int, v struct<a:bigint,l:array<struct<x:int>>>")
    source = spark.createDataFrame([(2, ([(5, "n")], "s", 9)), (3, None)], "id int, v struct<l:array<struct<x:int,y:string>>,s:string,a:int>")
    merged = upsert(target, source, ["id"])
    assert merged.schema["v"].dataType.simpleString() == "struct<a:bigint,l:array<struct<x:int,y:string>>,s:string>"
    assert sorted(map(str, merged.collect())) == [
        "Row(id=1, v=Row(a=1, l=[], s=None))",
        "Row(id=2, v=Row(a=9, l=[Row(x=5, y='n')], s='s'))",
        "Row(id=3, v=None)",
    ]
    # Rows are alike whatever the order and types of their fields; of a third one, l differs.
    other = source.limit(0).unionByName(spark.createDataFrame([(2, ([(5, "m")], "s", 9))], source.schema))
    assert insert_new_rows(merged, source.unionByName(other)).count() == 3 + 1
    with pytest.raises(ValueError, match="does not fit"):
        append_by_name(target, source)
    with pytest.raises(ValueError, match="does not fit"):
        upsert(target, spark.createDataFrame([(1, ("x",))], "id int, v struct<a:string>"), ["id"])


def test_days_of_different_shapes_are_read_as_one():
    days = [kind("struct<v:struct<a:int>>"), kind("struct<v:struct<a:bigint,b:string>>")]
    assert merged_schema(days).simpleString() == "struct<v:struct<a:bigint,b:string>>"
    with pytest.raises(ValueError, match="in one day"):
        merged_schema([kind("struct<v:struct<a:int>>"), kind("struct<v:struct<a:string>>")])


DAYS = {"logical_date": "2026-04-11", "lookback": 2}


def _nested_days(spark):
    target = spark.createDataFrame(
        [("20260410", 1, (1,)), ("20260410", 2, (2,)), ("20260409", 3, (3,))], "shard string, id int, v struct<a:int>"
    ).withColumn("modified", F.lit("2026-04-09").cast("timestamp"))
    source = spark.createDataFrame(
        [("20260410", 2, (5, "x")), ("20260409", 4, (4, "y"))], "shard string, id int, v struct<a:int,b:string>"
    ).withColumn("modified", F.lit("2026-04-10").cast("timestamp"))
    return source, target


def test_sync_of_files_with_a_new_field(spark, tmp_path):
    paths = [str(tmp_path / side) for side in ("source", "target")]
    for df, path in zip(_nested_days(spark), paths, strict=True):
        write_day_table(df, path)
    sync_table(spark, *paths, "modified", keys=["id"], modified="modified", **DAYS)
    merged = read_day_table(spark, paths[1]).select("id", "v.a", "v.b").collect()
    assert sorted(map(tuple, merged)) == [(1, 1, None), (2, 5, "x"), (3, 3, None), (4, 4, "y")]


def test_partitioned_table_refuses_a_new_field_before_anything_is_written(spark, tmp_path):
    for df, side in zip(_nested_days(spark), ("ns_source", "ns_target"), strict=True):
        write_day_table(df, str(tmp_path / side))
        fields = [f for f in df.schema.fields if f.name != "shard"]
        spark.sql(f"CREATE TABLE {side} ({ddl(fields)}, shard string) USING parquet PARTITIONED BY (shard) LOCATION '{tmp_path / side}'")
        spark.catalog.recoverPartitions(side)
    try:
        with pytest.raises(ValueError, match="v.b"):
            sync_partitions(spark, "ns_source", "ns_target", "modified", keys=["id"], modified="modified", folder=str(tmp_path / "f"), **DAYS)
        assert spark.table("ns_target").count() == 3
        left = [p for p in tmp_path.joinpath("f").rglob("*.parquet")]
        assert not left
    finally:
        spark.sql("DROP TABLE ns_source")
        spark.sql("DROP TABLE ns_target")
