
from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from daysync import snapshots as snap  # noqa: E402
from daysync.functions.columns import (  # noqa: E402
    col,
    event_label,
    row_text,
    shard_name,
    shift_days,
    shift_minutes,
)
from daysync.functions.generate import generate_events  # noqa: E402
from daysync.operators.append import append_by_name, union_all  # noqa: E402
from daysync.operators.dedupe import latest  # noqa: E402
from daysync.operators.joins import merge_on  # noqa: E402
from daysync.operators.merge import (  # noqa: E402
    choose_keys,
    high_water,
    incremental,
    insert_new_rows,
    merge_incremental,
    upsert,
)
from daysync.operators.schema import drift, empty_clone, nested_drift, schema_rows  # noqa: E402
from daysync.operators.update import update_all, update_first  # noqa: E402
from daysync.plans import report, state  # noqa: E402
from daysync.plans.apply import apply_plan, backfill, replace_days  # noqa: E402
from daysync.plans.bucketed import merge_into_bucketed, write_bucketed  # noqa: E402
from daysync.plans.policies import plan_profiles, sync_plan  # noqa: E402
from daysync.plans.run import sync_day_tables, sync_partitions, sync_table  # noqa: E402
from daysync.session import work_folder  # noqa: E402
from daysync.sinks.publish import add_columns, days_of, ddl, location_of  # noqa: E402
from daysync.sinks.write import export_parquet, write_day_table  # noqa: E402
from daysync.sources.files import Folder  # noqa: E402
from daysync.sources.shards import (  # noqa: E402
    SHARD,
    in_shards,
    lookback,
    lookback_shards,
    missing_shards,
    profile,
    with_shard,
)
from daysync.sources.tables import file_profile, read_day_table  # noqa: E402

import oracle  # noqa: E402

try:  # the corpus operators and their pipeline are a part that can be left out
    import corpus_pipeline
    from daysync.llm import queries as corpus
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "daysync.llm", "public_tokenizers", "tiktoken", "regex"):
        raise
    corpus = None

SMOKE = "/root/testdata/sf0.001"
ID = {"keys": ["event_id"], "within": ["shard"]}
EVENT = ["user_id", "ts", "event_type"]
SESSION = ["user_id", "event_type"]
BUCKETS = 16
WINDOW = {"logical_date": snap.LOGICAL_DATE, "lookback": snap.LOOKBACK}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events")


def _sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    events = _events(spark, sf_dir)
    return snap.source_events(events), snap.target_events(events)


def _nested(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Both sides with columns in columns; the source's have fields, at three depths, the target's lack."""
    source, target = _sides(spark, sf_dir)
    sides = []
    for df, newer in ((source, True), (target, False)):
        value, kind = [F.col("value")] if newer else [], [F.col("event_type").alias("kind")]
        user = F.col("user_id") if newer else F.col("user_id").cast("string")
        about = F.struct("user_id", F.struct(*kind, *value).alias("what"), *([F.col("props")] if newer else []))
        steps = F.array(F.struct(F.lit(1).cast("bigint" if not newer else "int").alias("n"), *value))
        facts = F.create_map(F.col("event_type"), F.struct(user.cast("string").alias("who"), *value))
        sides.append(df.select("event_id", SHARD, about.alias("about"), steps.alias("steps"), facts.alias("facts")))
    return sides[0], sides[1]


def _all_days() -> list[str]:
    return lookback_shards(snap.LOGICAL_DATE, snap.ALL_DAYS)


# Scans


def shard_scan(spark, d):
    return in_shards(with_shard(_events(spark, d), "ts"), ["20240130"], "ts")


def lookback_scan(spark, d):
    return lookback(with_shard(_events(spark, d), "ts"), snap.LOGICAL_DATE, snap.LOOKBACK, "ts")


def shard_names(spark, d):
    return _events(spark, d).select("event_id", shard_name("events", col("ts")).alias("table_name"))


def source_gaps(spark, d):
    return missing_shards(_sides(spark, d)[0], snap.LOGICAL_DATE, snap.LOOKBACK, "ts")


def equi_join(spark, d):
    orders = _table(spark, d, "orders").withColumnsRenamed({"o_orderkey": "common_id", "o_totalprice": "price"})
    lines = _table(spark, d, "lineitem").withColumnsRenamed({"l_orderkey": "common_id", "l_extendedprice": "price"})
    return merge_on(orders, lines, "common_id")


# Profiles and schemas


def shard_counts(spark, d):
    return profile(_sides(spark, d)[0], "modified").select(SHARD, "rows")


def shard_high_water(spark, d):
    return high_water(_sides(spark, d)[1], "modified", _all_days())


def schema_fingerprint(spark, d):
    source, target = _sides(spark, d)
    sides = (("source", source, {}), ("target", target, snap.declared(target)))
    return union_all(
        *[
            profile(df, "modified", with_schema=True, schemas=schemas).select(
                F.lit(side).alias("side"), SHARD, "fingerprint"
            )
            for side, df, schemas in sides
        ]
    )


def schema_drift(spark, d):
    source, target = _sides(spark, d)
    return drift(source, target, target_schemas=snap.declared(target))


def schema_listing(spark, d):
    source, target = _sides(spark, d)
    return schema_rows(source, "source").unionByName(schema_rows(target, "target", snap.declared(target)))


def nested_schema_drift(spark, d):
    source, target = _nested(spark, d)
    older = target.withColumn("about", F.struct("about.user_id")).schema
    return nested_drift(source, target, target_schemas={snap.DRIFTED: older})


# Plans and reports


def _plan(policy: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark, d):
        source, target = _sides(spark, d)
        schemas = ({}, snap.declared(target))
        return sync_plan(source, target, policy, time_column="ts", schemas=schemas, **WINDOW)

    return query


def _reported(make: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, d: make(_plan("hybrid")(spark, d))


# Rows of the merged table


def dedupe_latest(spark, d):
    return latest(_sides(spark, d)[0], [SHARD, *SESSION], ["ts", "event_id"])


def merge_by_id(spark, d):
    source, target = _sides(spark, d)
    return upsert(target, source, **ID)


def merge_composite(spark, d):
    source, target = _sides(spark, d)
    return upsert(target, source, choose_keys(source.columns, composite=EVENT), within=[SHARD])


def merge_partial_key(spark, d):
    source, target = _sides(spark, d)
    keys = choose_keys(source.columns, composite=[*EVENT, "device"], present_only=True)
    return upsert(target, source, keys, within=[SHARD])


def merge_keep_modified(spark, d):
    source, target = _sides(spark, d)
    return upsert(target, source, **ID, update_columns=["ts", "user_id", "event_type", "value", "props"])


def merge_dedup(spark, d):
    source, target = _sides(spark, d)
    return upsert(
        target, source, SESSION, within=[SHARD], on_duplicate="latest", order_by=["ts", "event_id"]
    )


def merge_fingerprint(spark, d):
    source, target = _sides(spark, d)
    return insert_new_rows(target, source, ignore=["modified"])


def incremental_rows(spark, d):
    source, target = _sides(spark, d)
    return incremental(source, target, "modified", _all_days(), "ts")


def incremental_merge(spark, d):
    source, target = _sides(spark, d)
    return merge_incremental(
        target, source, "modified", _all_days(), keys=["event_id"], within=[SHARD], time_column="ts"
    )


def evolve_schema(spark, d):
    source, target = _sides(spark, d)
    target = target.drop("props").withColumn("loaded_from", F.concat(F.lit("events_"), SHARD))
    return upsert(target, source, **ID)


def nested_evolve(spark, d):
    """Fields in fields of arrays, maps and columns are added, and what is nested is returned in columns of its own."""
    source, target = _nested(spark, d)
    fact = F.get(F.map_values("facts"), 0)
    return upsert(target, source, **ID).select(
        "event_id", SHARD, F.col("about.user_id").alias("user_id"), F.col("about.what.kind").alias("kind"),
        F.col("about.what.value").alias("what_value"), F.col("about.props").alias("props"),
        F.get("steps", 0)["n"].alias("n"), F.get("steps", 0)["value"].alias("step_value"),
        fact["who"].alias("who"), fact["value"].alias("fact_value"),
    )


def empty_clone_merge(spark, d):
    source, _ = _sides(spark, d)
    return upsert(empty_clone(source), source, **ID)


def replace_shard(spark, d):
    return replace_days(*_sides(spark, d), ["20240130"], "ts")


def replace_narrows(spark, d):
    """A column that only the replaced day declares goes with it, one that another day has too stays."""
    source, target = _sides(spark, d)
    recent = F.col(SHARD) == "20240130"
    noted = target.withColumns({
        "batch": F.when(recent, F.concat(F.lit("b"), F.col("event_id").cast("string"))),
        "note": F.when(recent | (F.col(SHARD) == "20240129"), F.concat(F.lit("n"), F.col("event_id").cast("string"))),
    })
    schemas = {day: target.schema for day in _all_days()}
    schemas |= {"20240130": noted.schema, "20240129": noted.drop("batch").schema}
    plan = sync_plan(source, target, "d1_replace", time_column="ts", **WINDOW)
    return apply_plan(source, noted, plan, ["event_id"], time_column="ts", target_schemas=schemas)


def backfill_copy(spark, d):
    return backfill(*_sides(spark, d), snap.LOGICAL_DATE, snap.LOOKBACK, "ts")


def hybrid_result(spark, d):
    source, target = _sides(spark, d)
    plan = sync_plan(source, target, "hybrid", time_column="ts", **WINDOW)
    return apply_plan(source, target, plan, ["event_id"], time_column="ts")


def replicate_result(spark, d):
    source, target = _sides(spark, d)
    schemas = ({}, snap.declared(target))
    plan = sync_plan(source, target, "replicate", time_column="ts", schemas=schemas, **WINDOW)
    return apply_plan(source, target, plan, time_column="ts")


def incremental_result(spark, d):
    source, target = _sides(spark, d)
    plan = sync_plan(source, target, "incremental", time_column="ts", **WINDOW)
    return apply_plan(source, target, plan, ["event_id"], time_column="ts", incremental_by="modified")


# Written tables


def _synced(policy: str, result: Callable[[SparkSession, str, DataFrame], DataFrame], **options):
    def query(spark, d):
        folder = work_folder(spark)
        source, target = f"{folder}/source", f"{folder}/target"
        snap.write_tables(_events(spark, d), source, target)
        done = sync_table(spark, source, target, policy, modified="modified", **WINDOW, **options)
        return result(spark, target, done)

    return query


def incremental_first_sync(spark, d):
    """The target has no table yet."""
    folder = work_folder(spark)
    write_day_table(_sides(spark, d)[0], f"{folder}/source")
    sync_table(
        spark, f"{folder}/source", f"{folder}/target", "incremental", modified="modified", keys=["event_id"], **WINDOW
    )
    return read_day_table(spark, f"{folder}/target")


def _renamed_sync(names: dict[str, str], columns: list[str], policy: str, **options):
    """A sync of tables that have the key columns by their names."""

    def query(spark, d):
        folder = work_folder(spark)
        for side, df in zip(("source", "target"), _sides(spark, d), strict=True):
            if "event_time" in names.values():
                df = df.withColumn("ts", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
            write_day_table(df.withColumnsRenamed(names).select(*columns, SHARD), f"{folder}/{side}")
        sync_table(spark, f"{folder}/source", f"{folder}/target", policy, modified="modified", **WINDOW, **options)
        return read_day_table(spark, f"{folder}/target")

    return query


def _catalog_names(folder: str) -> dict[str, str]:
    return {side: f"{side}_{folder.rpartition('-')[2]}" for side in ("source", "target")}


def day_tables_sync(spark, d):
    """Tables of one day each; they are gone from the catalog afterwards, their files are read."""
    folder = work_folder(spark)
    names = _catalog_names(folder)
    window = lookback_shards(snap.LOGICAL_DATE, snap.LOOKBACK)
    for side, df in zip(names, _sides(spark, d), strict=True):
        write_day_table(in_shards(df, window, "ts"), f"{folder}/{side}")
        written = read_day_table(spark, f"{folder}/{side}", df.schema)
        for day in window:
            if Folder(spark, f"{folder}/{side}/{SHARD}={day}").exists():
                rows = written.where(F.col(SHARD) == day).drop(SHARD)
                rows = rows.drop("props") if (side, day) == ("target", snap.DRIFTED) else rows
                rows.write.option("path", f"{folder}/{names[side]}_{day}").saveAsTable(f"{names[side]}_{day}")
    sync_day_tables(
        spark, names["source"], names["target"], modified="modified", keys=["event_id"], folder=folder, **WINDOW
    )
    parts = []
    for day in window:
        if spark.catalog.tableExists(f"{names['target']}_{day}"):
            parts.append(spark.table(f"{names['target']}_{day}").withColumn(SHARD, F.lit(day)))
        for name in names.values():
            spark.sql(f"DROP TABLE IF EXISTS {name}_{day}")
    return union_all(*parts)


def partitions_sync(spark, d):
    """Catalog tables partitioned by day; the files of the target are read when it is gone from the catalog."""
    folder = work_folder(spark)
    names = _catalog_names(folder)
    for side, df in zip(names, _sides(spark, d), strict=True):
        write_day_table(df, f"{folder}/{side}")
        fields = [f for f in df.schema.fields if f.name != SHARD]
        spark.sql(
            f"CREATE TABLE {names[side]} ({ddl(fields)}, {SHARD} string) USING parquet "
            f"PARTITIONED BY ({SHARD}) LOCATION '{folder}/{side}'"
        )
        spark.catalog.recoverPartitions(names[side])
    sync_partitions(
        spark, names["source"], names["target"], modified="modified", keys=["event_id"], folder=folder, **WINDOW
    )
    result = spark.table(names["target"])
    parts = [
        spark.read.schema(result.drop(SHARD).schema).parquet(location_of(spark, names["target"], day)).withColumn(SHARD, F.lit(day))
        for day in days_of(spark, names["target"])
    ]
    for name in names.values():
        spark.sql(f"DROP TABLE {name}")
    return union_all(*parts)


def catalog_evolve(spark, d):
    """Day tables of the target get the columns only the source has, and no file of theirs changes."""
    folder = work_folder(spark)
    source, target = _sides(spark, d)
    write_day_table(target.drop("props"), f"{folder}/target")
    written = read_day_table(spark, f"{folder}/target", target.drop("props").schema)
    name = _catalog_names(folder)["target"]
    spark.sql(
        f"CREATE TABLE {name} ({ddl(written.drop(SHARD).schema.fields)}, {SHARD} string) USING parquet "
        f"PARTITIONED BY ({SHARD}) LOCATION '{folder}/target'"
    )
    spark.catalog.recoverPartitions(name)
    add_columns(spark, name, source.schema)
    evolved = spark.table(name).schema
    spark.sql(f"DROP TABLE {name}")
    return read_day_table(spark, f"{folder}/target", evolved)


def merge_bucketed(spark, d):
    """The target is bucketed by its key; it is gone from the catalog afterwards, its files are read."""
    folder = work_folder(spark)
    source, target = _sides(spark, d)
    name = _catalog_names(folder)["target"]
    write_bucketed(target, name, [SHARD, "event_id"], BUCKETS, f"{folder}/target")
    merge_into_bucketed(spark, name, source, folder=f"{folder}/new")
    merged, path = spark.table(name).schema, location_of(spark, name)
    spark.sql(f"DROP TABLE {name}")
    return spark.read.schema(merged).parquet(path)


def late_rows(spark, d):
    """Days whose newest rows are alike and of which the source has more are merged too."""
    source, target = _sides(spark, d)
    late = source.withColumn("modified", target_time(source))
    return sync_plan(late, target, "modified", time_column="ts", late_rows=True, **WINDOW)


def checksum_plan(spark, d):
    """The target's rows stand for what the source had when it was last synced."""
    source, target = _sides(spark, d)
    days = _all_days()
    before = profile(in_shards(target, days, "ts"), "modified", checksums=True)
    last = state.synced(before, before)
    plan = sync_plan(source, target, "hybrid", time_column="ts", state=last, checksums=True, **WINDOW)
    return plan.drop("source_checksum")


def file_times_plan(spark, d):
    """What is newer is told by the files, and those of the source are written last."""
    folder = work_folder(spark)
    source, target = _sides(spark, d)
    write_day_table(target, f"{folder}/target")
    write_day_table(source, f"{folder}/source")
    sides = []
    for side in ("source", "target"):
        rows = profile(read_day_table(spark, f"{folder}/{side}"), "modified").select(SHARD, "rows")
        times = file_profile(spark, f"{folder}/{side}").select(SHARD, "max_modified")
        sides.append(rows.join(times, SHARD))
    plan = plan_profiles(*sides, "hybrid", snap.LOGICAL_DATE, snap.LOOKBACK)
    return plan.select(SHARD, "offset", "source_rows", "target_rows", "action")


def target_time(source):
    return F.col("ts").cast(source.schema["modified"].dataType)


def _target_table(spark, target, _):
    return read_day_table(spark, target)


def _sync_report(spark, _, done):
    return done.select(SHARD, "action", "written_rows")


def export_projection(spark, d):
    path = f"{work_folder(spark)}/customer"
    customer = _table(spark, d, "customer").withColumnsRenamed({"c_custkey": "id", "c_name": "name"})
    export_parquet(customer, ["id", "name"], path)
    return spark.read.parquet(path)


# Appends, updates, expressions


def append_rows_by_name(spark, d):
    source, target = _sides(spark, d)
    return append_by_name(target, source.select("event_id", "event_type", "ts", SHARD))


def union_both(spark, d):
    return union_all(*_sides(spark, d))


def update_every_row(spark, d):
    extra = F.concat(F.lit("whole "), F.floor("value").cast("string"))
    return update_all(_sides(spark, d)[1], {"props": extra})


def update_by_subquery(spark, d):
    text = F.lit("first by id")
    return update_first(_sides(spark, d)[1], "event_id", 1, {"props": text})


def update_top_k(spark, d):
    extra = F.concat(F.lit("user "), F.col("user_id").cast("string"))
    return update_first(_sides(spark, d)[1], "event_id", 3, {"props": extra})


def update_first_ties(spark, d):
    """Many rows of the least users; three rows change."""
    extra = F.concat(F.lit("tied "), F.col("event_id").cast("string"))
    return update_first(_sides(spark, d)[1], "user_id", 3, {"props": extra}, then_by=["ts", "event_id"])


def generated_random(spark, d):
    """What is random of the events is not returned, but what holds of all of them is."""
    made = generate_events(_events(spark, d), 5, key="event_id", start="ts", random=True)
    labels = F.when(F.col("event_type") == event_label(F.col("event_type_id")), 1)
    return made.groupBy("description").agg(
        F.count("*").alias("rows"), F.count_distinct("id").alias("ids"),
        F.count_if(F.col("id").rlike("^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$")).alias("uuids"),
        F.count(labels).alias("labels"), F.min("event_type_id").alias("least_type"), F.max("event_type_id").alias("most_type"),
        F.count_if(F.col("last_modified").isNull()).alias("no_time"),
    )


def row_fingerprint(spark, d):
    return _sides(spark, d)[1].select(
        "event_id", row_text(["event_id", "user_id", "event_type", "props"]).alias("row_text")
    )


def case_label(spark, d):
    type_id = F.pmod("event_id", F.lit(5)).cast("bigint")
    return _events(spark, d).select(
        "event_id", type_id.alias("event_type_id"), event_label(type_id).alias("label")
    )


def timestamp_shift(spark, d):
    now = F.lit("2024-01-31 12:00:00").cast("timestamp_ntz")
    return _events(spark, d).select(
        "event_id",
        shift_days(col("ts"), -4).alias("four_days_before"),
        shift_minutes(col("ts"), F.pmod("event_id", F.lit(10))).alias("minutes_after"),
        shift_days(now, -10).alias("ten_days_ago"),
    )


def _generated(random: bool) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, d: generate_events(_events(spark, d), 5, key="event_id", start="ts", random=random)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    if corpus is None:
        return table_queries()
    return table_queries() | corpus.queries() | {"pipeline": corpus_pipeline.run}


def table_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "shard_scan": shard_scan,
        "lookback_scan": lookback_scan,
        "shard_name": shard_names,
        "missing_shards": source_gaps,
        "equi_join": equi_join,
        "shard_counts": shard_counts,
        "shard_high_water": shard_high_water,
        "schema_rows": schema_listing,
        "schema_fingerprint": schema_fingerprint,
        "schema_drift": schema_drift,
        "sync_plan_incremental": _plan("incremental"),
        "sync_plan_modified": _plan("modified"),
        "sync_plan_d1_replace": _plan("d1_replace"),
        "sync_plan_rowcount": _plan("rowcount"),
        "sync_plan_both": _plan("both"),
        "sync_plan_hybrid": _plan("hybrid"),
        "sync_plan_replicate": _plan("replicate"),
        "sync_plan_replicate_brief": _plan("replicate_brief"),
        "report_by_action": _reported(report.by_action),
        "report_buckets": _reported(report.by_bucket),
        "report_transfers": _reported(report.transfers),
        "report_ready": _reported(report.ready),
        "dedupe_latest": dedupe_latest,
        "merge_by_id": merge_by_id,
        "merge_composite": merge_composite,
        "merge_partial_key": merge_partial_key,
        "merge_keep_modified": merge_keep_modified,
        "merge_dedup": merge_dedup,
        "merge_fingerprint": merge_fingerprint,
        "incremental_rows": incremental_rows,
        "merge_incremental": incremental_merge,
        "evolve_schema": evolve_schema,
        "nested_drift": nested_schema_drift,
        "nested_evolve": nested_evolve,
        "merge_bucketed": merge_bucketed,
        "empty_clone": empty_clone_merge,
        "replace_shard": replace_shard,
        "replace_narrows": replace_narrows,
        "backfill_copy": backfill_copy,
        "hybrid_result": hybrid_result,
        "replicate_result": replicate_result,
        "incremental_result": incremental_result,
        "hybrid_sync_table": _synced("hybrid", _target_table, keys=["event_id"]),
        "replicate_sync_table": _synced("replicate", _target_table),
        "hybrid_sync_report": _synced("hybrid", _sync_report, keys=["event_id"]),
        "modified_sync_table": _synced("modified", _target_table, keys=["event_id"]),
        "d1_replace_sync_table": _synced("d1_replace", _target_table, keys=["event_id"]),
        "rowcount_sync_table": _synced("rowcount", _target_table, keys=["event_id"]),
        "both_sync_table": _synced("both", _target_table, keys=["event_id"]),
        "incremental_sync_table": _synced("incremental", _target_table, keys=["event_id"]),
        "incremental_first_sync": incremental_first_sync,
        "event_key_sync_table": _renamed_sync(
            {"ts": "event_time", "event_type": "event_name"}, ["event_time", "event_name", "value", "modified"],
            "hybrid", on_duplicate="latest",
        ),
        "composite_sync_table": _renamed_sync(
            {"user_id": "user_pseudo_id", "ts": "event_timestamp", "event_type": "event_name"},
            ["event_id", "user_pseudo_id", "event_timestamp", "event_name", "value", "modified"], "hybrid",
        ),
        "day_tables_sync": day_tables_sync,
        "partitions_sync": partitions_sync,
        "catalog_evolve": catalog_evolve,
        "late_rows": late_rows,
        "checksum_sync_plan": checksum_plan,
        "sync_plan_file_times": file_times_plan,
        "report_replicate": lambda spark, d: report.by_bucket(_plan("replicate")(spark, d), report.REPLICATE_BUCKETS),
        "export_projection": export_projection,
        "append_by_name": append_rows_by_name,
        "union_all": union_both,
        "update_all": update_every_row,
        "update_by_subquery": update_by_subquery,
        "update_top_k": update_top_k,
        "update_first_ties": update_first_ties,
        "row_fingerprint": row_fingerprint,
        "case_label": case_label,
        "timestamp_shift": timestamp_shift,
        "generate_events": _generated(False),
        "generate_events_random": _generated(True),
        "generate_events_facts": generated_random,
    }


def entry(spark: SparkSession) -> DataFrame:
    """Which of the last days are stale, and what to do with each."""
    return _plan("hybrid")(spark, SMOKE)


def oracle_sql() -> dict[str, str]:
    if corpus is None:
        return oracle.statements()
    sql = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return oracle.statements() | corpus.oracle_sql() | sql
