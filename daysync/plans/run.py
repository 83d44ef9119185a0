"""One sync of a target table on disk: profile, plan, copy or merge, swap, report."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daysync.functions.columns import col
from daysync.functions.rows import checksum
from daysync.operators.dedupe import latest
from daysync.operators.merge import ID_COLUMN, UNIQUE, choose_keys, merge_staged, newer_than
from daysync.operators.schema import conform, empty_clone, evolve
from daysync.plans import state
from daysync.plans.apply import Decisions, merge_days
from daysync.plans.policies import plan_profiles, sync_plan
from daysync.session import shuffles_for, work_folder
from daysync.sinks import publish
from daysync.sinks.write import by_shard, finish_replace, replace_shards, stage
from daysync.sources.files import Folder
from daysync.sources.shards import (
    DEFAULT_LOOKBACK,
    SHARD,
    in_shards,
    lookback_shards,
    per_day,
    schema_text,
)
from daysync.sources.tables import merged_schema, read_day_table, read_day_tables, shard_schemas


class _Side:
    """The window of one table: its days' columns, its rows, its profile.

    Folders of other days are not even listed.
    """

    def __init__(self, spark: SparkSession, path: str, shards: list[str], modified: str | None):
        self.spark, self.path, self.shards, self.modified = spark, path, shards, modified
        self.folder = Folder(spark, path)
        present = self.folder.shards(set(shards))
        self.schemas = shard_schemas(spark, path, present)
        self.rows = read_day_table(spark, path, merged_schema(self.schemas.values()), present)

    def profile(self, checksums: bool = False) -> DataFrame:
        """Two columns are read for it at most, none if files tell what is newer; all for checksums."""
        if self.modified in self.rows.columns:
            newest = F.max(col(self.modified))
        elif self.modified or not self.schemas:
            newest = F.max(F.lit(None).cast("timestamp"))
        else:
            newest = F.max("_metadata.file_modification_time")
        days = in_shards(self.rows, self.shards).groupBy(SHARD).agg(
            F.count(F.lit(1)).alias("rows"), newest.alias("max_modified"),
            *([checksum(self.rows, [c for c in self.rows.columns if c != SHARD]).alias("checksum")] if checksums else []),
        )
        texts = {day: F.lit(schema_text(schema)) for day, schema in self.schemas.items()}
        return days.withColumn("fingerprint", per_day(texts, F.lit(None).cast("string")))

    def size(self, days: list[str]) -> int:
        return sum(self.folder.size(f"{SHARD}={day}") for day in days)

    def by_columns(self, days: list[str]) -> list[DataFrame]:
        """The rows of the given days, a frame for each set of columns; usually one."""
        alike: dict[str, list[str]] = {}
        for day in days:
            alike.setdefault(schema_text(self.schemas[day]), []).append(day)
        return [
            read_day_table(self.spark, self.path, self.schemas[group[0]], group)
            for group in alike.values()
        ]


def sync_table(
    spark: SparkSession,
    source_path: str,
    target_path: str,
    policy: str = "hybrid",
    *,
    logical_date: date | str,
    lookback: int = DEFAULT_LOOKBACK,
    keys: Sequence[str] | None = None,
    modified: str | None = None,
    present_only: bool = False,
    checksums: bool = False,
    **options,
) -> DataFrame:
    """Bring the target's days of the window up to date; returns the plan with ``written_rows``.

    Whether the source is newer is told by the ``modified`` column, or without one by the
    times of the files. Beyond that only days that change are read, and only they are
    written; a copied day gets the source's columns, a merged one those of both sides.
    With the column, a day of which the source has more rows counts as newer too, see ``late_rows`` of
    ``plan_profiles``, unless it is as it was when last synced, which is noted in the target's
    folder. With ``checksums`` all columns of the source's days are read, and a day is taken when
    anything of it differs from what was synced last. ``keys`` and ``options`` are those of ``merge.upsert``; without keys the
    columns of the source decide, see ``_keys``. The latest row of a key is by ``modified``
    unless ``order_by`` says else.

    The source has to be there and is never written to; a folder of a day without files is no
    day. The target is made if it is not there. One sync of a table may run at a time.
    """
    if policy == "incremental" and modified is None:
        raise ValueError("the incremental policy needs a modified column")
    if not Folder(spark, source_path).exists():
        raise ValueError(f"there is no source table at {source_path}")
    Folder(spark, target_path).make()
    finish_replace(spark, target_path)
    shards = lookback_shards(logical_date, lookback)
    source = _Side(spark, source_path, shards, modified)
    target = _Side(spark, target_path, shards, modified)
    if modified and source.schemas and modified not in source.rows.columns:
        raise ValueError(f"the source has no column {modified}")
    plan = plan_profiles(
        source.profile(checksums), target.profile(), policy, logical_date, lookback,
        late_rows=modified is not None, state=state.read(spark, target_path), checksums=checksums,
    )
    decisions = Decisions.of(plan)

    if keys is None and (policy == "incremental" or decisions.merged):
        keys = _keys(policy, source.rows.columns, present_only)
    if keys is not None:
        options.setdefault("within", [SHARD])
        if modified:
            options.setdefault("order_by", [modified])
    staged: list[Folder] = []
    try:
        with shuffles_for(spark, source.size(decisions.merged) + target.size(decisions.merged)):
            if policy == "incremental":
                days, frames = _incremental(source, target, decisions, keys, options, staged)
            else:
                days, frames = decisions.changed, source.by_columns(decisions.copied)
                if decisions.merged:
                    frames.append(_merged(source, target, decisions.merged, keys, options, staged))
            if days:
                replace_shards(spark, frames, target_path, days)
    finally:
        for folder in staged:
            folder.drop("")
    written = _written(spark, days, target_path)
    state.write(spark, target_path, decisions.states(written))
    return _report(spark, plan.schema, decisions, written)


def _keys(policy: str, columns: list[str], present_only: bool) -> list[str] | None:
    """The id, else a complete event key; incremental merges without an id compare whole rows.

    With ``present_only`` what there is of the event key will do.
    """
    if policy == "incremental":
        return [ID_COLUMN] if ID_COLUMN in columns else None
    return choose_keys(columns, present_only=present_only)


def _staged(df: DataFrame, staged: list[Folder]) -> tuple[DataFrame, Folder]:
    folder = Folder(df.sparkSession, work_folder(df.sparkSession))
    staged.append(folder)
    return stage(df, folder.path), folder


def _incremental(
    source: _Side, target: _Side, decisions: Decisions, keys: Sequence[str] | None, options: dict,
    staged: list[Folder],
) -> tuple[list[str], list[DataFrame]]:
    """The days that have newer rows, and those days with the rows merged in."""
    if not decisions.marks:
        return [], []
    newer, folder = _staged(newer_than(source.rows, source.modified, decisions.marks), staged)
    days = folder.shards()
    # Days that the target lacks start without rows, from the columns of the source.
    mine = in_shards(target.rows, days) if target.schemas else empty_clone(source.rows)
    merged = merge_staged(mine, newer, source.modified, keys, **options)
    return days, [by_shard(merged)]


def _merged(
    source: _Side, target: _Side, days: list[str], keys: Sequence[str], options: dict,
    staged: list[Folder],
) -> DataFrame:
    theirs = source.rows
    if options.get("on_duplicate") == "latest":
        by = list(dict.fromkeys([*options["within"], *keys]))
        if not options.get("order_by"):
            raise ValueError("the latest row of a key needs a modified column or order_by")
        survivors = latest(in_shards(theirs, days), by, options["order_by"])
        theirs, _ = _staged(survivors, staged)
        options["on_duplicate"] = UNIQUE
    return by_shard(merge_days(theirs, target.rows, days, keys, **options))


def _written(spark: SparkSession, days: list[str], target_path: str) -> dict[str, int]:
    """How many rows each written day now has, by the file footers."""
    if not days:
        return {}
    # The listing of the target may be older than the swap.
    now = read_day_table(spark, target_path, T.StructType(), Folder(spark, target_path).shards(set(days)))
    return dict.fromkeys(days, 0) | {r[SHARD]: r["count"] for r in now.groupBy(SHARD).count().collect()}


def _report(spark: SparkSession, schema: T.StructType, decisions: Decisions, written: dict[str, int]) -> DataFrame:
    """The fetched plan, and the rows of each day that was written."""
    shown = schema.names
    rows = [(*(r[c] for c in shown), written.get(r[SHARD])) for r in decisions.rows]
    out = T.StructType([*schema.fields, T.StructField("written_rows", T.LongType())])
    return spark.createDataFrame(rows, out)


def sync_day_tables(
    spark: SparkSession,
    source_prefix: str,
    target_prefix: str,
    policy: str = "hybrid",
    *,
    logical_date: date | str,
    lookback: int = DEFAULT_LOOKBACK,
    keys: Sequence[str] | None = None,
    modified: str,
    present_only: bool = False,
    checksums: bool = False,
    folder: str | None = None,
    **options,
) -> DataFrame:
    """``sync_table`` for catalog tables of one day each, such as ``db.events_20240130``.

    Returns the plan. A copied day becomes a table with the source's columns, a merged one
    has those of both sides. New rows are written once, where they stay: below ``folder``, or else
    where the database has its tables. When all are complete the tables are pointed at them, see
    ``sinks.publish``; a run that is lost on the way is finished by the next one.
    """
    root = _root(spark, target_prefix, folder)
    publish.finish(spark, root)
    shards = lookback_shards(logical_date, lookback)
    sides = [
        {s: spark.table(f"{prefix}_{s}") for s in shards if spark.catalog.tableExists(f"{prefix}_{s}")}
        for prefix in (source_prefix, target_prefix)
    ]
    if not sides[0]:
        raise ValueError(f"no table {source_prefix}_<day> for any of the days")
    source = read_day_tables(spark, source_prefix, sides[0])
    target = read_day_tables(spark, target_prefix, sides[1]) if sides[1] else empty_clone(source)
    schemas = [{s: df.schema for s, df in side.items()} for side in sides]
    plan = sync_plan(
        source, target, policy, logical_date, lookback, modified=modified, late_rows=True, schemas=schemas,
        state=state.read(spark, root), checksums=checksums,
    )
    decisions = Decisions.of(plan)
    if decisions.merged and keys is None:
        keys = _keys(policy, source.columns, present_only)
    if policy == "incremental":
        options["incremental_by"] = modified
    options.setdefault("order_by", [modified])
    run = publish.start(spark, root)
    written: dict[str, tuple[str, T.StructType]] = {}
    for day in decisions.copied:
        written[day] = f"{run}/{day}", sides[0][day].schema
        sides[0][day].write.parquet(written[day][0])
    written |= _write_merged(source, target, decisions.merged, keys, run, options)
    changes = [
        publish.Change(name, None, path, schema.json(), publish.location_of(spark, name))
        for day, (path, schema) in written.items()
        for name in [f"{target_prefix}_{day}"]
    ]
    publish.publish(spark, run, changes)
    state.write(spark, root, decisions.states({day: spark.read.parquet(path).count() for day, (path, _) in written.items()}))
    return spark.createDataFrame([tuple(r[c] for c in plan.columns) for r in decisions.rows], plan.schema)


def _root(spark: SparkSession, name: str, folder: str | None) -> str:
    database, _, table = name.rpartition(".")
    if folder is None:
        folder = spark.catalog.getDatabase(database or spark.catalog.currentDatabase()).locationUri
    return f"{folder.rstrip('/')}/_{table}-days"


def _write_merged(
    source: DataFrame, target: DataFrame, days: list[str], keys: Sequence[str] | None, run: str, options: dict
) -> dict[str, tuple[str, T.StructType]]:
    """The folder and the columns of each merged day, all days written by one job."""
    if not days:
        return {}
    merged = merge_days(source, target, days, keys, **options)
    rows = stage(merged, f"{run}/merged")
    schema = T.StructType([f for f in merged.schema.fields if f.name != SHARD])
    out = {day: (f"{run}/merged/{SHARD}={day}", schema) for day in days}
    for path, _ in out.values():
        if not Folder(source.sparkSession, path).exists():  # a day merged to no rows
            rows.limit(0).drop(SHARD).write.parquet(path)
    return out


def sync_partitions(
    spark: SparkSession,
    source_table: str,
    target_table: str,
    policy: str = "hybrid",
    *,
    logical_date: date | str,
    lookback: int = DEFAULT_LOOKBACK,
    keys: Sequence[str] | None = None,
    modified: str,
    present_only: bool = False,
    checksums: bool = False,
    folder: str | None = None,
    **options,
) -> DataFrame:
    """``sync_table`` for catalog tables partitioned by shard, whose partitions the catalog tracks.

    Returns the plan. New rows are written where they stay and the partitions pointed at them,
    as by ``sync_day_tables``. Columns only the source has are added to the table; those only the
    target has are NULL in copied days. The target is made if it is not there.
    """
    root = _root(spark, target_table, folder)
    publish.finish(spark, root)
    source = spark.table(source_table)
    if not spark.catalog.tableExists(target_table):
        Folder(spark, f"{root}/table").make()
        fields = [f for f in source.schema.fields if f.name != SHARD]
        spark.sql(
            f"CREATE TABLE {publish.quoted(target_table)} ({publish.ddl(fields)}, {SHARD} string) "
            f"USING parquet PARTITIONED BY ({SHARD}) LOCATION '{root}/table'"
        )
    target = spark.table(target_table)
    plan = sync_plan(
        source, target, policy, logical_date, lookback, modified=modified, late_rows=True,
        state=state.read(spark, root), checksums=checksums,
    )
    decisions = Decisions.of(plan)
    if decisions.merged and keys is None:
        keys = _keys(policy, source.columns, present_only)
    if policy == "incremental":
        options["incremental_by"] = modified
    options.setdefault("order_by", [modified])
    wide = evolve(target, source)
    publish.refuse_new_fields(spark, target_table, wide.schema)
    schema = T.StructType([f for f in wide.schema.fields if f.name != SHARD])
    run = publish.start(spark, root)
    written: dict[str, str | None] = {}
    if decisions.copied:
        # Days of the source are read as they lie, without a shuffle.
        conform(in_shards(source, decisions.copied), wide).write.partitionBy(SHARD).parquet(f"{run}/copied")
        written |= {day: f"{run}/copied/{SHARD}={day}" for day in decisions.copied}
    merged = _write_merged(source, target, decisions.merged, keys, run, options)
    written |= {day: path for day, (path, _) in merged.items()}
    changes = [
        publish.Change(target_table, day, path, schema.json(), publish.location_of(spark, target_table, day))
        for day, path in written.items()
    ]
    publish.publish(spark, run, changes)
    state.write(spark, root, decisions.states({day: spark.read.parquet(path).count() for day, path in written.items()}))
    return spark.createDataFrame([tuple(r[c] for c in plan.columns) for r in decisions.rows], plan.schema)
