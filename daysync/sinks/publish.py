"""Days of catalog tables replaced by pointing at new files.

New files of a day are written where they stay, in a folder of the run. When all are complete
an intent is recorded, and only then does each table, or partition, of the catalog get its new
location. A driver lost before the intent leaves every table as it was; after it, the next start
goes on from the intent. Files that nothing points at any more go at the next start, so a
reader that began before the change still finds what it reads.

Pointing shows old or new rows at any moment. Columns that are new are added first, NULL in
old rows. Only where a table of a day loses a column, or has another type or order of columns
than before, is it dropped and made again; a driver lost between the two leaves it out until
the next start.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from daysync.functions.shapes import changes, fits
from daysync.sources.files import Folder
from daysync.sources.shards import SHARD

_WRITING, _INTENT, _OLD = "_writing-", "_intent-", "_old-"


@dataclass(frozen=True)
class Change:
    """A table, or with ``day`` a partition of it, and where its rows are from now on.

    Without ``location`` the partition goes. ``columns`` is the JSON of the new rows' schema, ``old``
    the location so far.
    """

    table: str
    day: str | None
    location: str | None
    columns: str
    old: str | None


def quoted(name: str) -> str:
    return ".".join(f"`{part.replace('`', '``')}`" for part in name.split("."))


def _text(value: str) -> str:
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def ddl(fields: Sequence[T.StructField]) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in fields)


def location_of(spark: SparkSession, table: str, day: str | None = None) -> str | None:
    """Where the catalog finds a table's files, or those of a partition; None if it has none."""
    if not spark.catalog.tableExists(table):
        return None
    part = "" if day is None else f" PARTITION ({SHARD}={_text(day)})"
    if day is not None and day not in days_of(spark, table):
        return None
    rows = spark.sql(f"DESCRIBE EXTENDED {quoted(table)}{part}").collect()
    return next(r["data_type"] for r in rows if r["col_name"] == "Location")


def days_of(spark: SparkSession, table: str) -> list[str]:
    """The days a table partitioned by shard has in the catalog."""
    return sorted(r[0].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {quoted(table)}").collect())


def start(spark: SparkSession, root: str) -> str:
    """A folder for the files of a run, in ``root``; ``finish`` removes it if no intent follows."""
    run = uuid.uuid4().hex
    folder = Folder(spark, root)
    folder.make()
    folder.touch(f"{_WRITING}{run}")
    return f"{folder.path}/{run}"


def publish(spark: SparkSession, run: str, changes: Sequence[Change]) -> None:
    """Points at the files of a run that are complete, with all its changes or, if lost, at the next ``finish``."""
    root, _, name = run.rpartition("/")
    folder = Folder(spark, root)
    folder.write_text(f"{_INTENT}{name}", json.dumps([asdict(c) for c in changes]))
    _go_on(spark, folder, name)


def finish(spark: SparkSession, root: str) -> None:
    """What earlier runs left: intents are carried out, unfinished files and replaced ones go."""
    folder = Folder(spark, root)
    for name in folder.names():
        if name.startswith(_INTENT):
            _go_on(spark, folder, name.removeprefix(_INTENT))
    for name in folder.names():
        if name.startswith(_WRITING):  # without an intent, or it would be gone
            folder.drop(name.removeprefix(_WRITING))
            folder.drop(name)
        elif name.startswith(_OLD):
            for change in _read(folder, name):
                if change.old != location_of(spark, change.table, change.day):
                    Folder(spark, change.old).drop("")
            folder.drop(name)


def _read(folder: Folder, name: str) -> list[Change]:
    return [Change(**c) for c in json.loads(folder.read_text(name))]


def _go_on(spark: SparkSession, folder: Folder, run: str) -> None:
    """Every step may be repeated: the intent goes only after all of them."""
    changes = _read(folder, f"{_INTENT}{run}")
    for change in changes:
        _point(spark, change)
    replaced = [c for c in changes if c.old and c.old != c.location]
    if replaced:
        folder.write_text(f"{_OLD}{run}", json.dumps([asdict(c) for c in replaced]))
    folder.drop(f"{_WRITING}{run}")
    folder.drop(f"{_INTENT}{run}")


def _point(spark: SparkSession, change: Change) -> None:
    new = T.StructType.fromJson(json.loads(change.columns))
    name = quoted(change.table)
    if change.day is not None:
        part = f"PARTITION ({SHARD}={_text(change.day)})"
        if change.location is None:
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {part}")
        else:
            add_columns(spark, change.table, new)
            spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {part} LOCATION {_text(change.location)}")
            spark.sql(f"ALTER TABLE {name} {part} SET LOCATION {_text(change.location)}")
    else:
        there = spark.catalog.tableExists(change.table)
        have = _shape(spark.table(change.table).schema) if there else []
        if there and _shape(new)[: len(have)] != have:
            spark.sql(f"DROP TABLE {name}")
            there = False
        if there:
            add_columns(spark, change.table, new)
            spark.sql(f"ALTER TABLE {name} SET LOCATION {_text(change.location)}")
        else:
            spark.sql(f"CREATE TABLE {name} ({ddl(new.fields)}) USING parquet LOCATION {_text(change.location)}")
    spark.catalog.refreshTable(name)


def _shape(schema: T.StructType) -> list[tuple[str, T.DataType]]:
    return [(f.name, f.dataType) for f in schema.fields]


def add_columns(spark: SparkSession, table: str, schema: T.StructType) -> list[str]:
    """Adds the columns a catalog table lacks and returns their names; no data file changes."""
    have = {f.name.lower() for f in spark.table(table).schema.fields}
    lacking = [f for f in schema.fields if f.name.lower() not in have]
    if lacking:
        spark.sql(f"ALTER TABLE {quoted(table)} ADD COLUMNS ({ddl(lacking)})")
        spark.catalog.refreshTable(quoted(table))
    return [f.name for f in lacking]


def refuse_new_fields(spark: SparkSession, table: str, schema: T.StructType) -> None:
    """An error where a column of the table would need fields it has not: the catalog cannot add those in place."""
    have = {f.name: f.dataType for f in spark.table(table).schema.fields}
    for f in schema.fields:
        if f.name in have and not fits(f.dataType, have[f.name]):
            paths = ", ".join(c[0] for c in changes(f.dataType, have[f.name], f.name))
            raise ValueError(f"table {table} cannot take new fields within a column: {paths}")
