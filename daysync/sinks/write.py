"""Writing Parquet: replacing and appending shards, and projected export."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from daysync.functions.columns import col
from daysync.operators.append import append_by_name
from daysync.sources.files import Folder
from daysync.sources.shards import SHARD
from daysync.sources.tables import read_day_table

_STAGED = "_staged-"
_READY = "_READY"
_EMPTY = "_EMPTY-"
_REPLACED = "_REPLACED-"


def by_shard(df: DataFrame) -> DataFrame:
    """Gather each shard's rows: a large one over many even tasks, a small one in one."""
    return df.hint("rebalance", col(SHARD))


def write_day_table(df: DataFrame, path: str) -> None:
    """Write a new table partitioned by shard."""
    by_shard(df).write.mode("errorifexists").partitionBy(SHARD).parquet(path)


def stage(df: DataFrame, path: str) -> DataFrame:
    """The rows written to a folder and read from there.

    What uses them more than once does not compute them again, and Spark knows their size
    when it plans the joins.
    """
    write_day_table(df, path)
    return read_day_table(df.sparkSession, path, df.schema)


def append_rows(spark: SparkSession, rows: DataFrame, path: str, schema: T.StructType) -> None:
    """Append to a table of the given columns; those the rows lack are NULL."""
    table = spark.createDataFrame([], schema)
    by_shard(append_by_name(table, rows)).write.mode("append").partitionBy(SHARD).parquet(path)


def export_parquet(df: DataFrame, columns: Sequence[str], path: str) -> None:
    """Write some columns to a folder of Parquet files, over what was there."""
    df.select(*[col(c) for c in columns]).write.mode("overwrite").parquet(path)


def replace_shards(
    spark: SparkSession, frames: Sequence[DataFrame], path: str, shards: Sequence[str]
) -> None:
    """Make the frames' rows the contents of the given shards of the table at ``path``.

    Rows of other shards are an error. (A filter here would reach into the plans of the
    frames, and keep them from sharing work.) Frames may differ in columns, as long as each
    shard comes from one of them, and may read the table itself: all rows are first written
    next to it, with a note of each shard that will have none. Only when all of this is
    marked as complete does a staged shard take the place of the old one, which is moved aside
    and deleted after all shards are in place, and a shard without rows go. If the driver dies before the mark, the table is as it was; after it,
    ``finish_replace`` goes on from the staged copy.

    Rows are written as they lie: good for days read from a table of days, which need no
    shuffle. Apply ``by_shard`` first where the rows of a day are scattered.
    """
    finish_replace(spark, path)
    folder = Folder(spark, path)
    staged = f"{_STAGED}{uuid.uuid4().hex}"
    for df in frames:
        df.write.mode("append").partitionBy(SHARD).parquet(f"{folder.path}/{staged}")
    written = Folder(spark, f"{folder.path}/{staged}").shards()
    other = sorted(set(written) - set(shards))
    if other:
        folder.drop(staged)
        raise ValueError(f"the frames have rows of other shards: {other}")
    for shard in sorted(set(shards) - set(written)):
        folder.touch(f"{staged}/{_EMPTY}{shard}")
    folder.touch(f"{staged}/{_READY}")
    finish_replace(spark, path)


def finish_replace(spark: SparkSession, path: str) -> None:
    """Move staged shards into place; staging that was never completed is dropped."""
    folder = Folder(spark, path)
    for staged in [n for n in folder.names() if n.startswith(_STAGED)]:
        names = folder.names(staged)
        if _READY in names:
            for name in names:
                if name.startswith(f"{SHARD}="):
                    _set_aside(folder, staged, name)
                    folder.move(f"{staged}/{name}", name)
                elif name.startswith(_EMPTY):
                    _set_aside(folder, staged, f"{SHARD}={name.removeprefix(_EMPTY)}")
        folder.drop(staged)


def _set_aside(folder: Folder, staged: str, name: str) -> None:
    """The old rows of a shard out of the way, whole: nothing is deleted before all is in place."""
    if folder.exists(name):
        folder.move(name, f"{staged}/{_REPLACED}{uuid.uuid4().hex}")
