"""What the source's days were like when they were last synced.

Rows that a day of the target does not have for good, because duplicates were reduced, would
look like late ones for ever. What a sync found of a day and what came of it is therefore
kept beside the target, a few numbers a day: as long as both sides still show them, the day
is at rest. With checksums, late rows, rows changed in place and rows that went all show.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daysync.operators.merge import mark_text
from daysync.sources.files import Folder
from daysync.sources.shards import SHARD

_FILE = "_daysync_state"
_COLUMNS = f"{SHARD} string, synced_rows long, synced_modified string, synced_checksum string, synced_target long"


def synced(source: DataFrame, target: DataFrame) -> DataFrame:
    """The state after a sync, by the profiles of the source and of the target then."""
    kind = source.schema["max_modified"].dataType
    sums = F.col("checksum") if "checksum" in source.columns else F.lit(None).cast("string")
    now = source.select(SHARD, F.col("rows").alias("synced_rows"), mark_text(F.col("max_modified"), kind).alias("synced_modified"), sums.alias("synced_checksum"))
    return now.join(target.select(SHARD, F.col("rows").alias("synced_target")), SHARD)


def at_rest(plan: DataFrame, checksums: bool) -> Column:
    """Whether a day of a plan that has a state is as it was synced; false without one."""
    kind = plan.schema["source_modified"].dataType
    same = (
        (F.col("source_rows") == F.col("synced_rows"))
        & mark_text(F.col("source_modified"), kind).eqNullSafe(F.col("synced_modified"))
        & (F.col("target_rows") == F.col("synced_target"))
    )
    if checksums:
        same &= F.col("source_checksum") == F.col("synced_checksum")
    return F.coalesce(same, F.lit(False))


def read(spark: SparkSession, folder: str) -> DataFrame:
    """The state kept in a folder; no rows if there is none."""
    rows = [(day, *values) for day, values in _kept(Folder(spark, folder)).items()]
    return spark.createDataFrame(rows, _COLUMNS)


def _kept(folder: Folder) -> dict[str, list]:
    return json.loads(folder.read_text(_FILE)) if folder.exists(_FILE) else {}


def write(spark: SparkSession, folder: str, days: Mapping[str, tuple[int, str | None, str | None, int]]) -> None:
    """Notes days that were synced beside those noted before: rows, mark, checksum, rows of the target.

    A run that is lost before it gets here takes the days once more.
    """
    if days:
        at = Folder(spark, folder)
        at.write_text(_FILE, json.dumps(_kept(at) | {day: list(values) for day, values in days.items()}))
