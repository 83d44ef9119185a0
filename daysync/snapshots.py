"""A source and a target made from one ``events`` table, one case per day of a window.

Logical date 2024-01-31, seven days back. All rows of all other days are in both sides.

20240130  rows missing in the target, rows changed in the source
20240129  alike
20240128  as 20240130, and the target has no ``props``
20240127  not in the target
20240126  not in the source
20240125  rows changed in the source, same number
20240124  alike
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daysync.sinks.write import append_rows, write_day_table
from daysync.sources.shards import SHARD, with_shard

LOGICAL_DATE = "2024-01-31"
LOOKBACK = 7
ALL_DAYS = 30
NOT_IN_SOURCE = "20240126"
NOT_IN_TARGET = "20240127"
CHANGED = ["20240130", "20240128", "20240125"]
ROWS_MISSING = ["20240130", "20240128"]
DRIFTED = "20240128"

# The rows that differ: purchases were corrected later, sign-ups arrived late.
CORRECTED = "purchase"
LATE = "signup"


def _corrected():
    return (F.col("event_type") == CORRECTED) & F.col(SHARD).isin(CHANGED)


def source_events(events: DataFrame) -> DataFrame:
    days = with_shard(events, "ts").where(F.col(SHARD) != NOT_IN_SOURCE)
    later = F.col("ts") + F.expr("INTERVAL 1 DAY")
    return days.withColumn("modified", F.when(_corrected(), later).otherwise(F.col("ts")))


def target_events(events: DataFrame) -> DataFrame:
    late = (F.col("event_type") == LATE) & F.col(SHARD).isin(ROWS_MISSING)
    days = with_shard(events, "ts").where((F.col(SHARD) != NOT_IN_TARGET) & ~late)
    return days.withColumns(
        {
            "value": F.when(_corrected(), F.lit(-1.0)).otherwise(F.col("value")),
            "props": F.when(F.col(SHARD) != DRIFTED, F.col("props")),
            "modified": F.col("ts"),
        }
    )


def declared(target: DataFrame) -> dict[str, T.StructType]:
    """The columns of the target's days that are not those of the frame."""
    return {DRIFTED: target.drop("props").schema}


def write_tables(events: DataFrame, source_path: str, target_path: str) -> None:
    """Both sides on disk, where the drifted day has no ``props`` column at all."""
    target = target_events(events)
    older = target.where(F.col(SHARD) == DRIFTED).drop("props")
    write_day_table(source_events(events), source_path)
    write_day_table(target.where(F.col(SHARD) != DRIFTED), target_path)
    append_rows(events.sparkSession, older, target_path, older.schema)
