"""What a plan did, in the forms people read. Plans have one row per day of the window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daysync.plans.policies import (
    BACKFILL_COPY,
    DATA_CHANGE,
    DIRECT_TRANSFER,
    MERGE,
    MISSING_SOURCE,
    SCHEMA_CHANGE,
    SKIPPED,
    SYNC_DONE,
)
from daysync.sources.shards import SHARD

# Report texts.
READY = "READY"
NOT_READY = "SKIPPED"
DONE_D1 = "MERGED (Direct Transfer)"
DONE_OTHER = "MERGED (Conditional Update)"
NOTHING_D1 = "SKIPPED (no changes or source missing)"
NOTHING_OTHER = "SKIPPED (no changes)"
EMPTY = "None"
HYBRID_BUCKETS = (DIRECT_TRANSFER, BACKFILL_COPY, MERGE, SKIPPED)
REPLICATE_BUCKETS = (SYNC_DONE, SCHEMA_CHANGE, DATA_CHANGE, SKIPPED, MISSING_SOURCE)


def _shards(holds: Column | None = None) -> Column:
    listed = F.col(SHARD) if holds is None else F.when(holds, F.col(SHARD))
    return F.array_join(F.sort_array(F.collect_list(listed)), ", ")


def by_action(plan: DataFrame) -> DataFrame:
    """``(action, days, shards)`` for the actions that occur."""
    return plan.groupBy("action").agg(F.count(F.lit(1)).alias("days"), _shards().alias("shards"))


def by_bucket(plan: DataFrame, buckets: Sequence[str] = HYBRID_BUCKETS, other: str = SKIPPED) -> DataFrame:
    """``(bucket, days, shards)`` for each bucket in turn, ``None`` where it is empty.

    An action that is no bucket counts as ``other``.
    """
    bucket = F.when(F.col("action").isin(list(buckets)), F.col("action")).otherwise(other)
    per = [
        F.struct(
            F.lit(name).alias("bucket"),
            F.count(F.when(F.col("bucket") == name, 1)).alias("days"),
            _shards(F.col("bucket") == name).alias("shards"),
        )
        for name in buckets
    ]
    line = plan.withColumn("bucket", bucket).agg(F.array(*per).alias("lines"))
    return line.select(F.explode("lines").alias("l")).select(
        "l.bucket", "l.days", F.when(F.col("l.days") > 0, F.col("l.shards")).otherwise(EMPTY).alias("shards")
    )


def transfers(plan: DataFrame) -> DataFrame:
    """One row ``(transferred, merged)`` listing the days, or saying there are none."""

    def listed(action: str, none: str) -> Column:
        names = _shards(F.col("action") == action)
        return F.when(names == "", none).otherwise(names)

    return plan.agg(
        listed(DIRECT_TRANSFER, "No transfers").alias("transferred"),
        listed(MERGE, "No merges").alias("merged"),
    )


def ready(plan: DataFrame) -> DataFrame:
    """``(shard, status, result)``: whether the source has the day, and what came of it."""
    idle = F.col("action").isin(SKIPPED, MISSING_SOURCE)
    first = F.col("offset") == 1
    return plan.select(
        SHARD,
        F.when(F.col("source_rows").isNull(), NOT_READY).otherwise(READY).alias("status"),
        F.when(idle & first, NOTHING_D1)
        .when(idle, NOTHING_OTHER)
        .when(first, DONE_D1)
        .otherwise(DONE_OTHER)
        .alias("result"),
    )
