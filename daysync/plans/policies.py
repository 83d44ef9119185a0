"""What to do with each due day.

Every policy is a rule chain over one row per day, which holds the profile of the day on
both sides. All days are decided in one job.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daysync.plans.state import at_rest
from daysync.sources.shards import (
    DEFAULT_LOOKBACK,
    SHARD,
    expected_shards,
    in_shards,
    lookback_shards,
    profile,
)

# The action labels.
MERGE = "merge"
DIRECT_TRANSFER = "direct_transfer"
BACKFILL_COPY = "backfill_copy"
SKIPPED = "skipped"
MISSING_SOURCE = "missing_source"
SYNC_DONE = "sync_done"
SCHEMA_CHANGE = "schema_change"
DATA_CHANGE = "data_change"

REPLACING = (DIRECT_TRANSFER, BACKFILL_COPY, SYNC_DONE, SCHEMA_CHANGE, DATA_CHANGE)


def _first(*rules: tuple[Column, str], otherwise: str) -> Column:
    """The action of the first rule that holds; a comparison with NULL does not hold."""
    chain = F.when(F.col("source_rows").isNull(), MISSING_SOURCE)
    for holds, action in rules:
        chain = chain.when(holds, action)
    return chain.otherwise(otherwise)


def _action(policy: str, late_rows: bool, rest: Column, checksums: bool) -> Column:
    yesterday = F.col("offset") == 1
    no_target = F.col("target_rows").isNull()
    # Rows that arrive late, below the newest, show in the number of rows only.
    no_late = F.lit(True) if not late_rows else (F.col("source_rows") <= F.col("target_rows")) | rest
    not_newer = (F.col("source_modified") <= F.col("target_modified")) & no_late
    newer = F.col("target_modified").isNull() | (F.col("source_modified") > F.col("target_modified")) | ~no_late
    if checksums:  # they decide alone, whatever the modified times say
        not_newer, newer, no_late = F.lit(False), F.lit(True), F.lit(False)
    modified_gate = (~no_target & ((F.col("source_modified").isNull() & no_late) | not_newer), SKIPPED)
    count_gate = [
        ((F.col("source_rows") == F.col("target_rows")) & F.lit(not checksums), SKIPPED),
        (yesterday, DIRECT_TRANSFER),
    ]
    copy_first = [(no_target, SYNC_DONE), (yesterday, SYNC_DONE)]
    chains = {
        "incremental": _first(otherwise=MERGE),
        "modified": _first((yesterday, MERGE), modified_gate, otherwise=MERGE),
        "d1_replace": _first((yesterday, DIRECT_TRANSFER), modified_gate, otherwise=MERGE),
        "rowcount": _first(*count_gate, otherwise=MERGE),
        "both": _first((not_newer, SKIPPED), *count_gate, otherwise=MERGE),
        "hybrid": _first(
            (yesterday, DIRECT_TRANSFER),
            (no_target, BACKFILL_COPY),
            (not_newer, SKIPPED),
            otherwise=MERGE,
        ),
        "replicate": _first(
            *copy_first,
            (F.col("schema_changed"), SCHEMA_CHANGE),
            (newer, DATA_CHANGE),
            otherwise=SKIPPED,
        ),
        "replicate_brief": _first(
            *copy_first,
            (F.col("schema_changed") | newer, SYNC_DONE),
            otherwise=SKIPPED,
        ),
    }
    return F.when(rest & F.col("source_rows").isNotNull(), SKIPPED).otherwise(chains[policy]) if checksums else chains[policy]


POLICIES = (
    "incremental",
    "modified",
    "d1_replace",
    "rowcount",
    "both",
    "hybrid",
    "replicate",
    "replicate_brief",
)
SCHEMA_POLICIES = ("replicate", "replicate_brief")


def plan_profiles(
    source: DataFrame,
    target: DataFrame,
    policy: str,
    logical_date: date | str,
    lookback: int = DEFAULT_LOOKBACK,
    *,
    late_rows: bool = False,
    state: DataFrame | None = None,
    checksums: bool = False,
) -> DataFrame:
    """The plan for two profiles ``(shard, rows, max_modified[, fingerprint])``.

    Both may have more days than the window. ``policy`` is one of ``POLICIES``:

    ``incremental``      merge every day the source has
    ``modified``         merge D-1; merge others unless the source is not newer
    ``d1_replace``       replace D-1; merge others unless the source is not newer
    ``rowcount``         nothing if row counts are equal; else replace D-1, merge others.
                         Does not see rows changed in place
    ``both``             nothing if the source is not newer; else as ``rowcount``
    ``hybrid``           replace D-1, copy days the target lacks, merge newer ones
    ``replicate``        replace D-1 and every day with other columns or newer rows
    ``replicate_brief``  the same with one label for all that is replaced

    With ``late_rows`` a day of which the source has more rows counts as newer too: rows that
    arrived late lie below the newest one. They still go unseen where the target has as many
    rows of its own; profiles by file times see those.
    """
    if policy not in POLICIES:
        raise ValueError(f"policy is one of {', '.join(POLICIES)}, not {policy}")
    shards = lookback_shards(logical_date, lookback)

    def side(df: DataFrame, name: str) -> DataFrame:
        named = {c: f"{name}_{c}" for c in ("rows", "fingerprint", "checksum")} | {"max_modified": f"{name}_modified"}
        return in_shards(df, shards).withColumnsRenamed(named)

    # Both profiles are partitioned by shard already, so this moves nothing.
    known = side(source, "source").join(side(target, "target"), SHARD, "full_outer")
    days = expected_shards(source.sparkSession, logical_date, lookback).join(known, SHARD, "left")
    shown = [SHARD, "offset", "source_rows", "target_rows", "source_modified", "target_modified"]
    if policy in SCHEMA_POLICIES:
        days = days.withColumn("schema_changed", F.col("source_fingerprint") != F.col("target_fingerprint"))
        shown.append("schema_changed")
    if checksums:
        shown.append("source_checksum")
    rest: Column = F.lit(False)
    if state is not None:
        # A row for each day of the window at most.
        days = days.join(in_shards(state, shards), SHARD, "left")
        rest = at_rest(days, checksums)
    return days.select(*shown, _action(policy, late_rows, rest, checksums).alias("action"))


def sync_plan(
    source: DataFrame,
    target: DataFrame,
    policy: str,
    logical_date: date | str,
    lookback: int = DEFAULT_LOOKBACK,
    *,
    modified: str = "modified",
    time_column: str | None = None,
    late_rows: bool = False,
    state: DataFrame | None = None,
    checksums: bool = False,
    schemas: Sequence[Mapping[str, T.StructType]] = ({}, {}),
) -> DataFrame:
    """The plan for two tables, from one aggregation over the window of each.

    ``schemas`` are the columns that days of the source and of the target declare, where
    they are not those of the frame.
    """
    shards = lookback_shards(logical_date, lookback)
    schema = policy in SCHEMA_POLICIES
    sides = [
        profile(in_shards(df, shards, time_column), modified, with_schema=schema, schemas=declared, checksums=sums)
        for df, declared, sums in zip((source, target), schemas, (checksums, False), strict=True)
    ]
    return plan_profiles(*sides, policy, logical_date, lookback, late_rows=late_rows, state=state, checksums=checksums)
