"""Carrying out a plan on DataFrames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, Row

from daysync.functions.columns import col
from daysync.operators.merge import mark_text, merge_incremental, upsert
from daysync.operators.schema import Schemas, conform, evolve
from daysync.plans.policies import MERGE, REPLACING
from daysync.sources.shards import DEFAULT_LOOKBACK, SHARD, in_shards, missing_shards


@dataclass(frozen=True)
class Decisions:
    """The days of a plan by what happens to them."""

    rows: list[Row]

    @classmethod
    def of(cls, plan: DataFrame) -> Decisions:
        """Fetches the plan: one row per day of the window, no data rows.

        Known days prune partitions when the next job is planned, and stay the same while
        that job replaces the files they were decided from.
        """
        marks = {
            name: mark_text(col(moment), plan.schema[moment].dataType)
            for name, moment in (("mark", "target_modified"), ("source_mark", "source_modified"))
        }
        return cls(sorted(plan.withColumns(marks).collect(), key=lambda r: r["offset"]))

    @property
    def copied(self) -> list[str]:
        """Days taken whole from the source; merging into nothing is a copy too."""
        return [
            r[SHARD]
            for r in self.rows
            if r["action"] in REPLACING or (r["action"] == MERGE and r["target_rows"] is None)
        ]

    @property
    def merged(self) -> list[str]:
        return [
            r[SHARD] for r in self.rows if r["action"] == MERGE and r["target_rows"] is not None
        ]

    @property
    def marks(self) -> dict[str, str | None]:
        """The target's high-water mark of each day to merge, as ``merge.mark_text``."""
        return {r[SHARD]: r["mark"] for r in self.rows if r["action"] == MERGE}

    def states(self, written: Mapping[str, int]) -> dict[str, tuple[int, str | None, str | None, int]]:
        """What ``plans.state`` keeps of the days that were written, each with its rows since."""
        return {
            r[SHARD]: (r["source_rows"], r["source_mark"], r["source_checksum"] if "source_checksum" in r else None, written[r[SHARD]])
            for r in self.rows
            if r[SHARD] in written
        }

    @property
    def changed(self) -> list[str]:
        return self.copied + self.merged


def replace_days(source: DataFrame, target: DataFrame, days: Sequence[str],
                 time_column: str | None = None, target_schemas: Schemas | None = None) -> DataFrame:
    """The target with the given days taken from the source, in the columns of both.

    A day the source does not have is gone from the result. With ``target_schemas``, the columns of
    the target's days as for ``schema.schema_rows``, a column only the target has goes with the last
    day that declares it; without, it stays and is NULL in the replaced days.
    """
    if target_schemas is not None:
        target = target.drop(*_outlived(source, target, days, target_schemas))
    wide = evolve(target, source)
    copied = conform(in_shards(source, list(days), time_column), wide)
    return _other_days(wide, days).unionByName(copied)


def _outlived(source: DataFrame, target: DataFrame, days: Sequence[str], schemas: Schemas) -> list[str]:
    """Columns the source lacks that no day declares but the given ones.

    The other days are fetched, one row each, and only if there is such a column.
    """
    mine = [c for c in target.columns if c not in source.columns]
    if not mine:
        return []
    staying = [r[SHARD] for r in _other_days(target, days).select(SHARD).distinct().collect()]
    return [c for c in mine if all(day in schemas and c not in schemas[day].names for day in staying)]


def backfill(source: DataFrame, target: DataFrame, logical_date: date | str, lookback: int = DEFAULT_LOOKBACK,
             time_column: str | None = None) -> DataFrame:
    """The target with the days of the window it has no row of copied from the source."""
    gaps = missing_shards(target, logical_date, lookback, time_column)
    return replace_days(source, target, [r[SHARD] for r in gaps.collect()], time_column)


def _other_days(df: DataFrame, days: Sequence[str]) -> DataFrame:
    return df.where(~col(SHARD).isin(list(days)) | col(SHARD).isNull())


def merge_days(
    source: DataFrame,
    target: DataFrame,
    days: Sequence[str],
    keys: Sequence[str] | None,
    *,
    incremental_by: str | None = None,
    time_column: str | None = None,
    **options,
) -> DataFrame:
    """The given days of the target with those of the source merged in.

    ``keys`` and ``options`` are those of ``merge.upsert``. The shard joins the key, as a
    day only merges with itself. With ``incremental_by`` only rows past the target's
    high-water mark of the day are merged.
    """
    mine = in_shards(target, list(days), time_column)
    theirs = in_shards(source, list(days), time_column)
    if keys is not None:
        options.setdefault("within", [SHARD])
    if incremental_by:
        return merge_incremental(mine, theirs, incremental_by, days, keys=keys, **options)
    if keys is None:
        raise ValueError("a plan that merges days needs key columns")
    return upsert(mine, theirs, keys, **options)


def apply_plan(
    source: DataFrame,
    target: DataFrame,
    plan: DataFrame,
    keys: Sequence[str] | None = None,
    *,
    time_column: str | None = None,
    target_schemas: Schemas | None = None,
    **options,
) -> DataFrame:
    """The whole target after the plan, in the columns of both sides.

    ``keys`` and ``options`` are those of ``merge_days``, ``target_schemas`` that of ``replace_days``.
    """
    decisions = Decisions.of(plan)
    copied, merged = decisions.copied, decisions.merged
    if options.get("incremental_by"):
        copied, merged = [], decisions.changed
    result = replace_days(source, target, copied, time_column, target_schemas)
    if merged:
        done = merge_days(source, target, merged, keys, time_column=time_column, **options)
        result = _other_days(result, merged).unionByName(done.select(*[col(c) for c in result.columns]))
    return result
