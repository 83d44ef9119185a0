"""Upsert and its parts, as DataFrames.

A merge is not one full outer join: Spark can neither broadcast a side of that nor split a
hot key in it. It is two left joins on the key, target to source for the rows that stay
and source to target keys for the rows that are new. Both read the source in one form, so
its shuffle is shared. The first needs no shuffle of the target when the source is small,
and both can be split where a key is hot.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daysync.functions.columns import EPOCH, any_of, col
from daysync.functions.rows import row_digest
from daysync.operators.dedupe import latest
from daysync.operators.joins import KEY_HASH, key_match, keyed, unkeyed, value
from daysync.operators.schema import conform, evolve
from daysync.session import work_folder
from daysync.sources.shards import SHARD, in_shards, per_day

# The column that is the key by itself, and the columns that are it together.
ID_COLUMN = "id"
EVENT_KEY = ("user_pseudo_id", "event_timestamp", "event_name")
TIME_KEY = ("event_time", "event_name")

# For callers that made the source's keys unique: nothing is checked.
UNIQUE = "unique"

_COPIES = "__copies"
_DIGEST = "__digest"
_TARGET_ROWS = "__target_rows"



def choose_keys(
    columns: Sequence[str],
    *,
    id_column: str = ID_COLUMN,
    composite: Sequence[str] = EVENT_KEY,
    by_time: Sequence[str] = TIME_KEY,
    present_only: bool = False,
) -> list[str]:
    """The merge key a source with these columns gets: its id, else a composite key.

    That is ``composite``, or ``by_time`` where only this one is complete. If neither is, it
    is an error. Only with ``present_only`` does ``composite`` shrink to the columns there
    are: rows that differ in the others are then one.
    """
    if id_column in columns:
        return [id_column]
    for key in (composite, by_time):
        if key and all(c in columns for c in key):
            return list(key)
    present = [c for c in composite if c in columns]
    missing = [c for c in composite if c not in columns]
    if not present or (missing and not present_only):
        raise ValueError(f"the source has no key columns {missing}")
    return present


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    *,
    within: Sequence[str] = (),
    update_columns: Sequence[str] | None = None,
    on_duplicate: str = "error",
    order_by: Sequence[str] = (),
    null_safe: bool = False,
) -> DataFrame:
    """``target`` after merging ``source`` into it.

    Matched rows take the source's ``update_columns`` (all but the keys unless given, and
    NULLs too), source rows without a match are inserted, other target rows stay. Columns
    only the source has are added; columns only the target has stay, NULL on insert.

    ``within`` names columns that are part of the key and in which NULL equals NULL, such
    as the shard. (Comparing so also keeps Spark from filtering one use of the source by
    NULLs and not the other, and computing it twice.)

    Two source rows matching one target row are ambiguous. ``on_duplicate="error"`` fails
    the job then; source rows that match nothing are inserted, however many share a key.
    ``"latest"`` first keeps one row per key, the greatest by ``order_by``, which has to be
    given then.

    Keys compare with ``=``, so rows with a NULL key match nothing: they stay or are
    inserted, and bypass the joins, where they would all meet in one task. With
    ``null_safe`` NULL equals NULL.

    Of the target's keys only those are counted that the source has. Spark broadcasts a
    small source for that, and the target is not shuffled.
    """
    by = checked_keys(keys, within, target, source)
    if on_duplicate not in ("error", "latest", UNIQUE):
        raise ValueError(f"on_duplicate is error or latest, not {on_duplicate}")
    if on_duplicate == "latest" and not order_by:
        raise ValueError("the latest row of a key needs order_by")
    updates = [c for c in (source.columns if update_columns is None else update_columns) if c not in by]
    unknown = [c for c in updates if c not in source.columns]
    if unknown:
        raise ValueError(f"update columns {unknown} are not in the source")

    target = evolve(target, source)
    source = conform(source, target)
    if on_duplicate == "latest":
        source = latest(source, by, order_by)

    parts = []
    if not null_safe:
        loose = any_of([col(k).isNull() for k in keys])
        parts = [target.where(loose), source.where(loose)]
        target, source = target.where(~loose), source.where(~loose)

    match = key_match(by, by if null_safe else within)
    values = [c for c in target.columns if c not in by]
    incoming = keyed(source, by, values)
    known = target.select(*[col(k) for k in by]).join(keyed(source, by), match, "left_semi")
    known = known.groupBy(*[col(k) for k in by]).agg(F.count(F.lit(1)).alias(_TARGET_ROWS))
    if updates and on_duplicate == "error":
        parts.insert(0, _ambiguous(source, known, by, match))
    found = incoming.join(known, match, "left")
    new = found.where(F.col(_TARGET_ROWS).isNull())
    parts.append(unkeyed(new, by, values).select(*[col(c) for c in target.columns]))
    if updates:
        target = _updated(target.join(incoming, match, "left"), target.columns, values, updates)
    return reduce(DataFrame.unionByName, [*parts, target])


def checked_keys(
    keys: Sequence[str], within: Sequence[str], target: DataFrame, source: DataFrame
) -> list[str]:
    if not keys:
        raise ValueError("a merge needs at least one key column")
    by = list(dict.fromkeys([*within, *keys]))
    missing = [k for k in by if k not in source.columns or k not in target.columns]
    for k in missing:
        other = [c for c in (*source.columns, *target.columns) if c.lower() == k.lower() and c != k]
        if other:
            raise ValueError(f"key column {k} is {other[0]} on a side: names differ in case only")
    if missing:
        raise ValueError(f"key columns {missing} are not on both sides")
    return by


def _updated(
    joined: DataFrame, columns: Sequence[str], values: Sequence[str], updates: Sequence[str]
) -> DataFrame:
    """The target rows, with the source's values where a source row matches."""
    hit = F.col(KEY_HASH).isNotNull()
    return joined.select(
        *[
            F.when(hit, value(values, c)).otherwise(col(c)).alias(c) if c in updates else col(c)
            for c in columns
        ]
    )


def _ambiguous(source: DataFrame, known: DataFrame, keys: Sequence[str], match: Column) -> DataFrame:
    """No rows; fails the job if a key of several source rows is in the target.

    Both sides are aggregated to their keys first, and adaptive execution drops the join
    once it sees no key repeated. It is a part of the result, so it runs in the same job and
    leads the stage that would multiply rows. Its keys are real and its other columns are
    the failure, so a later filter cannot drop it unasked.
    """
    copies = source.groupBy(*[col(k) for k in keys]).agg(F.count(F.lit(1)).alias(_COPIES))
    repeated = keyed(copies.where(F.col(_COPIES) > 1), keys, [_COPIES])
    both = known.join(repeated, match)
    # Naming a value of each side keeps the check above the join.
    message = F.concat(
        F.lit("merge key "),
        F.to_json(F.struct(*[col(k) for k in keys])),
        F.lit(" is in "), value([_COPIES], _COPIES).cast("string"), F.lit(" source rows and "),
        F.col(_TARGET_ROWS).cast("string"), F.lit(" target rows"),
    )
    failure = F.raise_error(message)
    columns = [
        col(f.name) if f.name in keys else failure.cast(f.dataType).alias(f.name)
        for f in source.schema.fields
    ]
    return both.where(failure.isNotNull()).select(*columns)


def insert_new_rows(target: DataFrame, source: DataFrame, *, ignore: Sequence[str] = ()) -> DataFrame:
    """``target`` plus the source rows it has no equal of.

    Rows are equal if all source columns but ``ignore`` are, NULL equal to NULL, maps whatever the
    order of their entries. This is the merge for sources without a key: a matched row has
    nothing to update.

    What is compared is the SHA-256 of each row, so of the target's columns none is shuffled,
    only distinct digests of 32 bytes are.
    """
    compared = [c for c in source.columns if c not in ignore]
    if not compared:
        raise ValueError("no column left to compare")
    target = evolve(target, source)
    source = conform(source, target)
    known = keyed(target.select(row_digest(target, compared).alias(_DIGEST)).distinct(), [_DIGEST])
    marked = source.withColumn(_DIGEST, row_digest(source, compared))
    found = marked.join(known, key_match([_DIGEST]), "left")
    new = found.where(F.col(KEY_HASH).isNull())
    return target.unionByName(new.select(*[col(c) for c in target.columns]))


def high_water(target: DataFrame, modified: str, shards: Sequence[str]) -> DataFrame:
    """``(shard, high_water)`` of the given days the target has; at most one row each."""
    return in_shards(target, list(shards)).groupBy(SHARD).agg(F.max(col(modified)).alias("high_water"))


def incremental(
    source: DataFrame, target: DataFrame, modified: str, shards: Sequence[str],
    time_column: str | None = None,
) -> DataFrame:
    """Source rows of the given days modified after all the target has of that day.

    Strictly after: rows at the high-water mark, and rows with no modified time, are not
    taken. A day the target does not have counts from 1970.
    """
    mark = ["high_water"]
    marks = keyed(high_water(target, modified, shards), [SHARD], mark)
    floor = F.lit(EPOCH).cast(source.schema[modified].dataType)
    return (
        in_shards(source, list(shards), time_column)
        .join(marks, key_match([SHARD]), "left")
        .where(col(modified) > F.coalesce(value(mark, "high_water"), floor))
        .select(*[col(c) for c in source.columns])
    )


def mark_text(moment: Column, kind: T.DataType) -> Column:
    """A modified time in a form that survives the way through the driver exactly."""
    return F.unix_micros(moment).cast("string") if isinstance(kind, T.TimestampType) else moment.cast("string")


def newer_than(source: DataFrame, modified: str, marks: Mapping[str, str | None]) -> DataFrame:
    """``incremental`` where the mark of each day, as ``mark_text``, is known already.

    The days and the smallest mark are literals in the filter, so partitions and Parquet row
    groups with nothing newer are not read. The mark of a row's day is looked up in a map.
    """
    kind = source.schema[modified].dataType
    if not marks:
        return source.limit(0)

    def mark(text: str | None) -> Column:
        if text is None:
            return F.lit(EPOCH).cast(kind)
        if isinstance(kind, T.TimestampType):
            return F.timestamp_micros(F.lit(int(text)))
        return F.lit(text).cast(kind)

    known = {shard: mark(text) for shard, text in marks.items() if text is not None}
    fresh = [shard for shard, text in marks.items() if text is None]
    parts = []
    if known:
        least = F.least(*known.values()) if len(known) > 1 else next(iter(known.values()))
        parts.append(col(SHARD).isin(list(known)) & (col(modified) > least) & (col(modified) > per_day(known)))
    if fresh:  # days without a mark do not lower that of the others
        parts.append(col(SHARD).isin(fresh) & (col(modified) > mark(None)))
    return in_shards(source, list(marks)).where(any_of(parts))


def merge_incremental(
    target: DataFrame,
    source: DataFrame,
    modified: str,
    shards: Sequence[str],
    *,
    keys: Sequence[str] | None,
    time_column: str | None = None,
    **options,
) -> DataFrame:
    """Merge only the ``incremental`` rows.

    The marks are fetched, a row per day, and reach the scan of the source as literals. What
    passes is written to the shared folder once, and all uses in the merge read it from there.
    """
    kind = source.schema[modified].dataType
    found = high_water(target, modified, shards)
    found = found.select(SHARD, mark_text(col("high_water").cast(kind), kind).alias("mark"))
    marks = dict.fromkeys(shards) | {r[SHARD]: r["mark"] for r in found.collect()}
    newer = newer_than(in_shards(source, list(shards), time_column), modified, marks)
    return merge_staged(target, kept(newer), modified, keys, **options)


def kept(df: DataFrame) -> DataFrame:
    """The rows of ``df``, computed once, as a table in the shared folder."""
    path = work_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def merge_staged(
    target: DataFrame, staged: DataFrame, modified: str, keys: Sequence[str] | None, **options
) -> DataFrame:
    """Merge rows by ``keys``, or without keys by whole-row comparison.

    The modified column of matched rows stays as it was unless ``update_columns`` names
    it, so an updated row is taken again the next time.
    """
    if keys is None:
        return insert_new_rows(target, staged, ignore=[modified])
    options.setdefault("update_columns", [c for c in staged.columns if c not in (*keys, modified)])
    return upsert(target, staged, keys, **options)
