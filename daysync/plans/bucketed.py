"""Merges into tables bucketed by their key, which stay where they are.

A table whose files are bucketed by the merge key has all rows of a key in one bucket. Only the
source is shuffled for a merge, into as many parts as there are buckets; each task then joins
one bucket with its part and writes that bucket anew.

A bucket is one task's work: keys of which a table has very many rows are better merged by
``merge.upsert``, which can split them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daysync.functions.columns import all_of, col
from daysync.operators.dedupe import latest
from daysync.operators.merge import checked_keys
from daysync.operators.schema import conform, evolve
from daysync.sinks import publish

_COPIES, _THERE = "__copies", "__there"
_MINE = "__source_{}"
_STAGED = "__staged"


def write_bucketed(df: DataFrame, table: str, keys: Sequence[str], buckets: int, path: str) -> None:
    """Make a catalog table of ``df`` with ``buckets`` files at most, each sorted by the keys."""
    spread = df.repartition(buckets, *[col(k) for k in keys])
    _save(spread, table, keys, buckets, path)


def _save(df: DataFrame, table: str, keys: Sequence[str], buckets: int, path: str) -> None:
    writer = df.write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
    writer.option("path", path).saveAsTable(table)


def bucketing_of(spark: SparkSession, table: str) -> tuple[int, list[str]]:
    """The number of buckets of a catalog table, and the columns that tell them."""
    described = spark.sql(f"DESCRIBE EXTENDED {publish.quoted(table)}")
    facts = {r["col_name"]: r["data_type"] for r in described.collect() if r["col_name"] in ("Num Buckets", "Bucket Columns")}
    if not facts:
        raise ValueError(f"table {table} is not bucketed")
    columns = facts["Bucket Columns"].strip("[]").split(", ")
    return int(facts["Num Buckets"]), [c.strip("`").replace("``", "`") for c in columns]


def upsert_bucketed(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    buckets: int,
    *,
    update_columns: Sequence[str] | None = None,
    on_duplicate: str = "error",
    order_by: Sequence[str] = (),
) -> DataFrame:
    """``merge.upsert`` of a target bucketed by exactly ``keys``, none of whose rows is shuffled.

    The result lies in the target's buckets, one per task. NULL keys match nothing: those rows
    of both sides stay, all in the bucket of NULL.
    """
    by = checked_keys(keys, (), target, source)
    if on_duplicate not in ("error", "latest"):
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
    mine = {c: _MINE.format(i) for i, c in enumerate(target.columns)}
    keyed = [F.col(mine[k]) for k in by]
    incoming = source.select(*[col(c).alias(name) for c, name in mine.items()]).repartition(buckets, *keyed)
    match = all_of([col(k) == F.col(mine[k]) for k in by])
    if not updates:  # what matches changes nothing, however often
        new = incoming.join(target.select(*[col(k) for k in by]), match, "left_anti")
        return target.unionByName(new.select(*[F.col(name).alias(c) for c, name in mine.items()]))

    counted = incoming.withColumn(_COPIES, F.count(F.lit(1)).over(Window.partitionBy(*keyed)))
    both = target.withColumn(_THERE, F.lit(True)).join(counted, match, "full_outer")
    there, hit = F.col(_THERE).isNotNull(), F.col(_COPIES).isNotNull()
    message = F.concat(F.lit("merge key "), F.to_json(F.struct(*[col(k) for k in by])), F.lit(" is in several source rows"))
    checked = both.where(F.when(there & (F.col(_COPIES) > 1), F.raise_error(message).cast("boolean")).otherwise(True))
    return checked.select(*[
        (F.when(hit, F.col(mine[c])).otherwise(col(c)) if c in updates else F.when(there, col(c)).otherwise(F.col(mine[c]))).alias(c)
        for c in target.columns
    ])


def merge_into_bucketed(spark: SparkSession, table: str, source: DataFrame, *, folder: str, **options) -> None:
    """Merge ``source`` into a bucketed catalog table, by the columns that tell its buckets.

    The new files are written below ``folder`` where they stay, and the table is pointed at them
    when all are complete, see ``sinks.publish``: readers find old or new rows, and a run that is
    lost on the way is finished or undone by the next. Options are those of ``upsert_bucketed``.
    """
    publish.finish(spark, folder)
    staged = f"{table}{_STAGED}"
    spark.sql(f"DROP TABLE IF EXISTS {publish.quoted(staged)}")
    buckets, keys = bucketing_of(spark, table)
    merged = upsert_bucketed(spark.table(table), source, keys, buckets, **options)
    publish.refuse_new_fields(spark, table, merged.schema)
    run = publish.start(spark, folder)
    path = f"{run}/rows"
    _save(merged, staged, keys, buckets, path)
    spark.sql(f"DROP TABLE {publish.quoted(staged)}")
    change = publish.Change(table, None, path, merged.schema.json(), publish.location_of(spark, table))
    publish.publish(spark, run, [change])
