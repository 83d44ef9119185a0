"""Day shards: which days are due, which are there, and what each one holds."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daysync.functions.columns import col, shard_of
from daysync.functions.rows import checksum

SHARD = "shard"
DEFAULT_LOOKBACK = 4


def _as_date(logical_date: date | str) -> date:
    return date.fromisoformat(logical_date) if isinstance(logical_date, str) else logical_date


def lookback_shards(logical_date: date | str, lookback: int = DEFAULT_LOOKBACK) -> list[str]:
    """The shards of D-1 to D-``lookback``, latest first."""
    if lookback < 1:
        raise ValueError("lookback must be at least 1 day")
    day = _as_date(logical_date)
    return [(day - timedelta(days=n)).strftime("%Y%m%d") for n in range(1, lookback + 1)]


def expected_shards(
    spark: SparkSession, logical_date: date | str, lookback: int = DEFAULT_LOOKBACK
) -> DataFrame:
    """One row ``(shard, offset)`` per day of the window."""
    if lookback < 1:
        raise ValueError("lookback must be at least 1 day")
    day = F.lit(_as_date(logical_date))
    offset = F.col("id").cast("int")
    return spark.range(1, lookback + 1, numPartitions=1).select(
        shard_of(F.date_sub(day, offset)).alias(SHARD), offset.alias("offset")
    )


def with_shard(df: DataFrame, time_column: str) -> DataFrame:
    """Add the shard each row belongs to."""
    return df.withColumn(SHARD, shard_of(col(time_column)))


def in_shards(df: DataFrame, shards: list[str], time_column: str | None = None) -> DataFrame:
    """Keep the rows of the given shards.

    On a table partitioned by shard this prunes partitions. On a flat table name the time
    column the shard was made from: its range then reaches the Parquet reader, which the
    shard expression cannot.
    """
    kept = df.where(col(SHARD).isin(shards))
    if time_column and shards:
        first, last = (date(int(s[:4]), int(s[4:6]), int(s[6:])) for s in (min(shards), max(shards)))
        kind = df.schema[time_column].dataType
        kept = kept.where(
            (col(time_column) >= F.lit(first).cast(kind))
            & (col(time_column) < F.lit(last + timedelta(days=1)).cast(kind))
        )
    return kept


def lookback(
    df: DataFrame, logical_date: date | str, days: int = DEFAULT_LOOKBACK, time_column: str | None = None
) -> DataFrame:
    """The rows of D-1 to D-``days``."""
    return in_shards(df, lookback_shards(logical_date, days), time_column)


def missing_shards(df: DataFrame, logical_date: date | str, days: int = DEFAULT_LOOKBACK,
                   time_column: str | None = None) -> DataFrame:
    """The due days ``(shard, offset)`` without any row in ``df``."""
    present = lookback(df, logical_date, days, time_column).select(SHARD).distinct()
    due = expected_shards(df.sparkSession, logical_date, days)
    return due.join(present, SHARD, "left_anti")


def schema_text(schema: T.StructType) -> str:
    """Ordered ``name:type`` list of the columns."""
    return "|".join(f"{f.name}:{f.dataType.simpleString()}" for f in schema.fields if f.name != SHARD)


def per_day(values: Mapping[str, Column], otherwise: Column | None = None) -> Column:
    """The value of the row's day; ``otherwise`` (NULL unless given) for days not listed."""
    default = F.lit(None) if otherwise is None else otherwise
    if not values:
        return default
    listed = F.create_map(*[c for day, value in values.items() for c in (F.lit(day), value)])
    return F.coalesce(F.try_element_at(listed, F.col(SHARD)), default)


def profile(
    df: DataFrame,
    modified: str,
    *,
    with_schema: bool = False,
    schemas: Mapping[str, T.StructType] | None = None,
    checksums: bool = False,
) -> DataFrame:
    """One row per shard: ``rows``, ``max_modified`` and, on request, ``fingerprint`` and ``checksum``.

    A single aggregation with map-side combine, so a day holding most of the rows costs no
    more than any other. The fingerprint lists ``name:type`` of the columns that the day
    declares: those of ``schemas``, else those of ``df``. No value is read for it. The checksum,
    see ``rows.checksum``, reads all columns.
    """
    whole = [checksum(df, [c for c in df.columns if c != SHARD]).alias("checksum")] if checksums else []
    days = df.groupBy(SHARD).agg(F.count(F.lit(1)).alias("rows"), F.max(col(modified)).alias("max_modified"), *whole)
    if not with_schema:
        return days
    texts = {day: F.lit(schema_text(schema)) for day, schema in (schemas or {}).items()}
    return days.withColumn("fingerprint", per_day(texts, F.lit(schema_text(df.schema))))
