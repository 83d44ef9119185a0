"""Tables partitioned by shard on disk, and tables of the catalog."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daysync.functions.shapes import united
from daysync.sources.footers import by_spark, declared, footers
from daysync.sources.shards import SHARD


def read_named(spark: SparkSession, name: str) -> DataFrame:
    """A table by name, of whatever format its catalog serves."""
    return spark.table(name)


def read_day_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    shards: Iterable[str] | None = None,
) -> DataFrame:
    """A Parquet table partitioned by shard, the shard as text.

    With ``schema`` (the data columns) days written before a column existed read it as
    NULL. Without, the columns of all files are merged, which opens every footer.
    With ``shards``, days the table has, only their folders are listed.
    """
    folders, reader = _folders(spark, path, shards)
    if schema is None:
        found = reader.option("mergeSchema", "true").parquet(*folders)
        return found.withColumn(SHARD, F.col(SHARD).cast("string"))
    fields = [f for f in schema.fields if f.name != SHARD] + [T.StructField(SHARD, T.StringType())]
    typed = T.StructType(fields)
    return reader.schema(typed).parquet(*folders) if folders else spark.createDataFrame([], typed)


def file_profile(spark: SparkSession, path: str, shards: Iterable[str] | None = None) -> DataFrame:
    """Per shard ``files``, ``bytes`` and ``max_modified`` from the file listing alone.

    Only path, size and time of the files are selected, so none is opened.
    """
    folders, reader = _folders(spark, path, shards)
    files = reader.format("binaryFile").option("pathGlobFilter", "*.parquet").load(folders)
    return files.groupBy(F.col(SHARD).cast("string").alias(SHARD)).agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("length").alias("bytes"),
        F.max("modificationTime").alias("max_modified"),
    )


def _folders(
    spark: SparkSession, path: str, shards: Iterable[str] | None
) -> tuple[list[str], DataFrameReader]:
    root = path.rstrip("/")
    folders = [root] if shards is None else [f"{root}/{SHARD}={s}" for s in shards]
    return folders, spark.read.option("basePath", root)


def shard_schemas(spark: SparkSession, path: str, shards: Iterable[str]) -> dict[str, T.StructType]:
    """The columns of each shard, from the footers of its files, all days in one job.

    ``shards`` are the existing days of a lookback window: a few, not the table. Executors open the
    files that Spark deals them; to the driver comes each set of columns that a day has, and
    they are merged in the order of its files, to the wider type. A day with files that Spark did not
    write, or on a file system that Python cannot open, is read by Spark, a job for each such day.
    """
    days = list(shards)
    if not days:
        return {}
    folders, reader = _folders(spark, path, days)
    files = reader.format("binaryFile").load(folders).select(F.col(SHARD), "path")
    found: dict[str, list[str | None]] = {day: [] for day in days}
    for row in sorted(footers(files).collect(), key=lambda r: r["path"]):
        found[row["shard"]].append(row["columns"])
    merged = {}
    for day, folder in zip(days, folders, strict=True):
        schemas = declared(found[day])
        merged[day] = by_spark(spark, folder) if not schemas else merged_schema(schemas)
    return merged


def read_day_tables(spark: SparkSession, prefix: str, shards: Iterable[str]) -> DataFrame:
    """Catalog tables of one day each, such as ``db.events_20240130``, as one frame.

    Days without a table are left out, columns a day does not have are NULL. The shard is
    a constant of each part, so days a query does not want are dropped from its plan.
    """
    names = {s: f"{prefix}_{s}" for s in shards}
    parts = [
        spark.table(name).withColumn(SHARD, F.lit(shard))
        for shard, name in names.items()
        if spark.catalog.tableExists(name)
    ]
    if not parts:
        raise ValueError(f"no table {prefix}_<day> for any of the days")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def merged_schema(schemas: Iterable[T.StructType]) -> T.StructType:
    """All columns, and fields within them, in first-seen order, each with the wider of the types it has."""
    types: dict[str, T.DataType] = {}
    for schema in schemas:
        for f in schema.fields:
            seen = types.setdefault(f.name, f.dataType)
            try:
                types[f.name] = united(seen, f.dataType, widen=True)
            except ValueError as unlike:
                raise ValueError(
                    f"column {f.name} is {seen.simpleString()} in one day "
                    f"and {f.dataType.simpleString()} in another"
                ) from unlike
    return T.StructType([T.StructField(name, kind) for name, kind in types.items()])
