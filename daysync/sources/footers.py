"""The columns of a table's days, from the footers of all files, read by the executors in one job."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

if TYPE_CHECKING:
    import pyarrow as pa

#: Fixed value: where Spark keeps the columns in a footer.
SPARK_COLUMNS = b"org.apache.spark.sql.parquet.row.metadata"

#: Python's names of file systems that Hadoop calls otherwise.
SCHEMES = {"s3a": "s3", "s3n": "s3", "abfss": "abfs"}


def _reader(key: bytes, schemes: dict[str, str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Reads the footers of ``path``; a function of its own, as executors need not have this package."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from urllib.parse import quote

        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyarrow import fs

        def columns(path: str) -> str | None:
            scheme, _, rest = path.partition(":")
            try:
                if scheme == "file":
                    files, inner = fs.LocalFileSystem(), "/" + rest.lstrip("/")
                else:
                    files, inner = fs.FileSystem.from_uri(f"{schemes.get(scheme, scheme)}:{quote(rest)}")
                with files.open_input_file(inner) as file:
                    kept = pq.read_metadata(file).metadata or {}
            except (OSError, pa.ArrowException):
                return None  # out of Python's reach or no Parquet file: Spark has a look, and an error if need be
            return kept[key].decode() if key in kept else None

        for batch in batches:
            found = [columns(path) for path in batch.column("path").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("shard"), batch.column("path"), pa.array(found, pa.string())], names=["shard", "path", "columns"]
            )

    return run


def footers(files: DataFrame) -> DataFrame:
    """``(shard, columns, path)``: each set of columns, as JSON, that files of a day declare, and the first such file.

    ``files`` has ``shard`` and ``path``. ``columns`` is NULL for files that Spark did not write
    or that Python cannot open. Tasks cut their files to one row per set of columns before the shuffle.
    """
    read = files.select(F.col("shard").cast("string").alias("shard"), "path")
    each = read.mapInArrow(_reader(SPARK_COLUMNS, SCHEMES), "shard string, path string, columns string")
    return each.groupBy("shard", "columns").agg(F.min("path").alias("path"))


def by_spark(spark: SparkSession, folder: str) -> T.StructType:
    """The columns of a folder's files as Spark merges them, a job of its own."""
    return spark.read.option("mergeSchema", "true").parquet(folder).schema


def declared(found: Iterable[str | None]) -> list[T.StructType] | None:
    """The sets of columns of one day; None where Spark has to say, which knows files of others and spellings."""
    schemas = []
    for text in found:
        if text is None:
            return None
        schemas.append(T.StructType.fromJson(json.loads(text)))
    names = {name for schema in schemas for name in schema.names}
    return schemas if len({name.lower() for name in names}) == len(names) else None
