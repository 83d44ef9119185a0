"""What the operators share: tables in the shared folder, and text in Arrow batches."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DataType, StructField, StructType

from daysync.session import work_folder
from daysync.sources.files import Folder

#: Bytes of text that a task handles at a time. A longer text makes a block of its own.
BLOCK_BYTES = 4 << 20

_shipped: set[str] = set()

#: Paths that ``stored`` wrote, for each open ``scratch``.
_scratches: list[list[str]] = []


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors once, so that their Python can import it."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if os.path.isdir(package):  # else it was itself loaded from a file that Spark sent
        path = os.path.join(tempfile.mkdtemp(prefix="daysync-"), "daysync.zip")
        with zipfile.ZipFile(path, "w") as archive:
            for folder, _, names in os.walk(package):
                for name in names:
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        archive.write(full, os.path.relpath(full, os.path.dirname(package)))
        context.addPyFile(path)
    _shipped.add(context.applicationId)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables that ``stored`` makes inside are deleted at the end, failed or not.

    What is to last has to be written by then: frames of inside read deleted tables afterwards.
    """
    made: list[str] = []
    _scratches.append(made)
    try:
        yield
    finally:
        _scratches.pop()
        for path in made:
            Folder(spark, path).drop("")


def stored(df: DataFrame, lasting: bool = False) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, safe from lost executors.

    It stays there unless a ``scratch`` is open; a ``lasting`` one stays anyway.
    """
    spark = df.sparkSession
    path = work_folder(spark)
    if _scratches and not lasting:
        _scratches[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string array and where each row begins, nulls as empty texts.

    The second array has one entry more than rows, the last is the end.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], np.int64 if wide else np.int32)
    offsets = offsets[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(batch: pa.RecordBatch, column: str, most: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts have at most ``most`` bytes, or one row."""
    _, offsets = text_buffers(batch.column(column))
    first, rows = 0, batch.num_rows
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1
        last = min(max(last, first + 1), rows)
        yield batch.slice(first, last - first)
        first = last


def lists(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """A list column out of the values of all rows and where each row begins."""
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def fresh(columns: list[str], *names: str) -> list[str]:
    """The names, each lengthened until no column has it in any spelling."""
    taken = {c.lower() for c in columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def extended(df: DataFrame, kinds: dict[str, str]) -> StructType:
    """The schema of ``df`` and further columns of these types."""
    return StructType([*df.schema.fields, *(StructField(name, DataType.fromDDL(kind)) for name, kind in kinds.items())])
