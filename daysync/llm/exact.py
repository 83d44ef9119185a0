"""Exact duplicates by Grace hash deduplication.

Records are dealt to tasks by a hash of their text. A task puts them into an open-addressing
table that compares complete content. When the table outgrows its memory, its entries and
all further records go to spill files by the next bits of the hash, and every file is taken
the same way, until each fits. Equal records meet in the table as one entry with a count, so
a group of copies of any size fits; the same table runs before the shuffle, which therefore
gets a text once for each table that saw it, not once for each copy.

Spill files are the task's own and go with it; a task that is run again writes new ones.
"""

from __future__ import annotations

import hashlib
import os
import pickle
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daysync.llm.common import blocks, extended, fresh, ship, stored

#: Bytes of distinct text that a table holds before it spills.
TABLE_BYTES = 48 << 20
#: Spill files per level, and levels: each takes four bits of the hash's second half.
FANOUT_BITS = 4
LEVELS = 16
#: Bytes that an entry takes besides its text.
ENTRY_BYTES = 200


def normalise(text: str | None) -> bytes:
    """UTF-8 with A-Z lower-cased; null is empty."""
    return (text or "").encode().lower()


class OpenTable:
    """Open addressing with linear probing. An entry is ``[digest, text, top, tops, count]``.

    top is the largest id (None below all), tops how many records have it.
    """

    def __init__(self) -> None:
        self.entries: list[list] = []
        self.slots = [-1] * 1024
        self.bytes = 0

    def add(self, digest: bytes, text: bytes, top: int | None, tops: int, count: int) -> None:
        mask = len(self.slots) - 1
        at = int.from_bytes(digest[:8], "little") & mask
        while (k := self.slots[at]) >= 0:
            entry = self.entries[k]
            if entry[0] == digest:
                if entry[1] != text:
                    raise ValueError("two texts have the same SHA-256")
                _merge(entry, top, tops, count)
                return
            at = (at + 1) & mask
        self.slots[at] = len(self.entries)
        self.entries.append([digest, text, top, tops, count])
        self.bytes += len(text) + ENTRY_BYTES
        if 2 * len(self.entries) > len(self.slots):
            self._grow()

    def _grow(self) -> None:
        self.slots = [-1] * (4 * len(self.slots))
        mask = len(self.slots) - 1
        for k, entry in enumerate(self.entries):
            at = int.from_bytes(entry[0][:8], "little") & mask
            while self.slots[at] >= 0:
                at = (at + 1) & mask
            self.slots[at] = k


def _merge(entry: list, top: int | None, tops: int, count: int) -> None:
    entry[4] += count
    if top == entry[2]:
        entry[3] += tops
    elif entry[2] is None or (top is not None and top > entry[2]):
        entry[2:4] = [top, tops]


def grace(records: Iterator[tuple], folder: str, table_bytes: int = TABLE_BYTES, level: int = 0) -> Iterator[list]:
    """Entries of all distinct texts of ``records``, spilling below ``folder`` as needed."""
    table, files = OpenTable(), None
    try:
        for record in records:
            if files is None:
                table.add(*record)
                if table.bytes > table_bytes and level < LEVELS and len(table.entries) > 1:
                    paths = [os.path.join(folder, f"{level}-{k}") for k in range(1 << FANOUT_BITS)]
                    files = [open(p, "wb") for p in paths]  # noqa: SIM115
                    for entry in table.entries:
                        _spill(files, entry, level)
                    table = OpenTable()
            else:
                _spill(files, record, level)
    finally:
        for f in files or ():
            f.close()
    yield from table.entries
    if files is not None:
        table = OpenTable()
        for path in paths:
            yield from grace(_read(path), folder, table_bytes, level + 1)
            os.unlink(path)


def _spill(files: list, record: tuple, level: int) -> None:
    bits = int.from_bytes(record[0][8:16], "little") >> (FANOUT_BITS * level)
    pickle.dump(tuple(record), files[bits & ((1 << FANOUT_BITS) - 1)], protocol=5)


def _read(path: str) -> Iterator[tuple]:
    with open(path, "rb") as f:
        while True:
            try:
                yield pickle.load(f)  # noqa: S301  written by this task
            except EOFError:
                return


_RECORD = "digest binary, text binary, top long, tops long, size long"
_NAMES = ["digest", "text", "top", "tops", "size"]


def _batches(entries: Iterator[list], with_text: bool, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    kinds = [pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
    use = [k for k in range(5) if with_text or k != 1]
    rows: list[list] = []
    size = 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kinds[k]) for k in use], names=[_NAMES[k] for k in use])

    for entry in entries:
        rows.append(entry)
        size += len(entry[1]) * with_text + 64
        if size > most:
            yield batch()
            rows, size = [], 0
    if rows:
        yield batch()


def classes(docs: DataFrame, id_column: str, text_column: str, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """``digest, top, tops, size`` of each distinct text, stored."""
    ship(docs.sparkSession)

    def before(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def full() -> Iterator[list]:
            table = OpenTable()
            for batch in batches:
                for block in blocks(batch, "text"):
                    ids = block.column("id").to_pylist()
                    for key, text in zip(ids, block.column("text").to_pylist(), strict=True):
                        data = normalise(text)
                        table.add(hashlib.sha256(data).digest(), data, key, 1, 1)
                if table.bytes > table_bytes:
                    yield from table.entries
                    table = OpenTable()
            yield from table.entries

        yield from _batches(full(), True)

    def after(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        records = (
            r for batch in batches for r in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True)
        )
        with tempfile.TemporaryDirectory(prefix="grace-") as folder:
            yield from _batches(grace(records, folder, table_bytes), False)

    given = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))
    met = given.mapInArrow(before, _RECORD).repartition("digest")
    return stored(met.mapInArrow(after, "digest binary, top long, tops long, size long"))


def _digested(docs: DataFrame, text_column: str, name: str) -> DataFrame:
    """``docs`` with the SHA-256 of the normalised text instead of the text, or beside it."""
    schema = extended(docs, {name: "string"})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, text_column):
                texts = block.column(text_column).to_pylist()
                digests = pa.array([hashlib.sha256(normalise(t)).hexdigest() for t in texts], pa.string())
                yield pa.RecordBatch.from_arrays([*block.columns, digests], names=[*block.schema.names, name])

    return docs.mapInArrow(add, schema)


def exact_groups(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", table_bytes: int = TABLE_BYTES) -> DataFrame:
    """``id, keep, group_size, kept, sha256`` for each row of ``docs``.

    Texts are equal when identical after lower-casing A-Z. ``keep`` is the largest id of the
    group. Null counts as empty text. Null ids are smaller than any; a group of only such
    rows has a null ``keep`` and keeps one of them. Of rows that repeat both id and text one
    is kept. Other columns are not read. An empty table gives an empty result.
    """
    found = classes(docs, id_column, text_column, table_bytes)
    given = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))
    rows = _digested(given, "text", "sha256").select("id", "sha256")
    out = rows.join(found.withColumn("sha256", F.lower(F.hex("digest"))), "sha256")
    top = F.col("id").eqNullSafe(F.col("top"))
    # Rows that repeat the id that stays are alike in all but ``kept``: made from their number.
    single = out.where(~(top & (F.col("tops") > 1))).withColumn("kept", top)
    many = found.where("tops > 1").select(
        F.col("top").alias("id"), F.lower(F.hex("digest")).alias("sha256"), "top", "size",
        F.explode(F.sequence(F.lit(1).cast("long"), "tops")).alias("nth"),
    ).withColumn("kept", F.col("nth") == 1)
    columns = ["id", F.col("top").alias("keep"), F.col("size").alias("group_size"), "kept", "sha256"]
    return single.select(*columns).unionByName(many.select(*columns))


def deduplicate(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", table_bytes: int = TABLE_BYTES) -> DataFrame:
    """The rows of ``docs`` that ``exact_groups`` keeps, with all their columns.

    One row of each text stays: the one with the largest id, one without id only if no row
    of the text has one, and of rows that repeat both id and text any one. Columns may have
    any names. An empty table gives an empty result.
    """
    name, top, tops = fresh(docs.columns, "sha256", "top", "tops")
    found = classes(docs, id_column, text_column, table_bytes)
    stay = found.select(F.lower(F.hex("digest")).alias(name), F.col("top").alias(top), F.col("tops").alias(tops))
    rows = _digested(docs, text_column, name).join(stay, name)
    rows = rows.where(F.col(id_column).cast("long").eqNullSafe(F.col(top)))
    once = rows.where(F.col(tops) == 1)
    again = rows.where(F.col(tops) > 1).dropDuplicates([name])
    return once.unionByName(again).select(*docs.columns)
