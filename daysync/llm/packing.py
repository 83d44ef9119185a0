"""Packs documents into sequences of a fixed number of tokens by exact-complement hashing.

Only the number of pieces of each length matters for the plan, a table of at most
``capacity`` counts however many documents there are. The plan goes through the lengths from
the longest down. What a piece leaves open is looked up in an index of the sums of one, two and
three lengths that are still there, and a combination that fills it exactly is used as
often as its counts allow. Where there is none, the longest length that fits goes in (best fit)
and the lookup starts again with what is left.

Pieces find their place by their number within their length. It is counted within chunks of
a length, so a length that most documents have is dealt to many tasks, and the chunks are
numbered by a sum over their sizes.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daysync.llm import bpe
from daysync.llm.common import extended, fresh, ship, stored

CAPACITY = 2048
#: Pieces per chunk aimed at, and chunks of one length for each shuffle partition at most.
CHUNK = 256
CHUNKS_PER_PARTITION = 8


@dataclass(frozen=True)
class Pattern:
    """``count`` sequences that hold pieces of these lengths, in this order."""

    lengths: tuple[int, ...]
    count: int


class Sums:
    """An index of the sums of one, two and three lengths that are there.

    By sum it holds in how many ordered ways it can be made, each length used at most as often
    as it counts. Counts only fall, and only their steps to two, one and none change the index,
    each in one pass over the sums. So a lookup is one read, and a gap that nothing fills costs no search.
    """

    def __init__(self, counts: dict[int, int], capacity: int):
        self.left = np.zeros(capacity + 1, np.int64)
        for length, n in counts.items():
            self.left[length] = n
        # Ways without regard to counts, then the ways that use a single length more than once.
        self._one = (self.left > 0).astype(np.int64)
        self._two = self._product(self._one, self._one)
        self._three = self._product(self._two, self._one)
        self._single_twice = self._at_multiple(2, self.left == 1)
        self._single_thrice = self._at_multiple(3, self.left == 1)
        self._double_thrice = self._at_multiple(3, self.left == 2)
        self._twice_and_one = self._product(self._single_twice, self._one)

    def _product(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.convolve(a, b)[: len(self.left)]

    def _at_multiple(self, times: int, chosen: np.ndarray) -> np.ndarray:
        at = times * np.flatnonzero(chosen)
        return np.bincount(at[at < len(self.left)], minlength=len(self.left))

    def _shifted(self, ways: np.ndarray, by: int) -> np.ndarray:
        out = np.zeros_like(ways)
        if by < len(out):
            out[by:] = ways[: len(out) - by]
        return out

    def pairs(self, total: int) -> int:
        return int(self._two[total] - self._single_twice[total])

    def triples(self, total: int) -> int:
        # Three times one single length is taken off once for each place of the third.
        thrice = 2 * self._single_thrice[total] - self._double_thrice[total]
        return int(self._three[total] - 3 * self._twice_and_one[total] + thrice)

    def take(self, length: int, n: int = 1) -> None:
        before = min(int(self.left[length]), 3)
        self.left[length] -= n
        for count in range(before, min(int(self.left[length]), 3), -1):
            self._fall(length, count)

    def _fall(self, x: int, count: int) -> None:
        """From ``count`` pieces of a length to one fewer."""
        size = len(self.left)
        if count <= 2:
            sign = 1 if count == 2 else -1
            if 2 * x < size:
                self._single_twice[2 * x] += sign
            if 3 * x < size:
                self._single_thrice[3 * x] += sign
            self._twice_and_one += sign * self._shifted(self._one, 2 * x)
        if count >= 2 and 3 * x < size:
            self._double_thrice[3 * x] += 1 if count == 3 else -1
        if count == 1:  # (a - x)^3 and (a - x)^2, multiplied out
            self._three -= 3 * self._shifted(self._two, x) - 3 * self._shifted(self._one, 2 * x)
            self._two -= 2 * self._shifted(self._one, x)
            self._twice_and_one -= self._shifted(self._single_twice, x)
            self._one[x] = 0
            if 2 * x < size:
                self._two[2 * x] += 1
            if 3 * x < size:
                self._three[3 * x] -= 1

    def filling(self, gap: int) -> tuple[int, ...] | None:
        """One, two or three lengths that are there and fill the gap, the longest first."""
        if self._one[gap]:
            return (gap,)
        if self.pairs(gap):
            return _pair(self.left, gap, gap - 1)
        if not self.triples(gap):
            return None
        for x in (np.flatnonzero(self._one[: gap - 1]))[::-1].tolist():
            if self.pairs(gap - x):
                self.left[x] -= 1
                two = _pair(self.left, gap - x, x)
                self.left[x] += 1
                if two is not None:
                    return (x, *two)
        raise AssertionError(f"the index has a triple of {gap} that is not there")


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    """Patterns that use each length as often as it counts, no sequence over ``capacity``."""
    sums = Sums(counts, capacity)
    left = sums.left
    out = []
    for longest in range(capacity, 0, -1):
        while left[longest]:
            sums.take(longest)
            lengths, gap = [longest], capacity - longest
            while gap:
                filling = sums.filling(gap)
                if filling is None:
                    fits = np.flatnonzero(left[1 : gap + 1])
                    if not len(fits):
                        break
                    filling = (int(fits[-1]) + 1,)
                for x in filling:
                    sums.take(x)
                    lengths.append(x)
                gap -= sum(filling)
            # The same again, as often as every length of it is there.
            each = np.bincount(lengths, minlength=capacity + 1)
            used = np.flatnonzero(each)
            more = int((left[used] // each[used]).min())
            if more:
                for x in used.tolist():
                    sums.take(x, more * int(each[x]))
            out.append(Pattern(tuple(lengths), 1 + more))
    return out


def _pair(left: np.ndarray, gap: int, most: int) -> tuple[int, int] | None:
    """Two lengths of this sum, the longer at most ``most``."""
    low, high = -(-gap // 2), min(most, gap - 1)
    if high < low:
        return None
    long = left[low : high + 1]
    short = left[gap - high : gap - low + 1][::-1]
    both = (long > 0) & (short > 0)
    if 2 * low == gap and left[low] < 2:
        both[0] = False
    at = np.flatnonzero(both)
    return (low + int(at[-1]), gap - low - int(at[-1])) if len(at) else None


@dataclass(frozen=True)
class Places:
    """Where the pieces of each length go: by their number, runs of sequences and offsets."""

    starts: dict[int, list[int]]
    sequences: dict[int, list[int]]
    offsets: dict[int, list[int]]

    def find(self, length: int, number: int) -> tuple[int, int]:
        starts = self.starts[length]
        k = bisect_right(starts, number) - 1
        return self.sequences[length][k] + number - starts[k], self.offsets[length][k]


def places(patterns: list[Pattern]) -> Places:
    used: dict[int, int] = {}
    out = Places({}, {}, {})
    sequence = 0
    for pattern in patterns:
        offset = 0
        for length in pattern.lengths:
            number = used.get(length, 0)
            out.starts.setdefault(length, []).append(number)
            out.sequences.setdefault(length, []).append(sequence)
            out.offsets.setdefault(length, []).append(offset)
            used[length] = number + pattern.count
            offset += length
        sequence += pattern.count
    return out


def cut(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text", capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """``id, piece, start, length, ids_crc32`` of the pieces of each document.

    A document is its ids and ``end_id``. One of over ``capacity`` is cut from its end, so
    that only its first piece is shorter. A null or empty text is ``end_id`` alone, a null id
    stays null, repeated rows are documents each, and other columns are not read. An empty
    table gives an empty result.
    """

    def pieces(block, ids, offsets, _):
        ids = ids.astype("<u4")
        keys = block.column("id").to_pylist()
        rows, bounds = [], offsets.tolist()
        for key, a, b in zip(keys, bounds, bounds[1:], strict=False):
            own = np.append(ids[a:b], np.uint32(end_id)).astype("<u4")
            size = len(own)
            first = size % capacity or min(size, capacity)
            edges = [0, *range(first, size + 1, capacity)]
            for k, (x, y) in enumerate(zip(edges, edges[1:], strict=False)):
                rows.append((key, k, x, y - x, zlib.crc32(own[x:y].tobytes())))
        columns = list(zip(*rows, strict=True)) or [()] * 5
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["id", "piece", "start", "length", "ids_crc32"])

    given = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))
    return bpe.with_ids(given, "text", path, pieces, "id long, piece int, start long, length long, ids_crc32 long", trie=False)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; reads its column ``length``.

    Sequences hold at most ``capacity`` tokens without gaps, in as few sequences as the plan
    finds. Lengths are from 1 to ``capacity``, else an error is raised. Rows that are alike
    are packed each. An empty table gives an empty result.
    """
    spark = pieces.sparkSession
    ship(spark)
    pieces = stored(pieces.drop("sequence_id", "offset"))
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    if any(k is None or not 0 < k <= capacity for k in counts):
        raise ValueError(f"lengths must be from 1 to {capacity}")
    found = spark.sparkContext.broadcast(places(plan(counts, capacity)))
    names = pieces.columns
    size, parts, chunk, n, at = fresh(names, "size", "parts", "chunk", "n", "at")

    # At most ``capacity`` rows, so they can be broadcast. The chunk of a row follows from its
    # content, so it is the same when a task runs again.
    most = CHUNKS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = [(k, min(-(-c // CHUNK), most)) for k, c in counts.items()]
    dealt = spark.createDataFrame(dealt, f"{size} long, {parts} long")
    given = pieces.join(F.broadcast(dealt), pieces["length"] == F.col(size))
    given = stored(given.select(*names, size, F.pmod(F.xxhash64(*names), parts).alias(chunk)))
    sizes = given.groupBy(size, chunk).agg(F.count("*").alias(n))
    before = Window.partitionBy(size).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    sizes = stored(sizes.select(size, chunk, F.coalesce(F.sum(n).over(before), F.lit(0)).alias(n)))
    inside = Window.partitionBy(size, chunk).orderBy(*names)
    numbered = given.withColumn(at, F.row_number().over(inside)).join(sizes, [size, chunk])
    numbered = numbered.select(*names, (F.col(n) + F.col(at) - 1).alias(at))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = found.value.find
        for batch in batches:
            where = [find(*x) for x in zip(batch.column("length").to_pylist(), batch.column(at).to_pylist(), strict=True)]
            columns = [pa.array([w[k] for w in where], pa.int64()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], names=[*names, "sequence_id", "offset"])

    return numbered.mapInArrow(place, extended(pieces, {"sequence_id": "long", "offset": "long"}))
