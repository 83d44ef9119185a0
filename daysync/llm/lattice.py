"""Near-duplicate vectors by lattice hashing.

In each of several tables a vector is projected at random to blocks of eight dimensions and
each block is decoded to the nearest point of the E8 lattice; the points are its cell. The
vector is also put into the neighbouring cells whose points are next nearest to it. Vectors
of one label that share a cell of a table are compared by cosine in double precision.

Equal vectors are put into a class first. Of the rest only cells with several classes are
looked at. A cell of many is dealt to tasks by pairs of chunks, so that no task has more
than two chunks and every pair of the cell is compared; what leaves a task is a count and a
root for each vector, not a row for each pair. A pair that shares several cells counts in
the smallest of them only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daysync.llm.common import lists, ship, stored
from daysync.llm.components import components
from daysync.llm.shingles import mix

#: Vectors of one chunk of a cell.
CHUNK = 512


@dataclass(frozen=True)
class Lattice:
    """Tables, blocks of eight dimensions in each, cells for a vector in each, cell width.

    With the default values, fewer than one in 1,000 pairs at a cosine of 0.93 in 64 dimensions
    share no cell (``tests/llm`` measures it), and one in 1,000 pairs at a cosine of 0 share
    one. More rows per label ask for more blocks and tables.
    """

    tables: int = 10
    blocks: int = 2
    cells: int = 6
    width: float = 1.9
    seed: int = 7


def _minimal_vectors() -> np.ndarray:
    """The 240 shortest vectors of E8, each of squared length 2."""
    out = []
    for i in range(8):
        for j in range(i + 1, 8):
            for a in (-1, 1):
                for b in (-1, 1):
                    v = np.zeros(8)
                    v[[i, j]] = a, b
                    out.append(v)
    for bits in range(256):
        signs = np.array([1 - 2 * (bits >> k & 1) for k in range(8)])
        if signs.prod() > 0:
            out.append(signs / 2)
    return np.array(out)


def nearest_e8(y: np.ndarray) -> np.ndarray:
    """The E8 point nearest to each row: whole numbers or halves, with an even sum."""
    best, distance = None, None
    for shift in (0.0, 0.5):
        point = np.round(y - shift)
        off = y - shift - point
        rows = np.flatnonzero(point.sum(1) % 2)
        worst = np.abs(off[rows]).argmax(1)
        point[rows, worst] += np.where(off[rows, worst] >= 0, 1, -1)
        point += shift
        d = ((y - point) ** 2).sum(1)
        if best is None:
            best, distance = point, d
        else:
            closer = d < distance
            best = np.where(closer[:, None], point, best)
    return best


def cells(x: np.ndarray, labels: np.ndarray, lattice: Lattice) -> np.ndarray:
    """Keys of the cells of unit vectors, ``tables * cells`` in a row, those of a table together."""
    n, d = x.shape
    minimal = _minimal_vectors()
    count = min(lattice.cells, 1 + lattice.blocks * len(minimal))
    out = np.zeros((n, lattice.tables, count), np.uint64)
    rng = np.random.default_rng([lattice.seed, d])
    for t in range(lattice.tables):
        scale = rng.standard_normal((d, 8 * lattice.blocks)) / lattice.width
        points, gains = [], []
        for k in range(lattice.blocks):
            y = x @ scale[:, 8 * k : 8 * k + 8]
            point = nearest_e8(y)
            points.append(point)
            gains.append((y - point) @ minimal.T)  # the more, the nearer is the point beyond
        gain = np.concatenate(gains, axis=1)
        order = np.argsort(-gain, axis=1, kind="stable")[:, : count - 1]
        base = np.concatenate(points, axis=1)
        for c in range(count):
            moved = base.copy()
            if c:
                k, m = np.divmod(order[:, c - 1], len(minimal))
                for block in range(lattice.blocks):
                    rows = k == block
                    moved[rows, 8 * block : 8 * block + 8] += minimal[m[rows]]
            key = mix(labels.astype(np.int64).view(np.uint64) + np.uint64((t + 1) << 48))
            for column in (2 * moved).astype(np.int64).view(np.uint64).T:
                key = mix(key * np.uint64(31) + column)
            out[:, t, c] = key
    return out.reshape(n, -1)


def _matrix(column: pa.Array) -> list[np.ndarray]:
    """Rows as arrays of doubles; empty where a row is null, empty, zero or not finite."""
    out = []
    for value in column.to_pylist():
        x = np.zeros(0)
        if value and None not in value:
            with np.errstate(over="ignore", invalid="ignore"):
                given = np.array(value, float)
                # First by the largest component, so that squares neither overflow nor vanish.
                top = np.abs(given).max()
                if np.isfinite(top) and top > 0:
                    x = given / top
                    x = x / np.sqrt((x * x).sum())
        out.append(x)
    return out


def _keyed(vectors: DataFrame, lattice: Lattice) -> DataFrame:
    """``rep, keys`` of ``rep, label, vector``; no row where nothing can be compared."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _matrix(batch.column("vector"))
            labels = batch.column("label").to_numpy(zero_copy_only=False)
            for size in sorted({len(x) for x in rows} - {0}):
                at = np.array([k for k, x in enumerate(rows) if len(x) == size])
                # Vectors of another length are never compared: the length is part of the label.
                keys = cells(np.array([rows[k] for k in at]), labels[at] + size * (1 << 32), lattice)
                keys = np.sort(keys.view(np.int64), axis=1)
                offsets = np.arange(len(at) + 1) * keys.shape[1]
                yield pa.RecordBatch.from_arrays([batch.column("rep").take(pa.array(at)), lists(keys.reshape(-1), offsets, pa.int64())], names=["rep", "keys"])

    return vectors.mapInArrow(run, "rep long, keys array<long>")


def _smallest_shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest key that each row of ``a`` shares with that of ``b``; both sorted."""
    both = np.sort(np.concatenate([a, b], axis=1), axis=1)
    twin = both[:, 1:] == both[:, :-1]
    return both[np.arange(len(both)), twin.argmax(1)]


def _linked(x: np.ndarray, keys: np.ndarray, side: np.ndarray, copies: np.ndarray, key: int, across: bool, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Of the vectors of a cell: links counted here, and the first vector each is joined to."""
    close = x @ x.T >= least
    np.fill_diagonal(close, False)
    if across:
        close &= side[:, None] != side[None, :]
    a, b = np.nonzero(np.triu(close))
    counts = np.zeros(len(x), np.int64)
    for first in range(0, len(a), 20_000):
        p, q = a[first : first + 20_000], b[first : first + 20_000]
        own = _smallest_shared(keys[p], keys[q]) == key
        np.add.at(counts, p[own], copies[q[own]])
        np.add.at(counts, q[own], copies[p[own]])
    roots = np.arange(len(x))
    while len(a):
        lower = roots.copy()
        np.minimum.at(lower, a, roots[b])
        np.minimum.at(lower, b, roots[a])
        lower = lower[lower]
        if (lower == roots).all():
            break
        roots = lower
    return counts, roots


def near_vectors(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
    least: float = 0.93,
    lattice: Lattice | None = None,
    chunk: int = CHUNK,
) -> DataFrame:
    """``id, n_links, component, kept`` for each row of ``vectors``.

    Rows of an equal label are linked when the cosine of their vectors is ``least`` or more.
    n_links counts the rows linked directly, component is the smallest id that links lead to,
    kept marks the row that has it.

    A row is linked with nothing when its label is null, or its vector is null, empty, zero
    or has a null or non-finite component; vectors of different length are not compared.
    Repeated rows are vectors of their own. Rows that share an id count as one in components.
    A row without id has links but is never kept. Other columns are not read. An empty table
    gives an empty result.
    """
    lattice = lattice or Lattice()
    ship(vectors.sparkSession)
    given = stored(
        vectors.select(
            F.col(id_column).cast("long").alias("id"), F.col(label_column).cast("long").alias("label"),
            F.col(vector_column).cast("array<double>").alias("vector"),
        ).withColumn("digest", F.sha2(F.array_join("vector", ",", "null"), 256))
    )
    usable = given.where("label is not null and vector is not null")
    classes = usable.groupBy("label", "digest").agg(F.min("id").alias("least_id"), F.count("*").alias("copies"), F.first("vector").alias("vector"))
    classes = stored(classes.withColumn("rep", F.monotonically_increasing_id()))
    keyed = stored(_keyed(classes.select("rep", "label", "vector"), lattice))
    each = keyed.select("rep", F.explode(F.array_distinct("keys")).alias("key"))
    sizes = stored(each.groupBy("key").agg(F.count("*").alias("size")).where("size > 1"))
    parts = F.ceil(F.col("size") / chunk).cast("int")
    placed = each.join(sizes, "key").withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64("key", "rep"), "parts").cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")
    placed = placed.select("rep", "key", "part", other)
    placed = placed.select("rep", "key", "part", F.least("part", "other").alias("lo"), F.greatest("part", "other").alias("hi"))
    full = placed.join(classes.select("rep", "vector", "copies").join(keyed, "rep"), "rep")
    full = full.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []

        def groups(table: pa.Table, last: bool) -> Iterator[pa.RecordBatch]:
            """The result for all groups of the table but the last one, which may go on."""
            key, lo, hi = (table.column(c).to_numpy() for c in ("key", "lo", "hi"))
            new = np.flatnonzero((key[1:] != key[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])) + 1
            edges = [0, *new.tolist(), table.num_rows]
            stop = edges[-1] if last else edges[-2]
            rep, side, copies = (table.column(c).to_numpy() for c in ("rep", "part", "copies"))
            rows = _matrix(table.column("vector").combine_chunks().slice(0, stop))
            keys = table.column("keys").combine_chunks().slice(0, stop)
            keys = keys.flatten().to_numpy().reshape(stop, -1) if stop else None
            out = []
            for a, b in zip(edges, edges[1:], strict=False):
                if b <= stop and b - a > 1:
                    x = np.array(rows[a:b])
                    counts, roots = _linked(x, keys[a:b], side[a:b], copies[a:b], key[a], lo[a] != hi[a], least)
                    some = np.flatnonzero((counts > 0) | (roots != np.arange(b - a)))
                    out.append((rep[a:b][some], counts[some], rep[a:b][roots[some]]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], names=["rep", "links", "root"])
            waiting[:] = table.slice(stop).combine_chunks().to_batches() if stop < table.num_rows else []

        for batch in batches:
            for first in range(0, batch.num_rows, 2048):
                waiting.append(batch.slice(first, 2048))
                yield from groups(pa.Table.from_batches(waiting), False)
        if waiting:
            yield from groups(pa.Table.from_batches(waiting), True)

    compared = stored(full.select("key", "lo", "hi", "part", "rep", "copies", "vector", "keys").mapInArrow(compare, "rep long, links long, root long"))
    links = compared.groupBy("rep").agg(F.sum("links").alias("links"))
    found = components(compared.select("rep", "root").distinct(), "rep", "root")
    grouped = classes.select("rep", "label", "digest", "least_id", "copies").join(keyed.select("rep", F.lit(True).alias("valid")), "rep", "left")
    grouped = grouped.join(links, "rep", "left").join(found, F.col("rep") == F.col("node"), "left")
    grouped = stored(grouped.select("label", "digest", "least_id", "copies", "valid", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "rep").alias("group")))
    smallest = stored(grouped.groupBy("group").agg(F.min("least_id").alias("smallest")))
    grouped = stored(
        grouped.where("valid").join(smallest, "group")
        .select("label", "digest", (F.col("links") + F.col("copies") - 1).alias("n_links"), "smallest")
    )
    out = given.select("id", "label", "digest").join(grouped, ["label", "digest"], "left")
    out = out.select("id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("smallest", "id").alias("component"))
    return out.withColumn("kept", F.coalesce(F.col("id") == F.col("component"), F.lit(False)))
