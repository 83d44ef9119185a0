"""Whitening of vectors by Chebyshev-filtered subspace iteration.

Vectors become whole numbers first, so what is one vector and what the means are is exact.
The covariance ``V`` of the distinct vectors is never formed: one pass over them multiplies it
with a block of ``b`` vectors, every task returning the sums of its rows, which are centred
before they are multiplied. What comes back to the driver is as large as the block.

Passes follow the three-term recurrence of Chebyshev polynomials, scaled to the part of the
spectrum that is not wanted: there they stay below one in size, and above it they grow as
fast as any polynomial can. After each filter the block is made orthonormal (QR), rotated to
the eigenvectors of ``V`` within it (Rayleigh-Ritz), and the border of the unwanted part is set
anew from its last value. The components are certified when ``V q - e q`` of each is as short as
rounding allows, and a fresh random block, kept orthogonal to them and filtered likewise, has no
greater value than the last of them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daysync.llm.common import ship, stored

COMPONENTS = 16
STEPS = 64
SHIFT = 1_000_000
#: Least degree of a filter. It rises where the last component and the unwanted part lie close.
DEGREE = 8
#: Logarithm of what a filter of a raised degree multiplies the last component by, at least.
GAIN = 4.0
MOST_DEGREE = 256
#: Logarithm of how much more a filter multiplies the first component by than the last, at most.
RANGE = 16.0
#: Length of a residual, in parts of the greatest eigenvalue, at which a component is certified.
TOLERANCE = 1e-14
#: Filters at most; after the last an error says what is left.
MOST_FILTERS = 200
#: Entries are kept between plus and minus this, so that they are whole numbers of 64 bits.
_EDGE = 1 << 62


def _whole(vector: list | None, steps: int, shift: int) -> list[int] | None:
    """The vector in whole numbers; null where it is null, empty, or has an entry that is no number."""
    if not vector or None in vector:
        return None
    values = np.array(vector, float)
    if not np.isfinite(values).all():
        return None
    with np.errstate(over="ignore"):
        floors = np.floor(values * steps)
    if np.abs(floors).max() < 1 << 52:
        return (floors.astype(np.int64) + shift).tolist()
    return [max(-_EDGE, min(_EDGE, (int(v) if np.isfinite(v) else (_EDGE if v > 0 else -_EDGE)) + shift)) for v in floors.tolist()]


def _packed(whole: list[int], shift: int) -> bytes:
    """Equal vectors, and only they, have equal bytes: as few for an entry as the largest asks for."""
    values = np.array(whole, np.int64) - shift
    for kind in ("<i1", "<i2", "<i4", "<i8"):
        short = values.astype(kind)
        if (short == values).all():
            return kind[-1].encode() + short.tobytes()
    raise AssertionError("all fit eight bytes")


def _unpacked(column: pa.Array) -> np.ndarray:
    """Rows of packed vectors of one size, without the shift."""
    return np.array([np.frombuffer(v, f"<i{chr(v[0])}", offset=1).astype(np.int64) for v in column.to_pylist()])


def coded(vectors: DataFrame, id_column: str, vector_column: str, steps: int = STEPS, shift: int = SHIFT) -> DataFrame:
    """``id, size, code`` of the rows whose vector can be used."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 4096):
                block = batch.slice(first, 4096)
                rows = [_whole(v, steps, shift) for v in block.column("vector").to_pylist()]
                at = [k for k, r in enumerate(rows) if r is not None]
                sizes, codes = [len(rows[k]) for k in at], [_packed(rows[k], shift) for k in at]
                yield pa.RecordBatch.from_arrays([block.column("id").take(pa.array(at, pa.int64())), pa.array(sizes, pa.int32()), pa.array(codes, pa.binary())], names=["id", "size", "code"])

    given = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast("array<double>").alias("vector"))
    return given.mapInArrow(run, "id long, size int, code binary")


def _gathered(distinct: DataFrame, most: int = 4096) -> DataFrame:
    """``kind, codes``: packed vectors of one kind one after the other, many to a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by: dict[int, list[bytes]] = {}
            for code in batch.column("code").to_pylist():
                by.setdefault(code[0], []).append(code[1:])
            for kind, codes in by.items():
                for first in range(0, len(codes), most):
                    joined = b"".join(codes[first : first + most])
                    yield pa.RecordBatch.from_arrays([pa.array([kind], pa.int32()), pa.array([joined], pa.binary())], names=["kind", "codes"])

    return distinct.mapInArrow(run, "kind int, codes binary")


def _vectors(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[np.ndarray]:
    """Blocks of vectors out of ``_gathered`` rows."""
    for batch in batches:
        for kind, codes in zip(batch.column("kind").to_pylist(), batch.column("codes"), strict=True):
            yield np.frombuffer(codes.as_buffer(), f"<i{chr(kind)}").reshape(-1, size).astype(np.int64)


@dataclass(frozen=True)
class Centre:
    """Number of distinct vectors, and their sums without the shift, as Python's whole numbers."""

    n: int
    sums: list[int]

    def rows(self, whole: np.ndarray) -> np.ndarray:
        """Vectors less the mean. The whole part of the mean goes first, which is exact."""
        base = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([(s % self.n) / self.n for s in self.sums])
        if len(whole) and np.abs(whole).max() >= 1 << 61:
            return (whole.astype(object) - base.astype(object)).astype(float) - rest
        return (whole - base) - rest

    def deviations(self, whole: np.ndarray) -> list[int]:
        """The squared length of ``n * x - sums`` of each vector, exact."""
        far = max([1, *(abs(s) for s in self.sums), *([int(np.abs(whole).max()) * self.n] if len(whole) else [])])
        if 4 * far * far * len(self.sums) < 1 << 62:
            apart = whole * self.n - np.array(self.sums, np.int64)
            return (apart * apart).sum(1).tolist()
        return [sum((self.n * x - s) ** 2 for x, s in zip(row, self.sums, strict=True)) for row in whole.tolist()]


Sums = Callable[[np.ndarray], np.ndarray]


def _summed(fit: DataFrame, centre: Centre, sums: Sums) -> np.ndarray:
    """The matrices that ``sums`` makes of the centred rows of each block, added up.

    A task returns one matrix, and rows of equal number are added before they reach the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for whole in _vectors(batches, len(centre.sums)):
            part = sums(centre.rows(whole))
            total = part if total is None else total + part
        if total is not None:
            rows = pa.array(total.tolist(), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), rows], names=["row", "part"])

    parts = fit.mapInArrow(run, "row long, part array<double>")
    each = parts.select("row", F.posexplode("part").alias("column", "x")).groupBy("row", "column").agg(F.sum("x").alias("x"))
    found = each.toArrow()
    rows, columns = found.column("row").to_numpy(), found.column("column").to_numpy()
    out = np.zeros((rows.max() + 1, columns.max() + 1))
    out[rows, columns] = found.column("x").to_numpy()
    return out


@dataclass(frozen=True)
class Whitening:
    centre: Centre
    size: int
    values: np.ndarray
    vectors: np.ndarray  # a column for each component
    trace: float
    identity_error: float
    passes: int

    def rows(self, whole: np.ndarray) -> np.ndarray:
        return self.centre.rows(whole) @ (self.vectors / np.sqrt(self.values))


def subspace(
    times: Callable[[np.ndarray], np.ndarray],
    size: int,
    trace: float,
    count: int,
    degree: int = DEGREE,
    tolerance: float = TOLERANCE,
    seed: int = 7,
) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest eigenvalues and eigenvectors of the symmetric matrix that ``times`` multiplies with.

    Values that are zero, but for rounding, are left out. The matrix has no negative ones.
    """
    rng = np.random.default_rng(seed)
    count = min(count, size)
    block = min(size, 3 * count)  # the more, the fewer passes

    def ritz(q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        q, _ = np.linalg.qr(q)
        product = times(q)
        inner = q.T @ product
        values, turn = np.linalg.eigh((inner + inner.T) / 2)
        turn = turn[:, ::-1]
        return values[::-1], q @ turn, product @ turn

    def filtered(by: Callable, q: np.ndarray, product: np.ndarray, border: float, top: float, steps: int) -> np.ndarray:
        """The polynomial on [0, border], scaled to one at ``top``; ``product`` is the matrix times ``q``."""
        half = border / 2
        sigma = first = half / (top - half)
        before, now = q, (product - half * q) * (sigma / half)
        for _ in range(steps - 1):
            after = 1 / (2 / first - sigma)
            before, now = now, 2 * (after / half) * (by(now) - half * now) - sigma * after * before
            sigma = after
        return now

    def growth(value: float, border: float) -> float:
        """Logarithm of what each degree multiplies the vector of a value beyond the border by."""
        return float(np.arccosh(max(1.0, 2 * value / border - 1)))

    values, q, product = ritz(rng.standard_normal((size, block)))
    floor = size * np.finfo(float).eps * trace
    best = np.inf
    for _ in range(MOST_FILTERS):
        wanted = int((values[:count] > floor).sum())
        top = values[0]
        worst = np.linalg.norm(product - q * values, axis=0)[:wanted].max(initial=0.0)
        border = max(values[-1], floor)
        # Below the tolerance it goes on for as long as it still gets better.
        done = worst <= tolerance * top or (worst <= 100 * tolerance * top and worst > best / 2)
        if block == size or done or border >= top:
            break
        best = min(best, worst)
        high, low = growth(top, border), growth(values[max(wanted, 1) - 1], border)
        steps = min(MOST_DEGREE, max(degree, GAIN / max(low, 1e-9)))
        # More would drown the last component in the first.
        steps = max(1, int(min(steps, RANGE / max(high - low, 1e-9))))
        values, q, product = ritz(filtered(times, q, product, border, top, steps))
    else:
        raise ArithmeticError(f"after {MOST_FILTERS} filters a residual of {worst:.3g} is left")
    found, kept = q[:, :wanted], values[:wanted]
    if wanted == count and border < kept[-1]:
        # Nothing greater than the last component may be left beside them.
        def beside(x: np.ndarray) -> np.ndarray:
            y = times(x - found @ (found.T @ x))
            return y - found @ (found.T @ y)

        probe, _ = np.linalg.qr(beside(rng.standard_normal((size, min(4, size - count)))))
        probe, _ = np.linalg.qr(filtered(beside, probe, beside(probe), border, kept[-1], degree))
        rest = np.linalg.eigvalsh(probe.T @ beside(probe)).max()
        if rest > kept[-1] + 1000 * tolerance * kept[0]:
            raise ArithmeticError(f"a direction of variance {rest:.6g} was missed beside the last component, {kept[-1]:.6g}")
    signs = np.sign(found[np.abs(found).argmax(0), np.arange(found.shape[1])])
    return kept, found * signs


def _most_common_size(rows: DataFrame) -> int | None:
    sizes = rows.groupBy("size").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "size").limit(1).collect()
    return sizes[0]["size"] if sizes else None


def fit(rows: DataFrame, count: int = COMPONENTS) -> Whitening | None:
    """The whitening of the distinct vectors of ``coded`` rows of one size; None without rows."""
    ship(rows.sparkSession)
    size = _most_common_size(rows)
    if size is None:
        return None
    distinct = stored(_gathered(rows.where(F.col("size") == size).select("code").distinct()))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, [0] * size
        for whole in _vectors(batches, size):
            wide = int(np.abs(whole).max(initial=0)) >= 1 << 48
            part = whole.astype(object).sum(0) if wide else whole.sum(0)
            n, sums = n + len(whole), [a + int(b) for a, b in zip(sums, part, strict=True)]
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size + 1)), pa.array([str(x) for x in [*sums, n]])], names=["at", "x"])

    sums = distinct.mapInArrow(add, "at long, x string").groupBy("at").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("x"))
    exact = [int(r["x"]) for r in sums.orderBy("at").collect()]
    centre = Centre(exact[-1], exact[:-1])
    n = centre.n
    passes = 0

    def times(q: np.ndarray) -> np.ndarray:
        nonlocal passes
        passes += 1
        return _summed(distinct, centre, lambda x: x.T @ (x @ q)) / n

    trace = float(_summed(distinct, centre, lambda x: (x * x).sum(keepdims=True))[0, 0] / n)
    values, vectors = subspace(times, size, trace, count) if trace > 0 else (np.zeros(0), np.zeros((size, 0)))
    error = 0.0
    if len(values):
        scaled = vectors / np.sqrt(values)
        # The last row has the sums, to centre what was rounded.
        both = _summed(distinct, centre, lambda x: np.vstack([(x @ scaled).T @ (x @ scaled), (x @ scaled).sum(0)]))
        mean = both[-1] / n
        error = float(np.abs(both[:-1] / n - np.outer(mean, mean) - np.eye(len(values))).max())
    return Whitening(centre, size, values, vectors, trace, error, passes)


_COLUMNS = "id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whitened(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    count: int = COMPONENTS,
    steps: int = STEPS,
    shift: int = SHIFT,
) -> DataFrame:
    """``id, component, n, deviation, whitened, explained, identity_error``: a row for each row and component.

    An entry ``c`` counts as ``floor(steps * c) + shift``. Components are those of the distinct
    vectors, by falling variance; ``whitened`` is the place of the centred vector along one, over its
    standard deviation. ``deviation`` is exact, and null where it passes 64 bits.

    Rows drop out whose vector is null, empty, or has a null or non-finite entry, or another
    length than most rows have (of lengths as frequent, the smallest counts). Entries beyond 62
    bits count as that. A row without id and repeated rows are rows like others; equal vectors
    are fitted once. Directions without variance are no components, so one vector alone, or an
    empty table, gives no rows. Other columns are not read, whatever their names.
    """
    spark = vectors.sparkSession
    ship(spark)
    rows = coded(vectors, id_column, vector_column, steps, shift)
    found = fit(rows, count)
    if found is None or not len(found.values):
        return spark.createDataFrame([], _COLUMNS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(found.values)
        for batch in batches:
            for first in range(0, batch.num_rows, 2048):
                block = batch.slice(first, 2048)
                whole = _unpacked(block.column("code"))
                deviations = [d if d < 1 << 63 else None for d in found.centre.deviations(whole)]
                m = len(whole)
                columns = [
                    block.column("id").take(pa.array(np.repeat(np.arange(m), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, found.centre.n)), pa.array(deviations, pa.int64()).take(pa.array(np.repeat(np.arange(m), k))),
                    pa.array(found.rows(whole).reshape(-1)), pa.array(np.tile(found.values / found.trace, m)),
                    pa.array(np.full(m * k, found.identity_error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in _COLUMNS.split(", ")])

    return rows.where(F.col("size") == found.size).mapInArrow(run, _COLUMNS)
