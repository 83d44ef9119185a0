"""Near-duplicate documents by MinHash with tensored banding.

A table key of ordinary banding is made of ``2 * r`` MinHash values of its own. Here there
are two small collections of ``m`` half keys, each of ``r`` values, and every pair of a half
key of the first and one of the second makes a table: ``m * m`` tables out of ``2 * m * r``
values instead of ``2 * m * m * r``. Texts of similarity ``s`` meet in some table with
probability ``(1 - (1 - s**r) ** m) ** 2``: with the default 4 and 20, all but one pair in
19,000 at a similarity of just 0.8, and all but one in 3 million at 0.86. A half key that
no other text has is left out before pairs are made of it, as its tables hold one text.

Texts with the same words are put into a class, by SHA-256 of the words, before anything is
paired, so a group of copies takes part once. What meets in a table is confirmed on full sets
of the words themselves, so no hash decides on a link:

1. every class with one leader of each of its tables, the class that meets most others;
   confirmed links give components;
2. in tables that still hold several components, pairs between components. Texts there may
   meet by the thousand for a passage they all have. Of a linked pair, either text shares
   with the other all but a few of its shingles, so they share one among the rarest of each,
   and of either text no more than from the first they share on, its rarest first. Pairs are
   therefore joined by their rare shingles with this bound. Where a shingle is one that many
   texts have, they are joined by the size of the smaller text too, in which each takes part only
   where its bound suffices for such sizes, and those of the component that most there are of
   are joined with others only: members of a group that are linked already are not paired, and
   copies that were changed too much to be linked with most of their group drop out before pairing.

So members of a large group that are linked cost a link each, not one per pair, and no table is
cut. Texts around it that are in other components and little farther from it than links reach still
meet by the square of their number, in the join and as pairs to confirm.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daysync.llm.common import blocks, lists, ship, stored
from daysync.llm.components import components
from daysync.llm.shingles import exact_sets, mix, normal, overlap, shingle_sets
from daysync.llm.wordcodes import WordCodes

HALVES = 20
ROWS = 4
#: A shingle that more texts have is frequent; the number changes what is compared, not the result.
FREQUENT = 16
#: Classes of set sizes for each factor of e, where frequent shingles are met; changes no result.
SIZES = 16


def _multipliers(count: int) -> np.ndarray:
    return mix(np.arange(1, count + 1, dtype=np.uint64)) | np.uint64(1)


def signatures(docs: DataFrame, id_column: str, text_column: str, words: int, halves: int = HALVES, rows: int = ROWS) -> DataFrame:
    """``id, n_shingles, digest, a, b`` of each row of a binary text.

    The digest identifies the words, a and b are its half keys. Without words n_shingles is 0
    and the lists are empty.
    """
    ship(docs.sparkSession)
    values = 2 * halves * rows

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors, known = _multipliers(values), WordCodes()
        for batch in batches:
            for block in blocks(batch, "text"):
                texts = _texts(block.column("text"))
                sets = shingle_sets(texts, words, known)
                sizes = np.array([len(s) for s in sets], np.int64)
                full = np.flatnonzero(sizes)
                least = np.zeros((len(full), values), np.uint64)
                if len(full):
                    flat = np.concatenate([sets[k] for k in full])
                    starts = np.cumsum(sizes[full]) - sizes[full]
                    for k in range(values):
                        least[:, k] = np.minimum.reduceat(flat * factors[k], starts)
                half = np.zeros((len(full), 2 * halves), np.uint64)
                for k in range(rows):
                    half = mix(half + least[:, k :: rows])
                offsets = np.concatenate([[0], np.cumsum((sizes > 0) * halves)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        block.column("id"),
                        pa.array(sizes),
                        pa.array([hashlib.sha256(normal(t)).digest() for t in texts], pa.binary()),
                        lists(half[:, :halves].reshape(-1).view(np.int64), offsets, pa.int64()),
                        lists(half[:, halves:].reshape(-1).view(np.int64), offsets, pa.int64()),
                    ],
                    names=["id", "n_shingles", "digest", "a", "b"],
                )

    given = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("binary").alias("text"))
    return given.mapInArrow(sign, "id long, n_shingles long, digest binary, a array<long>, b array<long>")


def _texts(column: pa.Array) -> list[bytes]:
    return [t or b"" for t in column.to_pylist()]


def _exploded(docs: DataFrame, words: int) -> DataFrame:
    """``id, n, h``: each shingle of the texts of ``id, text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordCodes()
        for batch in batches:
            for block in blocks(batch, "text", 1 << 20):
                sets = shingle_sets(_texts(block.column("text")), words, known)
                sizes = np.array([len(x) for x in sets], np.int64)
                ids = np.repeat(block.column("id").to_numpy(), sizes)
                hashes = np.concatenate(sets).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(np.repeat(sizes, sizes)), pa.array(hashes)], names=["id", "n", "h"])

    return docs.mapInArrow(run, "id long, n long, h long")


def _pairs_by_rare_shingles(texts: DataFrame, groups: DataFrame, words: int, percent: int) -> DataFrame:
    """Pairs ``a, b`` of different groups that may be similar enough; no such pair is missing.

    ``texts`` has ``id, text``, one for each set; ``groups`` has ``rep, component``.
    """
    rows = stored(_exploded(texts, words))
    often = stored(rows.groupBy("h").agg(F.count("*").alias("df")).where("df > 1"))
    rows = stored(rows.join(often, "h"))
    # So many of its shingles a text must share with another.
    sums = rows.groupBy("id", "n").agg(F.count("*").alias("shared"))
    sums = sums.where(F.col("shared") * 100 >= F.col("n") * percent)
    ranked = rows.join(stored(sums), ["id", "n"])
    nth = F.row_number().over(Window.partitionBy("id", "n").orderBy("df", "h"))
    # The rarest of a text: those that no other has come first, and are not among the rows.
    most = F.col("shared") - F.ceil(F.col("n") * percent / 100) + 1
    rare = ranked.withColumn("nth", nth).where(F.col("nth") <= most)
    # Where the first shingle that two texts share is its nth, no more than the rest are shared.
    rare = rare.withColumn("bound", F.col("shared") - F.col("nth") + 1)
    rare = stored(rare.join(groups, F.col("id") == F.col("rep")).select("h", "df", "id", "n", "bound", "component"))
    few, many = rare.where(F.col("df") <= FREQUENT).drop("df"), rare.where(F.col("df") > FREQUENT).drop("df")
    smaller, larger = _by_sizes(many, percent)
    found = (
        _meeting(few, few, ["h"], percent)
        .union(_meeting(larger.where("apart"), smaller, ["h", "size"], percent))
        .union(_meeting(larger.where("not apart"), smaller.where("apart"), ["h", "size"], percent))
    )
    return found.distinct()


def _by_sizes(rows: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """``rows`` as the smaller text of a pair and as the larger one, by ``h`` and the class ``size`` of the smaller.

    A row is left out where its bound is too low for any text of the other side. ``apart`` tells
    the rows that are not of the component most rows of their ``h`` and ``size`` have; where all
    are of one, none are returned.
    """
    n, bound = F.col("n"), F.col("bound") * (100 + percent)
    least = F.ceil(n * percent / 100)
    size_of = lambda number: F.floor(F.log(number.cast("double")) * SIZES).cast("int")
    # A little less than the smallest of the class, as logarithms are rounded.
    smallest = F.greatest(least.cast("double"), F.exp(F.col("size") / SIZES) * (1 - 1e-9))
    smaller = rows.where(bound >= n * 2 * percent).withColumn("size", size_of(n))
    larger = rows.withColumn("size", F.explode(F.sequence(size_of(least), size_of(n)))).where(bound >= (n + smallest) * percent)
    sides = stored(smaller.withColumn("smaller", F.lit(True)).unionByName(larger.withColumn("smaller", F.lit(False))))
    counts = sides.groupBy("h", "size", "component").agg(F.count("*").alias("rows"))
    main = counts.groupBy("h", "size").agg(
        F.max_by("component", F.struct("rows", "component")).alias("main"), F.min("component").alias("x"), F.max("component").alias("y")
    )
    main = stored(main.where("x < y").select("h", "size", "main"))
    sides = sides.join(main, ["h", "size"]).withColumn("apart", F.col("component") != F.col("main")).drop("main")
    sides = stored(sides)
    return sides.where("smaller"), sides.where("not smaller")


def _meeting(larger: DataFrame, smaller: DataFrame, on: list[str], percent: int) -> DataFrame:
    """Pairs ``a, b`` of different components, the first no smaller, that may share enough from where they meet."""
    left = larger.select(*on, F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("bound").alias("bound_a"), F.col("component").alias("x"))
    right = smaller.select(*on, F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("bound").alias("bound_b"), F.col("component").alias("y"))
    enough = F.least("bound_a", "bound_b") * (100 + percent) >= (F.col("n_a") + F.col("n_b")) * percent
    pairs = left.join(right, on).where((F.col("x") != F.col("y")) & (F.col("n_a") >= F.col("n_b")) & enough)
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def _confirmed(pairs: DataFrame, texts: DataFrame, words: int, share: Fraction) -> DataFrame:
    """Pairs ``a, b`` of ids whose full sets are similar enough; ``texts`` has ``id, text``."""
    up, down = share.numerator, share.denominator

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordCodes()
        for batch in batches:
            for block in blocks(batch, "text_a"):
                x, y = _texts(block.column("text_a")), _texts(block.column("text_b"))
                sets = exact_sets(x + y, words, known)
                good = []
                for s, t in zip(sets[: len(x)], sets[len(x) :], strict=True):
                    both = overlap(s, t)
                    good.append(both > 0 and down * both >= up * (len(s) + len(t) - both))
                yield block.filter(pa.array(good, pa.bool_())).select(["a", "b"])

    first = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    second = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(first, "a").join(second, "b").select("a", "b", "text_a", "text_b").mapInArrow(verify, "a long, b long")


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    words: int = 5,
    percent: int = 80,
    halves: int = HALVES,
    rows: int = ROWS,
) -> DataFrame:
    """``id, n_shingles, component, kept`` for each row of ``docs``, as whole numbers.

    Rows are linked when ``100 * intersection >= percent * union`` of their shingle sets of
    ``words`` words. ``component`` is the smallest id that links lead to, and ``kept`` marks
    the row that has it.

    Null and blank texts have no shingles and are linked with nothing; a text of fewer words
    than asked for is one shingle. Repeated rows each get a row of the result. Rows that share
    an id count as one document of all their links. A row without id has the component of
    its copies, or none, and is never kept. Other columns are not read, whatever their names.
    An empty table gives an empty result.
    """
    signed = stored(signatures(docs, id_column, text_column, words, halves, rows))
    given = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("binary").alias("text"))
    full = signed.where("n_shingles > 0")
    identity = ["n_shingles", "digest"]
    classes = stored(full.groupBy(*identity).agg(F.min("id").alias("rep")))
    reps = (
        full.withColumnRenamed("id", "rep").join(classes.where("rep is not null"), [*identity, "rep"], "left_semi")
        .dropDuplicates([*identity, "rep"]).select("rep", "a", "b")
    )

    # Half keys that several classes have, and the tables that pairs of them make.
    halves_of = stored(
        reps.select("rep", F.posexplode("a").alias("i", "x")).select("rep", F.lit(0).alias("side"), F.xxhash64(F.lit(0), "i", "x").alias("half"))
        .unionByName(reps.select("rep", F.posexplode("b").alias("i", "x")).select("rep", F.lit(1).alias("side"), F.xxhash64(F.lit(1), "i", "x").alias("half")))
    )
    common = halves_of.groupBy("half").agg(F.min("rep").alias("x"), F.max("rep").alias("y")).where("x < y")
    halves_of = stored(halves_of.join(stored(common.select("half")), "half", "left_semi"))
    first = halves_of.where("side = 0").select("rep", F.col("half").alias("x"))
    second = halves_of.where("side = 1").select("rep", F.col("half").alias("y"))
    tabled = stored(first.join(second, "rep").select("rep", F.xxhash64("x", "y").alias("key")))
    several = tabled.groupBy("key").agg(F.min("rep").alias("x"), F.max("rep").alias("y"), F.count("*").alias("size")).where("x < y")
    met = stored(tabled.join(stored(several.select("key", "size")), "key"))

    # Each with the leader of its tables.
    degrees = stored(met.groupBy("rep").agg(F.sum("size").alias("degree")))
    met = stored(met.join(degrees, "rep").select("key", "rep", "degree"))
    leaders = met.groupBy("key").agg(F.max_by("rep", F.struct("degree", "rep")).alias("leader"))
    pairs = met.join(stored(leaders), "key").where("rep != leader")
    pairs = stored(pairs.select(F.least("rep", "leader").alias("a"), F.greatest("rep", "leader").alias("b")).distinct())
    texts = given.join(degrees.select(F.col("rep").alias("id")), "id", "left_semi")
    texts = stored(texts.dropDuplicates(["id", "text"]))
    share = Fraction(percent, 100)
    linked = stored(_confirmed(pairs, texts, words, share))

    # Between components that share a table.
    found = components(linked)
    at = met.join(found, F.col("rep") == F.col("node"), "left")
    at = stored(at.select("key", "rep", F.coalesce("component", "rep").alias("component")))
    mixed = at.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x < y")
    groups = stored(at.join(stored(mixed.select("key")), "key", "left_semi").select("rep", "component").distinct())
    mixed_texts = texts.join(groups.select(F.col("rep").alias("id")), "id", "left_semi")
    rest = stored(_pairs_by_rare_shingles(mixed_texts, groups, words, percent))
    linked = linked.union(_confirmed(rest.join(pairs, ["a", "b"], "left_anti"), texts, words, share))

    # Classes of one id (rows that repeat it with other texts) belong together.
    found = components(linked)
    placed = classes.join(found, F.col("rep") == F.col("node"), "left")
    placed = stored(placed.select(*identity, F.coalesce("component", "rep").alias("component")))
    out = signed.select("id", *identity).join(placed, identity, "left")
    out = out.select("id", "n_shingles", F.coalesce("component", "id").alias("component"))
    return out.withColumn("kept", F.coalesce(F.col("id") == F.col("component"), F.lit(False)))
