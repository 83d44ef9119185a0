"""Phrases whose words keep company, from counts of a truncated suffix tree built in parts.

The tree of all suffixes of the texts, cut at ``longest`` words, is partitioned vertically: each
part holds the suffixes that begin with one prefix of words, and is built apart from the
others. Only prefixes that are frequent enough have a part at all. Words are counted first and
then pairs of frequent words; a suffix ends where its next pair of words is infrequent, as no
phrase across it can be a candidate. Tasks know frequent words and pairs by a filter of a
fixed number of bits, which may let others pass but loses none.

A prefix is two words. Where more suffixes begin with it than the budget allows, a fraction of
a shuffle partition, its parts have prefixes of three words, and then of four; so many
prefixes are over the budget at most that their list can be broadcast. A task puts the parts
it gets into groups up to a number of suffixes that fit in memory, builds the subtrees of a
group by sorting and reads the count of each node from the leaves below it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daysync.llm.common import blocks, ship, stored
from daysync.llm.shingles import mix
from daysync.llm.wordcodes import WordCodes, byte_table

#: Fixed values of the text rules: what parts words, and what ends a piece.
_TABLE = byte_table(b" \t", b".,;:!?\n\x0b\x0c\r")
#: Bits of a filter, a power of two; more let fewer infrequent words pass.
FILTER_BITS = 1 << 25
#: Suffixes of a group of subtrees, unless one prefix has more.
GROUP = 1 << 18
#: A prefix is extended where it has more suffixes than this share of an even partition.
SHARE = 4
LANG = "und"


def _languages(block: pa.RecordBatch) -> Iterator[tuple[str, list[bytes]]]:
    """The texts of each language."""
    by: dict[str, list[bytes]] = {}
    for lang, text in zip(block.column("lang").to_pylist(), block.column("text").to_pylist(), strict=True):
        by.setdefault(lang, []).append(text or b"")
    yield from by.items()


class _Coders(dict):
    """The words of each language. Langs that a worker has met often are kept."""

    def __missing__(self, lang: str) -> WordCodes:
        if len(self) > 64:
            self.clear()
        made = self[lang] = WordCodes(lang.encode())
        return made


def _pair_hash(hashes: np.ndarray) -> np.ndarray:
    """A hash of each two values in a row."""
    return mix(mix(hashes[:-1] + np.uint64(0x9E3779B97F4A7C15)) ^ hashes[1:])


def _passes(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes & np.uint64(len(bits) * 64 - 1)
    return (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) != 0


def _filter(frequent: DataFrame, size: int) -> np.ndarray:
    """The bits set for the one or two words of ``lang, phrase``; fetched as a bounded number of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coders = _Coders()
        for batch in batches:
            for lang, phrases in _languages(batch.rename_columns(["lang", "text"])):
                known = coders[lang]
                codes = known.codes(phrases, _TABLE)
                own = np.append(known.hashes(), np.uint64(0))[codes]
                if batch.schema.names[1] == "word":
                    hashes = own[codes >= 0]
                else:
                    first = np.flatnonzero((codes[:-1] >= 0) & (codes[1:] >= 0))
                    hashes = _pair_hash(own)[first]
                at = hashes & np.uint64(size - 1)
                slots = pa.array((at >> np.uint64(6)).view(np.int64))
                yield pa.RecordBatch.from_arrays([slots, pa.array((np.uint64(1) << (at & np.uint64(63))).view(np.int64))], names=["slot", "bits"])

    name = frequent.columns[1]
    rows = frequent.select("lang", F.col(name).cast("binary").alias(name)).mapInArrow(run, "slot long, bits long")
    found = rows.groupBy("slot").agg(F.bit_or("bits").alias("bits")).toArrow()
    bits = np.zeros(size // 64, np.uint64)
    bits[found.column("slot").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return bits


def _counted(rows: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows of a matrix of codes in order, and how often each occurs."""
    order = np.lexsort(rows.T[::-1])
    rows = rows[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]).any(1)
    at = np.flatnonzero(new)
    if weights is None:
        return rows[at], np.diff(np.append(at, len(rows)))
    return rows[at], np.add.reduceat(weights[order], at) if len(at) else weights[:0]


def _word_counts(docs: DataFrame) -> DataFrame:
    """``lang, word, f`` of each block of ``lang, text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, "text"):
                for lang, texts in _languages(block):
                    known = WordCodes()
                    codes = known.codes(texts, _TABLE)
                    counts = np.bincount(codes[codes >= 0], minlength=len(known.words))
                    columns = [_repeated(lang, len(counts)), _names(known), pa.array(counts, pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns, names=["lang", "word", "f"])

    return docs.mapInArrow(run, "lang string, word string, f long")


def _pair_counts(docs: DataFrame, words) -> DataFrame:
    """``lang, phrase, f``: pairs in a row of words that pass the filter, of each block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coders, bits = _Coders(), words.value
        for batch in batches:
            for block in blocks(batch, "text"):
                for lang, texts in _languages(block):
                    known = coders[lang]
                    codes = known.codes(texts, _TABLE)
                    good = np.append(_passes(bits, known.hashes()), False)[codes]
                    first = np.flatnonzero(good[:-1] & good[1:])
                    keys, counts = np.unique(codes[first] << 32 | codes[first + 1], return_counts=True)
                    names = _names(known)
                    phrase = _joined([names.take(pa.array(keys >> 32)), names.take(pa.array(keys & 0xFFFFFFFF))])
                    yield pa.RecordBatch.from_arrays([_repeated(lang, len(keys)), phrase, pa.array(counts, pa.int64())], names=["lang", "phrase", "f"])

    return docs.mapInArrow(run, "lang string, phrase string, f long")


def _joined(parts: list[pa.Array]) -> pa.Array:
    return pc.binary_join_element_wise(*parts, pa.scalar(" "))


def _names(known: WordCodes) -> pa.Array:
    """All words by their number; as text without a check, as they were cut from text."""
    return pa.array(known.words, pa.binary()).view(pa.string())


def _repeated(lang: str, count: int) -> pa.Array:
    return pa.repeat(pa.scalar(lang, pa.string()), count)


def _suffixes(docs: DataFrame, pairs, longest: int) -> DataFrame:
    """``lang, w1, ... , f``: suffixes of three words and more as far as their pairs pass, of each block."""
    names = [f"w{k}" for k in range(1, longest + 1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coders, bits = _Coders(), pairs.value
        for batch in batches:
            for block in blocks(batch, "text"):
                for lang, texts in _languages(block):
                    known = coders[lang]
                    codes = known.codes(texts, _TABLE)
                    own = np.append(known.hashes(), np.uint64(0))[codes]
                    good = np.append(_passes(bits, _pair_hash(own)) & (codes[:-1] >= 0) & (codes[1:] >= 0), np.zeros(longest, bool))
                    at = np.flatnonzero(good[:-longest] & good[1 : len(good) - longest + 1])
                    rows = np.full((len(at), longest), -1, np.int64)
                    going = np.ones(len(at), bool)
                    for k in range(longest):
                        going &= good[at + k - 1] if k else True
                        rows[going, k] = codes[at[going] + k]
                    rows, counts = _counted(rows)
                    words = _names(known)
                    columns = [words.take(pa.array(rows[:, k], mask=rows[:, k] < 0)) for k in range(longest)]
                    yield pa.RecordBatch.from_arrays([_repeated(lang, len(rows)), *columns, pa.array(counts, pa.int64())], names=["lang", *names, "f"])

    return docs.mapInArrow(run, ", ".join(["lang string", *(f"{n} string" for n in names), "f long"]))


def _subtrees(parts: DataFrame, longest: int, least: int, group: int) -> DataFrame:
    """``lang, phrase, f``: nodes of frequency ``least`` of the subtrees, from rows sorted by ``lang, head``.

    Of a head of ``size`` words the nodes are complete from that depth on, so only these are
    returned.
    """
    names = [f"w{k}" for k in range(1, longest + 1)]

    def build(table: pa.Table) -> Iterator[pa.RecordBatch]:
        langs = table.column("lang").combine_chunks().dictionary_encode()
        every = pa.chunked_array([c for n in names for c in table.column(n).chunks], pa.string()).combine_chunks().dictionary_encode()
        codes = every.indices.fill_null(-1).to_numpy().reshape(longest, -1).T.astype(np.int64)
        leaves = np.column_stack([langs.indices.to_numpy().astype(np.int64), codes])
        sizes = table.column("size").to_numpy()
        kept, counts = _counted(np.column_stack([leaves, sizes]), table.column("f").to_numpy())
        for depth in range(3, longest + 1):
            rows = np.flatnonzero((kept[:, depth] >= 0) & (kept[:, -1] <= depth))
            if not len(rows):
                continue
            nodes = kept[rows][:, : depth + 1]
            new = np.ones(len(rows), bool)
            new[1:] = (nodes[1:] != nodes[:-1]).any(1)
            at = np.flatnonzero(new)
            sums = np.add.reduceat(counts[rows], at)
            often = at[sums >= least]
            phrase = _joined([every.dictionary.take(pa.array(nodes[often, k])) for k in range(1, depth + 1)])
            yield pa.RecordBatch.from_arrays([langs.dictionary.take(pa.array(nodes[often, 0])), phrase, pa.array(sums[sums >= least])], names=["lang", "phrase", "f"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            waiting.append(batch)
            rows += batch.num_rows
            if rows >= group:
                table = pa.Table.from_batches(waiting)
                lang, head = table.column("lang").combine_chunks(), table.column("head").combine_chunks()
                # The last head may go on in the next batch.
                other = np.flatnonzero(~_as_last(lang, head))
                stop = int(other[-1]) + 1 if len(other) else 0
                if stop:
                    yield from build(table.slice(0, stop))
                    waiting = table.slice(stop).combine_chunks().to_batches()
                    rows = table.num_rows - stop
        if waiting:
            yield from build(pa.Table.from_batches(waiting))

    return parts.mapInArrow(run, "lang string, phrase string, f long")


def _as_last(lang: pa.Array, head: pa.Array) -> np.ndarray:
    """Which rows are of the same prefix as the last."""
    return pc.and_(pc.equal(lang, lang[-1]), pc.equal(head, head[-1])).to_numpy(zero_copy_only=False)


def _tree_nodes(suffixes: DataFrame, longest: int, least: int, group: int) -> DataFrame:
    """``lang, phrase, f``: all phrases of three words and more of frequency ``least``."""
    spark = suffixes.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    budget = max(1, suffixes.count() // (SHARE * parts))
    size: Column = F.lit(2)
    parted, nodes, over = suffixes, [], suffixes
    for depth in range(2, longest):
        prefix = ["lang", *(f"w{k}" for k in range(1, depth + 1))]
        # Fewer than ``SHARE * parts`` prefixes of a length can be over the budget.
        over = over.where(F.col(prefix[-1]).isNotNull())
        hot = stored(over.groupBy(*prefix).agg(F.count("*").alias("rows"), F.sum("f").alias("f")).where(F.col("rows") > budget))
        if depth > 2:
            nodes.append(hot.where(F.col("f") >= least).select("lang", F.concat_ws(" ", *prefix[1:]).alias("phrase"), "f"))
        marked = hot.select(*prefix, F.lit(depth + 1).alias(f"size{depth}"))
        parted = parted.join(F.broadcast(marked), prefix, "left")
        over = over.join(F.broadcast(hot.select(*prefix)), prefix, "left_semi")
        size = F.coalesce(f"size{depth}", size)
    words = F.array(*(f"w{k}" for k in range(1, longest + 1)))
    # A suffix shorter than its prefix ends at a node whose count is taken from the list above.
    parted = parted.withColumn("size", size.cast("long")).where(F.size(F.array_compact(words)) >= F.col("size"))
    parted = parted.withColumn("head", F.array_join(F.slice(words, F.lit(1), F.col("size").cast("int")), " "))
    parted = parted.repartition("lang", "head").sortWithinPartitions("lang", "head")
    found = _subtrees(parted.select("lang", "head", "size", *(f"w{k}" for k in range(1, longest + 1)), "f"), longest, least, group)
    for more in nodes:
        found = found.unionByName(more)
    return found


def _exact(value: Column) -> Column:
    return value.cast("decimal(20,0)")


def _part(words: Column, start: Column, size: Column) -> Column:
    return F.array_join(F.slice(words, start, size), " ")


def _scored(phrases: DataFrame, candidates: DataFrame, scale: int) -> DataFrame:
    """``lang, phrase, depth, a, score, l, r`` of each candidate, by its lowest cut."""
    words = F.split("phrase", " ")
    cuts = F.transform(
        F.sequence(F.lit(1), F.col("depth") - 1),
        lambda k: F.struct(k.alias("k"), _part(words, F.lit(1), k).alias("first"), _part(words, k + 1, F.col("depth") - k).alias("rest")),
    )
    cut = candidates.select("lang", "phrase", "depth", "f", F.explode(cuts).alias("cut"))
    cut = cut.select("lang", "phrase", "depth", F.col("f").alias("a"), "cut.k", "cut.first", "cut.rest")
    left = phrases.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = phrases.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    cut = cut.join(left, ["lang", "first"]).join(right, ["lang", "rest"])
    over, under = _exact(F.col("a")) * scale, _exact(F.col("l")) + _exact(F.col("r"))
    # Without the remainder the division is exact.
    score = ((over - over % under) / under).cast("long")
    least = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("least")
    return cut.groupBy("lang", "phrase", "depth", "a").agg(least).select("lang", "phrase", "depth", "a", "least.score", "least.l", "least.r")


def _standing(candidates: DataFrame, scored: DataFrame, percent: int) -> DataFrame:
    """The candidates that no longer one takes in, most of whose occurrences lie inside it."""
    words = F.split("phrase", " ")
    inner = F.flatten(F.transform(
        F.sequence(F.lit(2), F.col("depth") - 1),
        lambda m: F.transform(F.sequence(F.lit(1), F.col("depth") - m + 1), lambda at: _part(words, at, m)),
    ))
    longer = candidates.where("depth > 2").select("lang", F.explode(F.array_distinct(inner)).alias("phrase"), "f")
    longer = longer.groupBy("lang", "phrase").agg(F.max("f").alias("inside"))
    gone = F.coalesce(_exact(F.col("inside")) * 100 >= _exact(F.col("a")) * percent, F.lit(False))
    return scored.join(longer, ["lang", "phrase"], "left").where(~gone)


def collocations(
    docs: DataFrame,
    lang_column: str = "lang",
    text_column: str = "text",
    longest: int = 4,
    least: int = 30,
    percent: int = 80,
    top: int = 2000,
    scale: int = 2_000_000,
    filter_bits: int = FILTER_BITS,
    group: int = GROUP,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of each language.

    Phrases have 2 to ``longest`` words and occur ``a >= least`` times. l and r are the frequencies
    of their two sides at the cut of the lowest score, ``scale * a / (l + r)`` rounded down, n is
    the number of words. A phrase that lies in a longer one goes where that occurs
    ``percent`` % as often or more.

    Null and empty texts have no words; a null language is ``und``. Texts are read whole, of
    any length. Repeated rows count each. Equal scores are ordered by a, then by phrase. Other
    columns are not read, whatever their names. An empty table gives an empty result.
    """
    if not 2 <= longest:
        raise ValueError("phrases have two words at least")
    spark = docs.sparkSession
    ship(spark)
    given = docs.select(
        F.coalesce(F.col(lang_column).cast("string"), F.lit(LANG)).alias("lang"), F.col(text_column).cast("binary").alias("text")
    )
    words = stored(_word_counts(given).groupBy("lang", "word").agg(F.sum("f").alias("f")))
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    frequent = words.where(F.col("f") >= least)
    known = spark.sparkContext.broadcast(_filter(frequent.select("lang", "word"), filter_bits))
    pairs = _pair_counts(given, known).groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
    pairs = stored(pairs.where(F.col("f") >= least))
    found = frequent.withColumnRenamed("word", "phrase").unionByName(pairs)
    if longest > 2:
        paired = spark.sparkContext.broadcast(_filter(pairs.select("lang", "phrase"), filter_bits))
        found = found.unionByName(_tree_nodes(stored(_suffixes(given, paired, longest)), longest, least, group))
    phrases = stored(found.withColumn("depth", F.size(F.split("phrase", " "))))

    candidates = phrases.where("depth > 1")
    standing = stored(_standing(candidates, _scored(phrases, candidates, scale), percent))
    # A language may have most of the phrases: the best of each share of them come first.
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    shares = int(spark.conf.get("spark.sql.shuffle.partitions"))
    best = standing.withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(shares)))
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*order))).where(F.col("rank") <= top)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
