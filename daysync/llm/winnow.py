"""Documents that hold passages of a benchmark, by winnowing.

A window is ``size`` words of an item in a row, or the whole of a shorter item. Of every
window the k-gram with the smallest hash is its fingerprint, k being half the window, the
last one of equals. Equal windows have equal fingerprints wherever they stand, so a document
that shares a window with an item shares the fingerprint too: nothing is missed, while
neighbouring windows mostly agree on theirs and few k-grams are kept.

Fingerprints of documents are joined with those of the items. Hits are extended to all the
windows of the document they stand for, and these are joined with the windows of the items by
their words, so that hashes only nominate. Items take part in the last step alone: a passage
that many items share is found once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daysync.llm.common import blocks, lists, ship, stored
from daysync.llm.shingles import mix
from daysync.llm.wordcodes import WordCodes, byte_table, chained

SIZE = 10
#: Everything but digits, letters and what is not ASCII parts words.
_TABLE = byte_table(bytes(b for b in range(128) if not (0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A)))


def fingerprints(hashes: np.ndarray, rows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window of ``size`` words within a row: where it starts, and its fingerprint.

    ``hashes`` are those of the words of all rows, ``rows`` says which row each is of.
    """
    count = max(0, len(hashes) - size + 1)
    k = (size + 1) // 2
    grams = mix(chained(hashes, k) + np.uint64(size))
    best = grams[:count].copy()
    for j in range(1, size - k + 1):
        np.minimum(best, grams[j : j + count], out=best)
    starts = np.flatnonzero(rows[:count] == rows[size - 1 : size - 1 + count])
    return starts, best[starts]


def _texts(column: pa.Array) -> list[bytes]:
    return [t or b"" for t in column.to_pylist()]


def _hashed(known: WordCodes, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes and hashes of all words, and the text each is of."""
    codes = known.codes(texts, _TABLE)
    rows = np.cumsum(codes < 0)
    at = codes >= 0
    return codes[at], known.hashes()[codes[at]], rows[at]


def _signed(docs: DataFrame, sizes: list[int]) -> DataFrame:
    """``id, near, exact, n_words, prints``: the distinct fingerprints of each row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordCodes()
        for batch in batches:
            for block in blocks(batch, "text"):
                _, hashes, rows = _hashed(known, _texts(block.column("text")))
                words = np.bincount(rows, minlength=block.num_rows)
                of, prints = [], []
                for size in sizes:
                    starts, found = fingerprints(hashes, rows, size)
                    # Neighbouring windows mostly share theirs.
                    new = np.ones(len(starts), bool)
                    new[1:] = (found[1:] != found[:-1]) | (rows[starts[1:]] != rows[starts[:-1]])
                    of.append(rows[starts[new]])
                    prints.append(found[new])
                of = np.concatenate([np.zeros(0, np.int64), *of])
                prints = np.concatenate([np.zeros(0, np.uint64), *prints])
                order = np.lexsort((prints, of))
                of, prints = of[order], prints[order]
                new = np.ones(len(of), bool)
                new[1:] = (of[1:] != of[:-1]) | (prints[1:] != prints[:-1])
                offsets = np.concatenate([[0], np.cumsum(np.bincount(of[new], minlength=block.num_rows))])
                columns = [*(block.column(c) for c in ("id", "near", "exact")), pa.array(words), lists(prints[new].view(np.int64), offsets, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "near", "exact", "n_words", "prints"])

    return docs.mapInArrow(run, "id long, near long, exact binary, n_words long, prints array<long>")


def _windows(texts: DataFrame, key: str, kind: str, size: int, sizes: list[int] | None) -> DataFrame:
    """``key, start, words, print, window``: windows of the rows of ``key, text[, prints]``.

    With ``sizes`` those of each of these sizes whose fingerprint is among the row's, else all
    windows of ``size`` words, or of the whole of a shorter text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordCodes()
        for batch in batches:
            for block in blocks(batch, "text", 1 << 20):
                codes, hashes, rows = _hashed(known, _texts(block.column("text")))
                ends = np.cumsum(np.bincount(rows, minlength=block.num_rows))
                begins = np.concatenate([[0], ends[:-1]])
                if sizes is None:
                    own = np.minimum(ends - begins, size)
                    asked = {int(n): own == n for n in np.unique(own) if n}
                else:
                    asked = dict.fromkeys(sizes)
                    wanted = block.column("prints")
                    of = np.repeat(np.arange(block.num_rows, dtype=np.uint64), np.diff(wanted.offsets.to_numpy()))
                    wanted = np.unique(mix(wanted.flatten().to_numpy().view(np.uint64) ^ mix(of)))
                for n, where in asked.items():
                    starts, prints = fingerprints(hashes, rows, n)
                    at = rows[starts]
                    if where is None:
                        kept = np.isin(mix(prints ^ mix(at.astype(np.uint64))), wanted)
                    else:
                        kept = where[at]
                    starts, prints, at = starts[kept], prints[kept], at[kept]
                    texts_ = [b" ".join([known.words[c] for c in codes[s : s + n].tolist()]) for s in starts.tolist()]
                    columns = [
                        block.column(key).take(pa.array(at)), pa.array(starts - begins[at]), pa.array(np.full(len(at), n, np.int64)),
                        pa.array(prints.view(np.int64)), pa.array(texts_, pa.binary()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=[key, "start", "words", "print", "window"])

    return texts.mapInArrow(run, f"{key} {kind}, start long, words long, print long, window binary")


def _covered(spans: Column) -> Column:
    """How many places the ``from, to`` of sorted spans cover."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))

    def add(done: Column, span: Column) -> Column:
        new = F.greatest(span["to"] - F.greatest(span["from"], done["end"]), F.lit(0).cast("long"))
        return F.struct((done["n"] + new).alias("n"), F.greatest(done["end"], span["to"]).alias("end"))

    return F.aggregate(spans, start, add, lambda done: done["n"])


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    size: int = SIZE,
) -> DataFrame:
    """``id, n_words, n_hit, items`` for each row of ``docs``.

    n_hit counts words inside any occurrence of an item's window, ``items`` are the ids, as sorted
    strings, of the items that have such a window.

    Null and empty texts have no words and are never hit; items without words have no window.
    A text of any length is read whole. Repeated rows each get a row of the result, repeated
    items count once, and an item without id counts for n_hit only. Rows without id are judged
    by their text like others. Other columns are not read, whatever their names. An empty
    table of either side gives no hits.
    """
    spark = docs.sparkSession
    ship(spark)
    items = benchmark.select(F.col(item_column).cast("string").alias("item"), F.col(item_text_column).cast("binary").alias("text"))
    items = stored(_windows(items, "item", "string", size, None).select("item", "words", "print", "window").distinct())
    # One row for each size a window may have.
    sizes = sorted(r["words"] for r in items.select("words").distinct().collect())

    text = F.col(text_column)
    key = F.concat_ws(":", F.coalesce(F.col(id_column).cast("string"), F.lit("-")), F.coalesce(text, F.lit("")))
    given = docs.select(
        F.col(id_column).cast("long").alias("id"), F.xxhash64(F.col(id_column), text).alias("near"),
        F.unhex(F.sha2(key, 256)).alias("exact"), text.cast("binary").alias("text"),
    )
    signed = stored(_signed(given, sizes))
    prints = stored(items.select("print").distinct())
    met = signed.select("near", F.explode("prints").alias("print")).join(prints, "print", "left_semi")
    met = stored(met.groupBy("near").agg(F.collect_set("print").alias("prints")))

    # Rows that agree in ``near`` by chance only get more windows to look at.
    texts = given.join(met, "near").select("exact", "text", "prints")
    windows = _windows(texts, "exact", "binary", size, sizes)
    hits = windows.join(items.select("window").distinct(), "window", "left_semi")
    hits = stored(hits.select("exact", "window", F.col("start").alias("from"), (F.col("start") + F.col("words")).alias("to")).distinct())
    spans = hits.groupBy("exact").agg(F.sort_array(F.collect_set(F.struct("from", "to"))).alias("spans"))
    spans = spans.select("exact", _covered(F.col("spans")).alias("n_hit"))
    named = hits.select("exact", "window").distinct().join(items.where("item is not null").select("item", "window"), "window")
    named = named.select("exact", "item").distinct().groupBy("exact").agg(F.sort_array(F.collect_list("item")).alias("items"))
    found = stored(spans.join(named, "exact", "left"))
    out = signed.select("id", "exact", "n_words").join(found, "exact", "left")
    none = F.array().cast("array<string>")
    return out.select("id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("items", none).alias("items"))
