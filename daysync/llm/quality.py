"""Text quality by a sparse ensemble of rules.

Shallow boosted trees over statistics of a text give rules: each path from the root to a
node is a conjunction of comparisons. A logistic model over the rules with a lasso penalty
keeps few of them, and those become one Spark column expression over the statistics.

Statistics, scores and decisions cover every row. Only the fit reads a sample: at most
``most_rows`` labelled rows, those with the smallest hash of their id.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daysync.llm.common import blocks, extended, fresh, ship, text_buffers
from daysync.llm.shingles import word_hashes

# What a text is judged by, all as shares or means so that its length matters in one only.
STATISTICS = (
    "log_words", "upper_share", "symbols_per_word", "bars_per_word", "exclamations_per_word",
    "repeated_share", "distinct_share", "bytes_per_word", "digit_share", "stops_per_word",
    "words_per_line", "beyond_ascii_share", "cycle_share",
)
# Signs that prose has few of, and those that end or divide sentences.
_SYMBOLS = "%$#&*@^~<>{}[]\\=_+/"
_STOPS = ".,;:?"

MOST_ROWS = 20_000
TREES = 24
DEPTH = 3
BINS = 48


def _table(signs: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[ord(c) for c in signs]] = True
    return out


_UPPER, _LOWER, _DIGIT = (_table("".join(map(chr, range(a, b)))) for a, b in ((65, 91), (97, 123), (48, 58)))
_SYMBOL, _STOP = _table(_SYMBOLS), _table(_STOPS)


def statistics(texts: pa.Array) -> np.ndarray:
    """A row of ``STATISTICS`` for each text; nulls and empty texts have zeros."""
    data, offsets = text_buffers(texts)
    rows = len(offsets) - 1
    hashes, at = word_hashes(data, offsets)

    def count(mask: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
        return (sums[offsets[1:]] - sums[offsets[:-1]]).astype(float)

    def same(step: int) -> np.ndarray:
        if len(at) <= step:
            return np.zeros(rows)
        equal = (hashes[step:] == hashes[:-step]) & (at[step:] == at[:-step])
        return np.bincount(at[step:][equal], minlength=rows).astype(float)

    size = np.diff(offsets).astype(float)
    words = np.bincount(at, minlength=rows).astype(float)
    order = np.lexsort((hashes, at))
    new = np.ones(len(at), bool)
    if len(at):
        new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (at[order][1:] != at[order][:-1])
    distinct = np.bincount(at[order][new], minlength=rows).astype(float)
    upper, lower = count(_UPPER[data]), count(_LOWER[data])
    white = count((data == 0x20) | ((data >= 0x09) & (data <= 0x0D)))
    per_word, per_byte = np.maximum(words, 1), np.maximum(size, 1)
    return np.column_stack([
        np.log1p(words),
        upper / np.maximum(upper + lower, 1),
        count(_SYMBOL[data]) / per_word,
        count(data == ord("|")) / per_word,
        count(data == ord("!")) / per_word,
        same(1) / per_word,
        distinct / per_word,
        (size - white) / per_word,
        count(_DIGIT[data]) / per_byte,
        count(_STOP[data]) / per_word,
        words / (1 + count(data == 0x0A)),
        count(data >= 0x80) / per_byte,
        (same(2) + same(3)) / per_word,
    ])


def with_statistics(docs: DataFrame, text_column: str = "text") -> tuple[DataFrame, list[str]]:
    """``docs`` with a column for each statistic, and the columns' names."""
    ship(docs.sparkSession)
    names = fresh(docs.columns, *STATISTICS)
    schema = extended(docs, dict.fromkeys(names, "double"))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, text_column):
                found = statistics(block.column(text_column))
                columns = [pa.array(found[:, k]) for k in range(found.shape[1])]
                yield pa.RecordBatch.from_arrays([*block.columns, *columns], names=[*block.schema.names, *names])

    return docs.mapInArrow(add, schema), names


@dataclass(frozen=True)
class Rule:
    """Holds where every statistic is in its bounds: ``low < value <= high``."""

    bounds: tuple[tuple[int, float, float], ...]
    weight: float = 0.0

    def holds(self, x: np.ndarray) -> np.ndarray:
        out = np.ones(len(x), bool)
        for k, low, high in self.bounds:
            out &= (x[:, k] > low) & (x[:, k] <= high)
        return out


@dataclass(frozen=True)
class RuleModel:
    intercept: float
    rules: tuple[Rule, ...]

    def score(self, x: np.ndarray) -> np.ndarray:
        z = self.intercept + sum((r.weight * r.holds(x) for r in self.rules), np.zeros(len(x)))
        return 1 / (1 + np.exp(-z))

    def column(self, names: list[str]) -> Column:
        """The score as an expression over the columns of the statistics."""
        z = F.lit(self.intercept)
        for rule in self.rules:
            holds = F.lit(True)
            for k, low, high in rule.bounds:
                if low > -np.inf:
                    holds &= F.col(names[k]) > F.lit(low)
                if high < np.inf:
                    holds &= F.col(names[k]) <= F.lit(high)
            z += F.when(holds, F.lit(rule.weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def _paths(x: np.ndarray, y: np.ndarray) -> list[Rule]:
    """The paths of all nodes of ``TREES`` boosted trees."""
    edges = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, BINS + 1)[1:-1])) for k in range(x.shape[1])]
    binned = [np.searchsorted(e, x[:, k], "left") for k, e in enumerate(edges)]
    z = np.zeros(len(y))
    found: dict[tuple, Rule] = {}
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-z))
        gradient, weight = y - p, np.maximum(p * (1 - p), 1e-6)

        def grow(rows: np.ndarray, bounds: dict[int, tuple[float, float]], depth: int, gradient=gradient, weight=weight) -> None:
            total, heavy = gradient[rows].sum(), weight[rows].sum()
            best = (1e-6, -1, -1)
            if depth < DEPTH and len(rows) >= 20:
                for k, bins in enumerate(binned):
                    if not len(edges[k]):
                        continue
                    own = bins[rows]
                    g = np.cumsum(np.bincount(own, gradient[rows], len(edges[k]) + 1))[:-1]
                    h = np.cumsum(np.bincount(own, weight[rows], len(edges[k]) + 1))[:-1]
                    n = np.cumsum(np.bincount(own, minlength=len(edges[k]) + 1))[:-1]
                    gain = g**2 / (h + 1) + (total - g) ** 2 / (heavy - h + 1) - total**2 / (heavy + 1)
                    gain[(n < 5) | (n > len(rows) - 5)] = -1
                    at = int(gain.argmax())
                    best = max(best, (float(gain[at]), k, at))
            if best[1] < 0:
                z[rows] += 0.5 * total / (heavy + 1)
                return
            _, k, at = best
            cut, (low, high) = float(edges[k][at]), bounds.get(k, (-np.inf, np.inf))
            under = binned[k][rows] <= at
            for side, span in ((rows[under], (low, min(high, cut))), (rows[~under], (max(low, cut), high))):
                inner = bounds | {k: span}
                path = tuple(sorted((s, *b) for s, b in inner.items()))
                found.setdefault(path, Rule(path))
                grow(side, inner, depth + 1)

        grow(np.arange(len(y)), {}, 0)
    return list(found.values())


def _lasso(r: np.ndarray, y: np.ndarray, penalty: float, steps: int = 400) -> tuple[float, np.ndarray]:
    """Weights of a logistic model with an L1 penalty, by accelerated proximal steps."""
    n, k = r.shape
    mean, spread = r.mean(0), np.maximum(r.std(0), 1e-3)
    s = (r - mean) / spread
    top = np.linalg.eigvalsh(s.T @ s / n)[-1] / 4 + 0.25
    w, v, b, c, t = np.zeros(k), np.zeros(k), 0.0, 0.0, 1.0
    for _ in range(steps):
        off = 1 / (1 + np.exp(-(s @ v + c))) - y
        w_next = v - (s.T @ off) / n / top
        w_next = np.sign(w_next) * np.maximum(np.abs(w_next) - penalty / top, 0)
        b_next = c - off.mean() / top
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, c = w_next + (t - 1) / t_next * (w_next - w), b_next + (t - 1) / t_next * (b_next - b)
        w, b, t = w_next, b_next, t_next
    return float(b - (w * mean / spread).sum()), w / spread


def fit(x: np.ndarray, y: np.ndarray, penalty: float = 3e-4) -> RuleModel:
    """A model of labels 0 and 1. With one label only, or none, its score is that label (none: 1)."""
    if not len(y) or y.min() == y.max():
        return RuleModel(20.0 if not len(y) or y[0] else -20.0, ())
    rules = _paths(x, y.astype(float))
    held = [r.holds(x) for r in rules]
    kept: dict[bytes, int] = {}  # of rules that hold for the same rows the shortest
    for k in sorted(range(len(rules)), key=lambda k: len(rules[k].bounds)):
        kept.setdefault(np.packbits(held[k]).tobytes(), k)
    chosen = sorted(kept.values())
    if not chosen:
        rate = y.mean()
        return RuleModel(float(np.log(rate / (1 - rate))), ())
    intercept, weights = _lasso(np.column_stack([held[k] for k in chosen]).astype(float), y.astype(float), penalty)
    return RuleModel(intercept, tuple(Rule(rules[k].bounds, float(w)) for k, w in zip(chosen, weights, strict=True) if w))


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "quality",
    most_rows: int = MOST_ROWS,
) -> RuleModel:
    """Fits ``label_column`` (0 or 1) of ``labels`` by the texts of ``docs`` with the same id.

    Rows without id or label are not used. The sample is taken from ``labels`` before texts
    are read; it is broadcast, as ``most_rows`` bounds it.
    """
    labelled = labels.select(F.col(id_column).alias("_label_id"), F.col(label_column).cast("int").alias("_label"))
    labelled = labelled.where("_label_id is not null and _label in (0, 1)")
    labelled = labelled.orderBy(F.xxhash64("_label_id"), "_label_id", "_label").limit(most_rows)
    texts = docs.select(F.col(id_column).alias("_id"), F.col(text_column).cast("string").alias("_text"))
    joined = texts.join(F.broadcast(labelled), F.col("_id") == F.col("_label_id")).select("_id", "_label", "_text")
    counted, names = with_statistics(joined, "_text")
    rows = counted.select("_id", "_label", *names).orderBy(F.xxhash64("_id"), "_id", "_label", *names).limit(most_rows)
    sample = rows.toPandas()
    return fit(sample[names].to_numpy(float), sample["_label"].to_numpy(int))


def scored(docs: DataFrame, model: RuleModel, text_column: str = "text", score_column: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1 for every row, null and empty texts too.

    Other columns are kept and not read; one named as the score is replaced. An empty table
    gives an empty result.
    """
    docs = docs.drop(score_column)
    counted, names = with_statistics(docs, text_column)
    return counted.select(*docs.columns, model.column(names).alias(score_column))
