"""Sets of word shingles, made by numpy over whole blocks of text.

Words are runs of characters other than ASCII white space; A-Z count as a-z.
"""

from __future__ import annotations

import numpy as np

from daysync.llm.mixing import mix
from daysync.llm.wordcodes import WordCodes, byte_table, chained

__all__ = ["exact_sets", "mix", "normal", "overlap", "shingle_sets", "word_hashes"]

_TABLE = byte_table(b" \t\n\x0b\x0c\r")
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A quick hash for each word and the row it stands in, for statistics: different words may share one."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    solid = ~_SPACE[data]
    at_row = np.zeros(len(data) + 1, bool)
    at_row[offsets] = True
    begins = solid.copy()
    begins[1:] &= ~solid[:-1] | at_row[1:-1]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    where = np.flatnonzero(solid)
    first = np.flatnonzero(begins[where])
    lengths = np.diff(np.append(first, len(where)))
    powers = np.full(int(lengths.max()), _BASE, np.uint64)
    powers = np.cumprod(powers, dtype=np.uint64)
    place = np.arange(len(where)) - np.repeat(first, lengths)
    values = (_LOWER[data[where]].astype(np.uint64) + np.uint64(1)) * powers[place]
    hashes = np.add.reduceat(values, first) + lengths.astype(np.uint64) * _STEP
    rows = np.searchsorted(offsets, starts, "right") - 1
    return mix(hashes), rows


def normal(text: bytes) -> bytes:
    """The words with one blank between them: equal for texts of equal words, and only for them."""
    return b" ".join(text.translate(_TABLE).split())


def _rows(texts: list[bytes], known: WordCodes) -> tuple[np.ndarray, np.ndarray]:
    """The words of all texts one after the other, and where each text's begin and the last ends."""
    codes = known.codes(texts, _TABLE)
    ends = np.flatnonzero(codes < 0) - np.arange(len(texts))
    return codes[codes >= 0], np.concatenate([[0], ends])


def _distinct(values: np.ndarray, bounds: np.ndarray, size: int, short: list) -> list[np.ndarray]:
    """The distinct values of each row, of which those that reach into the next do not count."""
    sets = []
    for k, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
        if b - a >= size:
            own = np.sort(values[a : b - size + 1])
            sets.append(own[np.append(True, own[1:] != own[:-1])])
        else:
            sets.append(short[k] if b > a else values[:0])
    return sets


def shingle_sets(texts: list[bytes], size: int, known: WordCodes) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of ``size`` words in a row.

    A text of fewer words has the whole of them as its one shingle; without words, none.
    """
    codes, bounds = _rows(texts, known)
    hashes = known.hashes()[codes]
    sizes = np.diff(bounds)
    short = {k: chained(hashes[bounds[k] : bounds[k + 1]], sizes[k]) for k in np.flatnonzero((sizes > 0) & (sizes < size)).tolist()}
    return _distinct(chained(hashes, size), bounds, size, short)


def exact_sets(texts: list[bytes], size: int, known: WordCodes) -> list[np.ndarray]:
    """As ``shingle_sets``, but numbers that are equal for equal words only; they hold within one call."""
    words, bounds = _rows(texts, known)
    found, count = words, len(known.words)
    for k in range(1, size):
        # Two numbers that stand for k words and the next make one for k + 1 words.
        both = found[: max(0, len(words) - k)] * count + words[k:]
        found = np.unique(both, return_inverse=True)[1]
    seen: dict[bytes, int] = {}
    sizes = np.diff(bounds)
    short = {}
    for k in np.flatnonzero((sizes > 0) & (sizes < size)).tolist():
        whole = words[bounds[k] : bounds[k + 1]].tobytes()
        short[k] = np.array([-1 - seen.setdefault(whole, len(seen))])
    return _distinct(found, bounds, size, short)


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """How many values two sorted sets share."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum()) if len(b) else 0
