"""Distinct words of a worker as numbers, each with a strong hash, for whole blocks of text."""

from __future__ import annotations

import hashlib

import numpy as np

from daysync.llm.mixing import mix

#: Words that a worker keeps between blocks; a bound on memory that changes no result.
KEPT_WORDS = 1_000_000
#: Stands between texts; no byte of UTF-8, and texts that hold it all the same lose it first.
BREAK = b"\xff"


def byte_table(spaces: bytes, breaks: bytes = b"") -> bytes:
    """For ``bytes.translate``: A-Z as a-z, ``spaces`` as a blank and ``breaks`` as ``BREAK``.

    The two have to hold all of the white space 0x09 to 0x0D.
    """
    table = bytearray(range(256))
    table[BREAK[0]] = 0xFE
    for upper in range(0x41, 0x5B):
        table[upper] = upper + 32
    for at in spaces:
        table[at] = 0x20
    for at in breaks:
        table[at] = BREAK[0]
    return bytes(table)


class WordCodes(dict):
    """Numbers of words in order of appearance; ``BREAK`` is -1.

    Hashes are 64 bits of BLAKE2 over the word, so that no words of one hash can be made up
    in passing.
    """

    def __init__(self, salt: bytes = b""):
        super().__init__()
        self.salt = hashlib.blake2b(salt, digest_size=16).digest()
        self._reset()

    def _reset(self) -> None:
        self.clear()
        self[BREAK] = -1
        self.words: list[bytes] = []
        self._hashes = np.zeros(0, np.uint64)

    def __missing__(self, word: bytes) -> int:
        code = self[word] = len(self.words)
        self.words.append(word)
        return code

    def codes(self, texts: list[bytes], table: bytes) -> np.ndarray:
        """The words of all texts one after the other, each text with -1 after it."""
        if len(self.words) > KEPT_WORDS:
            self._reset()
        joined = b"".join(t.translate(table) + BREAK for t in texts).replace(BREAK, b" " + BREAK + b" ")
        return np.fromiter(map(self.__getitem__, joined.split()), np.int64)

    def hashes(self) -> np.ndarray:
        """The hash of each word by its number."""
        known = len(self._hashes)
        if known < len(self.words):
            new = b"".join([hashlib.blake2b(w, digest_size=8, key=self.salt).digest() for w in self.words[known:]])
            self._hashes = np.concatenate([self._hashes, np.frombuffer(new, "<u8")])
        return self._hashes


def chained(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of every ``size`` values in a row, by where they start."""
    count = max(0, len(hashes) - size + 1)
    out = np.full(count, np.uint64(size))
    for k in range(size):
        out = mix(out + np.uint64(0x9E3779B97F4A7C15)) ^ hashes[k : k + count]
    return mix(out)
