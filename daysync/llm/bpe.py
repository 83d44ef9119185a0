"""Byte-level BPE by a depth-first walk over a trie of the distinct words.

Every prefix of a word has one BPE encoding, and it ends in one last token; the tokens
before are the encoding of the prefix without it. So one token for each trie node holds the
encodings of all prefixes. The last token of a node is the one token ending there that can
follow the last token of the node where it begins: two tokens can stand side by side when
no merge across their border comes before the merges that made them.

The distinct words of a batch of texts, sorted by bytes, are the trie's leaves in depth-first
order; the path to the present leaf is a stack, and what a word shares with the one before
is on it already. Results are kept for later batches of the same worker, up to a bound on
their number that changes nothing but time.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from daysync.llm.common import blocks, extended, lists, ship
from daysync.llm.words import PATTERN, split_words

#: Words kept by a worker between batches, and characters of them.
KEPT_WORDS = 600_000
KEPT_CHARS = 12_000_000
#: Characters of a text from which on the library gets single words.
LONG = 100_000


def _byte_letters() -> dict[str, int]:
    """The byte that each letter of a token's written form stands for.

    Printable bytes are written as themselves, the others as letters from 256 on, in order.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Vocabulary:
    """Tokens, merges and special tokens of a vocabulary file."""

    def __init__(self, content: str):
        given = json.loads(content)
        model, letters = given["model"], _byte_letters()
        self.specials = {t["content"]: t["id"] for t in given["added_tokens"]}
        size = 1 + max([*model["vocab"].values(), *self.specials.values()])
        self.token_bytes = [b""] * size
        for written, k in model["vocab"].items():
            known = all(c in letters for c in written) and written not in self.specials
            self.token_bytes[k] = bytes(letters[c] for c in written) if known else written.encode()
        for content_, k in self.specials.items():
            self.token_bytes[k] = content_.encode()
        ids = model["vocab"]
        self.merges: dict[tuple[int, int], int] = {}  # of two tokens: the rank of their merge
        parts: dict[int, tuple[int, int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            x, y = merge.split(" ") if isinstance(merge, str) else merge
            pair = ids[x], ids[y]
            self.merges[pair] = rank
            parts.setdefault(ids[x + y], (rank, *pair))
        #: Whether merges go in the order of the ids they make.
        self.by_id = all(a < b for a, b in pairwise(parts)) and len(parts) == len(self.merges)
        self.ids = {bytes([letters[w]]): k for w, k in ids.items() if w in letters}
        self.ids |= {self.token_bytes[k]: k for k in parts}
        # The lengths of the tokens that end with a byte, the longest first, up to each length.
        longest = max(map(len, self.ids))
        ending: dict[int, set[int]] = {}
        for token in self.ids:
            ending.setdefault(token[-1], set()).add(len(token))
        self.longest = longest
        self.lengths = {
            byte: [tuple(n for n in sorted(sizes, reverse=True) if n <= most) for most in range(longest + 1)] for byte, sizes in ending.items()
        }
        # The tokens at a token's right and left border as merges make it, each with the rank
        # of the merge that takes it into the next.
        never = len(self.merges) + 1
        self.right = {k: _spine(k, parts, 2, never) for k in self.ids.values()}
        self.left = {k: _spine(k, parts, 1, never) for k in self.ids.values()}
        self.known: dict[int, bool] = {}  # answers of ``stays``, by both tokens

    def beside(self, x: int, y: int) -> bool:
        """``stays``, remembered."""
        if len(self.known) > 1_000_000:
            self.known.clear()
        found = self.known[x << 32 | y] = self.stays(x, y)
        return found

    def stays(self, x: int, y: int) -> bool:
        """Whether ``x`` followed by ``y`` is how the two are encoded."""
        rights, lefts, i, j = self.right[x], self.left[y], 0, 0
        while True:
            (a, a_ends), (b, b_ends) = rights[i], lefts[j]
            across = self.merges.get((a, b))
            # At equal ranks the merge further left goes first.
            if across is not None and across < a_ends and across <= b_ends:
                return False
            if i == len(rights) - 1 and j == len(lefts) - 1:
                return True
            if a_ends <= b_ends:
                i += 1
            else:
                j += 1


def _spine(token: int, parts: dict, side: int, never: int) -> list[tuple[int, int]]:
    out = [(token, never)]
    while (made := parts.get(out[-1][0])) is not None:
        out.append((made[side], made[0]))
    return out[::-1]


def _words(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The words of all texts, where each starts, and where each text ends."""
    joined = "".join(texts)
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes)
    if not joined:
        return [], np.zeros(0, np.int64), ends
    points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    starts = split_words(points, (ends - sizes)[sizes > 0])
    edges = [*starts.tolist(), len(points)]
    return [joined[a:b] for a, b in zip(edges, edges[1:], strict=False)], starts, ends


class TrieEncoder:
    """Encodes and decodes texts with a vocabulary."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self._special = re.compile("|".join(map(re.escape, sorted(vocabulary.specials, key=len, reverse=True))) or r"(?!)")
        self._forget()

    def _forget(self) -> None:
        self._codes: dict[str, int] = {}
        self._flat = np.zeros(1 << 16, np.int32)
        self._ends = np.zeros(1 << 14, np.int64)  # after the ids of each word, from place 1 on
        self._chars = 0

    def encode_words(self, words: list[bytes]) -> Iterator[list[int]]:
        """The ids of sorted distinct words."""
        get, longest, beside = self.vocabulary.ids.get, self.vocabulary.longest, self.vocabulary.beside
        lengths = self.vocabulary.lengths
        known = self.vocabulary.known.get
        before, tokens, sizes = b"", [-1], [0]  # the path: last token and its length, by depth
        for word in words:
            depth = 0
            most = min(len(before), len(word))
            while depth < most and before[depth] == word[depth]:
                depth += 1
            del tokens[depth + 1 :], sizes[depth + 1 :]
            for end in range(depth + 1, len(word) + 1):
                for size in lengths[word[end - 1]][end if end < longest else longest]:
                    begin = end - size
                    token = get(word[begin:end])
                    if token is None:
                        continue
                    if begin:
                        stays = known(tokens[begin] << 32 | token)
                        if stays is None:
                            stays = beside(tokens[begin], token)
                        if not stays:
                            continue
                    tokens.append(token)
                    sizes.append(size)
                    break
                else:
                    raise ValueError("the vocabulary cannot encode a byte")
            out, at = [], len(word)
            while at:
                out.append(tokens[at])
                at -= sizes[at]
            yield out[::-1]
            before = word

    def _learn(self, words: set[str]) -> None:
        ordered = sorted(w.encode() for w in words)
        known = len(self._codes)
        lengths, flat = [], []
        for word, ids in zip(ordered, self.encode_words(ordered), strict=True):
            self._codes[word.decode()] = len(self._codes)
            self._chars += len(word)
            lengths.append(len(ids))
            flat += ids
        used = int(self._ends[known])
        while len(self._flat) < used + len(flat):
            self._flat = np.concatenate([self._flat, np.zeros_like(self._flat)])
        while len(self._ends) <= known + len(lengths):
            self._ends = np.concatenate([self._ends, np.zeros_like(self._ends)])
        self._flat[used : used + len(flat)] = flat
        self._ends[known + 1 : known + 1 + len(lengths)] = used + np.cumsum(lengths)

    def prepare(self, groups: Iterator[list[str | None]]) -> None:
        """Learns the words of several blocks of texts in one walk; optional before ``encode``."""
        every: set[str] = set()
        for texts in groups:
            plain = [s for t in texts if t for s in self._special.split(t)]
            every.update(_words(plain)[0])
            if len(every) > KEPT_WORDS:
                break  # the rest is learned block by block
        new = every.difference(self._codes)
        if len(self._codes) + len(new) > KEPT_WORDS or self._chars > KEPT_CHARS:
            self._forget()
            new = every
        self._learn(new)

    def _encode_plain(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        words, starts, ends = _words(texts)
        if not words:
            return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
        codes = list(map(self._codes.get, words))
        if None in codes:
            new = {w for w, k in zip(words, codes, strict=True) if k is None}
            if len(self._codes) + len(new) > KEPT_WORDS or self._chars > KEPT_CHARS:
                self._forget()
                new = set(words)
            self._learn(new)
            codes = list(map(self._codes.__getitem__, words))
        codes = np.array(codes)
        first = self._ends[codes]
        lengths = self._ends[codes + 1] - first
        stop = np.cumsum(lengths)
        ids = self._flat[np.repeat(first - (stop - lengths), lengths) + np.arange(int(stop[-1]))]
        # Words up to each text's end.
        offsets = np.concatenate([[0], stop])[np.searchsorted(starts, np.concatenate([[0], ends]), "left")]
        return ids, offsets

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and where each text's begin.

        Special tokens written in a text are found as such.
        """
        texts = [t or "" for t in texts]
        marked = {k: self._special.split(t) for k, t in enumerate(texts) if self._special.search(t)}
        if not marked:
            return self._encode_plain(texts)
        segments = [s for k, t in enumerate(texts) for s in marked.get(k, [t])]
        ids, offsets = self._encode_plain(segments)
        out, sizes, at = [], [], 0
        for k, t in enumerate(texts):
            found = self._special.findall(t) if k in marked else []
            size = 0
            for n in range(len(found) + 1):
                part = ids[offsets[at] : offsets[at + 1]]
                out.append(part)
                size += len(part)
                if n < len(found):
                    out.append(np.array([self.vocabulary.specials[found[n]]], np.int32))
                    size += 1
                at += 1
            sizes.append(size)
        return np.concatenate(out), np.concatenate([[0], np.cumsum(sizes)])

    def decode(self, ids: list[int]) -> str:
        """The text of ids, special tokens as they are written."""
        table = self.vocabulary.token_bytes
        return b"".join([table[k] for k in ids]).decode("utf-8", "replace")


class LibraryEncoder(TrieEncoder):
    """The same ids by tiktoken, for operators that only need them."""

    def __init__(self, vocabulary: Vocabulary):
        import tiktoken

        super().__init__(vocabulary)
        self._library = tiktoken.Encoding("texts", pat_str=PATTERN, mergeable_ranks=vocabulary.ids, special_tokens={})

    def prepare(self, groups: Iterator[list[str | None]]) -> None:
        """Nothing is gained by many texts at a time."""

    def _encode_plain(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        parts = [self._library.encode_to_numpy(t, disallowed_special=()) if len(t) <= LONG else self._by_words(t) for t in texts]
        offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts], dtype=np.int64)])
        return np.concatenate([np.zeros(0, np.int32), *parts]).astype(np.int32), offsets


    def _by_words(self, text: str) -> np.ndarray:
        """The library's pattern gives up on very long runs of white space, so the words are cut here."""
        piece = lru_cache(maxsize=100_000)(self._library._core_bpe.encode_single_piece)
        return np.fromiter((k for word in _words([text])[0] for k in piece(word.encode())), np.int32)


@lru_cache(maxsize=2)
def _encoder(content: str, trie: bool) -> TrieEncoder:
    vocabulary = Vocabulary(content)
    return TrieEncoder(vocabulary) if trie or not vocabulary.by_id else LibraryEncoder(vocabulary)


def read_vocabulary(path: str) -> str:
    """A vocabulary file's content, a few MB of JSON that goes to the tasks with their code."""
    with open(path, encoding="utf-8") as f:
        return f.read()


Coded = Callable[[pa.RecordBatch, np.ndarray, np.ndarray, TrieEncoder], pa.RecordBatch]


def with_ids(docs: DataFrame, text_column: str, path: str, make: Coded, schema: StructType | str, trie: bool = True) -> DataFrame:
    """Calls ``make(rows, ids, offsets, encoder)`` for each block of ``docs``: one pass over the texts.

    Without ``trie`` a library encodes the texts, to the same ids.
    """
    spark = docs.sparkSession
    ship(spark)
    content = spark.sparkContext.broadcast(read_vocabulary(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(content.value, trie)
        for batch in batches:
            parts = list(blocks(batch, text_column))
            if len(parts) > 1:
                encoder.prepare(b.column(text_column).to_pylist() for b in parts)
            for block in parts:
                ids, offsets = encoder.encode(block.column(text_column).to_pylist())
                yield make(block, ids, offsets, encoder)

    return docs.mapInArrow(run, schema)


def encode(docs: DataFrame, path: str, text_column: str = "text", ids_column: str = "ids") -> DataFrame:
    """``docs`` with the ids of its texts as ``array<int>`` beside all its columns.

    Null and empty texts have no ids. A column of the name given goes. No row is dropped or
    merged; texts of any length are encoded whole. An empty table gives an empty result.
    """
    docs = docs.drop(ids_column) if ids_column != text_column else docs
    schema = extended(docs, {ids_column: "array<int>"})

    def add(block, ids, offsets, _):
        return pa.RecordBatch.from_arrays([*block.columns, lists(ids, offsets, pa.int32())], names=[*block.schema.names, ids_column])

    return with_ids(docs, text_column, path, add, schema)


def decode(docs: DataFrame, path: str, ids_column: str = "ids", text_column: str = "decoded") -> DataFrame:
    """``docs`` with the text of its ids; null ids give null."""
    spark = docs.sparkSession
    ship(spark)
    content = spark.sparkContext.broadcast(read_vocabulary(path))
    docs = docs.drop(text_column)
    schema = extended(docs, {text_column: "string"})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(content.value, True)
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                block = batch.slice(first, 256)
                texts = [None if x is None else encoder.decode(x) for x in block.column(ids_column).to_pylist()]
                yield pa.RecordBatch.from_arrays([*block.columns, pa.array(texts, pa.string())], names=[*block.schema.names, text_column])

    return docs.mapInArrow(run, schema)
