"""Personal data by rules and a linear-chain conditional random field.

Rules find e-mail addresses, IP addresses, card numbers and phone numbers by their exact
form. The field adds what has their shape beside it, such as a number that lacks its country
code: it labels words by their shapes (letters, digits and signs, runs shortened), and is
trained from a small table of labelled lines.

Only words with a digit or an ``@`` can be part of such data; the field is conditioned on
all others being outside. A line therefore falls into runs of such words, and decoding the
runs is decoding the line. Viterbi goes over many runs at a time in numpy.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daysync.llm.common import blocks, extended, fresh, ship, text_buffers

# Kinds in the order of the results, and the forms that the rules look for.
KINDS = ("email", "ip", "card", "phone")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")

# Labelled lines that the corpus may lack, data in brackets after its kind.
LINES = (
    "call {phone:(988) 555-2485} today",
    "call {phone:(212) 555 0199} or {phone:212-555-0199}",
    "tel {phone:030 1234567} fax {phone:030-1234568}",
    "tel {phone:+49 30 1234567}",
    "tel {phone:+1 (412) 555-0123} {card:4041894974608795}",
    "{email:ann.lee@mail.example.com} {phone:+1 (412) 555-0123} {ip:42.144.35.254}",
    "{ip:42.144.35.254} {card:4041894974608795} {email:b.07@example.org}",
    "card {card:4041 8949 7460 8795} and {card:4041-8949-7460-8795}",
    "order 12345678 of 2024-11-30 at 10:45",
    "order 4041894974608796 was 1234567890123456",
    "in 1999 and 2003, 17 of 250 or 6.8 %",
    "version 3.14 or 1.2.3 or 300.1.2.3 or 1.2.3.4.5",
    "pages 12-15, room 555, 24/7",
    "a@b and @home and x@ 5",
    "item 0641917ea4e9feb9cda83477b57ac2654884f485 or 9f86d081884c7d65",
    "3. 4.0. 12. 100",
    "numbers 1 2 3 4 5 6 7 8 and 1,000 or 12,500.75",
)

LABELS = ("O", *(f"{edge}-{kind}" for kind in KINDS for edge in "BI"))
_OUT = 0

#: Of the labelled table: documents it is made from, and words of a piece of a run.
MOST_DOCUMENTS = 2_000
MOST_WORDS = 24


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        value = int(c) << (k & 1)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def rule_spans(text: str) -> list[tuple[int, int, int]]:
    """``start, end, kind`` of what the rules find, each kind from left to right without overlap."""
    out = []
    done, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > done and _LOCAL.match(text, begin - 1):
            begin -= 1
        domain = _DOMAIN.match(text, at + 1) if begin < at else None
        if domain:
            out.append((begin, domain.end(), 0))
            done = domain.end()
        at = text.find("@", max(at + 1, done))
    for m in _IP.finditer(text):
        if all(len(p) <= 3 or not p[:-3].strip("0") for p in m[0].split(".")) and all(int(p[-3:]) <= 255 for p in m[0].split(".")):
            out.append((*m.span(), 1))
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m[0]) if m.end() - m.start() <= 37 else ""
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((*m.span(), 2))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                out.append((*m.span(), 3))
    return sorted((a, b, k) for a, b, k in out)


def shape(word: str) -> str:
    """Letters, digits and signs of a word, each run of one of the first two shortened to one."""
    kinds = ("d" if "0" <= c <= "9" else "A" if c.isupper() else "a" if c.isalpha() else c for c in word)
    out: list[str] = []
    for c in kinds:
        if not (out and out[-1] == c and c in "dAa"):
            out.append(c)
    return "".join(out)


def _short(text: str) -> str:
    """A name for ``text``, itself unless it is long; features are only compared."""
    return text if len(text) <= 64 else hashlib.sha256(text.encode(errors="replace")).hexdigest()


def features(word: str) -> tuple[str, ...]:
    """What the field knows of a word."""
    digits = _NOT_DIGIT.sub("", word)
    bare = word.strip(".,;:!?\"'()<>[]")
    parts = bare.split(".")
    out = ["any", "shape " + _short(shape(word)), "bare " + _short(shape(bare)), f"digits {min(len(digits), 24)}", f"size {min(len(word), 48) // 4}"]
    if 12 <= len(digits) <= 19 and len(digits) + bare.count("-") == len(bare):
        out.append("check digit" if luhn(digits) else "no check digit")
    if len(parts) == 4 and all(p.isascii() and p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in parts):
        out.append("octets")
    out += [sign for sign in "@+(" if sign in word]
    return tuple(out)


def runs(text: str) -> list[list[tuple[int, int]]]:
    """Words with a digit or ``@`` that follow each other in a line, as ``start, end``."""
    out: list[list[tuple[int, int]]] = []
    last = -1
    for m in _WORD.finditer(text):
        if re.search("[0-9@]", m[0]):
            joined = out and out[-1][-1][1] == last and "\n" not in text[last : m.start()]
            if joined:
                out[-1].append(m.span())
            else:
                out.append([m.span()])
            last = m.end()
        else:
            last = -1
    return out


#: Features of words, their labels, and whether a run begins and ends there (it does if not said).
Labelled = tuple[list[tuple[str, ...]], list[int]] | tuple[list[tuple[str, ...]], list[int], tuple[bool, bool]]


@dataclass(frozen=True)
class Crf:
    """Weights: of each feature for each label, from label to label, at a run's edges."""

    known: dict[str, int]
    unary: np.ndarray
    pairs: np.ndarray
    first: np.ndarray
    last: np.ndarray

    def emissions(self, words: Iterable[tuple[str, ...]]) -> np.ndarray:
        rows = [self.unary[[self.known[f] for f in w if f in self.known]].sum(0) for w in words]
        return np.array(rows).reshape(-1, len(LABELS))

    def decode(self, sequences: list[list[tuple[str, ...]]]) -> list[list[int]]:
        """The best labels of each sequence; sequences of like length go through together."""
        seen: dict[tuple[str, ...], int] = {}
        codes = [np.array([seen.setdefault(w, len(seen)) for w in s]) for s in sequences]
        scores = self.emissions(seen)
        out: list[list[int]] = [[] for _ in sequences]
        order = sorted(range(len(codes)), key=lambda k: len(codes[k]))
        first = 0
        while first < len(order):
            limit = max(16, 2 * len(codes[order[first]]))
            last = first
            while last < len(order) and len(codes[order[last]]) <= limit and last - first < 4096:
                last += 1
            self._viterbi([codes[k] for k in order[first:last]], scores, out, order[first:last])
            first = last
        return out

    def _viterbi(self, batch: list[np.ndarray], scores: np.ndarray, out: list[list[int]], names: list[int]) -> None:
        sizes = np.array([len(c) for c in batch])
        words = np.zeros((len(batch), sizes.max()), np.int64)
        for k, c in enumerate(batch):
            words[k, : len(c)] = c
        best = self.first + scores[words[:, 0]]
        back = np.zeros((*words.shape, len(LABELS)), np.int8)
        for t in range(1, words.shape[1]):
            ways = best[:, :, None] + self.pairs
            back[:, t] = ways.argmax(1)
            step = ways.max(1) + scores[words[:, t]]
            best = np.where((t < sizes)[:, None], step, best)
        label = (best + self.last).argmax(1)
        found = np.zeros(words.shape, np.int8)
        for t in range(words.shape[1] - 1, -1, -1):
            inside = t < sizes
            found[inside, t] = label[inside]
            label = np.where(inside & (t > 0), back[np.arange(len(batch)), t, label], label)
        for k, name in enumerate(names):
            out[name] = found[k, : sizes[k]].tolist()


def fit(rows: list[Labelled], steps: int = 150, penalty: float = 0.02) -> Crf:
    """A field that gives the labels of ``rows`` the greatest likelihood, with an L2 penalty.

    Rows are features of a run's words and their labels; pieces of a run teach its edges only
    where they have them. Without rows nothing is ever labelled.
    """
    alike = Counter((tuple(x), tuple(y), *(map(tuple, edges) if edges else [(True, True)])) for x, y, *edges in rows if x)
    known: dict[str, int] = {}
    for x, _, _ in alike:
        for word in x:
            for f in word:
                known.setdefault(f, len(known))
    n_labels = len(LABELS)
    if not alike:
        return Crf({}, np.zeros((0, n_labels)), *_bare())
    items = list(alike.items())
    weight = np.array([c for _, c in items], float)
    weight = np.sqrt(weight) / np.sqrt(weight).sum()
    n, t_max = len(items), max(len(x) for (x, _, _), _ in items)
    sizes = np.array([len(x) for (x, _, _), _ in items])
    begins, closes = np.array([edges for (_, _, edges), _ in items], float).T[:, :, None]
    gold = np.zeros((n, t_max), np.int64)
    words: dict[tuple[str, ...], int] = {}
    code = np.zeros((n, t_max), np.int64)
    for k, ((x, y, _), _) in enumerate(items):
        gold[k, : len(y)] = y
        code[k, : len(x)] = [words.setdefault(w, len(words)) for w in x]
    has = np.zeros((len(words), len(known)))
    for w, k in words.items():
        has[k, [known[f] for f in w]] = 1
    inside = np.arange(t_max) < sizes[:, None]
    spans = [(len(known), n_labels), (n_labels, n_labels), (n_labels,), (n_labels,)]
    parts = [np.zeros(s) for s in spans]
    m, v = [np.zeros(s) for s in spans], [np.zeros(s) for s in spans]

    def log_sum(a: np.ndarray, axis: int) -> np.ndarray:
        top = a.max(axis, keepdims=True)
        return np.squeeze(top, axis) + np.log(np.exp(a - top).sum(axis))

    for step in range(1, steps + 1):
        unary, pairs, first, last = parts
        e = (has @ unary)[code]
        ahead = [begins * first + e[:, 0]]
        for t in range(1, t_max):
            ahead.append(np.where(inside[:, t, None], log_sum(ahead[-1][:, :, None] + pairs, 1) + e[:, t], ahead[-1]))
        total = log_sum(ahead[-1] + closes * last, 1)
        behind = closes * last
        g_words = np.zeros((len(words), n_labels))
        g_pairs, g_first, g_last = np.zeros_like(pairs), np.zeros_like(first), np.zeros_like(last)
        for t in range(t_max - 1, -1, -1):
            here = inside[:, t]
            p = np.exp(ahead[t] + behind - total[:, None]) * (weight * here)[:, None]
            ends = here & (t == sizes - 1)
            np.add.at(g_words, code[here, t], -p[here])
            np.add.at(g_words, (code[here, t], gold[here, t]), weight[here])
            g_last -= (closes * p)[ends].sum(0)
            np.add.at(g_last, gold[ends, t], (weight * closes[:, 0])[ends])
            if t == 0:
                g_first -= (begins * p).sum(0)
                np.add.at(g_first, gold[:, 0], weight * begins[:, 0])
            else:
                q = ahead[t - 1][:, :, None] + pairs + (e[:, t] + behind)[:, None, :] - total[:, None, None]
                g_pairs -= (np.exp(q) * (weight * here)[:, None, None]).sum(0)
                np.add.at(g_pairs, (gold[here, t - 1], gold[here, t]), weight[here])
                behind = np.where(here[:, None], log_sum(pairs + (e[:, t] + behind)[:, None, :], 2), behind)
        grads = [has.T @ g_words, g_pairs, g_first, g_last]
        for k in range(4):
            g = grads[k] - penalty / 100 * parts[k]
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.99 * v[k] + 0.01 * g * g
            parts[k] = parts[k] + 0.1 * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)
    unary, pairs, first, last = parts
    none = _bare()
    return Crf(known, unary, pairs + none[0], first + none[1], last)


def _bare() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What cannot be: an inner label that follows anything but the same kind."""
    pairs, first = np.zeros((len(LABELS),) * 2), np.zeros(len(LABELS))
    for k in range(len(KINDS)):
        inner = 2 + 2 * k
        pairs[:, inner] = -1e6
        pairs[[inner - 1, inner], inner] = 0
        first[inner] = -1e6
    return pairs, first, np.zeros(len(LABELS))


def _labels(text: str, run: list[tuple[int, int]], spans: list[tuple[int, int, int]]) -> Labelled:
    labels, before = [], None
    for a, b in run:
        hit = next((s for s in spans if s[0] < b and a < s[1]), None)
        labels.append(_OUT if hit is None else 1 + 2 * hit[2] + (hit == before))
        before = hit
    return [features(text[a:b]) for a, b in run], labels


def labelled_lines() -> list[Labelled]:
    """The runs of ``LINES`` with their labels."""
    out = []
    for line in LINES:
        text, spans = "", []
        for part in re.split(r"(\{\w+:[^}]*\})", line):
            if part.startswith("{"):
                kind, value = part[1:-1].split(":", 1)
                spans.append((len(text), len(text) + len(value), KINDS.index(kind)))
                part = value
            text += part
        out += [_labels(text, run, spans) for run in runs(text)]
    return out


def labelled_runs(text: str, most_words: int = MOST_WORDS) -> list[Labelled]:
    """Runs of a text with the labels that the rules give their words.

    A run of over ``most_words`` words comes in pieces that say which edges of it they have.
    Pieces with something of a rule's form that failed its other conditions are left out: it
    may be two things that stand side by side.
    """
    spans = rule_spans(text)
    kept = {s[:2] for s in spans}
    doubtful = [m.span() for form in (_IP, _CARD, _PHONE) for m in form.finditer(text) if m.span() not in kept and len(_NOT_DIGIT.sub("", m[0])) >= 9]
    out = []
    for run in runs(text):
        words, labels = _labels(text, run, spans)
        for k in range(0, len(run), most_words):
            piece = run[k : k + most_words]
            if not any(a < piece[-1][1] and piece[0][0] < b for a, b in doubtful):
                out.append((words[k : k + most_words], labels[k : k + most_words], (k == 0, k + most_words >= len(run))))
    return out


def train(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", most_documents: int = MOST_DOCUMENTS, most_words: int = MOST_WORDS) -> Crf:
    """A field trained on a small table of labelled runs.

    The table has ``LINES`` and what the rules say of ``most_documents`` documents with
    digits, those with the smallest hash of their id; it holds the ``most_documents`` most frequent
    kinds of run once with their number, which counts up to 100, long ones in pieces of ``most_words``
    words. Rows without id are not used here.
    """
    ship(docs.sparkSession)
    given = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    given = given.where(F.col("id").isNotNull() & F.col("text").rlike("[0-9@]"))
    chosen = given.select("id").orderBy(F.xxhash64("id"), "id").limit(most_documents)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for text in batch.column("text").to_pylist():
                seen.update((tuple(x), tuple(y), edges) for x, y, edges in labelled_runs(text, most_words))
        rows = list(seen.items())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([list(map(list, x)) for (x, _, _), _ in rows], pa.list_(pa.list_(pa.string()))),
                pa.array([list(y) for (_, y, _), _ in rows], pa.list_(pa.int32())),
                pa.array([list(edges) for (_, _, edges), _ in rows], pa.list_(pa.bool_())),
                pa.array([c for _, c in rows], pa.int64()),
            ],
            names=["words", "labels", "edges", "n"],
        )

    texts = given.join(F.broadcast(chosen.distinct()), "id").select("text")
    found = texts.mapInArrow(label, "words array<array<string>>, labels array<int>, edges array<boolean>, n long")
    found = found.groupBy("words", "labels", "edges").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "words", "labels", "edges").limit(most_documents)
    rows = [([tuple(w) for w in r["words"]], list(r["labels"]), tuple(r["edges"])) for r in found.collect() for _ in range(min(r["n"], 100))]
    return fit(rows + 20 * labelled_lines())


def _is_card(text: str) -> bool:
    digits = _NOT_DIGIT.sub("", text)
    return 12 <= len(digits) <= 19 and luhn(digits)


def _added(texts: list[str], rules: list[list[tuple[int, int, int]]], model: Crf) -> list[list[tuple[int, int, int]]]:
    """What the field finds in each text beside the rules' spans; a card has to have its check digit."""
    placed = [(k, run) for k, text in enumerate(texts) for run in runs(text)]
    found = model.decode([[features(texts[k][a:b]) for a, b in run] for k, run in placed])
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for (k, run), labels in zip(placed, found, strict=True):
        t = 0
        while t < len(run):
            if labels[t] == _OUT:
                t += 1
                continue
            stop = t + 1
            while stop < len(run) and labels[stop] != _OUT and labels[stop] % 2 == 0:
                stop += 1
            begin, end = run[t][0], run[stop - 1][1]
            while end > begin and texts[k][end - 1] in ".,;:!?\"'>]":
                end -= 1
            while begin < end and texts[k][begin] in "\"'<[,;:":
                begin += 1
            kind = (labels[t] - 1) // 2
            sound = begin < end and (KINDS[kind] != "card" or _is_card(texts[k][begin:end]))
            if sound and not any(a < end and begin < b for a, b, _ in rules[k]):
                out[k].append((begin, end, kind))
            t = stop
    return out


_SPANS = "array<struct<kind:string,start:int,end:int,base:boolean>>"
_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())])


def find(docs: DataFrame, model: Crf, text_column: str = "text", spans_column: str = "pii", redact: bool = False) -> DataFrame:
    """``docs`` with the personal data of each text: kind, start and end (code points), base.

    base marks what the rules found. Spans go by start, then kind. With ``redact`` the text
    has ``<KIND>`` in place of each span; spans that overlap are replaced as one, named after
    the first.

    Null and empty texts have none; a null text stays null. Every row gives a row with all its
    columns; one named as the spans is replaced. An empty table gives an empty result.
    """
    ship(docs.sparkSession)
    docs = docs.drop(spans_column)
    schema = extended(docs, {spans_column: _SPANS})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signal = np.zeros(256, bool)
        signal[[*range(48, 58), ord("@")]] = True
        for batch in batches:
            for block in blocks(batch, text_column):
                data, offsets = text_buffers(block.column(text_column))
                sums = np.concatenate([[0], np.cumsum(signal[data], dtype=np.int64)])
                some = np.flatnonzero(sums[offsets[1:]] > sums[offsets[:-1]])
                texts = block.column(text_column).take(pa.array(some)).to_pylist()
                rules = [rule_spans(t) for t in texts]
                added = _added(texts, rules, model)
                spans: list[list[dict]] = [[] for _ in range(block.num_rows)]
                clean = block.column(text_column).to_pylist() if redact else []
                for k, text, own, more in zip(some.tolist(), texts, rules, added, strict=True):
                    every = sorted([(a, kind, b, True) for a, b, kind in own] + [(a, kind, b, False) for a, b, kind in more])
                    spans[k] = [{"kind": KINDS[kind], "start": a, "end": b, "base": base} for a, kind, b, base in every]
                    if redact and every:
                        clean[k] = _replaced(text, every)
                columns = dict(zip(block.schema.names, block.columns, strict=True))
                if redact:
                    columns[text_column] = pa.array(clean, pa.string())
                yield pa.RecordBatch.from_arrays([*columns.values(), pa.array(spans, pa.list_(_SPAN))], names=[*columns, spans_column])

    return docs.mapInArrow(run, schema)


def _replaced(text: str, spans: list[tuple[int, int, int, bool]]) -> str:
    out, at = [], 0
    for a, kind, b, _ in spans:
        if a >= at:
            out += [text[at:a], f"<{KINDS[kind].upper()}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redacted(docs: DataFrame, model: Crf, text_column: str = "text") -> DataFrame:
    """``docs`` with personal data replaced in its texts, all rows and columns kept; see ``find``."""
    (name,) = fresh(docs.columns, "pii")
    return find(docs, model, text_column, name, redact=True).drop(name)
