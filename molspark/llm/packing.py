"""Order-preserving packing of documents into training sequences.

The tasks tokenise whole documents and cut the stream of tokens into windows by
dynamic programming: over the allowed cuts (document ends, sentence ends, and
dearer cuts inside a sentence) it minimises padding plus penalties for cutting
a document. The best start of a window of at most the sequence length is the
front of a monotone queue, so a cut costs amortised constant time.

Windows never span tasks: nothing is shuffled, and a task that runs again gives
the same rows.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: A space that surely starts a pre-token, whatever white space is around it.
_SAFE_SPACE = re.compile(r"(?<=\S) (?=\S)")
#: Marks the first unit of a text, which no space goes before; a character that
#: texts, being valid UTF-8, never hold.
_FIRST = "\udfff"
_MARKS = ".,;:!?#$%&*"
#: How byte-level tokenizers write bytes: printable Latin-1 as itself, all others
#: as the characters from 256 on, in order.
_UNSEEN = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255)]
_WRITTEN = {b: chr(256 + i) for i, b in enumerate(_UNSEEN)}
_BLANK = _WRITTEN[32]
_SENTENCE_END = re.compile(r"""[.!?…]["')\]»”]*\s*$|\n\s*$""")


@dataclass(frozen=True)
class Params:
    """``sentence_cost`` and ``inner_cost``: what a cut inside a document costs
    at a sentence end and elsewhere, in tokens of padding. Windows of a power of
    two from ``least_power`` on need no padding. ``buffer``: tokens per run of
    the dynamic programme; its last two windows go on into the next run."""

    length: int = 1024
    end_id: int = 0
    sentence_cost: float = 2.0
    inner_cost: float = 10.0
    least_power: int = 128
    buffer: int = 1 << 17


def _room(array: np.ndarray, size: int) -> np.ndarray:
    """``array``, doubled until it has ``size`` places."""
    while len(array) < size:
        array = np.concatenate([array, np.empty_like(array)])
    return array


class Units:
    """Token ids of whole texts by way of their space-separated units.

    A byte-level tokenizer splits before every single space, so a text's ids are
    the joined ids of its units, and each distinct unit is encoded once. The
    strings of added tokens (``<|endoftext|>``) have their own ids, as the
    tokenizer as loaded gives them; what stands between two is a text of its own. Where
    white space stands around a split (two spaces and more), the text is split
    only at spaces between two other characters. The memory of units is bounded
    and starts anew when it is full.
    """

    def __init__(self, path: str, most: int = 800_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core per task
        from tokenizers import Tokenizer, pre_tokenizers

        tokenizer = Tokenizer.from_file(path)
        self.split, self.model, self.most = tokenizer.pre_tokenizer, tokenizer.model, most
        if (tokenizer.normalizer or not isinstance(self.split, pre_tokenizers.ByteLevel)
                or self.split.add_prefix_space):
            raise ValueError("units hold for byte-level tokenizers without normaliser and added space")
        tokens = tokenizer.get_added_tokens_decoder()
        if any(t.lstrip or t.rstrip or t.single_word for t in tokens.values()):
            raise ValueError("added tokens that take spaces or whole words with them are not covered")
        self.added = {t.content: i for i, t in tokens.items()}
        longest_first = sorted(self.added, key=len, reverse=True)
        self.at_added = re.compile(f"({'|'.join(map(re.escape, longest_first))})") if self.added else None
        self.forget()

    def forget(self) -> None:
        self.places: dict[str, int] = {}
        self.words: dict[str, bytes] = {}  # ids of the pre-tokens met so far, four bytes each
        self.ids = np.empty(1 << 16, np.uint32)  # the units' ids, one after another
        self.starts = np.zeros(1 << 16, np.int64)  # of each unit in ids, and the end
        self.ends_sentence = np.empty(1 << 16, bool)
        self.starts_blank = np.empty(1 << 16, bool)

    def _words(self, unit: str) -> list[str]:
        """Pre-tokens of a unit; a word, or a word and marks, is known by sight."""
        word = unit.rstrip(_MARKS)
        if word.isalpha():
            written = _BLANK + (word if word.isascii() else word.encode().decode("latin-1").translate(_WRITTEN))
            return [written, unit[len(word):]] if len(word) < len(unit) else [written]
        text = unit[1:] if unit[:1] == _FIRST else " " + unit
        return [word for word, _ in self.split.pre_tokenize_str(text)]

    def learn(self, units: list[str]) -> None:
        flat, stops = bytearray(), []
        words, tokenize = self.words, self.model.tokenize
        for unit in units:
            for word in self._words(unit):
                if (ids := words.get(word)) is None:
                    ids = words[word] = array("I", [t.id for t in tokenize(word)]).tobytes()
                flat += ids
            stops.append(len(flat))
        at = len(self.places)
        base, end, size = int(self.starts[at]), at + len(units), len(flat) // 4
        self.ids = _room(self.ids, base + size)
        self.ids[base:base + size] = np.frombuffer(flat, np.uint32)
        self.starts = _room(self.starts, end + 1)
        self.starts[at + 1:end + 1] = base + np.array(stops, np.int64) // 4
        self.ends_sentence, self.starts_blank = _room(self.ends_sentence, end), _room(self.starts_blank, end)
        self.ends_sentence[at:end] = [not u[-1:].isalpha() and bool(_SENTENCE_END.search(u)) for u in units]
        self.starts_blank[at:end] = [not u[:1].isalpha() and not u[:1].strip() for u in units]
        self.places.update(zip(units, range(at, end)))

    def _lookup(self, texts: list[list[str]]) -> list[np.ndarray]:
        new = set().union(*texts).difference(self.places)
        if new:
            if len(self.places) > self.most:
                self.forget()
                new = set().union(*texts)
            self.learn(list(new))
        return [np.fromiter(map(self.places.__getitem__, units), np.int64, len(units)) for units in texts]

    @staticmethod
    def _split(text: str, safe: bool) -> list[str]:
        """Units without their leading space; the first has none, which a mark says."""
        units = (_SAFE_SPACE.split(text) if safe else text.split(" ")) if text else []
        if units:
            units[0] = _FIRST + units[0]
        return units

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each text its ids and the offsets after which a sentence ends; an
        added token ends one too."""
        if self.at_added is None:
            return self._encode_plain(texts)
        split = [self.at_added.split(t) for t in texts]  # text, token, text, ...
        plain = iter(self._encode_plain([piece for pieces in split for piece in pieces[::2]]))
        out = []
        for pieces in split:
            got = next(plain)
            if len(pieces) > 1:
                ids, ends, size = [got[0]], [got[1]], len(got[0])
                for token in pieces[1::2]:
                    more, stops = next(plain)
                    ids += [np.array([self.added[token]], np.uint32), more]
                    ends += [[size + 1], stops + size + 1]
                    size += 1 + len(more)
                got = np.concatenate(ids), np.unique(np.concatenate(ends).astype(np.int64))
            out.append(got)
        return out

    def _encode_plain(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        rows = self._lookup([self._split(t, False) for t in texts])
        odd = [i for i, at in enumerate(rows) if self.starts_blank[at[1:]].any()]
        if odd:  # looked up together, as the memory may start anew in between
            rows = self._lookup([self._split(t, i in set(odd)) for i, t in enumerate(texts)])
        out = []
        for at in rows:
            first, sizes = self.starts[at], self.starts[at + 1] - self.starts[at]
            stops = np.cumsum(sizes)
            total = int(stops[-1]) if len(stops) else 0
            flat = np.repeat(first - (stops - sizes), sizes) + np.arange(total)
            out.append((self.ids[flat], stops[self.ends_sentence[at]]))
        return out


def best_cuts(n: int, cuts: np.ndarray, costs: np.ndarray, params: Params = Params()) -> list[int]:
    """Ends of the windows that cover 0..n at the least padding plus cost.

    ``cuts``: ascending allowed ends in 1..n with their ``costs``; n itself is
    always allowed. Between them further cuts at ``inner_cost`` are tried: a
    full window after each allowed one, and as many as long gaps need. Ties go to the earliest start of the last window.
    """
    length = params.length
    points = np.union1d(np.append(cuts, n), np.append(cuts, 0) + length)
    points = points[points <= n]
    gaps = np.flatnonzero(np.diff(np.append(0, points)) > length)
    if len(gaps):
        edges = np.append(0, points)
        points = np.union1d(points, np.concatenate(
            [np.arange(edges[g], edges[g + 1], length)[1:] for g in gaps]))
    prices = np.full(len(points), params.inner_cost)
    prices[np.searchsorted(points, cuts)] = costs
    prices[-1] = 0.0
    powers = [p for p in (1 << k for k in range(length.bit_length())) if params.least_power <= p < length]
    # Starts of power-of-two windows are few: only ends that another point precedes so are looked up.
    exact = np.zeros(len(points), bool)
    for size in powers:
        exact |= np.isin(points - size, points, assume_unique=True) | (points == size)
    cost: dict[int, float] = {0: 0.0}
    back: dict[int, int] = {}
    # The monotone queue: starts and their cost plus start, which ascends from ``front`` on.
    starts, values, front = [0], [0.0], 0
    for p, price, tried in zip(points.tolist(), prices.tolist(), exact.tolist()):
        oldest = p - length
        while starts[front] < oldest:
            front += 1
        start, best = starts[front], values[front] + length - p
        if tried:
            for size in powers:
                if (c := cost.get(p - size)) is not None and c < best:
                    best, start = c, p - size
        best += price
        cost[p], back[p] = best, start
        value = best + p
        while len(values) > front and values[-1] > value:
            values.pop()
            starts.pop()
        values.append(value)
        starts.append(p)
    out, p = [], n
    while p > 0:
        out.append(p)
        p = back[p]
    return out[::-1]


class Packer:
    """Cuts one task's stream of documents; rows come out in order."""

    def __init__(self, params: Params, first_sequence: int):
        self.params, self.sequence = params, first_sequence
        self.pieces: list[np.ndarray] = []
        self.documents: list[tuple[object, int, int, int]] = []  # key, at, start in document, tokens
        self.cuts: list[np.ndarray] = []
        self.costs: list[np.ndarray] = []
        self.held = 0

    def add(self, key: object, ids: np.ndarray, sentences: np.ndarray) -> Iterator[tuple]:
        p = self.params
        whole = np.append(ids, np.uint32(p.end_id)).astype("<u4")
        n = len(whole)
        inner = sentences[sentences < n]
        cuts, costs = np.append(inner, n), np.append(np.full(len(inner), p.sentence_cost), 0.0)
        done = 0
        while done < n:  # a document longer than the buffer goes in by parts
            take = min(n - done, max(p.buffer - self.held, p.length))
            here = (cuts > done) & (cuts <= done + take)
            self.documents.append((key, self.held, done, n))
            self.cuts.append(cuts[here] - done + self.held)
            self.costs.append(costs[here])
            self.pieces.append(whole[done:done + take])
            self.held += take
            done += take
            if self.held >= p.buffer:
                yield from self.flush(False)

    def flush(self, last: bool) -> Iterator[tuple]:
        """Rows of the windows held so far; without ``last`` all but the final two."""
        if not self.held:
            return
        ids, cuts, costs = (np.concatenate(x) for x in (self.pieces, self.cuts, self.costs))
        ends = best_cuts(self.held, cuts, costs, self.params)
        keep_from = self.held if last else (ends[-3] if len(ends) > 2 else 0)
        docs, d, begin = self.documents, 0, 0
        starts = [x[1] for x in docs] + [self.held]
        for end in ends:
            if end > keep_from:
                break
            at = begin
            while at < end:
                while starts[d + 1] <= at:
                    d += 1
                stop = min(end, starts[d + 1])
                key, base, done, total = docs[d]
                yield (key, done + at - base, stop - at, zlib.crc32(ids[at:stop].tobytes()), total,
                       self.sequence, at - begin)
                at = stop
            self.sequence += 1
            begin = end
        rest = [(key, max(0, base - keep_from), done + max(0, keep_from - base), total)
                for (key, base, done, total), stop in zip(docs, starts[1:]) if stop > keep_from]
        later = cuts > keep_from
        self.documents = rest
        self.pieces, self.cuts, self.costs = ([ids[keep_from:]], [cuts[later] - keep_from], [costs[later]])
        self.held -= keep_from


def pack(docs: DataFrame, tokenizer_path: str, key: str = "doc_id", text: str = "text",
         params: Params = Params()) -> DataFrame:
    """One row per piece: key, start, length, ids_crc32, doc_tokens,
    sequence_id, offset.

    A document is its ids and ``end_id``; null and empty texts are that id
    alone. Every id lies in exactly one piece, documents keep the order in
    which their task reads them, repeated rows are packed each on their own, and
    a sequence's offsets run from 0 without a gap. An empty table gives no row.
    A text longer than the buffer goes through in parts, cut like any other. Of
    equally cheap windows the one with the earliest start is taken. Only ``key``
    and ``text`` are read, so further columns cannot clash with the result's.
    sequence_id is unique: the task's partition number and a counter.
    """
    kind = docs.schema[key].dataType
    schema = T.StructType([
        T.StructField(key, kind), T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()),
        T.StructField("doc_tokens", T.LongType()), T.StructField("sequence_id", T.LongType()),
        T.StructField("offset", T.LongType())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = Units(tokenizer_path)
        packer = Packer(params, TaskContext.get().partitionId() << 40)
        rows: list[tuple] = []
        arrow = None

        def batch() -> pa.RecordBatch:
            cols = list(zip(*rows))
            rows.clear()
            return pa.record_batch([pa.array(cols[0], arrow),
                                    *[pa.array(c, pa.int64()) for c in cols[1:]]], schema.names)

        for got in batches:
            arrow = got.schema.field(0).type
            for at in range(0, got.num_rows, 256):
                part = got.slice(at, 256)
                texts = [t or "" for t in part.column(1).to_pylist()]
                for k, (ids, sentences) in zip(part.column(0).to_pylist(), units.encode(texts)):
                    rows.extend(packer.add(k, ids, sentences))
                if len(rows) >= 10_000:
                    yield batch()
        rows.extend(packer.flush(True))
        if rows:
            yield batch()

    return docs.select(key, text).mapInArrow(task, schema)
