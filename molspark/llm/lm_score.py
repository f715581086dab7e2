"""Document scores by cross-entropy difference of two n-gram models.

A target and a background bigram model share one vocabulary (every word of all
documents), one smoothing and one total count, so their per-token losses differ
only by what the texts say. The occurrences of a word, with the word before and
the document, meet in one task, which counts the word and its pairs and adds up
its losses by document: no table of pairs is written, and nothing is joined
with the documents' own pairs. Words are taken in several shares, one after
another, whose shuffles are removed in between, which bounds the disk.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import freed_shuffles, mix64, stored, words

#: Stand for the words outside a bounded vocabulary and for the start of a document.
_REST, _START = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
#: Words of the documents that a task looks at together.
CHUNK = 2_000_000
#: Shares of the words that are shuffled one after another; occurrences of a task.
SHARES, TASK = 4, 1_000_000
#: Bits of a document's number within a file, that of the stored table's rows.
_LOW = 28
#: Bits of it within a block, whose sums go together.
_BLOCK = 12


@dataclass(frozen=True)
class Params:
    """``vocabulary``: None for every word of the documents; a number keeps the
    most frequent words only, as that many entries with the rest-of-words and
    the start-of-document entry included. ``prior``: weight, in tokens, of the
    unigram distribution in each context. ``local``: a pair that makes up one
    in so many tokens is looked up where the text is read instead of shuffled,
    and a word that does is dealt to several tasks; there are at most as many of
    each, and no key is hot."""

    vocabulary: int | None = None
    prior: float = 20.0
    local: int = 1 << 12


def vocabulary(docs: DataFrame, text: str = "text", params: Params = Params()) -> np.ndarray:
    """Ascending hashes of the most frequent words of all documents (ties to
    the smaller hash)."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def batch() -> pa.RecordBatch:
            keys, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            return pa.record_batch([pa.array(keys.view(np.int64)), pa.array(n)], ["word", "n"])

        for got in batches:
            for t in got.column(0):
                held.append(words(t.as_py())[0])
                size += len(held[-1])
                if size > 4_000_000:
                    yield batch()
                    size = 0
        if size:
            yield batch()

    rows = (docs.select(text).mapInArrow(count, "word long, n long")
            .groupBy("word").agg(F.sum("n").alias("n"))
            .orderBy(F.desc("n"), "word").limit(params.vocabulary - 2).select("word").toArrow())
    return np.sort(rows["word"].to_numpy().view(np.uint64))


@dataclass(frozen=True)
class Tokens:
    """The words of some documents, one after another: each with the word
    before, its document's place in ``rows``, whether that is a target and
    whether it is the document's last word."""

    rows: pa.RecordBatch
    word: np.ndarray
    before: np.ndarray
    doc: np.ndarray
    own: np.ndarray
    last: np.ndarray


def _tokens(batches: Iterator[pa.RecordBatch], known: np.ndarray | None) -> Iterator[Tokens]:
    """The documents (no, own, text, ...) in chunks; every document is in one."""
    held: list[np.ndarray] = []
    parts: list[pa.RecordBatch] = []

    def chunk() -> Tokens:
        rows = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
        sizes = np.array([len(x) for x in held])
        word = np.concatenate(held)
        if known is not None:
            word = np.where(np.isin(word, known), word, _REST)
        ends = np.cumsum(sizes)[sizes > 0]
        last, before = np.zeros(len(word), bool), np.empty(len(word), np.uint64)
        last[ends - 1] = True
        before[1:] = word[:-1]
        before[np.append(0, ends[:-1])[:len(ends)]] = _START
        doc = np.repeat(np.arange(len(sizes)), sizes)
        own = rows.column("own").to_numpy(zero_copy_only=False)
        held.clear()
        parts.clear()
        return Tokens(rows, word, before, doc, own[doc], last)

    waiting, here = 0, -1
    for got in batches:
        high = got.column("no").to_numpy() >> _LOW  # of one file of the table
        cuts = np.union1d(np.arange(0, got.num_rows, 64), np.flatnonzero(np.diff(high)) + 1).tolist()
        for begin, end in zip(cuts, [*cuts[1:], got.num_rows]):
            if parts and (waiting >= CHUNK or high[begin] != here):
                yield chunk()
                waiting = 0
            here = high[begin]
            parts.append(got.slice(begin, end - begin))
            held += [words(t.as_py())[0] for t in parts[-1].column("text")]
            waiting += sum(map(len, held[begin - end:]))
    if parts:
        yield chunk()


@dataclass(frozen=True)
class Model:
    """Totals, and what is known of the most frequent words and pairs."""

    known: np.ndarray | None
    words: np.ndarray  # ascending, the start of a document with them
    dealt: np.ndarray  # tasks that the occurrences of each are dealt to
    smooth: np.ndarray  # (2, words): smoothing of the pairs with each as second word
    context: np.ndarray  # (2, words): log denominators of the pairs with each as first word
    pairs: np.ndarray  # ascending places of the first word * len(words) + of the second
    losses: np.ndarray  # (2, pairs): their whole losses
    scale: np.ndarray
    mass: np.ndarray
    prior: float

    def smoothing(self, counts: np.ndarray) -> np.ndarray:
        return (counts * self.scale[:, None] + 1.0) * (self.prior / self.mass)[:, None]

    def denominators(self, counts: np.ndarray) -> np.ndarray:
        return np.log(counts * self.scale[:, None] + self.prior)

    def place(self, word: np.ndarray) -> np.ndarray:
        """Of each word among the frequent ones, or -1."""
        at = np.minimum(np.searchsorted(self.words, word), len(self.words) - 1)
        return np.where(self.words[at] == word, at, -1)

    def frequent(self, before: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Of each pair among the frequent ones, or -1, by the words' places."""
        if not len(self.pairs):
            return np.full(len(word), -1)
        pair = before * len(self.words) + word
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        return np.where((before >= 0) & (word >= 0) & (self.pairs[at] == pair), at, -1)


def _groups(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, starts of the runs of equal keys in it)"""
    order = np.argsort(key, kind="stable")
    key = key[order]
    return order, np.flatnonzero(np.append(True, key[1:] != key[:-1])[:len(key)])


def _weighed(keys: np.ndarray, *weights: np.ndarray) -> list[pa.Array]:
    """The distinct keys and the sum of each weight."""
    order, first = _groups(keys)
    return [pa.array(keys[order][first].astype(np.int64) if keys.dtype != np.uint64 else keys[order][first].view(np.int64)),
            *[pa.array(np.add.reduceat(w[order].astype(np.int64), first)) for w in weights]]


def word_counts(texts: DataFrame, known: np.ndarray | None) -> DataFrame:
    """(word, st, se, bt, be): of each word how often it occurs in the targets
    and in all documents, and how often it goes before another there. The
    start of a document is not among them."""
    shared = texts.sparkSession.sparkContext.broadcast(known)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _tokens(batches, shared.value):
            if len(t.word):
                cols = _weighed(t.word, t.own, np.ones(len(t.word)), t.own & ~t.last, ~t.last)
                whole = pa.record_batch(cols, ["word", "st", "se", "bt", "be"])
                yield from (whole.slice(at, 100_000) for at in range(0, len(whole), 100_000))

    return (texts.mapInArrow(count, "word long, st long, se long, bt long, be long")
            .groupBy("word").agg(*[F.sum(c).alias(c) for c in ("st", "se", "bt", "be")]))


def fit(texts: DataFrame, known: np.ndarray | None, params: Params) -> tuple[Model, int]:
    """(model, words of all documents)"""
    spark = texts.sparkSession
    single = stored(word_counts(texts, known), "lm-words")
    sums = single.agg(F.count("word"), *[F.sum(c) for c in ("st", "se", "bt", "be")]).head()
    distinct, st, se, bt, be = (int(x or 0) for x in sums)
    tokens = np.array([st, se], float)
    total = min(tokens) or 1.0
    scale = total / np.maximum(1.0, tokens)
    mass = np.where(tokens > 0, total, 0.0) + (params.vocabulary or distinct + 2)
    least = max(2.0, se / params.local)
    often = single.where(F.col("se") >= least).toArrow()
    word = np.append(often["word"].to_numpy().view(np.uint64), _START)
    order = np.argsort(word)
    # Every document with words has a last one, and so a start.
    counts = {c: np.append(often[c].to_numpy().astype(float), end)[order]
              for c, end in (("st", 0), ("se", 0), ("bt", st - bt), ("be", se - be))}
    none = Model(known, word[order], np.maximum(1, np.ceil(counts["se"] / least)).astype(np.int64),
                 *[np.empty((2, 0))] * 2, np.empty(0, np.int64), np.empty((2, 0)), scale, mass, params.prior)
    smooth = none.smoothing(np.stack([counts["st"], counts["se"]]))
    context = none.denominators(np.stack([counts["bt"], counts["be"]]))
    shared = spark.sparkContext.broadcast(none)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for t in _tokens(batches, m.known):
            first, second = m.place(t.before), m.place(t.word)
            some = (first >= 0) & (second >= 0)
            if some.any():
                pair = first[some] * len(m.words) + second[some]
                yield pa.record_batch(_weighed(pair, t.own[some], np.ones(len(pair))), ["pair", "t", "e"])

    both = (texts.mapInArrow(count, "pair long, t long, e long").groupBy("pair")
            .agg(F.sum("t").alias("t"), F.sum("e").alias("e")).where(F.col("e") >= least).orderBy("pair").toArrow())
    pair = both["pair"].to_numpy()
    a, b = pair // len(word), pair % len(word)
    losses = context[:, a] - np.log(np.stack([both["t"].to_numpy(), both["e"].to_numpy()]) * scale[:, None] + smooth[:, b])
    return Model(known, none.words, none.dealt, smooth, context, pair, losses, scale, mass, params.prior), se


_OCCURRENCES = "word long, part long, base long, before array<long>, doc array<int>"


def occurrences(texts: DataFrame, shared, share: int) -> DataFrame:
    """(word, part, base, before, doc): the occurrences of the words of one
    share, those of frequent pairs left out. ``doc`` is the document's number
    less ``base``, times four, plus two for its last word and one for a target.
    The ``part`` of a frequent word goes by the word before."""
    def emit(key: np.ndarray, part: np.ndarray, t: Tokens, at: np.ndarray) -> Iterator[pa.RecordBatch]:
        order, first = _groups(key)
        at, part = at[order], part[order][first]
        number = t.rows.column("no").to_numpy()
        base = int(number[0]) >> _LOW << _LOW
        doc = ((number - base)[t.doc[at]] * 4 + t.last[at] * 2 + t.own[at]).astype(np.int32)
        offsets = pa.array(np.append(first, len(at)).astype(np.int32))
        whole = pa.record_batch([
            pa.array(t.word[at][first].view(np.int64)), pa.array(part), pa.array(np.full(len(first), base)),
            pa.ListArray.from_arrays(offsets, pa.array(t.before[at].view(np.int64))),
            pa.ListArray.from_arrays(offsets, pa.array(doc))], ["word", "part", "base", "before", "doc"])
        yield from (whole.slice(i, 20_000) for i in range(0, len(whole), 20_000))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = shared.value
        for t in _tokens(batches, m.known):
            here = np.flatnonzero(t.word % np.uint64(SHARES) == share)
            first, second = m.place(t.before[here]), m.place(t.word[here])
            left = m.frequent(first, second) < 0
            here, second = here[left], second[left]
            usual = here[second < 0]
            if len(usual):
                yield from emit(t.word[usual], np.zeros(len(usual), np.int64), t, usual)
            dealt, second = here[second >= 0], second[second >= 0]
            if len(dealt):
                part = (mix64(t.before[dealt]) % m.dealt[second].astype(np.uint64)).astype(np.int64)
                yield from emit(second * int(m.dealt.max()) + part, part, t, dealt)

    return texts.mapInArrow(task, _OCCURRENCES)


def document_sums(found: DataFrame, shared) -> DataFrame:
    """(no, a, b): the losses of the words of a share, added up by document. All
    occurrences of a word, or of a frequent word's part, are in one task; what
    it adds to the documents of a block of numbers goes on as one row."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = shared.value
        table = pa.Table.from_batches(list(batches)) if (batches := [b for b in batches if b.num_rows]) else None
        if table is None:
            return
        rows = table.combine_chunks()
        word, at = np.unique(rows["word"].to_numpy().view(np.uint64), return_inverse=True)
        before, doc = (rows[c].combine_chunks().flatten().to_numpy() for c in ("before", "doc"))
        sizes = np.diff(rows["before"].combine_chunks().offsets.to_numpy())
        at = np.repeat(at, sizes)
        number = np.repeat(rows["base"].to_numpy(), sizes) + (doc >> 2)
        own, inner = (doc & 1).astype(float), (doc & 2) == 0
        place = m.place(word)
        known = np.flatnonzero(place >= 0)
        n = len(word)
        count = lambda *w: np.bincount(at, *w, minlength=n).astype(float)
        smooth = m.smoothing(np.stack([count(own), count()]))
        smooth[:, known] = m.smooth[:, place[known]]
        context = m.denominators(np.stack([count(own * inner), count(inner)]))
        context[:, known] = 0.0  # added where the text is read
        order, first = _groups((before.view(np.uint64) << np.uint64(1) | before.view(np.uint64) >> np.uint64(63)) ^ word[at])
        every = np.diff(np.append(first, len(order)))
        pair = np.stack([np.add.reduceat(own[order], first), every]) * m.scale[:, None] + smooth[:, at[order][first]]
        documents, to = np.unique(number[order], return_inverse=True)
        block = documents >> _BLOCK
        first_of = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
        offsets = pa.array(np.append(first_of, len(block)).astype(np.int32))
        cols = [pa.array((documents - (block << _BLOCK)).astype(np.int32))]
        for of_pair, of_word in zip(-np.log(pair), context):
            loss = np.repeat(of_pair, every) + np.where(inner[order], of_word[at[order]], 0.0)
            cols.append(pa.array(np.bincount(to, loss, minlength=len(documents))))
        whole = pa.record_batch([pa.array(block[first_of]), *[pa.ListArray.from_arrays(offsets, c) for c in cols]],
                                ["block", "doc", "a", "b"])
        yield from (whole.slice(i, 100) for i in range(0, len(whole), 100))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}  # of each block: whether a document is in it, and its sums
        for got in batches:
            doc, a, b = (got.column(i).flatten().to_numpy() for i in (1, 2, 3))
            ends = np.cumsum(got.column(1).value_lengths().to_numpy()).tolist()
            for block, begin, end in zip(got.column(0).to_pylist(), [0, *ends], ends):
                if (sums := held.get(block)) is None:
                    sums = held[block] = np.zeros((3, 1 << _BLOCK))
                at = doc[begin:end]  # each document once
                sums[0, at] = 1.0
                sums[1, at] += a[begin:end]
                sums[2, at] += b[begin:end]
        for block, (there, a, b) in held.items():
            at = np.flatnonzero(there)
            yield pa.record_batch([pa.array(at + (block << _BLOCK)), pa.array(a[at]), pa.array(b[at])], ["no", "a", "b"])

    return (found.mapInArrow(task, "block long, doc array<int>, a array<double>, b array<double>")
            .repartition("block").mapInArrow(add, "no long, a double, b double"))


def _local(texts: DataFrame, shared, key: T.DataType) -> DataFrame:
    """(no, key, words, a, b): the number of words and the losses of frequent
    pairs and contexts of every document."""
    schema = T.StructType([T.StructField("no", T.LongType()), T.StructField("key", key), T.StructField("words", T.LongType()),
                           T.StructField("a", T.DoubleType()), T.StructField("b", T.DoubleType())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = shared.value
        for t in _tokens(batches, m.known):
            n = t.rows.num_rows
            first = m.place(t.before)
            pair = m.frequent(first, m.place(t.word))
            sums = []
            for context, loss in zip(m.context, m.losses):
                # The loss of a frequent pair is whole, its context within it.
                each = np.where(first >= 0, context[first], 0.0)
                each[pair >= 0] = loss[pair[pair >= 0]]
                sums.append(pa.array(np.bincount(t.doc, each, minlength=n)))
            yield pa.record_batch([t.rows.column("no"), t.rows.column("key"),
                                   pa.array(np.bincount(t.doc, minlength=n).astype(np.int64)), *sums], schema.names)

    return texts.mapInArrow(task, schema)


def score(docs: DataFrame, target: str = "target", key: str = "doc_id", text: str = "text",
          params: Params = Params()) -> DataFrame:
    """key, n_words, ce_target, ce_background and score of every row of ``docs``.

    ``score`` is ce_background - ce_target, in nats per word: above zero means
    more like the target. Whole texts are scored; a null or wordless text has 0
    words and null losses and score. A null flag is false. Without any target
    row the target model is the uniform prior; an empty table gives no row.
    The rows are written once with a number each, by which sums are brought back.
    """
    spark = docs.sparkSession
    with freed_shuffles(spark):
        texts = stored(docs.select(F.monotonically_increasing_id().alias("no"), F.col(key).alias("key"),
                                   F.coalesce(F.col(target).cast("boolean"), F.lit(False)).alias("own"),
                                   F.col(text).alias("text")), "lm-texts")
        known = None if params.vocabulary is None else vocabulary(texts, "text", params)
        model, tokens = fit(texts, known, params)
        shared = spark.sparkContext.broadcast(model)
        local = stored(_local(texts, shared, docs.schema[key].dataType), "lm-local")
        tasks = max(spark.sparkContext.defaultParallelism, -(-tokens // (SHARES * TASK)))
        sums = [stored(document_sums(occurrences(texts, shared, share).repartition(tasks, "word", "part"), shared), "lm-sums")
                for share in range(SHARES if tokens else 0)]
    every = reduce(DataFrame.unionByName, sums, local.select("no", "a", "b")) \
        .groupBy("no").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))

    def mean(column: str) -> Column:
        return F.when(F.col("words") > 0, F.col(column) / F.col("words"))

    return (local.select("no", "key", "words").join(every, "no")
            .select(F.col("key").alias(key), F.col("words").alias("n_words"), mean("a").alias("ce_target"),
                    mean("b").alias("ce_background"), (mean("b") - mean("a")).alias("score")))
