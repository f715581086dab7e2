"""Benchmark decontamination by latent semantic retrieval.

Benchmark items are cut into passages, weighted by TF-IDF with document
frequencies over all documents, and a distributed randomised SVD of the
passages gives the latent space. Document windows are folded into it; windows
near a passage are candidates, which a longest common subsequence of item and
document and, for paraphrases, a check for the item's answer decide.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stored, words


@dataclass(frozen=True)
class Params:
    """``width``, ``stride``: words of a window and between window starts; a
    window is a whole number of strides.
    ``cosine``: least similarity of a candidate. ``copied``: share of an item's
    words, in order, that a copy holds; from ``paraphrased`` on the answer must
    be there too. ``features``: hash buckets of words. ``block``: passages per
    latent space; larger benchmarks take several blocks. ``kept``: a space has the
    fewest directions that keep this share of the squared length of each of its
    passages, so none is lost; ``rank`` bounds the directions looked at.
    ``least``: words of an item below which nothing is matched."""

    width: int = 24
    stride: int = 6
    cosine: float = 0.4
    copied: float = 0.7
    paraphrased: float = 0.5
    answered: float = 0.8
    features: int = 1 << 18
    block: int = 1024
    rank: int = 1024
    kept: float = 0.8
    iterations: int = 2
    least: int = 5


def document_frequencies(docs: DataFrame, text: str, params: Params) -> tuple[np.ndarray, int]:
    """(documents that hold each feature, documents), over all documents."""
    mask = np.uint64(params.features - 1)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = np.zeros(params.features, np.int64), 0
        for got in batches:
            for t in got.column(0):
                n += 1
                seen = np.zeros(params.features, bool) if len(t.as_py() or "") > 1 << 20 else None
                at = (words(t.as_py())[0] & mask).astype(np.int64)
                if seen is None:
                    at = np.unique(at)
                else:
                    seen[at] = True
                    at = np.flatnonzero(seen)
                held[at] += 1
        some = np.flatnonzero(held)
        yield pa.record_batch([pa.array(np.append(some, -1)), pa.array(np.append(held[some], n))],
                              ["feature", "n"])

    rows = (docs.select(text).mapInArrow(count, "feature long, n long")
            .groupBy("feature").agg(F.sum("n").alias("n")).toArrow())
    out = np.zeros(params.features + 1, np.int64)
    out[rows["feature"].to_numpy()] = rows["n"].to_numpy()
    return out[:-1], int(out[-1])


def passages(benchmark: DataFrame, idf: np.ndarray, item: str, text: str, params: Params) -> DataFrame:
    """(item, no, features, weights): normalised TF-IDF rows of all passages."""
    shared = benchmark.sparkSession.sparkContext.broadcast(idf)
    mask = np.uint64(params.features - 1)
    schema = T.StructType([T.StructField("item", benchmark.schema[item].dataType), T.StructField("no", T.IntegerType()),
                           T.StructField("features", T.ArrayType(T.IntegerType())),
                           T.StructField("weights", T.ArrayType(T.FloatType()))])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for got in batches:
            rows = []
            for key, t in zip(got.column(0).to_pylist(), got.column(1).to_pylist()):
                at = (words(t)[0] & mask).astype(np.int64)
                if len(at) < params.least:
                    continue
                for no, begin in enumerate(range(0, max(1, len(at) - params.width // 2), params.width // 2)):
                    f, n = np.unique(at[begin:begin + params.width], return_counts=True)
                    w = n * shared.value[f]
                    if norm := float(np.sqrt((w * w).sum())):
                        rows.append((key, no, f.astype(np.int32), (w / norm).astype(np.float32)))
            cols = list(zip(*rows)) or [[]] * 4
            yield pa.record_batch([pa.array(cols[0], got.schema.field(0).type), pa.array(cols[1], pa.int32()),
                                   pa.array(cols[2], pa.list_(pa.int32())),
                                   pa.array(cols[3], pa.list_(pa.float32()))], schema.names)

    return benchmark.select(item, text).mapInArrow(cut, schema)


def randomised_svd(rows: DataFrame, vocabulary: np.ndarray, rank: int, iterations: int = 2,
                   seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(right singular vectors as columns, singular values) of the sparse rows
    (features, weights) over the ascending ``vocabulary``.

    A random test matrix is refined by passes over the rows: every task adds up
    A'(A X) of its rows, partial sums meet in a tree, and the driver only
    orthonormalises the (vocabulary x rank) result.
    """
    sc = rows.sparkSession.sparkContext
    data = rows.select("features", "weights").rdd.map(
        lambda r: (np.searchsorted(vocabulary, np.array(r[0])), np.array(r[1])))

    def over(x: np.ndarray, gram: bool) -> np.ndarray:
        shared = sc.broadcast(x)

        def add(part) -> Iterator[np.ndarray]:
            x = shared.value
            out = np.zeros((x.shape[1], x.shape[1]) if gram else x.shape)
            for f, w in part:
                y = w @ x[f]
                if gram:
                    out += np.outer(y, y)
                else:
                    out[f] += np.outer(w, y)
            yield out

        try:
            return data.mapPartitions(add).treeReduce(np.add)
        finally:
            shared.destroy()

    rank = min(rank, len(vocabulary))
    q = np.random.default_rng(seed).standard_normal((len(vocabulary), rank))
    for _ in range(max(1, iterations)):
        q = np.linalg.qr(over(q, False))[0]
    values, turn = np.linalg.eigh(over(q, True))
    keep = np.flatnonzero(values > 1e-9 * max(values.max(), 1e-300))[::-1]
    return q @ turn[:, keep], np.sqrt(values[keep])


def directions(latent: np.ndarray, kept: float) -> int:
    """How many of the leading columns hold ``kept`` of the squared length of
    every row (rows of length 0 ask for none)."""
    held = np.cumsum(latent * latent, axis=1)
    return int((held < kept * held[:, -1:]).sum(axis=1).max()) + 1


def common_words(item: np.ndarray, other: np.ndarray) -> int:
    """Length of the longest common subsequence, one bit per word of ``item``."""
    masks: dict[int, int] = {}
    for i, w in enumerate(item.tolist()):
        masks[w] = masks.get(w, 0) | (1 << i)
    full = (1 << len(item)) - 1
    v = full
    for w in other.tolist():
        if m := masks.get(w):
            u = v & m
            v = ((v + u) | (v - u)) & full
    return len(item) - v.bit_count()


@dataclass(frozen=True)
class Item:
    key: object
    words: np.ndarray
    answer: np.ndarray


def answer_words(text: str, answer: str | None) -> np.ndarray:
    """Words of the given answer, or else of the item's last sentence."""
    if not answer:
        sentences = [s for s in re.split(r"(?<=[.!?])\s+", text.strip()) if len(words(s)[0]) > 1]
        answer = sentences[-1] if sentences else text
    return words(answer)[0]


@dataclass(frozen=True)
class Index:
    """A latent space and what candidates are checked against."""

    idf: np.ndarray
    place: np.ndarray  # row of each feature in ``basis``, or -1
    #: Features x directions, times their idf: what a word adds to a folded
    #: window; the last row is that of all other words.
    basis: np.ndarray
    passages: np.ndarray  # directions x passages, each of length 1
    item: np.ndarray  # of each passage
    items: list[Item]


def find(text: str | None, index: Index, params: Params) -> list[tuple[int, float, float, float, int]]:
    """(item, cosine, share of its words, share of its answer, first word of the
    window) of every item that ``text`` holds; every window near an item is looked at."""
    hashes = words(text)[0]
    n = len(hashes)
    if n < params.least or not index.passages.size:
        return []
    bucket = (hashes & np.uint64(params.features - 1)).astype(np.int64)
    idf, place = index.idf[bucket], index.place[bucket]
    starts = np.arange(0, max(1, n - params.width + params.stride), params.stride)
    ends = np.minimum(starts + params.width, n)
    energy = np.concatenate([[0.0], np.cumsum(idf * idf)])
    within = np.concatenate([[0.0], np.cumsum(np.where(place >= 0, idf * idf, 0))])
    all_of = energy[ends] - energy[starts]
    # What lies outside the benchmark's vocabulary bounds the cosine.
    near = np.flatnonzero(within[ends] - within[starts] >= params.cosine ** 2 * all_of)
    candidates: dict[int, dict[int, float]] = {}  # of each item: start of a window, its highest cosine
    for at in range(0, len(near), 512):
        some = near[at:at + 512]
        # Windows overlap: strides are folded once, each window adds up its own.
        strides, turn = np.unique(some[:, None] + np.arange(params.width // params.stride), return_inverse=True)
        at_words = strides[:, None] * params.stride + np.arange(params.stride)
        rows = np.where(at_words < n, place[np.minimum(at_words, n - 1)], -1)
        folded = index.basis[rows].sum(axis=1)[turn.reshape(len(some), -1)].sum(axis=1)
        # A window is no nearer to any passage than to the space, in the sums' own precision.
        inside = np.einsum("ij,ij->i", folded, folded) >= (0.9999 * params.cosine) ** 2 * all_of[some]
        some, folded = some[inside], folded[inside]
        cosine = (folded @ index.passages) / np.sqrt(np.maximum(all_of[some], 1e-12))[:, None]
        w, p = np.nonzero(cosine >= params.cosine)
        cosine = np.minimum(1.0, cosine[w, p])
        for i, begin, c in zip(index.item[p].tolist(), starts[some[w]].tolist(), cosine.tolist()):
            here = candidates.setdefault(i, {})
            here[begin] = max(c, here.get(begin, 0.0))
    out = []
    for i, here in sorted(candidates.items()):
        if (hit := _accepted(hashes, index.items[i], sorted(here.items()), params)) is not None:
            out.append((i, *hit))
    return out


def _accepted(hashes: np.ndarray, item: Item, windows: list[tuple[int, float]],
              params: Params) -> tuple[float, float, float, int] | None:
    """(cosine, share of words, share of answer, first word) of the window of
    the highest cosine (ties to the first) whose surroundings hold ``item``.

    ``windows`` (start, cosine) ascend. Runs of windows whose surroundings
    overlap are looked at as one and halved: what is too little in all of a run
    is too little around each of its windows."""
    reach = len(item.words) + params.width
    cuts = [k for k in range(1, len(windows)) if windows[k][0] - windows[k - 1][0] > params.width + 2 * reach]
    runs = [windows[lo:hi] for lo, hi in zip([0, *cuts], [*cuts, len(windows)])]
    order = lambda run: max((c, -begin) for begin, c in run)
    runs.sort(key=order)
    best = None
    while runs:
        run = runs.pop()
        if best is not None and order(run) < (best[0], -best[3]):
            continue
        region = hashes[max(0, run[0][0] - reach):run[-1][0] + params.width + reach]
        share = common_words(item.words, region) / len(item.words)
        if share < params.paraphrased:
            continue
        if len(run) > 1:
            half = len(run) // 2
            runs += sorted((run[:half], run[half:]), key=order)
            continue
        answer = common_words(item.answer, region) / max(1, len(item.answer))
        if share >= params.copied or answer >= params.answered:
            best = (run[0][1], share, answer, run[0][0])
    return best


def contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
                 item: str = "item_id", item_text: str = "text", answer: str | None = None,
                 params: Params = Params()) -> DataFrame:
    """One row per document row and benchmark item that it holds: key, item,
    cosine, lcs_share, answer_share, first_word.

    Whole texts are searched. Null and empty texts on either side and items of
    fewer than ``least`` words match nothing; repeated items each give their
    rows. ``answer`` names a column of ``benchmark``; without one the last
    sentence of the item is its answer. Nothing of the documents but hashed word
    counts reaches the driver; of the benchmark one block at a time does.
    """
    key_type, item_type = docs.schema[key].dataType, benchmark.schema[item].dataType
    schema = T.StructType([
        T.StructField(key, key_type), T.StructField(item, item_type), T.StructField("cosine", T.DoubleType()),
        T.StructField("lcs_share", T.DoubleType()), T.StructField("answer_share", T.DoubleType()),
        T.StructField("first_word", T.LongType())])
    out = docs.sparkSession.createDataFrame([], schema)
    for index in indexes(docs, benchmark, text, item, item_text, answer, params):
        shared = docs.sparkSession.sparkContext.broadcast(index)
        out = out.unionByName(_search(docs.select(key, text), shared, schema, params))
    return out


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id",
          item_text: str = "text", answer: str | None = None, params: Params = Params()) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with all their columns;
    null texts stay."""
    out = docs
    for index in indexes(docs, benchmark, text, item, item_text, answer, params):
        out = out.where(~_holds(docs.sparkSession.sparkContext.broadcast(index), params)(F.col(text)))
    return out


def _holds(shared, params: Params):
    @F.pandas_udf("boolean")
    def holds(texts: pd.Series) -> pd.Series:
        return pd.Series([bool(find(t, shared.value, params)) for t in texts], dtype=bool)

    return holds


def indexes(docs: DataFrame, benchmark: DataFrame, text: str, item: str, item_text: str,
            answer: str | None, params: Params) -> Iterator[Index]:
    """The latent spaces of the benchmark, block by block."""
    held, total = document_frequencies(docs, text, params)
    idf = np.log((total + 1) / (held + 0.5)).clip(0.0)
    draw = F.pmod(F.xxhash64("item"), F.lit(1 << 30))
    items = benchmark.select(F.col(item).alias("item"), F.col(item_text).alias("text"),
                             (F.col(answer) if answer else F.lit(None)).cast("string").alias("answer")) \
        .where(F.col("item").isNotNull()).distinct()
    rows = stored(passages(items, idf, "item", "text", params).withColumn("draw", draw), "benchmark-passages")
    items = items.withColumn("draw", draw)
    blocks = math.ceil(rows.count() / params.block)
    for b in range(blocks):
        here = F.pmod(F.col("draw"), F.lit(blocks)) == b
        if (index := _index(rows.where(here), items.where(here), idf, params)) is not None:
            yield index


def _index(rows: DataFrame, items: DataFrame, idf: np.ndarray, params: Params) -> Index | None:
    local = rows.select("item", "features", "weights").collect()
    if not local:
        return None
    vocabulary = np.unique(np.concatenate([np.asarray(r.features) for r in local]))
    basis, _ = randomised_svd(rows, vocabulary, min(params.rank, len(local)), params.iterations)
    place = np.full(params.features, -1, np.int32)
    place[vocabulary] = np.arange(len(vocabulary))
    latent = np.stack([np.asarray(r.weights) @ basis[place[np.asarray(r.features)]] for r in local])
    size = directions(latent, params.kept)
    basis, latent = basis[:, :size], latent[:, :size]
    latent /= np.maximum(np.linalg.norm(latent, axis=1), 1e-12)[:, None]
    texts = [Item(r.item, words(r.text)[0], answer_words(r.text, r.answer))
             for r in items.where(F.col("text").isNotNull()).collect()]
    texts = [t for t in texts if len(t.words) >= params.least]
    at: dict[object, list[int]] = {}
    for i, t in enumerate(texts):
        at.setdefault(t.key, []).append(i)
    # A key with several texts: its passages stand for each of them.
    pairs = [(p, i) for p, r in enumerate(local) for i in at.get(r.item, ())]
    folds = np.vstack([basis * idf[vocabulary, None], np.zeros((1, size))])
    return Index(idf, place, folds.astype(np.float32),
                 np.ascontiguousarray(latent[[p for p, _ in pairs]].T, np.float32),
                 np.array([i for _, i in pairs], int), texts)


def _search(docs: DataFrame, shared, schema: T.StructType, params: Params) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: Index = shared.value
        for got in batches:
            rows = [(key, index.items[i].key, c, share, answer, begin)
                    for key, t in zip(got.column(0).to_pylist(), got.column(1))
                    for i, c, share, answer, begin in find(t.as_py(), index, params)]
            cols = list(zip(*rows)) or [[]] * 6
            yield pa.record_batch([pa.array(c, k) for c, k in zip(cols, kinds(got))], schema.names)

    def kinds(got: pa.RecordBatch) -> list[pa.DataType]:
        item = shared.value.items[0].key if shared.value.items else 0
        return [got.schema.field(0).type, pa.array([item]).type, *[pa.float64()] * 3, pa.int64()]

    return docs.mapInArrow(run, schema)
