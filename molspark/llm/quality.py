"""Quality classifier: regularised quadratic discriminant analysis over
transformed statistics of a document.

The statistics of a text are put on scales on which they are closer to normal
(logarithms of sizes, log odds of shares). Labelled documents add up to counts,
sums and products per class inside every task; from those come the class means
and the class covariances, shrunk towards the pooled covariance and its
diagonal by the amount that the sample size asks for (OAS) and at least by two
documented parameters. The Cholesky factors are computed once and sent with the
model (a few kilobytes); a document's score is the logistic function of the
difference of the two log densities, each a Mahalanobis distance by a triangular
solve, and the log prior odds.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .common import stored

STATISTICS = ("words", "word_length", "word_spread", "letters", "upper", "digits", "symbols", "marks",
              "shouts", "distinct", "commonest", "short_words", "repeated_lines", "sentence_words", "odd_words")


@dataclass(frozen=True)
class Params:
    """``pooled`` and ``diagonal``: least shares of the pooled covariance and of
    a multiple of the identity in a class covariance; ``prior``: share of the
    labelled documents' class odds that enters the score; ``limit``: how many
    pooled standard deviations a statistic may lie from its mean before it is
    cut off there (one absurd value then cannot decide by itself)."""

    pooled: float = 0.05
    diagonal: float = 0.01
    prior: float = 1.0
    limit: float = 6.0


LETTER, UPPER, DIGIT, SPACE, MARK, SYMBOL, LINE = 1, 2, 3, 4, 5, 6, 7
_KINDS: list[np.ndarray] = []


def _kinds() -> np.ndarray:
    """The kind of every character of the basic plane, by its Unicode category;
    built once a worker."""
    if not _KINDS:
        kind = np.full(1 << 16, SYMBOL, np.uint8)
        names = [unicodedata.category(chr(i)) for i in range(1 << 16)]
        for i, name in enumerate(names):
            if name == "Lu":
                kind[i] = UPPER
            elif name[0] in "LM":
                kind[i] = LETTER
            elif name[0] == "N":
                kind[i] = DIGIT
            elif name[0] == "Z" or name == "Cc":
                kind[i] = SPACE
        kind[[ord(c) for c in ".,;:!?'\"()-"]] = MARK
        kind[[ord(c) for c in "\n\r\x0b\x0c\x85"]] = LINE
        _KINDS.append(kind)
    return _KINDS[0]


def _odds(part: float, whole: float) -> float:
    """Log odds of a share, with half a count on either side."""
    return float(np.log((part + 0.5) / (max(whole - part, 0.0) + 0.5)))


def statistics(text: str | None) -> list[float]:
    """The transformed statistics of a whole text; null is the empty text."""
    text = text or ""
    points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    kind = _kinds()[np.minimum(points, 0xFFFF)]
    tally = np.bincount(kind, minlength=8)
    inside = np.zeros(len(kind) + 2, bool)
    inside[1:-1] = (kind != SPACE) & (kind != LINE)
    turns = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = turns[0::2], turns[1::2]
    n, lengths = len(starts), (ends - starts).astype(float)
    words = text.split()
    counts = pd.Series(words, dtype=object).value_counts(sort=False).to_numpy() if words else np.zeros(1)
    odd = np.add.reduceat(kind == SYMBOL, starts) > 0 if n else np.zeros(0, bool)
    lines = [x for x in text.splitlines() if x.strip()]
    letters = tally[LETTER] + tally[UPPER]
    full = len(kind) - tally[SPACE] - tally[LINE]
    ends_of = int(np.isin(points, [ord(c) for c in ".!?"]).sum())
    return [
        float(np.log1p(n)),
        float(np.log1p(lengths.mean())) if n else 0.0,
        float(np.log1p(lengths.std())) if n else 0.0,
        _odds(letters, full), _odds(tally[UPPER], letters), _odds(tally[DIGIT], full), _odds(tally[SYMBOL], full),
        _odds(tally[MARK], full), _odds(int((points == 33).sum()), full),
        _odds(len(counts) if words else 0, n), _odds(counts.max(), n), _odds(int((lengths <= 3).sum()), n),
        _odds(len(lines) - len(set(lines)), len(lines)),
        float(np.log((n + 0.5) / (ends_of + 0.5))),
        _odds(int(odd.sum()), n),
    ]


def with_statistics(docs: DataFrame, text: str = "text", name: str = "statistics") -> DataFrame:
    """``docs`` with the statistics of each whole text as an array column."""
    @pandas_udf("array<double>")
    def read(batch: pd.Series) -> pd.Series:
        return pd.Series([statistics(x) for x in batch], dtype=object)

    return docs.withColumn(name, read(F.col(text)))


@dataclass(frozen=True)
class Model:
    """``centre`` and ``spread`` scale the statistics; per class (label 0, then
    1) the number of labelled documents, the mean, the lower Cholesky factor of
    the covariance and the logarithm of its determinant's root."""

    centre: np.ndarray
    spread: np.ndarray
    sizes: tuple[int, int]
    means: list[np.ndarray] = field(default_factory=list)
    factors: list[np.ndarray] = field(default_factory=list)
    volumes: list[float] = field(default_factory=list)
    params: Params = Params()

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of statistics. With labels of one
        class only it is that class, without any it is 0.5."""
        if not all(self.sizes):
            return np.full(len(x), 0.5 if not any(self.sizes) else float(self.sizes[1] > 0))
        z = np.clip((x - self.centre) / self.spread, -self.params.limit, self.params.limit)
        density = [-0.5 * np.square(np.linalg.solve(f, (z - m).T)).sum(axis=0) - v
                   for m, f, v in zip(self.means, self.factors, self.volumes)]
        odds = density[1] - density[0] + self.params.prior * np.log(self.sizes[1] / self.sizes[0])
        return 1.0 / (1.0 + np.exp(-np.clip(odds, -700, 700)))


def _oas(s: np.ndarray, n: int) -> float:
    """Oracle approximating shrinkage: share of the scaled identity that makes
    the expected squared error of a covariance of ``n`` rows least."""
    p, trace, squares = len(s), np.trace(s), float((s * s).sum())
    below = (n + 1.0 - 2.0 / p) * (squares - trace * trace / p)
    return 1.0 if below <= 0 else float(min(1.0, ((1.0 - 2.0 / p) * squares + trace * trace) / below))


def _sums(centre: np.ndarray, spread: np.ndarray, limit: float):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows, sums and sums of products of each class in this task."""
        d = len(centre)
        totals = np.zeros((2, 1 + d + d * d))
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.array(batch["statistics"].flatten().to_numpy(zero_copy_only=False)).reshape(-1, d)
            z = np.clip((x - centre) / spread, -limit, limit)
            label = batch["label"].to_numpy(zero_copy_only=False)
            for k in (0, 1):
                one = z[label == k]
                totals[k] += np.concatenate([[len(one)], one.sum(axis=0), (one.T @ one).ravel()])
        yield pa.RecordBatch.from_pydict({"label": pa.array([0, 1], pa.int32()), "at": pa.array([[*range(totals.shape[1])]] * 2, pa.list_(pa.int32())),
                                          "sums": pa.array(totals.tolist(), pa.list_(pa.float64()))})
    return read


def fit(labelled: DataFrame, label: str = "label", params: Params = Params()) -> Model:
    """The model of all rows of ``labelled`` (statistics, label 0 or 1; rows with
    another or no label take no part). The driver receives one row per class
    and entry of the covariance, whatever the size of the table."""
    d = len(STATISTICS)
    rows = labelled.where(F.col(label).isin(0, 1)).select("statistics", F.col(label).cast("int").alias("label"))
    entry = lambda i: F.get("statistics", F.lit(i))
    scale = rows.agg(*[F.avg(entry(i)).alias(f"m{i}") for i in range(d)],
                     *[F.stddev_pop(entry(i)).alias(f"s{i}") for i in range(d)]).first()
    if scale["m0"] is None:
        return Model(np.zeros(d), np.ones(d), (0, 0), params=params)
    centre = np.array([scale[f"m{i}"] for i in range(d)])
    spread = np.array([scale[f"s{i}"] or 0.0 for i in range(d)])
    spread[spread < 1e-9] = 1.0  # a statistic that is always the same
    sums = (rows.mapInArrow(_sums(centre, spread, params.limit), "label int, at array<int>, sums array<double>")
            .select("label", F.explode(F.arrays_zip("at", "sums")).alias("x"))
            .groupBy("label", "x.at").agg(F.sum("x.sums").alias("sum")).collect())
    totals = np.zeros((2, 1 + d + d * d))
    for r in sums:
        totals[r["label"], r["at"]] = r["sum"]
    sizes = (int(totals[0, 0]), int(totals[1, 0]))
    if not all(sizes):
        return Model(centre, spread, sizes, params=params)
    means = [totals[k, 1:1 + d] / sizes[k] for k in (0, 1)]
    own = [totals[k, 1 + d:].reshape(d, d) / sizes[k] - np.outer(means[k], means[k]) for k in (0, 1)]
    pooled = (sizes[0] * own[0] + sizes[1] * own[1]) / sum(sizes)
    factors, volumes = [], []
    for k in (0, 1):
        s = (1 - params.pooled) * own[k] + params.pooled * pooled
        share = max(params.diagonal, _oas(s, sizes[k]))
        s = (1 - share) * s + share * max(np.trace(s) / d, 1e-6) * np.eye(d)
        factors.append(np.linalg.cholesky(s))
        volumes.append(float(np.log(np.diag(factors[k])).sum()))
    return Model(centre, spread, sizes, means, factors, volumes, params)


def score(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """``docs`` (with ``statistics``) and the probability of label 1.

    Null and empty texts have the statistics of no word and get a score like any
    other; equal texts have equal scores; a row without statistics has none.
    """
    @pandas_udf("double")
    def read(batch: pd.Series) -> pd.Series:
        known = batch.notna()
        out = pd.Series(np.nan, index=batch.index)
        if known.any():
            out[known] = model.scores(np.stack(batch[known].to_numpy()).astype(float))
        return out

    return docs.withColumn(name, read(F.col("statistics")))


def classify(docs: DataFrame, labels: DataFrame, held_out: Column, threshold: float = 0.3, key: str = "doc_id",
             text: str = "text", label: str = "quality", params: Params = Params()) -> DataFrame:
    """(key, held_out, score, predicted) of every row of ``docs``, learned from
    the labelled rows that are not held out.

    Labels are matched by ``key``; a label given twice counts once, two
    different labels count both, rows without key are scored and not learned
    from. Repeated rows each get a row; an empty table gives none. Other columns
    are not read. Texts are read once: their statistics are a written table.
    """
    read = stored(with_statistics(docs.select(F.col(key).alias("key"), F.col(text).alias("text")))
                  .select("key", "statistics"), "statistics")
    rows = read.select(F.col("key").alias(key), "statistics").withColumn("held_out", F.coalesce(held_out, F.lit(False)))
    known = labels.select(F.col(key), F.col(label).alias("label")).distinct()
    model = fit(rows.where(~F.col("held_out")).join(known, key), params=params)
    return (score(rows, model)
            .select(key, "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted")))
