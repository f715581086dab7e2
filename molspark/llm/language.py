"""Language identification by word-first backoff.

A word that the model knows scores by its log frequency in each language. An
unseen word backs off to its character n-grams, from the longest down to single
characters: the longest n-grams that are known score, shorter ones only where
no longer one is known.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh

UNDETERMINED = "und"
#: Words: runs of letters. Only letters count, so digits, marks and markup say nothing.
_WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Params:
    """Bounds of the model and of the sample it learns from.

    ``sample_chars``: labelled text per language, in characters, that the model
    is fitted on (documents are chosen by a hash of their id; a language with
    less text uses all of it). ``max_words`` and ``max_grams``: the most
    frequent entries that are kept, so the broadcast model has a fixed bound.
    """

    sample_chars: int = 6_000_000
    max_words: int = 120_000
    max_grams: int = 120_000
    longest: int = 4
    smoothing: float = 0.5


@dataclass(frozen=True)
class Model:
    """``words`` and ``grams`` map an entry to its row in ``word_rows`` and
    ``gram_rows``: log frequencies, one column per language."""

    languages: tuple[str, ...]
    words: dict[str, int]
    word_rows: np.ndarray
    grams: dict[str, int]
    gram_rows: np.ndarray
    longest: int

    def word_score(self, word: str) -> np.ndarray:
        """Log frequencies of a word, or else the mean over its longest known
        n-grams; zeros when not even one of its characters is known."""
        if (row := self.words.get(word)) is not None:
            return self.word_rows[row]
        marked = f" {word} "
        for n in range(min(self.longest, len(marked)), 0, -1):
            hits = [g for i in range(len(marked) - n + 1)
                    if (g := self.grams.get(marked[i:i + n])) is not None]
            if hits:
                return self.gram_rows[hits].mean(axis=0)
        return np.zeros(len(self.languages))

    def familiar(self, word: str) -> bool:
        """Whether the word or a run of three of its characters is known."""
        marked = f" {word} "
        return word in self.words or any(marked[i:i + 3] in self.grams for i in range(len(marked) - 2))

    def coverage(self) -> np.ndarray:
        """The share of each language's words that are known; small where words
        are not set apart."""
        return np.exp(self.word_rows.astype(float)).sum(axis=0) if len(self.word_rows) else np.zeros(len(self.languages))


class Scorer:
    """Predicts with a model and remembers the scores of words it has met; the
    memory is bounded and starts anew when it is full."""

    def __init__(self, model: Model, most: int = 400_000):
        self.model, self.most, self.coverage = model, most, model.coverage()
        self.forget()

    def forget(self) -> None:
        self.places: dict[str, int] = {}
        self.rows = np.empty((4096, len(self.model.languages)), np.float32)
        self.letters, self.known, self.familiar = (np.empty(4096, bool) for _ in range(3))

    def learn(self, word: str) -> None:
        at = len(self.places)
        if at == len(self.rows):
            self.rows, self.letters, self.known, self.familiar = (
                np.concatenate([x, np.empty_like(x)]) for x in (self.rows, self.letters, self.known, self.familiar))
        self.rows[at] = self.model.word_score(word)
        self.letters[at] = any(map(str.isalpha, word))  # the class also has marks like a half
        self.known[at] = word in self.model.words
        self.familiar[at] = self.model.familiar(word)
        self.places[word] = at

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, probability). ``und`` and 0 for null, for a text without
        a letter and for an empty model; ties go to the first language."""
        return self.judge(text)[:2]

    def judge(self, text: str | None) -> tuple[str, float, int, float, float]:
        """(language, probability, letters, share of familiar words, share of
        known words to that expected of the language, at most 1)."""
        counts = Counter(_WORD.findall((text or "").lower()))
        if not counts or not self.model.languages:
            return UNDETERMINED, 0.0, 0, 0.0, 0.0
        if len(self.places) > self.most:
            self.forget()
        for word in counts:
            if word not in self.places:
                self.learn(word)
        at = np.fromiter(map(self.places.__getitem__, counts), np.int64, len(counts))
        if not self.letters[at].any():
            return UNDETERMINED, 0.0, 0, 0.0, 0.0
        n = np.fromiter(counts.values(), float, len(counts))
        total = n @ self.rows[at].astype(float)
        best = int(total.argmax())
        said = self.model.languages[best], float(1 / np.exp(total - total[best]).sum())
        letters = sum(len(w) * k for w, k in counts.items())
        expected = max(float(self.coverage[best]), 1e-9) * n.sum()
        return *said, letters, float(n @ self.familiar[at] / n.sum()), min(1.0, float(n @ self.known[at] / expected))


def _ngrams(n: int) -> Column:
    marked = F.concat(F.lit(" "), "word", F.lit(" "))
    return F.when(F.length(marked) >= n, F.transform(
        F.sequence(F.lit(1), F.length(marked) - n + 1), lambda i: F.substr(marked, i, F.lit(n))))


def _log_frequencies(counts: DataFrame, key: str, languages: list[str], keep: int,
                     smoothing: float) -> tuple[dict[str, int], np.ndarray]:
    """Rows of log relative frequencies per language and each key's row, for the
    ``keep`` most frequent keys (by their share summed over languages; ties to
    the smaller key)."""
    totals = {r.lang: float(r.n) for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    sizes = np.array([totals.get(lang, 1.0) for lang in languages])
    wide = counts.groupBy(key).agg(*[F.sum(F.when(F.col("lang") == lang, F.col("n")).otherwise(0)).alias(f"n{i}")
                                     for i, lang in enumerate(languages)])
    share = sum((F.col(f"n{i}") / float(size) for i, size in enumerate(sizes)), F.lit(0.0))
    rows = wide.orderBy(share.desc(), key).limit(keep).toArrow()  # at most ``keep`` rows
    # Column by column into the model's own numbers: no second copy of all counts.
    logs = np.empty((len(rows), len(languages)), np.float32)
    for i, size in enumerate(sizes):
        logs[:, i] = np.log((rows[f"n{i}"].to_numpy() + smoothing) / (size + smoothing * (len(rows) + 1)))
    return {k: i for i, k in enumerate(rows[key].to_pylist())}, logs


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id",
        params: Params = Params()) -> Model:
    """Learn from the rows of ``labelled`` whose text and lang are not null.

    The counting runs in Spark on the bounded sample; only the model's entries
    reach the driver. No labelled row: an empty model, which answers ``und``.
    """
    rows = labelled.select(F.col(text).alias("text"), F.col(lang).alias("lang"),
                           F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(1 << 30)).alias("draw")) \
        .where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    sizes = {r.lang: int(r.n or 0) for r in
             rows.groupBy("lang").agg(F.sum(F.length("text")).alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        none = np.empty((0, 0))
        return Model((), {}, none, {}, none, params.longest)
    bound = F.element_at(F.create_map(*[x for lang in languages for x in (
        F.lit(lang), F.lit(math.ceil((1 << 30) * min(1.0, params.sample_chars / max(1, sizes[lang])))))]),
        F.col("lang"))
    words = (rows.where(F.col("draw") < bound)
             .select("lang", F.explode(F.regexp_extract_all(
                 F.lower("text"), F.lit(r"\p{L}+"), F.lit(0))).alias("word"))
             .groupBy("lang", "word").agg(F.count("*").alias("n")).cache())
    try:
        known = _log_frequencies(words, "word", languages, params.max_words, params.smoothing)
        grams, blocks = {}, []
        for n in range(params.longest, 0, -1):
            of_n = (words.select("lang", "n", F.explode(_ngrams(n)).alias("gram"))
                    .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
            places, block = _log_frequencies(of_n, "gram", languages,
                                             params.max_grams // params.longest, params.smoothing)
            grams |= {g: i + sum(map(len, blocks)) for g, i in places.items()}
            blocks.append(block)
    finally:
        words.unpersist()
    return Model(tuple(languages), *known, grams, np.concatenate(blocks), params.longest)


def predictor(spark: SparkSession, model: Model) -> Callable[[Column], Column]:
    """A function of a text column: struct of lang_pred and score. The bounded
    model is all that is shipped."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("struct<lang_pred:string,score:double>")
    def predict(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(shared.value)
        for batch in texts:
            yield pd.DataFrame([scorer.predict(t) for t in batch], columns=["lang_pred", "score"])

    return predict


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score (columns of these names are replaced).

    Whole texts are scored in the tasks that read them, one row out per row in,
    repeated rows included. Null texts and texts without a letter: ``und`` and 0.
    """
    said = fresh(docs, "_said")
    return (docs.withColumn(said, predictor(docs.sparkSession, model)(F.col(text)))
            .withColumns({"lang_pred": F.col(f"{said}.lang_pred"), "score": F.col(f"{said}.score")})
            .drop(said))


def accept(docs: DataFrame, model: Model, text: str = "text", least: float = 0.0, familiar: float = 0.5,
           known: float = 0.4, enough: int = 40) -> DataFrame:
    """The rows of ``docs`` whose language can be told: not ``und``, with a
    probability of at least ``least``, and, from ``enough`` letters on, in words
    that the model can judge: a share of ``familiar`` of them is known or has a
    known run of three characters, and the share of known ones is ``known`` of
    what the predicted language has or more. A short text of unseen words stays."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def told(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(shared.value)
        for batch in texts:
            yield pd.Series([said != UNDETERMINED and score >= least and (n < enough or f >= familiar and k >= known)
                             for said, score, n, f, k in map(scorer.judge, batch)], dtype=bool)

    return docs.where(told(F.col(text)))
