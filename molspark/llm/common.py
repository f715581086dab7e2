"""Helpers shared by the operators of this subpackage: scratch tables in the
cluster's shared folder and vectorised word hashing."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session may leave it unset (tests); it then gets a folder of
    its own. On a cluster a missing setting is an error, because executors do
    not share the driver's temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="llm-scratch-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder, used by one call only."""
    return f"{scratch_root(spark)}/llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts the
    lineage in a way that survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """The shuffles of every action within are removed when it ends, so that
    the next one has their disk. Only for steps whose results are stored."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def mix64(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of SplitMix64 (public domain constants)."""
    x = x.copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


#: Base of the polynomial word hash; odd, so it has an inverse modulo 2^64.
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[str, np.ndarray] = {}
#: Bytes of a word: ASCII letters and digits, and every byte of a non-ASCII character.
_WORD_BYTE = np.array([c >= 128 or chr(c).isalnum() for c in range(256)])


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = len(_POWERS.get("up", ()))
    if size < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        for key, base in (("up", _BASE), ("down", _INVERSE)):
            _POWERS[key] = np.cumprod(np.concatenate(
                [np.ones(1, np.uint64), np.full(size - 1, base, np.uint64)]))
    return _POWERS["up"], _POWERS["down"]


def words(text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, starts, ends) of the words of ``text``.

    A word is a longest run of ASCII letters, ASCII digits and non-ASCII
    characters of the lower-cased text; starts and ends are byte offsets in
    its UTF-8 form. Null and empty texts have no words.
    """
    raw = np.frombuffer((text or "").lower().encode("utf-8", "replace"), np.uint8)
    inside = np.zeros(len(raw) + 2, bool)
    inside[1:-1] = _WORD_BYTE[raw]
    turns = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = turns[0::2], turns[1::2]
    if not len(starts):
        return np.empty(0, np.uint64), starts, ends
    up, down = _powers(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:len(raw)], out=sums[1:])
    return mix64((sums[ends] - sums[starts]) * down[starts]), starts, ends


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``size`` words; a shorter,
    non-empty text is one shingle."""
    n = len(hashes)
    if not n:
        return hashes
    run = hashes[:max(1, n - size + 1)].copy()
    for i in range(1, min(size, n)):
        run = mix64(run * np.uint64(_BASE) + hashes[i:i + len(run)])
    return np.unique(run)
