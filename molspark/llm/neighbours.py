"""Approximate nearest neighbours by learned partitions.

On a bounded sample of distinct vectors a neighbour graph is cut into balanced
parts (recursive bisection along Fiedler vectors), and a small network learns
how a vector's neighbours are spread over the parts. The network puts every row
into its most probable part and sends a query to as many of its most probable
parts as a probability mass asks for; the mass is set on the sample so that the
recall against brute force reaches its target. Candidates are scored exactly.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import stored


@dataclass(frozen=True)
class Params:
    """``sample``: distinct vectors that the index is fitted on (a bound).
    ``part_sample``: sample vectors per part, ``most_parts`` a bound on parts.
    ``recall``: target of the routing on held-out sample queries. ``block`` and
    ``query_block``: rows and queries that meet in one task; a row moves once per
    block of queries of its part and a query once per block of rows."""

    sample: int = 8192
    part_sample: int = 256
    most_parts: int = 32
    graph: int = 16
    hidden: int = 64
    epochs: int = 15
    recall: float = 0.96
    block: int = 8192
    query_block: int = 4096
    seed: int = 11


@dataclass(frozen=True)
class Router:
    """A network with one hidden layer, and the probability mass of a search."""

    parts: int
    weights: tuple[np.ndarray, ...]
    mass: float

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        if self.parts == 1:
            return np.ones((len(x), 1))
        return _forward(self.weights, x)[1]

    def routes(self, x: np.ndarray, sizes: np.ndarray, least: int) -> list[list[int]]:
        """The most probable parts whose probabilities together reach the mass,
        and the next ones until ``least`` keys are covered; ``sizes``: keys of each part."""
        p = self.probabilities(x)
        order = np.argsort(-p, axis=1, kind="stable")
        before = np.cumsum(np.take_along_axis(p, order, 1), axis=1) \
            - np.take_along_axis(p, order, 1)
        covered = np.cumsum(sizes[order], axis=1) - sizes[order]
        return [o[(b < self.mass) | (c < least)].tolist() for o, b, c in zip(order, before, covered)]


def _forward(weights: tuple[np.ndarray, ...], x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    w1, b1, w2, b2 = weights
    hidden = np.maximum(x @ w1 + b1, 0)
    z = hidden @ w2 + b2
    p = np.exp(z - z.max(axis=1, keepdims=True))
    return hidden, p / p.sum(axis=1, keepdims=True)


def nearest(x: np.ndarray, k: int) -> np.ndarray:
    """Indices of the ``k`` largest inner products of each row with the others,
    in blocks of rows."""
    out = []
    for at in range(0, len(x), 256):
        s = x[at:at + 256] @ x.T
        s[np.arange(len(s)), np.arange(at, at + len(s))] = -np.inf
        out.append(np.argpartition(np.negative(s, out=s), k - 1, axis=1)[:, :k].copy())
    return np.concatenate(out)


def balanced_parts(neighbours: np.ndarray, levels: int, rng: np.random.Generator,
                   rounds: int = 60) -> np.ndarray:
    """Parts 0..2^levels-1 whose sizes differ by one at most: each level halves
    every part at the median of its Fiedler vector, by power iteration on the
    normalised adjacency within parts, all parts at once."""
    n, k = neighbours.shape
    a = np.repeat(np.arange(n), k)
    ends, others = np.concatenate([a, neighbours.ravel()]), np.concatenate([neighbours.ravel(), a])
    part = np.zeros(n, np.int64)
    for level in range(levels):
        count = 1 << level
        inside = part[ends] == part[others]
        s, d = ends[inside], others[inside]
        degree = np.maximum(np.bincount(s, minlength=n), 1).astype(float)
        root = np.sqrt(degree)
        weight = np.bincount(part, weights=degree, minlength=count)
        v = rng.standard_normal(n)
        for _ in range(rounds):
            v -= (np.bincount(part, weights=v * root, minlength=count) / np.maximum(weight, 1))[part] * root
            v = 0.5 * (v + np.bincount(s, weights=(v / root)[d], minlength=n) / root)
            v /= np.maximum(np.sqrt(np.bincount(part, weights=v * v, minlength=count)), 1e-300)[part]
        order = np.lexsort((v / root, part))
        sizes = np.bincount(part, minlength=count)
        rank = np.empty(n, np.int64)
        rank[order] = np.arange(n) - (np.cumsum(sizes) - sizes)[part[order]]
        part = 2 * part + (rank >= (sizes[part] + 1) // 2)
    return part


def fit_router(x: np.ndarray, params: Params = Params(), k: int = 20) -> Router:
    """Fit on the rows of ``x``, distinct non-zero vectors; every ninth row only
    sets the mass."""
    levels = 0
    while (2 << levels) <= min(params.most_parts, len(x) // params.part_sample):
        levels += 1
    parts, k = 1 << levels, min(k, len(x) - 1)
    if not levels:
        return Router(1, (), 1.0)
    rng = np.random.default_rng(params.seed)
    near = nearest(x, max(k, min(params.graph, len(x) - 1)))
    part = balanced_parts(near[:, :params.graph], levels, rng)
    near = near[:, :k]
    spread = np.zeros((len(x), parts))  # how each row's neighbours and itself lie in the parts
    np.add.at(spread, (np.repeat(np.arange(len(x)), k), part[near].ravel()), 1 / (2 * k))
    spread[np.arange(len(x)), part] += 0.5
    held = np.arange(len(x)) % 9 == 8
    learn = np.flatnonzero(~held)
    weights = [rng.standard_normal((x.shape[1], params.hidden)) * 2 / np.sqrt(x.shape[1]),
               np.zeros(params.hidden), rng.standard_normal((params.hidden, parts)) * 0.05, np.zeros(parts)]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    step = 0
    for _ in range(params.epochs):
        for rows in np.array_split(rng.permutation(learn), max(1, len(learn) // 256)):
            hidden, p = _forward(tuple(weights), x[rows])
            g = (p - spread[rows]) / len(rows)
            back = (g @ weights[2].T) * (hidden > 0)
            step += 1
            for i, grad in enumerate((x[rows].T @ back, back.sum(0), hidden.T @ g, g.sum(0))):
                first[i] = 0.9 * first[i] + 0.1 * grad
                second[i] = 0.99 * second[i] + 0.01 * grad * grad
                weights[i] -= 0.01 * (first[i] / (1 - 0.9 ** step)) / (np.sqrt(second[i] / (1 - 0.99 ** step)) + 1e-8)
    router = Router(parts, tuple(weights), 1.0)
    return Router(parts, tuple(weights), _mass(router, x, np.flatnonzero(held), near, params.recall))


def _mass(router: Router, x: np.ndarray, queries: np.ndarray, near: np.ndarray, target: float) -> float:
    """The least probability mass at which the queries' true neighbours lie in
    their routed parts to the target share."""
    home = router.probabilities(x).argmax(axis=1)
    p = router.probabilities(x[queries])
    order = np.argsort(-p, axis=1, kind="stable")
    before = np.cumsum(np.take_along_axis(p, order, 1), axis=1) - np.take_along_axis(p, order, 1)
    place = np.argsort(order, axis=1, kind="stable")  # of each part in a query's order
    need = np.take_along_axis(before, np.take_along_axis(place, home[near[queries]], 1), 1)
    return float(min(1.0, np.quantile(need, target, method="higher") + 1e-9))


def valid(vector: Column) -> Column:
    """Not null, not zero, and without null and non-finite components."""
    odd = F.exists(vector, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return vector.isNotNull() & F.coalesce(~odd & F.exists(vector, lambda v: v != 0), F.lit(False))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.to_list(), dtype=np.float64).reshape(len(column), -1)


def search(vectors: DataFrame, is_query: Column, k: int = 20, key: str = "vec_id",
           vector: str = "embedding", params: Params = Params()) -> DataFrame:
    """The ``k`` nearest rows found for every query row of ``vectors``:
    query_id, rank, ``key`` and score (inner product in double precision),
    nearest first, ties to the smaller key.

    A query's own key is no candidate. Invalid vectors (see ``valid``), null
    keys and vectors of another than the most common dimension take no part;
    rows repeated under one key count once. A query gets ``k`` rows wherever
    there are so many candidates, and else all of them: its route goes on to
    further parts until they hold ``k`` other keys. An empty table gives no rows.
    Only ``key``, ``vector`` and the columns of ``is_query`` are read, so further
    columns cannot clash.

    Rows meet queries by part, in blocks of rows and of queries, so a vector
    that very many rows share fills several blocks and not one task.
    """
    spark = vectors.sparkSession
    rows = (vectors.where(F.col(key).isNotNull() & valid(F.col(vector)))
            .select(F.col(key).alias("id"), F.col(vector).alias("v"),
                    F.coalesce(is_query, F.lit(False)).alias("asks")))
    dims = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).head()
    id_type = vectors.schema[key].dataType
    out = T.StructType([T.StructField("query_id", id_type), T.StructField(key, id_type),
                        T.StructField("score", T.DoubleType())])
    if dims is None:
        return spark.createDataFrame([], T.StructType([
            out["query_id"], T.StructField("rank", T.IntegerType()), out[key], out["score"]]))
    rows = rows.where(F.size("v") == dims["d"])
    draw = F.xxhash64("v")
    share = min(1.0, 4 * params.sample / dims["count"])
    sample = (rows.where(F.pmod(draw, F.lit(1 << 30)) < int(share * (1 << 30))).select("v").distinct()
              .orderBy(draw).limit(params.sample).toPandas())
    shared = spark.sparkContext.broadcast(fit_router(_matrix(sample["v"]), params, k))

    @F.pandas_udf("int")
    def part_of(v: pd.Series) -> pd.Series:
        return pd.Series(shared.value.probabilities(_matrix(v)).argmax(axis=1).astype(np.int32))

    index = stored(rows.withColumn("part", part_of("v")), "neighbour-index")
    sizes = np.zeros(shared.value.parts, np.int64)
    # A key with vectors in several parts counts in the first only, so a route's sum is never too high.
    for r in index.groupBy("id").agg(F.min("part").alias("part")).groupBy("part").count().collect():
        sizes[r["part"]] = r["count"]

    @F.pandas_udf("array<int>")
    def routes_of(v: pd.Series) -> pd.Series:
        return pd.Series(shared.value.routes(_matrix(v), sizes, k + 1))

    asked = stored(index.where("asks").groupBy("id").agg(F.max("v").alias("v"))
                   .withColumn("part", F.explode(routes_of("v"))), "neighbour-queries")

    def blocks(of: DataFrame, size: int) -> Column:
        """Blocks of each part, as a literal array: one number per part."""
        counts = {r.part: r["count"] for r in of.groupBy("part").count().collect()}
        return F.get(F.array(*[F.lit(-(-counts.get(p, 0) // size)) for p in range(shared.value.parts)]),
                     F.col("part"))

    base_blocks, query_blocks = blocks(index, params.block), blocks(asked, params.query_block)

    def dealt(of: DataFrame, own: Column, all_other: Column, own_name: str, other_name: str) -> DataFrame:
        return (of.where((own > 0) & (all_other > 0))
                .withColumn(own_name, F.pmod(F.xxhash64("id"), own).cast("int"))
                .withColumn(other_name, F.explode(F.sequence(F.lit(0), all_other - 1)))
                .select("part", "block", "query_block", "id", "v"))

    base = dealt(index, base_blocks, query_blocks, "block", "query_block")
    queries = dealt(asked, query_blocks, base_blocks, "query_block", "block")

    def score(candidates: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        if not len(candidates) or not len(asking):
            return pd.DataFrame({"query_id": [], key: [], "score": []})
        candidates = candidates.sort_values("id", kind="stable")
        ids, base = candidates["id"].to_numpy(), _matrix(candidates["v"])
        owners, near, scores = [], [], []
        for begin in range(0, len(asking), 256):
            some = asking.iloc[begin:begin + 256]
            own = some["id"].to_numpy()
            s = _matrix(some["v"]) @ base.T
            s[own[:, None] == ids[None, :]] = -np.inf
            for q, row in zip(own, s):
                least = np.partition(row, -k)[-k] if len(row) > k else -np.inf
                at = np.flatnonzero((row >= least) & (row > -np.inf))
                at = at[np.lexsort((at, -row[at]))]  # ids ascend, so ties go to the smaller
                if len(np.unique(ids[at[:k]])) < min(k, len(at)):  # a repeated key counts once
                    at = np.flatnonzero(row > -np.inf)
                    at = at[np.lexsort((at, -row[at]))]
                    at = at[np.sort(np.unique(ids[at], return_index=True)[1])]
                owners.append(np.full(len(at[:k]), q))
                near.append(ids[at[:k]])
                scores.append(row[at[:k]])
        return pd.DataFrame({"query_id": np.concatenate(owners), key: np.concatenate(near),
                             "score": np.concatenate(scores)})

    keys = ["part", "block", "query_block"]
    hits = (base.groupBy(keys).cogroup(queries.groupBy(keys)).applyInPandas(score, out)
            .groupBy("query_id", key).agg(F.max("score").alias("score")))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), key)
    return (hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", key, "score"))
