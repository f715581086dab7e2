import math
import os
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from molspark.llm import lm_score, neighbours
from molspark.llm.common import words


def plain_scores(docs, size, prior):
    """The definition, by dictionaries."""
    token = lambda t: words(t)[0].tolist()
    counts = Counter(w for _, t, _ in docs for w in token(t))
    known = {w for w, _ in sorted(counts.items(), key=lambda x: (-x[1], np.int64(np.uint64(x[0])) if x[0] < 2**63 else x[0] - 2**64))[:size - 2]}
    name = lambda w: w if w in known else "rest"
    pairs = [Counter(), Counter()]
    for _, t, target in docs:
        seq = ["start"] + [name(w) for w in token(t)]
        for p in zip(seq, seq[1:]):
            pairs[1][p] += 1
            pairs[0][p] += bool(target)
    total = min(sum(c.values()) for c in pairs) or 1.0
    out = {}
    for key, t, _ in docs:
        seq = ["start"] + [name(w) for w in token(t)]
        loss = []
        for c in pairs:
            scale = total / max(1, sum(c.values()))
            single, before = Counter(), Counter()
            for (a, b), n in c.items():
                single[b] += n * scale
                before[a] += n * scale
            mass = sum(single.values()) + size
            loss.append(np.mean([-math.log((c[p] * scale + prior * (single[p[1]] + 1) / mass) / (before[p[0]] + prior))
                                 for p in zip(seq, seq[1:])]) if len(seq) > 1 else None)
        out[key] = (len(seq) - 1, *loss)
    return out


def test_scores_against_the_definition(spark):
    r = random.Random(6)
    docs = [(i, " ".join(r.choice(("good fine nice plain words" if i % 3 else "bad noise junk plain words").split())
                         for _ in range(r.randint(1, 40))), bool(i % 3)) for i in range(60)]
    docs += [(100, None, True), (101, "", None), (102, "?!", False), (103, "good " * 50_000, None), (5, docs[5][1], docs[5][2])]
    df = spark.createDataFrame([(*d, 1.0) for d in docs], "doc_id long, text string, target boolean, score double").repartition(4)
    params = lm_score.Params(vocabulary=8, prior=3.0)
    got = lm_score.score(df, params=params).collect()
    want = plain_scores(docs, 8, 3.0)
    assert len(got) == len(docs)
    for g in got:
        n, a, b = want[g.doc_id]
        assert g.n_words == n
        if n:
            assert g.ce_target == pytest.approx(a, rel=1e-4) and g.ce_background == pytest.approx(b, rel=1e-4)
            assert g.score == pytest.approx(b - a, abs=1e-4)
        else:
            assert g.ce_target is None and g.score is None
    mean = lambda k: np.mean([g.score for g in got if g.doc_id < 60 and bool(g.doc_id % 3) == k])
    assert mean(True) > mean(False)


@pytest.mark.parametrize("local", [1, 20, 1 << 18])
def test_every_word_of_the_corpus_counts(spark, local):
    """3000 words: more than any fixed table of the earlier bound held apart."""
    r = random.Random(8)
    docs = [(i, " ".join(f"w{r.randint(0, 1499) + 1500 * (i % 2)}" for _ in range(120)), bool(i % 2)) for i in range(80)]
    docs += [(100 + i, docs[3][1], False) for i in range(3)] + [(200, None, True), (201, "w1", None)]
    df = spark.createDataFrame(docs, "doc_id long, text string, target boolean").repartition(4)
    size = len({w for _, t, _ in docs for w in words(t)[0].tolist()}) + 2
    assert size > 2048
    want = plain_scores(docs, size, 20.0)
    got = lm_score.score(df, params=lm_score.Params(local=local)).collect()
    assert sorted(g.doc_id for g in got) == sorted(d[0] for d in docs)
    for g in got:
        n, a, b = want[g.doc_id]
        assert g.n_words == n
        if n:
            assert g.ce_target == pytest.approx(a, rel=1e-4) and g.ce_background == pytest.approx(b, rel=1e-4)


def test_scores_write_no_table_of_pairs(spark):
    """What the scores of random words leave on disk follows the texts, not four
    times their pairs, and one word in every text is dealt to several tasks."""
    from pathlib import Path

    from molspark.llm.common import scratch_root
    r = random.Random(9)
    docs = [(i, " ".join(["the", *(f"{r.randint(0, 9999)}" for _ in range(400))]), bool(i % 2)) for i in range(200)]
    df = spark.createDataFrame(docs, "doc_id long, text string, target boolean")
    root = Path(scratch_root(spark).removeprefix("file:"))
    size = lambda: sum(f.stat().st_size for f in root.rglob("*.parquet"))
    before = size()
    got = {g.doc_id: g for g in lm_score.score(df).collect()}
    left = size() - before
    want = plain_scores(docs, len({w for _, t, _ in docs for w in words(t)[0].tolist()}) + 2, 20.0)
    for key, (n, a, b) in want.items():
        assert got[key].n_words == n == 401
        assert got[key].ce_target == pytest.approx(a, rel=1e-9) and got[key].ce_background == pytest.approx(b, rel=1e-9)
    assert left < 2 * sum(len(t) for _, t, _ in docs)


def test_shuffles_of_stored_steps_are_removed(spark):
    from molspark.llm.common import freed_shuffles
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    with pytest.raises(ValueError), freed_shuffles(spark):
        assert spark.conf.get(name) == "true"
        raise ValueError
    assert spark.conf.get(name, None) == before


def test_scores_without_target_or_rows(spark):
    df = spark.createDataFrame([(1, "a b", False)], "doc_id long, text string, target boolean")
    assert lm_score.score(df).head().n_words == 2
    assert lm_score.score(df.limit(0)).count() == 0


# --- nearest neighbours ------------------------------------------------------


def exact(ids, x, asks, k):
    out = {}
    for q, v in zip(ids[asks], x[asks]):
        s = x @ v
        order = [i for i in np.lexsort((ids, -s)) if ids[i] != q]
        out[q] = [(ids[i], s[i]) for i in order[:k]]
    return out


def found(df, **more):
    out = {}
    for r in neighbours.search(df, F.col("vec_id") % 20 == 0, **more).orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_recall_on_the_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = df.select("vec_id", "embedding").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    want = exact(ids, x, ids % 20 == 0, 20)
    got = found(df, params=neighbours.Params(part_sample=64))
    assert set(got) == set(want)
    hits = [len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want]
    assert np.mean(hits) >= 0.9
    place = {i: n for n, i in enumerate(ids)}
    for q, near in got.items():
        assert len(near) == 20
        for i, s in near:
            assert s == pytest.approx(x[place[i]] @ x[place[q]], abs=1e-12)


def test_ties_blocks_and_copies(spark):
    """One vector under a third of all ids, blocks of 16 rows: still the smallest ids."""
    rng = np.random.default_rng(1)
    x = rng.standard_normal((600, 8))
    x[::3] = x[0]
    ids = np.arange(600)
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x)], "vec_id long, embedding array<double>")
    got = found(df, k=5, params=neighbours.Params(part_sample=50, block=16, query_block=4, recall=1.0))
    want = exact(ids, x, ids % 60 == 0, 5)
    for q in want:  # the common vector's queries: all its copies tie
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]


def test_routes_go_on_until_there_are_enough(spark):
    """Parts of few rows: every query still gets k neighbours, or all if there are fewer."""
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.standard_normal((1, 8)) * 5 + rng.standard_normal((30, 8)) * 0.1 for _ in range(20)])
    ids = np.arange(len(x))
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x)], "vec_id long, embedding array<double>")
    few = neighbours.Params(part_sample=16, recall=0.01)
    assert neighbours.fit_router(x, few, 20).parts == 32
    for k in (20, 200, 1000):
        got = found(df, k=k, params=few)
        assert set(got) == set(ids[ids % 20 == 0].tolist())
        assert {len(near) for near in got.values()} == {min(k, len(x) - 1)}
        assert all(len({i for i, _ in near}) == len(near) and q not in {i for i, _ in near} for q, near in got.items())
    # Two vectors of one key in different parts are one candidate.
    twice = df.union(df.selectExpr("vec_id", "transform(embedding, c -> -c)"))
    assert {len(near) for near in found(twice, k=599, params=few).values()} == {599}


def test_parts_are_balanced():
    x = np.random.default_rng(2).standard_normal((512, 6))
    part = neighbours.balanced_parts(neighbours.nearest(x, 8), 3, np.random.default_rng(0))
    assert np.bincount(part).tolist() == [64] * 8


def test_invalid_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, []),
            (None, [1.0, 1.0]), (8, [1.0, 2.0, 3.0]), (20, [0.0, -1.0]), (1, [0.5, 0.5]), (0, [1.0, 0.0])]
    df = spark.createDataFrame([(*r, 9) for r in rows], "vec_id long, embedding array<double>, part int")
    assert found(df) == {0: [(1, 0.5), (20, 0.0)], 20: [(0, 0.0), (1, -0.5)]}
    assert found(df.limit(0)) == {}


# --- the pipeline --------------------------------------------------------------


@pytest.fixture(scope="module")
def pipeline():
    import corpus_pipeline
    return corpus_pipeline


def test_stages(spark, pipeline):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    bench = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    extra = spark.createDataFrame([
        (5001, "12 34 !!", "en", "s", 8), (5002, None, "en", "s", 0), (5003, "", None, "s", 0),
        (5004, f"Before it. {bench[0]} After it.", "en", "s", 1), (5005, "the token=abcdefgh is here with the rest of it", "en", "s", 1)], docs.schema)
    copies = docs.where("n_chars > 300").limit(5).withColumn("doc_id", F.col("doc_id") + 7000)
    ids = {r.doc_id for r in copies.collect()}
    rows = docs.union(extra).union(copies)
    seen = [rows]
    for name, stage in pipeline.STAGES:
        path = os.path.join(spark.conf.get("spark.checkpoint.dir"), f"test-{name}")
        stage(spark, seen[-1], sf).write.mode("overwrite").parquet(path)
        seen.append(spark.read.parquet(path))
    of = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    a, b, c, d, e, f = map(of, seen)
    assert a - b == {5001, 5002, 5003}
    assert ids <= b - c and 5005 in c
    assert 5004 in c - d and all(not any(t in (r.text or "") for t in bench) for r in seen[3].collect())
    assert d == e == f
    assert all(s.columns == docs.columns for s in seen[:5])
    r = seen[4].where("doc_id = 5005").head()
    assert r.text == "the [redacted] is here with the rest of it" and r.n_chars == len(r.text)


def test_run_of_an_empty_table(spark, pipeline, tmp_path):
    sf = "/root/testdata/sf0.001"
    for t in ("documents", "benchmark"):
        df = spark.read.parquet(f"{sf}/{t}.parquet")
        (df.limit(0) if t == "documents" else df).write.parquet(str(tmp_path / f"{t}.parquet"))
    assert pipeline.run(spark, str(tmp_path)).count() == 0
