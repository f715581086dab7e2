import os
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from molspark.llm import quality, queries_repair

SF = "/root/testdata/sf0.1"


def held_out():
    return F.crc32(F.col("doc_id").cast("string")) % 5 == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_held_out_accuracy(spark):
    got = queries_repair.op13_quality(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert got.count() == docs.count()
    rows = got.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("held_out").collect()
    assert len(rows) > 500 and all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in rows)
    good, bad = [r for r in rows if r.quality == 1], [r for r in rows if r.quality == 0]
    assert np.mean([r.predicted == 1 for r in good]) > 0.985 and np.mean([r.predicted == 0 for r in bad]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)


def test_density_against_formula(spark):
    r = np.random.default_rng(13)
    d = len(quality.STATISTICS)
    x = np.concatenate([r.normal(size=(300, d)) @ r.normal(size=(d, d)), 1 + r.normal(size=(200, d)) * 2])
    y = np.array([1] * 300 + [0] * 200)
    df = spark.createDataFrame([(v.tolist(), int(k)) for v, k in zip(x, y)] + [([0.0] * d, None), ([0.0] * d, 7)],
                               "statistics array<double>, label int").repartition(3)
    p = quality.Params(pooled=0.2, diagonal=0.1, limit=1e9)
    model = quality.fit(df, params=p)
    z = (x - x.mean(axis=0)) / x.std(axis=0)
    own = {k: np.cov(z[y == k].T, bias=True) for k in (0, 1)}
    pooled = (200 * own[0] + 300 * own[1]) / 500
    log = {}
    for k in (0, 1):
        s = 0.8 * own[k] + 0.2 * pooled
        share = max(0.1, quality._oas(s, int((y == k).sum())))
        s = (1 - share) * s + share * np.trace(s) / d * np.eye(d)
        at = z - z[y == k].mean(axis=0)
        log[k] = -0.5 * np.einsum("ij,jk,ik->i", at, np.linalg.inv(s), at) - 0.5 * np.linalg.slogdet(s)[1]
    want = 1 / (1 + np.exp(-np.clip(log[1] - log[0] + np.log(300 / 200), -700, 700)))
    assert np.allclose(model.scores(x), want, atol=1e-7)
    got = quality.score(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(-1, None)], "i int, statistics array<double>"), model)
    by = {r.i: r.score for r in got.collect()}
    assert np.allclose([by[i] for i in range(500)], want, atol=1e-7) and by[-1] is None


def docs(spark):
    rows = [(1, "Plain words stand here. They are fine."), (1, "Plain words stand here. They are fine."), (2, "ALL!! CAPS!! HERE!!"),
            (3, None), (4, ""), (None, "no key"), (6, "word " * 400_000), (7, "😀\x00 a"), (8, "퟿\n\n")]
    return spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("clash")).withColumn("key", F.lit("clash")) \
        .withColumn("statistics", F.lit("clash"))


def test_nulls_repeats_and_clashing_names(spark):
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (3, None), (None, 1), (6, 0), (8, 1), (99, 1)], "doc_id long, quality int")
    got = quality.classify(docs(spark), labels, F.lit(False)).collect()
    assert len(got) == 9 and all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in got)
    assert len({r.score for r in got if r.doc_id in (3, 4)}) == 1 and len({r.score for r in got if r.doc_id == 1}) == 1


@pytest.mark.parametrize("labels,want", [([], 0.5), ([(1, 1)], 1.0), ([(2, 0), (4, 0)], 0.0)])
def test_lacking_classes(spark, labels, want):
    got = quality.classify(docs(spark), spark.createDataFrame(labels, "doc_id long, quality int"), F.lit(False)).collect()
    assert {r.score for r in got} == {want}


def test_held_out_labels_are_not_learned(spark):
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    got = quality.classify(docs(spark), labels, F.col("doc_id") == 2).collect()
    assert {r.score for r in got} == {1.0} and {r.held_out for r in got if r.doc_id is None} == {False}


def test_empty_tables(spark):
    empty = docs(spark).limit(0)
    assert quality.classify(empty, spark.createDataFrame([], "doc_id long, quality int"), held_out()).count() == 0


def test_statistics_of_whole_texts():
    clean = "Some words. " * 3000
    a, b = quality.statistics(clean), quality.statistics(clean + "!!! ### " * 3000)
    assert b[quality.STATISTICS.index("symbols")] > a[quality.STATISTICS.index("symbols")] + 3
    assert len(quality.statistics(None)) == len(quality.STATISTICS) and quality.statistics(None) == quality.statistics("")
