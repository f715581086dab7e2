"""Packed model batches (X4) and the progress feed."""

import os
import random
import uuid

import pandas as pd
from pyspark.sql import functions as F

from molspark.operators import stages
from molspark.streaming.combine import progress_feed


def test_packed_batches_are_the_longest_runs():
    r = random.Random(2)
    for _ in range(100):
        sizes = sorted(r.choice([0, 1, 3, 10, 60]) for _ in range(r.randint(0, 40)))
        rows = pd.DataFrame({"id": range(len(sizes)), "n": sizes})
        cut = sorted(r.randint(0, len(sizes)) for _ in range(3))
        frames = [rows.iloc[a:b] for a, b in zip([0, *cut], [*cut, len(sizes)])]
        most, area = r.randint(1, 8), r.choice([20, 50, None])
        got = list(stages.packed_batches(iter(frames), "n", most, area))
        assert [i for p in got for i in p["id"]] == list(range(len(sizes)))

        def fits(p):
            return len(p) <= most and (area is None or len(p) * max(p) <= area)
        for k, part in enumerate(got):
            assert fits(part["n"].tolist()) or len(part) == 1
            if k + 1 < len(got):  # the next row would not have fitted
                assert not fits([*part["n"], got[k + 1]["n"].iloc[0]])
    assert list(stages.packed_batches(iter([]), "n", 3, 5)) == []


def test_models_of_a_worker():
    stages._MODELS.clear()
    made = []
    for key in ("a", "a", "b", "a", "c", "a", "b"):
        stages.worker_model(key, lambda key=key: made.append(key) or key)
    assert made == ["a", "b", "c", "b"]
    stages._MODELS.clear()


def test_inference_packs_by_size(spark):
    """A third of the molecules share one size, the others lie far apart; a column of maps and a null size do no harm."""
    df = spark.range(6000).select(F.col("id").cast("string").alias("unique_id"), F.create_map("id", "id").alias("m"),
                                  F.when(F.col("id") == 5, None).when(F.col("id") % 3 == 0, 40).otherwise(1 + F.col("id") * 7 % 900)
                                  .alias("num_atoms")).repartition(8)

    def make():
        load = f"{os.getpid()}/{uuid.uuid4().hex}"
        return lambda p: pd.DataFrame({"unique_id": p.unique_id, "n": p.num_atoms.fillna(0), "top": int(p.num_atoms.fillna(0).max()),
                                       "rows": len(p), "load": load})
    got = stages.batch_inference(df, make, "unique_id string, n long, top long, rows long, load string", batch_size=500, max_padded=5000,
                                 model_key="test-" + uuid.uuid4().hex).toPandas()
    assert sorted(map(int, got.unique_id)) == list(range(6000))
    assert (got.rows * got.top <= 5000).all() and got.rows.max() <= 500
    assert got.n.sum() >= 0.9 * got.top.sum()
    assert got.load.nunique() == got.load.str.split("/").str[0].nunique()


def feed(spark, root, every):
    rows = spark.readStream.schema("batch_id string, ok boolean").option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    q = (progress_feed(rows, every=every).writeStream.outputMode("append").option("checkpointLocation", f"{root}/checkpoint")
         .format("parquet").trigger(availableNow=True).start(f"{root}/feed"))
    q.awaitTermination()
    return sorted(((r.batch or "", r.milestone, r.n_done, r.n_failed) for r in spark.read.parquet(f"{root}/feed").collect()))


def test_feed_goes_on_after_a_restart(spark, tmp_path):
    def add(rows):
        spark.createDataFrame(rows, "batch_id string, ok boolean").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    add([("a", True)] * 7 + [("b", False)] * 3 + [(None, True)] * 4 + [("a", None)] * 50)
    first = feed(spark, tmp_path, 4)
    assert first == [("", 4, 4, 0), ("a", 4, 7, 0)]
    assert feed(spark, tmp_path, 4) == first  # nothing new
    add([("a", False)] * 6 + [("b", True)])
    assert feed(spark, tmp_path, 4) == sorted(first + [("a", 8, 7, 6), ("a", 12, 7, 6), ("b", 4, 1, 3)])


def test_feed_tells_quiet_batches(spark, tmp_path):
    """Rows below a milestone are told by the timer, once."""
    import time
    spark.createDataFrame([("a", True)] * 5, "batch_id string, ok boolean").write.parquet(f"{tmp_path}/in")
    rows = spark.readStream.schema("batch_id string, ok boolean").parquet(f"{tmp_path}/in")
    q = (progress_feed(rows, every=4, quiet_seconds=1).writeStream.outputMode("append").option("checkpointLocation", f"{tmp_path}/c")
         .format("parquet").trigger(processingTime="1 second").start(f"{tmp_path}/feed"))
    def told():
        out = spark.read.schema("batch string, milestone long, n_done long, n_failed long").parquet(f"{tmp_path}/feed")
        return sorted((r.milestone or 0, r.n_done) for r in out.collect())
    try:
        end, got = time.monotonic() + 60, []
        while len(got) < 2 and time.monotonic() < end:
            time.sleep(2)
            if (tmp_path / "feed" / "_spark_metadata").exists():
                got = told()
        time.sleep(4)
    finally:
        q.stop()
    assert told() == [(0, 5), (4, 5)]
