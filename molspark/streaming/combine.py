"""Incremental batch merge (T1) and progress feed (T2) with Structured
Streaming.

Batch folders keep filling while jobs run; the file source hands each new
file to exactly one micro-batch (its log lives in the checkpoint folder), and
``foreachBatch`` merges these files by header name and declared types into the
epoch's own folder of the combined table. An epoch that runs again overwrites
its folder. ``trigger(availableNow=True)`` processes what is there and stops, so
the same job serves both "merge now" and "merge what is new".
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from molspark.operators.batches import union_diagonal
from molspark.operators.merge import cast_numeric, cast_rejects
from molspark.sources.files import _fs, header_groups, read_batch_csv


#: Provider whose state lives in files beside the checkpoint and not in the executors' heaps.
_ROCKSDB = {"spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
            "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true"}
#: The file source forgets and ignores files this much older than the newest.
_MAX_AGE = "36500d"


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _fs(spark, path)
    return fs.exists(p)


def _finish(rows: DataFrame, merge: Callable[[DataFrame, int], None], checkpoint: str):
    q = (rows.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def _first_of_each(spark: SparkSession, merged: str, schema: T.StructType, key: str, out: str, checkpoint: str):
    """Append the rows of ``merged`` whose ``key`` no earlier epoch had to ``out``."""
    rows = (spark.readStream.schema(schema).option("recursiveFileLookup", True).option("maxFileAge", _MAX_AGE)
            .option("cleanSource", "delete").parquet(merged).dropDuplicates([key]))
    before = {k: spark.conf.get(k, None) for k in _ROCKSDB}
    for k, v in _ROCKSDB.items():
        spark.conf.set(k, v)
    try:
        return _finish(rows, lambda new, epoch: new.write.mode("overwrite").parquet(f"{out}/epoch={epoch}"), checkpoint)
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def combine_stream(spark: SparkSession, root: str, name: str, schema: T.StructType | str,
                   out: str, checkpoint: str, dedupe_key: str | None = None,
                   rejects_out: str | None = None, files_per_epoch: int = 10_000):
    """Add each new ``<root>/{batch_*,fs-sn-*}/<name>`` file to the Parquet
    table ``out``, which gets a partition column ``epoch``.

    ``schema`` declares the result's columns, strings and doubles: a file's
    columns are matched by their header names, whatever their order; a missing
    one is null and others are left out. Cells of double columns that are no
    numbers become null and are listed in ``rejects_out``. An epoch takes at most
    ``files_per_epoch`` files, as their paths pass the driver. Errors end the
    query. Returns the finished query (None if there is no file yet and a key is given).

    With ``dedupe_key`` one row of each key stays for good (null is a key too): the
    merged epochs wait below ``checkpoint``, and a second query takes them to
    ``out`` through a state of all keys so far. The state is partitioned by key and
    kept in files, so an epoch costs what its own rows cost and the table is
    never read. Of rows of one key, one of the first epoch that has the key stays."""
    schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    numeric = {f.name for f in schema if not isinstance(f.dataType, T.StringType)}
    files = (spark.readStream.format("binaryFile").schema(
        "path string, modificationTime timestamp, length bigint, content binary")
        .option("maxFilesPerTrigger", files_per_epoch).option("maxFileAge", _MAX_AGE)
        .load(f"{root.rstrip('/')}/{{batch_*,fs-sn-*}}/{name}").select("path"))

    def merge(batch: DataFrame, epoch: int) -> None:
        session = batch.sparkSession
        paths = [r["path"] for r in batch.filter(~F.regexp_like("path", F.lit("/[_.][^/]*$"))).collect()]
        groups = header_groups(session, paths) if paths else []
        if not groups:
            return
        raw = []
        for group in groups:
            df = read_batch_csv(session, *group)
            cols = [F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None).cast("string").alias(f.name)
                    for f in schema]
            raw.append(df.select(*cols, "batch_id", "_file"))
        one = union_diagonal(*raw)
        if rejects_out:
            cast_rejects(one, numeric).write.mode("overwrite").parquet(f"{rejects_out}/epoch={epoch}")
        cast_numeric(one, numeric).drop("_file").write.mode("overwrite").parquet(f"{to}/epoch={epoch}")

    if dedupe_key is None:
        to = out
        return _finish(files, merge, checkpoint)
    to = f"{checkpoint}/merged"
    _finish(files, merge, f"{checkpoint}/files")
    if not _exists(spark, to):   # no file yet
        return None
    return _first_of_each(spark, to, T.StructType([*schema, T.StructField("batch_id", T.StringType())]),
                          dedupe_key, out, f"{checkpoint}/keys")


def progress_stream(df: DataFrame, batch_col: str = "batch_id", ok_col: str = "ok"):
    """Running done / failed counts per batch over a streaming frame
    (complete-mode aggregate; state is one row per batch)."""
    return df.groupBy(batch_col).agg(F.count_if(F.col(ok_col)).alias("n_done"),
                                     F.count_if(~F.col(ok_col)).alias("n_failed"))


def progress_feed(df: DataFrame, batch_col: str = "batch_id", ok_col: str = "ok", every: int = 100,
                  quiet_seconds: int | None = None) -> DataFrame:
    """A feed over a streaming frame. For each batch one row whenever its
    count passes a further multiple of ``every`` (``milestone``), and with
    ``quiet_seconds`` one without milestone when nothing new came for that long:
    batch, milestone, n_done and n_failed as far as they are known then. The timer
    is for queries that go on: under ``availableNow`` Spark would run empty
    batches for it without end.

    Tasks count their rows per batch before the exchange, so a batch of very many
    rows moves as a few counts; the state is three numbers per batch and lives in
    the query's checkpoint, so a query that starts again goes on where it
    stopped. Rows whose outcome is null count nowhere; a null batch is one too."""
    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            ok = pdf["ok"].dropna().astype(bool)
            yield (pd.DataFrame({"batch": pdf["batch"][ok.index], "n_done": ok.astype(int), "n_failed": (~ok).astype(int)})
                   .groupby("batch", dropna=False, as_index=False).sum())

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        done, failed, told = state.get if state.exists else (0, 0, 0)
        reached: list[int | None] = []
        if state.hasTimedOut:
            if done + failed > told:
                reached, told = [None], done + failed
            state.update((done, failed, told))
        else:
            before = done + failed
            for pdf in frames:
                done, failed = done + int(pdf["n_done"].sum()), failed + int(pdf["n_failed"].sum())
            reached = list(range((before // every + 1) * every, done + failed + 1, every))
            told = max(told, reached[-1]) if reached else told
            state.update((done, failed, told))
            if quiet_seconds is not None:
                state.setTimeoutDuration(quiet_seconds * 1000)
        if reached:
            yield pd.DataFrame({"batch": pd.Series([key[0]] * len(reached), dtype=object),
                                "milestone": pd.Series(reached, dtype="Int64"), "n_done": done, "n_failed": failed})

    timer = GroupStateTimeout.NoTimeout if quiet_seconds is None else GroupStateTimeout.ProcessingTimeTimeout
    return (df.select(F.col(batch_col).cast("string").alias("batch"), F.col(ok_col).cast("boolean").alias("ok"))
            .mapInPandas(count, "batch string, n_done bigint, n_failed bigint").groupBy("batch")
            .applyInPandasWithState(step, "batch string, milestone bigint, n_done bigint, n_failed bigint",
                                    "n_done bigint, n_failed bigint, told bigint", "append", timer))
