"""Appending batches to a table so that a batch counts once, however often
its job runs.

A batch is written to a folder of its own that readers do not see, named by a
hash of what was written, and moved into the table by one rename. The folders
in the table are the ledger: a batch that is already there is not moved again.
A job that dies before the rename leaves nothing in the table, one that dies
after it has appended, and in both cases it is simply run again. Different batches
may be appended at once; one batch by one job at a time.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from molspark.sources.files import _fs


def matched_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with the columns of ``schema``: matched by name whatever its case,
    null where ``df`` has none, others left out."""
    lower = {c.lower(): c for c in df.columns}
    return df.select(*[(F.col(f"`{lower[f.name.lower()]}`") if f.name.lower() in lower else F.lit(None))
                       .cast(f.dataType).alias(f.name) for f in schema.fields])


def content_hash(df: DataFrame) -> str:
    """A hash of the rows of ``df`` that does not depend on their order: their
    number and sums of two hashes of each, one aggregate."""
    sums = [F.sum(F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in df.columns]).cast("decimal(38,0)")) for seed in (1, 2)]
    n, a, b = df.agg(F.count(F.lit(1)), *sums).first()
    return f"{n:x}-{int(a or 0) % (1 << 64):016x}{int(b or 0) % (1 << 64):016x}"


def stage_batch(df: DataFrame, table: str, schema: T.StructType) -> str:
    """Writes a batch beside the table, where no reader looks; its path."""
    path = f"{table.rstrip('/')}/_staging/{uuid.uuid4().hex}"
    matched_columns(df, schema).write.parquet(path)
    return path


def commit_batch(spark: SparkSession, table: str, staged: str, schema: T.StructType, batch_id: str | None = None) -> bool:
    """Moves a written batch into the table under ``batch_id``, or else the hash
    of its rows; False when the table has that batch already."""
    name = batch_id if batch_id is not None else content_hash(spark.read.schema(schema).parquet(staged))
    fs, source, jvm = _fs(spark, staged)
    target = jvm.org.apache.hadoop.fs.Path(f"{table.rstrip('/')}/batches/batch={name}")
    fs.mkdirs(target.getParent())
    if fs.exists(target):
        return False
    return bool(fs.rename(source, target))


def append_once(df: DataFrame, table: str, schema: T.StructType, batch_id: str | None = None) -> bool:
    """Appends ``df`` to the table at ``table`` unless this batch is in it
    already; whether it was appended. Batches are told apart by ``batch_id``, or
    else by their rows, so two batches of equal rows need ids to both count."""
    spark = df.sparkSession
    return commit_batch(spark, table, stage_batch(df, table, schema), schema, batch_id)


def read_appended(spark: SparkSession, table: str, schema: T.StructType) -> DataFrame:
    """The rows of all appended batches with their ``batch``."""
    full = T.StructType([*schema.fields, T.StructField("batch", T.StringType())])
    return spark.read.schema(full).parquet(f"{table.rstrip('/')}/batches")
