"""SMILES list ingest (S1-S4, S19) and the sample validators."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from molspark.functions.text import strip
from molspark.operators.qc import (drop_empty, looks_like_smiles, resolve_smiles_column,
                                   smiles_lexical_reason)


def read_smiles(spark: SparkSession, path: str, fmt: str | None = None,
                with_index: bool = False) -> DataFrame:
    """Read SMILES into a one-column DataFrame ``smiles``.

    * ``csv`` (S1): header row, lines starting with ``#`` skipped, the SMILES
      column found by alias (S4), null and empty values dropped.
    * ``parquet`` (S2): same column rule; the filter is pushed to the scan.
    * ``text`` (S3): one per line, stripped, blank lines dropped; a line is a
      comment only when it *starts* with ``#`` before stripping.

    ``with_index`` adds ``input_idx`` (file order within each split is kept;
    use ``_metadata`` columns for provenance)."""
    fmt = (fmt or _fmt_from_suffix(path)).lower()
    if fmt == "csv":
        df = (spark.read.option("header", True).option("comment", "#")
              .option("inferSchema", False).csv(path))
    elif fmt in ("parquet", "parq"):
        df = spark.read.parquet(path)
    elif fmt in ("text", "txt"):
        raw = spark.read.text(path)
        df = (raw.filter(~F.col("value").startswith("#"))
              .select(strip("value").alias("smiles"))
              .filter(F.col("smiles") != ""))
        return _index(df, with_index)
    else:
        raise ValueError(f"Unsupported file format: {fmt}")
    col = resolve_smiles_column(df.columns)
    out = drop_empty(df.select(F.col(f"`{col}`").alias("smiles")), "smiles")
    return _index(out, with_index)


def _index(df: DataFrame, with_index: bool) -> DataFrame:
    return df.withColumn("input_idx", F.monotonically_increasing_id()) if with_index else df


def _fmt_from_suffix(path: str) -> str:
    p = path.rstrip("/")
    ext = os.path.splitext(p)[1].lower()
    return {".csv": "csv", ".parquet": "parquet", ".parq": "parquet", ".txt": "text"}.get(ext, "")


def read_input(spark: SparkSession, path: str):
    """Dispatch on the input kind: ``.txt`` / ``.csv`` / ``.parquet`` /
    ``.parq`` give a SMILES DataFrame; a folder with ``*.xyz`` files gives
    (molecules, atoms, failures); anything else is an error."""
    fmt = _fmt_from_suffix(path)
    if fmt:
        return read_smiles(spark, path, fmt)
    from molspark.sources.files import _fs
    fs, p, _ = _fs(spark, path)
    if path.endswith("/") or (fs.exists(p) and fs.getFileStatus(p).isDirectory()):
        from molspark.sources.xyz import read_xyz_dir
        return read_xyz_dir(spark, path)
    raise ValueError(f"Unsupported input: {path}")


def is_single_column(spark: SparkSession, path: str, n: int = 5) -> bool:
    """Among the first ``n`` lines of the file, those that are neither blank
    nor comments (after stripping) each hold exactly one token that looks like
    SMILES. ``take`` reads the first split only as far as it must."""
    first = [(r["value"],) for r in spark.read.text(path).take(n)]
    sample = spark.createDataFrame(first, "value string").select(strip("value").alias("v")) \
        .filter((F.col("v") != "") & ~F.col("v").startswith("#"))
    chk = sample.agg(F.coalesce(F.bool_and(
        (F.size(F.split("v", r"\s+")) == 1) & smiles_lexical_reason(F.col("v")).isNull()),
        F.lit(True)).alias("ok"))
    return bool(chk.first()["ok"])


def validate_sample(spark: SparkSession, path: str, n: int = 5) -> tuple[bool, str | None]:
    """The first ``n`` rows of a CSV: a SMILES alias column must exist and
    each non-empty value must pass the lexical check. Returns (ok, first bad
    value or message)."""
    df = spark.read.option("header", True).option("comment", "#").csv(path)
    try:
        col = resolve_smiles_column(df.columns)
    except ValueError as e:
        return False, str(e)
    sample = df.select(F.col(f"`{col}`").alias("s")).limit(n)
    bad = sample.filter(F.col("s").isNotNull() & (F.col("s") != "")
                        & (~looks_like_smiles("s") | smiles_lexical_reason(F.col("s")).isNotNull()))
    row = bad.first()
    return (row is None), (None if row is None else row["s"])
