"""Combining the outputs of many batches (U6, F20, T1's batch rules).

Files are grouped by header first; each group is one CSV scan with an
all-string schema. Whether a column is numeric is decided from the first ten
non-null values of every file, and once per column over all header groups, so
the result's types don't depend on which files share a header.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from molspark.operators.batches import union_diagonal
from molspark.sources.files import batch_id_of, discover_batches, header_groups, read_batch_csv

# FIXED VALUES: columns that always stay text.
TEXT_COLUMNS = ("unique_id", "smiles", "canonical_smiles")
_INTERNAL = ("batch_id", "_file", "_at")


def _is_numeric(v: str, strict_reference: bool) -> bool:
    ok = v.replace(".", "").replace("-", "").replace("+", "").isdigit()
    if ok or strict_reference:
        return ok
    try:
        float(v.strip())
        return True
    except ValueError:
        return False


def numeric_columns(df: DataFrame, keep_text=TEXT_COLUMNS, sample: int = 10,
                    strict_reference: bool = True) -> DataFrame:
    """F20 as a table ``(column, is_numeric)`` with a row per column that has
    values: numeric when in every file the first ``sample`` non-null values,
    with ``.``, ``-``, ``+`` removed, are all digits (``strict_reference``) or,
    when not strict, also parse as numbers.

    Every range of a file hands over the verdicts on its own first ``sample``
    values; the first of a file are the first of its ranges in order, so nothing
    is sorted but a few rows per file."""
    cand = [c for c in df.columns if c not in keep_text and c not in _INTERNAL]
    if not cand:
        return df.sparkSession.createDataFrame([], "column string, is_numeric boolean")

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple, list[bool]] = {}
        for batch in batches:
            file, at = batch.column(0).dictionary_encode(), batch.column(1).to_numpy()
            code = file.indices.to_numpy()
            cuts = [0, *((code[1:] != code[:-1]) | (at[1:] != at[:-1])).nonzero()[0] + 1, len(at)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                name = file.dictionary[int(code[a])].as_py()
                for i, c in enumerate(cand):
                    votes = found.setdefault((name, int(at[a]), c), [])
                    if len(votes) < sample:
                        cells = batch.column(2 + i).slice(a, b - a).drop_null()
                        cells = cells.filter(pc.not_equal(cells, "")).slice(0, sample - len(votes))
                        votes += [_is_numeric(v, strict_reference) for v in cells.to_pylist()]
        rows = [(*k, v) for k, v in found.items() if v]
        if rows:
            yield pa.record_batch([pa.array(x) for x in zip(*rows)], ["file", "at", "column", "votes"])

    first = F.slice(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("at", "votes"))), lambda x: x["votes"])), 1, sample)
    return (df.select("_file", "_at", *[F.col(f"`{c}`") for c in cand])
            .mapInArrow(look, "file string, at bigint, column string, votes array<boolean>")
            .groupBy("file", "column").agg(F.forall(first, lambda v: v).alias("is_numeric"))
            .groupBy("column").agg(F.bool_and("is_numeric").alias("is_numeric")))


def cast_numeric(df: DataFrame, numeric: set[str]) -> DataFrame:
    """The ``numeric`` columns as DOUBLE; values that do not cast become null
    (``cast_rejects`` names them)."""
    return df.select(*[F.trim(F.col(f"`{c}`")).try_cast("double").alias(c) if c in numeric
                       else F.col(f"`{c}`") for c in df.columns])


def cast_rejects(df: DataFrame, numeric: set[str]) -> DataFrame:
    """(batch_id, file, column, value) of every value that does not cast."""
    cols = [c for c in df.columns if c in numeric]
    if not cols:
        return df.select("batch_id", F.col("_file").alias("file"), F.lit(None).cast("string").alias("column"),
                         F.lit(None).cast("string").alias("value")).limit(0)
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("value")) for c in cols]))
    long = df.select("batch_id", F.col("_file").alias("file"), cells.alias("c")).select("batch_id", "file", "c.*")
    return long.filter((F.trim("value") != "") & F.trim("value").try_cast("double").isNull())


def combine_batches(spark: SparkSession, root: str, name: str, out: str | None = None,
                    fmt: str = "parquet", strict_reference: bool = True,
                    keep_internal: bool = False, rejects_out: str | None = None) -> DataFrame | None:
    """Union the ``name`` file of every batch folder under ``root``.

    Header groups are read separately, one type per column is decided over all
    of them (F20), then they are unioned by column name (U1: missing columns
    are null). With ``out`` the result is written: atom tables always as
    Parquet, others as ``fmt`` ("parquet" or "csv"). With ``rejects_out`` the
    values of numeric columns that are no numbers are written there. None when
    there is no file."""
    paths = discover_batches(spark, root, name)
    groups = header_groups(spark, paths) if paths else []
    if not groups:
        return None
    raw = [read_batch_csv(spark, *group) for group in groups]
    votes = [numeric_columns(df, strict_reference=strict_reference) for df in raw]
    decided = union_diagonal(*votes).groupBy("column").agg(F.bool_and("is_numeric").alias("is_numeric"))
    numeric = {r["column"] for r in decided.filter("is_numeric").collect()}  # a row per column
    if rejects_out:
        union_diagonal(*[cast_rejects(df, numeric) for df in raw]).write.mode("overwrite").parquet(rejects_out)
    df = union_diagonal(*[cast_numeric(df, numeric) for df in raw])
    if not keep_internal:
        df = df.drop("_file", "_at")
    if out:
        if "atom_property" in name or fmt == "parquet":
            df.write.mode("overwrite").parquet(out)
        elif fmt == "csv":
            df.write.mode("overwrite").option("header", True).option("escape", '"').csv(out)
        else:
            raise ValueError(f"unsupported format {fmt}")
    return df


def combine_failures(spark: SparkSession, root: str,
                     name: str = "failed_inputs.txt") -> DataFrame:
    """K8 merge: every batch failure log as rows ``(batch_id, line)``."""
    paths = discover_batches(spark, root, name)
    if not paths:
        return spark.createDataFrame([], "batch_id string, line string")
    df = spark.read.text(paths)
    return df.filter(F.trim("value") != "").select(
        batch_id_of(F.col("_metadata.file_path")).alias("batch_id"),
        F.col("value").alias("line"))


def sample_non_null(df: DataFrame, col: str, n: int = 10, by: str = "_file",
                    order=("_pos",)) -> DataFrame:
    """O3: first ``n`` non-null values of a column per file."""
    w = Window.partitionBy(by).orderBy(*order)
    return (df.filter(F.col(col).isNotNull()).withColumn("_rn", F.row_number().over(w))
            .filter(F.col("_rn") <= n).drop("_rn"))
