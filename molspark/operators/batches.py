"""Batch layout and accounting.

Partitions replace the reference's batches inside Spark; these operators
exist to label rows for work handed to external systems and to account for
runs. No operator sorts the whole table into one partition: dense row
numbers come from a range-partitioned sort plus per-partition offsets (the
offset table has one row per partition).
"""

from __future__ import annotations

import functools
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from molspark.session import ensure_checkpoint_dir

_LOW33 = (1 << 33) - 1


def dense_index(df: DataFrame, order_cols: Sequence[str], out: str = "idx",
                checkpoint: bool = True) -> DataFrame:
    """0-based dense row number in ``order_cols`` order, computed without a
    single-partition window: sort (range partitioned), count rows per
    partition, prefix-sum the counts (one row per partition) and add the
    position inside the partition.

    The sorted data is checkpointed to the shared checkpoint folder so the
    counting pass and the numbering pass see the same partitions even if an
    executor is lost in between."""
    s = df.orderBy(*[F.col(c) for c in order_cols])
    if checkpoint:
        ensure_checkpoint_dir(df.sparkSession)
        s = s.checkpoint(eager=True)
    mono = F.monotonically_increasing_id()
    s = s.withColumn("_mono", mono).withColumn("_pid", F.shiftright(F.col("_mono"), 33))
    counts = s.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offs = counts.withColumn(
        "_off", F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)))
    offs = offs.select("_pid", F.coalesce(F.col("_off"), F.lit(0)).alias("_off"))
    # one row per partition: a bounded broadcast
    out_df = s.join(F.broadcast(offs), "_pid")
    return out_df.withColumn(out, (F.col("_off") + F.col("_mono").bitwiseAND(F.lit(_LOW33)))
                             .cast("long")).drop("_mono", "_pid", "_off")


def group_rank(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str], out: str = "rank",
               count_out: str | None = None, partitions: int | None = None) -> DataFrame:
    """0-based row number inside each ``keys`` group in ``order_cols``
    order (what ``row_number() OVER (PARTITION BY keys ORDER BY ...) - 1``
    gives), without putting a group into one task. Order columns must make
    the order total (ties get an arbitrary but consistent order).

    Rows are range-partitioned on (keys, order) so a hot group spans many
    partitions; each partition holds contiguous sorted runs of a group. A
    run table (one row per partition and group: first position, length)
    gets per-group prefix offsets, and is joined back on (partition, keys).
    ``count_out`` adds the group size. Every shuffle is balanced even when
    one group holds a third of the rows."""
    keys = list(keys)
    n = partitions or max(2 * df.sparkSession.sparkContext.defaultParallelism, 1)
    s = (df.repartitionByRange(n, *[F.col(c) for c in keys + list(order_cols)])
         .sortWithinPartitions(*keys, *order_cols)
         .withColumn("_pid", F.spark_partition_id())
         .withColumn("_loc", F.monotonically_increasing_id().bitwiseAND(F.lit(_LOW33))))
    # partition ids and positions are assigned once and materialised in the
    # shared checkpoint folder: the run table and the join-back read the same
    # values (a second evaluation could see different partitions, e.g. when
    # adaptive execution reads a shuffle locally), and lineage is cut
    ensure_checkpoint_dir(df.sparkSession)
    s = s.checkpoint(eager=True)
    runs = s.groupBy("_pid", *keys).agg(F.min("_loc").alias("_first"), F.count(F.lit(1)).alias("_cnt"))
    w = Window.partitionBy(*keys).orderBy("_pid")
    runs = runs.withColumn("_off", F.coalesce(
        F.sum("_cnt").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    if count_out:
        runs = runs.withColumn(count_out, F.sum("_cnt").over(Window.partitionBy(*keys)))
    j = s.join(runs, ["_pid", *keys])
    return (j.withColumn(out, (F.col("_off") + F.col("_loc") - F.col("_first")).cast("int"))
            .drop("_pid", "_loc", "_first", "_cnt", "_off"))


def distribute_expr(idx: Column, n: int, num_jobs: int) -> Column:
    """W1 as an expression: job number (0-based) of row ``idx`` when ``n``
    rows are spread over ``num_jobs`` jobs and the first ``n mod k`` jobs get
    one more row."""
    q, r = divmod(n, num_jobs)
    big = r * (q + 1)
    if q == 0:
        return idx.cast("int")
    return F.when(idx < big, F.floor(idx / F.lit(q + 1))).otherwise(
        F.lit(r) + F.floor((idx - F.lit(big)) / F.lit(q))).cast("int")


def distribute(df: DataFrame, num_jobs: int, idx_col: str = "idx", n: int | None = None) -> DataFrame:
    """Add ``job_id`` (0-based). Job sizes differ by at most one."""
    n = df.count() if n is None else n
    return df.withColumn("job_id", distribute_expr(F.col(idx_col), n, num_jobs))


def job_sizes(n: int, num_jobs: int) -> list[int]:
    """W1 sizes (for planning), e.g. 10 over 3 -> [4, 3, 3]."""
    q, r = divmod(n, num_jobs)
    return [q + 1 if i < r else q for i in range(num_jobs)]


def chunk(df: DataFrame, size: int = 12288, idx_col: str = "idx", n: int | None = None,
          nodes: Sequence[str] | None = None) -> DataFrame:
    """W2 + W3: fixed-size chunks of ``size`` rows plus a remainder, labelled
    ``batch_<first>-<last>``; with ``nodes`` each chunk is assigned
    round-robin (``pmod(chunk, len(nodes))``)."""
    n = df.count() if n is None else n
    b = F.floor(F.col(idx_col) / F.lit(size)).cast("long")
    start = b * F.lit(size)
    end = F.least(start + F.lit(size), F.lit(n)) - F.lit(1)
    out = df.withColumn("chunk_id", b).withColumn(
        "batch_label", F.concat(F.lit("batch_"), start.cast("string"), F.lit("-"), end.cast("string")))
    if nodes:
        arr = F.array(*[F.lit(x) for x in nodes])
        out = out.withColumn("node", F.element_at(arr, (F.pmod(b, F.lit(len(nodes))) + 1).cast("int")))
    return out


def clamped_batch_size(n: int, cores: int, lo: int = 32, hi: int = 4096) -> int:
    """``ceil(n / cores)`` clamped into [lo, hi]."""
    return max(lo, min(hi, math.ceil(n / max(1, cores))))


def optimal_partitions(n: int, min_items: int, cpus: int) -> int:
    """``min(max(1, n // min_items), cpus + 4)``."""
    return min(max(1, n // max(1, min_items)), cpus + 4)


def row_range(df: DataFrame, start: int, length: int | None, idx_col: str = "idx") -> DataFrame:
    """Rows ``start .. start+length-1`` of an indexed table."""
    c = F.col(idx_col) >= start
    if length is not None:
        c = c & (F.col(idx_col) < start + length)
    return df.filter(c)


# --- unions --------------------------------------------------------------------
def union_diagonal(*dfs: DataFrame) -> DataFrame:
    """Union by column name; columns missing on one side are null."""
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


union_lenient = union_diagonal


def union_strict(*dfs: DataFrame) -> DataFrame:
    """Union by name; every input must have the same columns."""
    cols = sorted(dfs[0].columns)
    for d in dfs[1:]:
        if sorted(d.columns) != cols:
            raise ValueError(f"Column mismatch: {sorted(d.columns)} vs {cols}")
    return functools.reduce(lambda a, b: a.unionByName(b), dfs)


def extra_columns(df: DataFrame, base: Sequence[str]) -> list[str]:
    """U5 + O4: columns beyond ``base``, sorted by name."""
    return sorted(c for c in df.columns if c not in base)


# --- accounting ----------------------------------------------------------------
def dropped_inputs(inputs: DataFrame, outputs: DataFrame, key: str = "unique_id") -> DataFrame:
    """Inputs with no output row."""
    return inputs.join(outputs.select(key), key, "left_anti")


def failure_counts(failures: DataFrame, by: Sequence[str] = ("stage", "reason")) -> DataFrame:
    """Failures counted per group."""
    return failures.groupBy(*by).agg(F.count(F.lit(1)).cast("long").alias("n_failures"))


def run_summary(inputs: DataFrame, outputs: DataFrame | Column, metadata: DataFrame | None = None,
                time_col: str = "total_time") -> DataFrame:
    """Inputs, outputs, success percentage and time per structure; an
    empty output gives nulls instead of a division by zero. ``outputs`` is a
    table, or the condition by which rows of ``inputs`` came out, so that these
    are read once. One aggregation over the tagged union (no joins)."""
    none = F.lit(None).cast("double").alias("_t")
    if isinstance(outputs, DataFrame):
        parts = [inputs.select(F.lit("in").alias("_src"), none), outputs.select(F.lit("out").alias("_src"), none)]
    else:
        tags = F.when(outputs, F.array(F.lit("in"), F.lit("out"))).otherwise(F.array(F.lit("in")))
        parts = [inputs.select(F.explode(tags).alias("_src"), none)]
    if metadata is not None and time_col in metadata.columns:
        parts.append(metadata.select(F.lit("meta").alias("_src"), F.col(time_col).cast("double")
                                     .alias("_t")))
    u = functools.reduce(lambda a, b: a.unionByName(b), parts)
    s = u.agg(F.count_if(F.col("_src") == "in").cast("long").alias("n_inputs"),
              F.count_if(F.col("_src") == "out").cast("long").alias("n_outputs"),
              F.sum("_t").alias("total_time"))
    return s.select(
        "n_inputs", "n_outputs",
        F.when(F.col("n_inputs") > 0, F.col("n_outputs") * 100.0 / F.col("n_inputs"))
         .alias("success_pct"),
        "total_time",
        F.when(F.col("n_outputs") > 0, F.col("total_time") / F.col("n_outputs"))
         .alias("time_per_structure"))


def batch_stats(molecules: DataFrame, batch_col: str = "batch_id",
                size_col: str = "num_atoms") -> DataFrame:
    """Per batch the number of molecules and min/max/total atoms."""
    return molecules.groupBy(batch_col).agg(
        F.count(F.lit(1)).cast("long").alias("n_molecules"),
        F.min(size_col).cast("long").alias("min_atoms"), F.max(size_col).cast("long").alias("max_atoms"),
        F.sum(size_col).cast("long").alias("total_atoms"))


def progress(df: DataFrame, batch_col: str = "batch_id", ok_col: str = "ok") -> DataFrame:
    """T2 (batch form): done / failed per batch."""
    return df.groupBy(batch_col).agg(F.count_if(F.col(ok_col)).cast("long").alias("n_done"),
                                     F.count_if(~F.col(ok_col)).cast("long").alias("n_failed"))


# --- formatting ----------------------------------------------------------------
def human_size(c) -> Column:
    """bytes as text in 1024 steps with two decimals, B .. TB."""
    c = F.col(c) if isinstance(c, str) else c
    units = F.array(*[F.lit(u) for u in ("B", "KB", "MB", "GB", "TB")])
    # exponent from repeated comparisons (exact at the unit boundaries)
    e = (F.when(c >= F.lit(1024.0 ** 4), 4).when(c >= F.lit(1024.0 ** 3), 3)
         .when(c >= F.lit(1024.0 ** 2), 2).when(c >= F.lit(1024.0), 1).otherwise(0))
    val = F.round(c / F.pow(F.lit(1024.0), e), 2)
    return F.concat(F.format_string("%.2f", val), F.lit(" "), F.element_at(units, e + 1))


def elapsed(start, end, digits: int = 4) -> Column:
    """rounded time difference."""
    s = F.col(start) if isinstance(start, str) else start
    e = F.col(end) if isinstance(end, str) else end
    return F.round(e - s, digits)


# --- sampling (O1, O2, O5) -------------------------------------------------------
def preview(df: DataFrame, n: int = 5) -> tuple[list[str], list]:
    """O1: column list and first ``n`` rows (a bounded peek, ``limit``)."""
    return df.columns, df.limit(n).collect()


def head(df: DataFrame, n: int) -> DataFrame:
    """O2: first ``n`` rows for sampling (a feature-level limit)."""
    return df.limit(n)


def representative_smiles(atoms: DataFrame, key: str = "unique_id") -> DataFrame:
    """The SMILES of a molecule's first atom row (``min_by`` on atom_idx)."""
    return atoms.groupBy(key).agg(F.min_by("smiles", "atom_idx").alias("smiles"))
