"""File-based sources: JSON structures (S11), batch outputs (S12, S13),
manifests (S16), object inventory (S17) and cheap profiling (S18)."""

from __future__ import annotations

import csv
import functools
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from molspark.sources.quoted_csv import ENDS_OPEN, read_quoted_csv

# FIXED VALUES: batch folder patterns and the result files a batch writes.
BATCH_DIR_GLOBS = ("batch_*", "fs-sn-*")
BATCH_FILES = ("molecule_property.csv", "atom_property.csv", "metadata.csv",
               "defluorined_molecule_property.csv", "defluorined_atom_property.csv")

STRUCTURE_SCHEMA = T.StructType([
    T.StructField("elements", T.ArrayType(T.StringType())),
    T.StructField("xyz", T.ArrayType(T.ArrayType(T.DoubleType()))),
    T.StructField("atomic_numbers", T.ArrayType(T.IntegerType())),
    T.StructField("smiles", T.StringType()),
    T.StructField("unique_id", T.StringType()),
    T.StructField("charge", T.IntegerType()),
    T.StructField("multiplicity", T.IntegerType()),
    T.StructField("property", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("atom_property", T.MapType(T.StringType(), T.ArrayType(T.DoubleType()))),
    T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
])


def read_structures_json(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """JSON files holding one structure object or an array of them.
    Returns (molecules, atoms, failures). Atoms come from ``arrays_zip`` +
    ``posexplode`` so ``atom_idx`` is the list position; ``atom_property`` is a
    map of the atom's values (forces, charges, ...). A file that is no JSON
    structure is a failure row (path, reason)."""
    raw = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("path"))
    text = F.trim(F.col("value"), F.lit(" \t\r\n"))
    arr = F.from_json(text, T.ArrayType(STRUCTURE_SCHEMA))
    one = F.from_json(text, STRUCTURE_SCHEMA)
    parsed = raw.withColumn("s", F.when(text.startswith("["), arr).otherwise(F.array(one)))
    broken = F.col("s").isNull() | F.exists("s", lambda x: x.isNull() | x["elements"].isNull())
    failures = parsed.filter(broken).select("path", F.lit("no JSON structure").alias("reason"))
    s = parsed.select(F.explode(F.filter("s", lambda x: x["elements"].isNotNull())).alias("s")).select("s.*")
    mols = s.select("unique_id", "smiles", F.coalesce("charge", F.lit(0)).alias("charge"),
                    F.coalesce("multiplicity", F.lit(1)).alias("multiplicity"),
                    F.size("elements").alias("num_atoms"), "property", "metadata")
    from molspark.functions.ids import symbol_to_z
    zs = F.coalesce(F.col("atomic_numbers"), F.transform("elements", lambda e: symbol_to_z(e)))
    z = F.arrays_zip(F.col("elements").alias("element"), F.col("xyz").alias("xyz"), zs.alias("z_num"))
    atoms = s.select("unique_id", "atom_property", F.posexplode(z).alias("atom_idx", "a")).select(
        "unique_id", F.col("atom_idx").cast("int"), "a.element", "a.z_num",
        F.element_at("a.xyz", 1).alias("x"), F.element_at("a.xyz", 2).alias("y"),
        F.element_at("a.xyz", 3).alias("z"),
        F.transform_values("atom_property", lambda _, v: F.get(v, F.col("atom_idx"))).alias("atom_property"))
    return mols, atoms, failures


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def discover_batches(spark: SparkSession, root: str, name: str) -> list[str]:
    """Paths of ``<root>/{batch_*,fs-sn-*}/<name>`` that exist (file
    listing is metadata work done through the cluster file system API). A
    ``<name>`` written by Spark is a folder; its data files are listed."""
    out = []
    for g in BATCH_DIR_GLOBS:
        fs, p, jvm = _fs(spark, f"{root.rstrip('/')}/{g}/{name}")
        st = fs.globStatus(p)
        for s in st or []:
            if s.isFile():
                out.append(s.getPath().toString())
            else:
                for c in fs.listStatus(s.getPath()):
                    nm = c.getPath().getName()
                    if c.isFile() and not nm.startswith(("_", ".")) and c.getLen() > 0:
                        out.append(c.getPath().toString())
    return sorted(out)


BATCH_ID_PATTERN = r"/((?:batch_|fs-sn-)[^/]+)/"


def batch_id_of(path_col):
    """The batch folder name inside a file path."""
    return F.regexp_extract(path_col, BATCH_ID_PATTERN, 1)


def header_columns(header: str) -> list[str]:
    """Column names of a header line, read as CSV (quotes, doubled quotes)."""
    return [c.strip() for c in next(csv.reader([header.removeprefix("\ufeff")]), [])]


def header_groups(spark: SparkSession, paths: list[str]) -> list[tuple[str, list[str], list[str]]]:
    """(header, files whose lines are records, files with cells that span lines)
    for each header line, so that each group is read with one positional schema
    (one ``csv()`` call over mixed headers would map columns by position).

    One job reads all lines: the first one of every file is a map-side combined
    minimum by position, and as long as no line that begins outside a quoted
    cell ends inside one, every line is a record. The driver gets one row per
    file of the list it already holds. Empty files have no header and are left
    out."""
    t = spark.read.option("lineSep", "\n").text(paths).select(
        F.col("_metadata.file_path").alias("f"), "value",
        F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("p"))
    spans = (F.contains("value", F.lit('"')) & F.col("value").rlike(ENDS_OPEN)
             | F.contains(F.rtrim("value", F.lit("\r")), F.lit("\r")))  # a line end of its own kind to Spark
    groups: dict[str, tuple[list[str], list[str]]] = defaultdict(lambda: ([], []))
    for r in t.groupBy("f").agg(F.min_by("value", "p").alias("header"), F.bool_or(spans).alias("spans")).collect():
        if r["header"].strip():
            groups[r["header"].rstrip("\r")][r["spans"]].append(r["f"])
    return [(h, sorted(plain), sorted(spanning)) for h, (plain, spanning) in sorted(groups.items())]


def group_by_header(spark: SparkSession, paths: list[str]) -> dict[str, list[str]]:
    """The files of each header line."""
    return {h: sorted(plain + spanning) for h, plain, spanning in header_groups(spark, paths)}


def read_batch_csv(spark: SparkSession, header: str, plain: list[str], spanning: list[str] = ()) -> DataFrame:
    """Read same-header CSVs with every column as string (so ``unique_id``
    keeps its leading zeros) plus ``batch_id`` (the batch folder), ``_file`` and
    ``_at`` (a position in it that orders ranges). Cells may be quoted, hold line
    breaks (MolBlocks) and doubled quotes. Any file is read in byte ranges: those
    of ``plain``, whose lines are records, by Spark's CSV source, the others by
    ``read_quoted_csv``."""
    cols = header_columns(header)
    parts = []
    if plain:
        schema = T.StructType([T.StructField(c, T.StringType()) for c in cols])
        df = (spark.read.option("header", True).option("quote", '"').option("escape", '"').option("maxCharsPerColumn", -1)
              .schema(schema).csv(plain))
        parts.append(df.select(*[F.col(f"`{c}`") for c in cols], F.col("_metadata.file_path").alias("_file"),
                               F.col("_metadata.file_block_start").alias("_at")))
    if spanning:
        parts.append(read_quoted_csv(spark, list(spanning), cols))
    df = functools.reduce(DataFrame.unionByName, parts)
    return df.select(*[F.col(f"`{c}`") for c in cols], batch_id_of(F.col("_file")).alias("batch_id"), "_file", "_at")


def parquet_row_range(spark: SparkSession, path: str, start: int, length: int | None = None,
                      idx_col: str | None = None) -> DataFrame:
    """Rows ``start .. start + length - 1`` (to the end without ``length``)
    of a Parquet table in the order of its files' paths and of the rows in them,
    with ``idx_col`` their numbers.

    Nothing is sorted: files are counted by their footers, a prefix sum over
    the files (one row each) tells which of them the range meets, only those are
    read, and a row's place in its file is what the reader says."""
    counts = sorted((r["f"], r["n"]) for r in spark.read.parquet(path).groupBy(
        F.col("_metadata.file_path").alias("f")).agg(F.count(F.lit(1)).alias("n")).collect())
    table, at, met = spark.read.parquet(path), 0, []
    start, stop = max(0, start), None if length is None else max(0, start) + max(0, length)
    for f, n in counts:
        if at + n > start and (stop is None or at < stop):
            met.append((f, at, max(0, start - at), n if stop is None else min(n, stop - at)))
        at += n
    if not met:
        return table.limit(0) if idx_col is None else table.limit(0).withColumn(idx_col, F.lit(0).cast("long"))
    row, file = F.col("_metadata.row_index"), F.col("_metadata.file_path")
    (first, _, low, _), (last, _, _, high) = met[0], met[-1]
    # Only the files at the ends of the range are read in part.
    keep = ((file != first) | (row >= low)) & ((file != last) | (row < high))
    df = spark.read.schema(table.schema).parquet(*[f for f, *_ in met])
    if idx_col is None:
        return df.where(keep)
    offsets = spark.createDataFrame([(f, at) for f, at, *_ in met], "_range_file string, _range_at bigint")
    return (df.where(keep).select(*table.columns, file.alias("_range_file"), row.alias("_range_row"))
            .join(F.broadcast(offsets), "_range_file")  # one row a file
            .select(*table.columns, (F.col("_range_at") + F.col("_range_row")).alias(idx_col)))


def read_manifest(spark: SparkSession, path: str, mode: str = "upload") -> tuple[DataFrame, DataFrame]:
    """Headerless manifest CSV. All-null rows are dropped, cells
    trimmed; ``upload`` rows need exactly 3 cells (bucket, local_path,
    remote_path), ``download`` rows exactly 2 (bucket, remote_path).
    Returns (rows, bad rows with reason)."""
    width = {"upload": 3, "download": 2}[mode]
    raw = spark.read.text(path).filter(F.trim("value") != "")
    # a cell is quoted (with doubled quotes inside) or runs to the next comma
    parts = F.regexp_extract_all(F.concat(F.lit(","), F.col("value")),
                                 F.lit(r',\s*("(?:[^"]|"")*"|[^,]*)'), F.lit(1))
    plain = lambda c: F.when(F.trim(c).rlike('^".*"$'), F.replace(
        F.substring(F.trim(c), F.lit(2), F.length(F.trim(c)) - 2),
        F.lit('""'), F.lit('"'))).otherwise(F.trim(c))
    r = raw.select(F.transform(parts, plain).alias("c"))
    r = r.filter(F.exists("c", lambda x: x != ""))
    good = r.filter(F.size("c") == width)
    bad = r.filter(F.size("c") != width).select(
        F.array_join("c", ",").alias("line"),
        F.format_string(f"expected {width} columns, got %d", F.size("c")).alias("reason"))
    names = ["bucket", "local_path", "remote_path"] if width == 3 else ["bucket", "remote_path"]
    return good.select(*[F.element_at("c", i + 1).alias(n) for i, n in enumerate(names)]), bad


def file_inventory(spark: SparkSession, path: str) -> DataFrame:
    """Key and size of stored files; file contents are never read
    (only ``path`` and ``length`` are selected, so the binary column is pruned)."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
            .select(F.col("path").alias("key"), F.col("length").alias("size")))


def profile_input(df: DataFrame, required=("xyz_block",)) -> dict:
    """Row count (Parquet answers it from footers) and columns; a
    missing required column is an error."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
    return {"rows": df.count(), "columns": list(df.columns)}
