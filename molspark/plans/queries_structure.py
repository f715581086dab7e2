"""Registered queries of the splittable CSV reader, of row ranges of tables and of
structural duplicates among conformers of one formula."""

from __future__ import annotations

import os
import socket
import uuid

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from molspark.plans import bridge as br
from molspark.plans.queries import register, rk
from molspark.session import freed_shuffles, scratch_path


# --- one large quoted file per batch, cut into byte ranges (S13) ------------------
@register("quoted_csv_ranges", """
SELECT lpad(CAST(o_orderkey AS VARCHAR), 8, '0') AS unique_id,
       'say "' || o_orderstatus || '", then' || chr(10) || '  1 2, end' || CASE WHEN o_custkey % 3 = 0 THEN chr(13) || chr(10) || '""' ELSE '' END AS note,
       CASE WHEN o_custkey % 5 <> 0 THEN printf('%.4f', o_totalprice) END AS energy,
       CASE WHEN o_custkey % 7 = 0 THEN '5" pipe' ELSE o_orderpriority END AS label
FROM orders""")
def q_quoted_csv_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` as one CSV file per priority, with notes that span lines, read
    in ranges of 64 KB: their borders lie inside quoted cells and line ends."""
    from molspark.sources.files import discover_batches, header_groups, read_batch_csv
    from molspark.plans.queries import _as_batches
    root = scratch_path(spark, f"ranges-{uuid.uuid4().hex[:12]}")
    k = F.col("o_custkey")
    note = F.concat(F.lit('say "'), "o_orderstatus", F.lit('", then\n  1 2, end'), F.when(k % 3 == 0, '\r\n""').otherwise(""))
    (br.table(spark, sf_dir, "orders").select(
        F.substring("o_orderpriority", 1, 1).alias("_k"), F.lpad(F.col("o_orderkey").cast("string"), 8, "0").alias("unique_id"),
        note.alias("note"), F.when(k % 5 != 0, F.format_string("%.4f", F.col("o_totalprice"))).alias("energy"),
        F.when(k % 7 == 0, '5" pipe').otherwise(F.col("o_orderpriority")).alias("label"))
     .repartition("_k").write.partitionBy("_k").option("header", True).option("escape", '"').csv(f"{root}/raw"))
    _as_batches(spark, f"{root}/raw", "_k", root, "molecule_property.csv")
    ranges = spark.newSession()  # the size of ranges is a setting of the session
    ranges.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    ranges.conf.set("spark.sql.files.openCostInBytes", "1b")
    groups = header_groups(ranges, discover_batches(ranges, root, "molecule_property.csv"))
    parts = [read_batch_csv(ranges, *g).select("unique_id", "note", "energy", "label") for g in groups]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# --- duplicates among centred conformers of one formula (J12) ---------------------
# Every order line of a part is a conformer of one formula: four atoms with the origin as mean.
# Every fifth has a copy within the tolerance, every ninth one just outside.
_ATOMS = [("C", "0.0", "0.0", "0.0"), ("O", "u", "0.0", "v"), ("H", "v", "w", "0.0"), ("H", "0.0", "u", "w")]
_MEAN = {"x": "(u + v) / 4.0", "y": "(w + u) / 4.0", "z": "(v + w) / 4.0"}
_POINTS = [(f"{c}{i}", f"{a[1 + d]} - {_MEAN[c]}") for i, a in enumerate(_ATOMS) for d, c in enumerate("xyz")]
_CONFORMERS = """SELECT lpad(CAST(l_orderkey AS {text}), 9, '0') || '-' || CAST(l_linenumber AS {text})
 || '-' || CAST(l_partkey AS {text}) AS id, l_orderkey AS k,
 max(l_quantity) / 10.0 AS u, max(l_extendedprice) / 10000.0 AS v, max(l_discount) * 10.0 + max(l_tax) AS w
 FROM lineitem GROUP BY l_orderkey, l_linenumber, l_partkey"""
_COPIED = """SELECT id AS unique_id, u, v, w FROM conf UNION ALL SELECT id || 'c', u + 1e-9, v, w FROM conf WHERE k % 5 = 0
 UNION ALL SELECT id || 'd', u + 1e-2, v, w FROM conf WHERE k % 9 = 0"""
_CLOSE = " AND ".join(f"abs(b.{p} - a.{p}) <= 1e-08 + 1e-05 * abs(a.{p})" for p, _ in _POINTS)


@register("conformer_duplicates", f"""
WITH conf AS ({_CONFORMERS.format(text='VARCHAR')}), copied AS ({_COPIED}),
p AS (SELECT unique_id, floor(v / 0.01) AS cell, {', '.join(f'{e} AS {n}' for n, e in _POINTS)} FROM copied),
q AS (SELECT p.* EXCLUDE (cell), cell + d AS cell FROM p, (VALUES (-1), (0), (1)) s(d))
SELECT b.unique_id, min(a.unique_id) AS rep_id
FROM p b JOIN q a ON a.cell = b.cell AND a.unique_id < b.unique_id AND {_CLOSE}
GROUP BY b.unique_id""")
def q_conformer_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from molspark.operators.structure import structural_duplicates
    lines = br.table(spark, sf_dir, "lineitem")
    conf = spark.sql(_CONFORMERS.format(text="STRING").replace("lineitem", "{lineitem}"), lineitem=lines)
    points = ", ".join(f"named_struct('atom_idx', {i}, 'element', '{a[0]}', 'x', {a[1]} - {_MEAN['x']}, "
                       f"'y', {a[2]} - {_MEAN['y']}, 'z', {a[3]} - {_MEAN['z']})" for i, a in enumerate(_ATOMS))
    # The copies of a conformer beside it, so the conformers are built once.
    copied = spark.sql("""SELECT i.unique_id, i.u, v, w FROM (SELECT v, w, inline(filter(array(
        named_struct('unique_id', id, 'u', u, 'there', true), named_struct('unique_id', id || 'c', 'u', u + 1e-9, 'there', k % 5 = 0),
        named_struct('unique_id', id || 'd', 'u', u + 1e-2, 'there', k % 9 = 0)), i -> i.there)) AS (unique_id, u, there) FROM {conf}) i""",
                       conf=conf)
    path = scratch_path(spark, f"conformers-{uuid.uuid4().hex[:12]}")
    with freed_shuffles(spark):
        spark.sql("SELECT unique_id, p.* FROM (SELECT unique_id, explode(array(" + points + ")) AS p FROM {copied})",
                  copied=copied).write.parquet(path)  # a table, as a user has it
    mols = spark.read.parquet(path).where("atom_idx = 0").select("unique_id")  # every conformer has one
    return structural_duplicates(mols, spark.read.parquet(path))


# --- a row range of a table of XYZ blocks (S10, W7) -------------------------------
@register("xyz_row_range", br.with_views("""
SELECT smiles, charge, num_atoms, sum_x FROM (
  SELECT 'CO' AS smiles, m.charge, c.num_atoms, c.sum_x, row_number() OVER (ORDER BY m.unique_id) - 1 AS idx, count(*) OVER () AS n
  FROM molecules m JOIN (SELECT unique_id, CAST(count(*) AS INTEGER) AS num_atoms, round(sum(x), 4) AS sum_x
                         FROM atoms GROUP BY 1) c ON m.unique_id = c.unique_id) t
WHERE idx >= n // 3 AND idx < n // 3 + n // 2""", "molecules", "atoms"))
def q_xyz_row_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    from molspark.sinks.tables import xyz_blocks
    from molspark.sources.xyz import read_xyz_rows
    m = br.molecules(spark, sf_dir).select("unique_id", "charge", F.lit(3).alias("multiplicity"), F.lit("CO").alias("smiles"))
    path = scratch_path(spark, f"xyz-rows-{uuid.uuid4().hex[:12]}")
    blocks = xyz_blocks(m, br.atoms(spark, sf_dir, with_z=False))
    # Written before they are put in order, as the search for the borders of the ranges reads every row once more.
    blocks.select("unique_id", "xyz_block", F.lit("CO").alias("smiles")).write.parquet(f"{path}-unordered")
    files = max(16, 4 * spark.sparkContext.defaultParallelism)
    spark.read.parquet(f"{path}-unordered").repartitionByRange(files, "unique_id") \
        .sortWithinPartitions("unique_id").write.parquet(path)
    n = spark.read.parquet(path).count()
    mols, atoms, _ = read_xyz_rows(spark, path, n // 3, n // 2)
    sums = atoms.groupBy("unique_id").agg(rk(F.sum("x"), 4).alias("sum_x"))
    return mols.join(sums, "unique_id").select("smiles", "charge", "num_atoms", "sum_x")


# --- XYZ files of many frames in byte ranges (S5-S9) ------------------------------
@register("xyz_frames", br.with_views("""
SELECT CASE WHEN kind <> 1 THEN m.unique_id END AS unique_id, CASE WHEN kind = 1 THEN num_atoms ELSE charge END AS charge,
       CASE WHEN kind <> 2 THEN num_atoms END AS num_atoms, CASE WHEN kind <> 2 THEN sum_x END AS sum_x,
       CASE WHEN kind = 1 THEN CAST(num_atoms AS DOUBLE) END AS sum_q, CAST(NULL AS VARCHAR) AS reason
FROM (SELECT *, CAST(unique_id AS BIGINT) % 4 AS kind FROM molecules) m
JOIN (SELECT unique_id, CAST(count(*) AS INTEGER) AS num_atoms, round(sum(x), 4) AS sum_x FROM atoms GROUP BY 1) c ON m.unique_id = c.unique_id
WHERE kind <> 2
UNION ALL
SELECT NULL, NULL, NULL, NULL, NULL, CAST(count(*) AS VARCHAR) || ' atom lines, 0 announced'
FROM atoms WHERE CAST(unique_id AS BIGINT) % 4 = 2 GROUP BY unique_id""", "molecules", "atoms"))
def q_xyz_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every molecule as a frame of one of four files, read in ranges of 64 KB: one
    file has a column of charges and comments of digits, one announces no atoms,
    and one has the line ends of another system."""
    from molspark.sinks.tables import xyz_blocks
    from molspark.sources.xyz_frames import read_xyz_frames
    m = br.molecules(spark, sf_dir).select("unique_id", "charge", F.lit(1).alias("multiplicity"))
    lines, kind = F.split("xyz_block", "\n"), F.col("unique_id").cast("long") % 4
    end = F.when(kind == 1, " 1.0").when(kind == 3, "\r").otherwise("")
    body = F.transform(F.slice(lines, 3, F.size(lines)), lambda x: F.concat(x, end))
    text = F.concat_ws("\n", F.when(kind == 2, "0").otherwise(F.element_at(lines, 1)),
                       F.when(kind == 1, F.col("unique_id")).otherwise(F.element_at(lines, 2)), body)
    root = scratch_path(spark, f"frames-{uuid.uuid4().hex[:12]}")
    (xyz_blocks(m, br.atoms(spark, sf_dir, with_z=False)).select(text.alias("value"), kind.alias("kind"))
     .repartition("kind").write.partitionBy("kind").text(root))
    ranges = spark.newSession()  # the size of ranges is a setting of the session
    ranges.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    ranges.conf.set("spark.sql.files.openCostInBytes", "1b")
    sum_x, no_q, no_reason = rk(F.sum("x"), 4).alias("sum_x"), F.lit(None).cast("double"), F.lit(None).cast("string")
    mols, atoms, failed = read_xyz_frames(ranges, f"{root}/kind=[023]", id_from="comment")
    out = mols.join(atoms.groupBy("unique_id").agg(sum_x), "unique_id").select(
        "unique_id", "charge", "num_atoms", "sum_x", no_q.alias("sum_q"), no_reason.alias("reason"))
    mols, atoms, _ = read_xyz_frames(ranges, f"{root}/kind=1", "tokens", charge_col_idx=4)
    sums = atoms.groupBy("unique_id").agg(sum_x, F.sum("partial_charge").alias("sum_q"))
    charged = mols.join(sums, "unique_id").select(F.lit(None).cast("string").alias("unique_id"), "charge", "num_atoms", "sum_x",
                                                  "sum_q", no_reason.alias("reason"))
    none = [F.lit(None).cast(t).alias(c) for c, t in (("unique_id", "string"), ("charge", "int"), ("num_atoms", "int"),
                                                      ("sum_x", "double"), ("sum_q", "double"))]
    return out.union(charged).union(failed.select(*none, "reason"))


# --- model batches packed by padded size (X4) --------------------------------------
@register("packed_inference", br.with_views("""
SELECT unique_id, CAST(num_atoms AS BIGINT) * 7 AS v, TRUE AS fits, TRUE AS little_padding, TRUE AS one_load
FROM (SELECT unique_id, count(*) AS num_atoms FROM atoms GROUP BY unique_id) t""", "atoms"))
def q_packed_inference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every molecule through a model in batches of at most 256 padded atoms: at
    most a tenth of all is padding, and a Python worker loads the model once."""
    from molspark.operators.stages import batch_inference
    sizes = br.atoms(spark, sf_dir, with_z=False).groupBy("unique_id").agg(F.count(F.lit(1)).alias("num_atoms"))

    def make_model():
        load, worker = uuid.uuid4().hex, f"{socket.gethostname()}:{os.getpid()}"
        return lambda pdf: pd.DataFrame({
            "unique_id": pdf["unique_id"], "v": pdf["num_atoms"] * 7, "n": pdf["num_atoms"], "padded": int(pdf["num_atoms"].max()),
            "area": len(pdf) * int(pdf["num_atoms"].max()), "alone": len(pdf) == 1, "load": f"{worker}/{load}"})

    path = scratch_path(spark, f"inference-{uuid.uuid4().hex[:12]}")
    key = f"sevenfold-{uuid.uuid4().hex}"
    batch_inference(sizes, make_model, "unique_id string, v bigint, n bigint, padded bigint, area bigint, alone boolean, load string",
                    max_padded=256, model_key=key).write.parquet(path)
    out = spark.read.parquet(path)  # one run: loads differ between two
    told = out.agg((F.sum("padded") * 0.9 <= F.sum("n")).alias("little_padding"),
                   (F.count_distinct("load") == F.count_distinct(F.substring_index("load", "/", 1))).alias("one_load"))
    return out.crossJoin(F.broadcast(told)).select(  # one row
        "unique_id", "v", (F.col("alone") | (F.col("area") <= 256)).alias("fits"), "little_padding", "one_load")


# --- progress every so many rows, over a restart (T2) ------------------------------
@register("progress_feed", """
SELECT batch, unnest(generate_series(1, n // 50)) * 50 AS milestone, TRUE AS reached
FROM (SELECT o_orderpriority AS batch, count(*) AS n FROM orders WHERE o_orderstatus IN ('F', 'O') GROUP BY 1) t""")
def q_progress_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Molecules arrive in two loads; the feed stops after the first, begins again
    from its checkpoint, and tells every multiple of 50 of each batch once."""
    from molspark.streaming.combine import progress_feed
    root = scratch_path(spark, f"progress-{uuid.uuid4().hex[:12]}")
    m = br.molecules(spark, sf_dir).select("unique_id", "batch_id", "converged")
    for load in (0, 1):
        m.where(F.pmod(F.xxhash64("unique_id"), F.lit(2)) == load).repartition(4).write.mode("append").parquet(f"{root}/in")
        rows = spark.readStream.schema(m.schema).option("maxFilesPerTrigger", 2).parquet(f"{root}/in")
        (progress_feed(rows, ok_col="converged", every=50).writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start(f"{root}/feed").awaitTermination())
    feed = spark.read.parquet(f"{root}/feed")
    return feed.select("batch", "milestone", (F.col("n_done") + F.col("n_failed") >= F.col("milestone")).alias("reached"))


# --- incremental merge, one row of each key (T1) -----------------------------------
@register("combine_stream_distinct", """
SELECT lpad(CAST(o_orderkey AS VARCHAR), 8, '0') AS unique_id, o_orderstatus AS smiles,
       CAST(printf('%.4f', -o_totalprice / 100.0) AS DOUBLE) AS homo
FROM orders""")
def q_combine_stream_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads of batch files that share a third of their molecules, in epochs of
    three files: every molecule stays once."""
    from molspark.plans.queries import _as_batches
    from molspark.streaming.combine import combine_stream
    root = scratch_path(spark, f"stream-{uuid.uuid4().hex[:12]}")
    o = br.table(spark, sf_dir, "orders")
    rows = o.select(
        (F.col("o_custkey") % 3).alias("third"), F.substring("o_orderpriority", 1, 1).alias("batch"),
        F.lpad(F.col("o_orderkey").cast("string"), 8, "0").alias("unique_id"), F.col("o_orderstatus").alias("smiles"),
        F.format_string("%.4f", -F.col("o_totalprice") / 100.0).alias("homo"))
    for load in (0, 1):
        part = rows.where(F.col("third").isin(load, load + 1)).withColumn("_k", F.concat("batch", F.lit(load))).drop("third", "batch")
        part.write.partitionBy("_k").option("header", True).csv(f"{root}/raw-{load}")
        _as_batches(spark, f"{root}/raw-{load}", "_k", f"{root}/in", "molecule_property.csv")
        combine_stream(spark, f"{root}/in", "molecule_property.csv", "unique_id string, smiles string, homo double",
                       f"{root}/merged", f"{root}/checkpoint", dedupe_key="unique_id", files_per_epoch=3)
    return spark.read.parquet(f"{root}/merged").select("unique_id", "smiles", "homo")


# --- appends that count once (K10) ------------------------------------------------
@register("append_ledger", """
SELECT CAST(o_orderkey AS VARCHAR) AS unique_id, o_totalprice AS energy, CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS label,
       CASE WHEN o_orderstatus = 'F' THEN 'finished' ELSE 'open' END AS batch
FROM orders""")
def q_append_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches with other column orders and spellings; one job runs twice and
    one dies between writing and committing and runs again."""
    from pyspark.sql import types as T

    from molspark.sinks.append import append_once, read_appended, stage_batch
    schema = T._parse_datatype_string("unique_id string, energy double, label string")
    table = scratch_path(spark, f"appended-{uuid.uuid4().hex[:12]}")
    o = br.table(spark, sf_dir, "orders")
    finished = F.col("o_orderstatus") == "F"
    done = o.where(finished).select(F.col("o_totalprice").alias("Energy"), F.col("o_orderkey").alias("UNIQUE_ID"),
                                    F.lit(1).alias("extra"))
    rest = o.where(~finished).select(F.col("o_orderpriority").alias("label"), F.col("o_orderkey").alias("unique_id"),
                                     F.col("o_totalprice").alias("energy"))
    append_once(done, table, schema, "finished")
    append_once(done, table, schema, "finished")
    stage_batch(rest, table, schema)  # a job that died before its commit
    append_once(rest, table, schema, "open")
    return read_appended(spark, table, schema)
