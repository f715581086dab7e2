"""Widths of what moves, and rows that went missing."""

import glob
import re

import numpy as np
import pyarrow.parquet as pq
from pyspark.sql import functions as F


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _atoms(spark, molecules=40, atoms=5):
    return spark.range(molecules * atoms).select(
        (F.col("id") % molecules).cast("string").alias("unique_id"), F.floor(F.col("id") / molecules).cast("int").alias("atom_idx"),
        F.lit("C").alias("element"), F.lit(6).alias("z_num"), *[(F.pmod(F.hash("id", F.lit(c)), F.lit(500)) / 100.0).alias(c) for c in "xyz"])


def test_duplicates_move_three_narrow_columns(spark):
    from molspark.operators.structure import structural_duplicates
    from molspark.session import ensure_checkpoint_dir
    atoms = _atoms(spark)
    copies = atoms.where("unique_id < '2'").withColumn("unique_id", F.concat("unique_id", F.lit("b")))
    every = atoms.union(copies)
    root = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(glob.glob(f"{root}/duplicate-rows-*"))
    out = structural_duplicates(every.select("unique_id").distinct(), every)
    assert {(r.unique_id, r.rep_id) for r in out.collect()} == {
        (r.unique_id, r.unique_id[:-1]) for r in copies.select("unique_id").distinct().collect()}
    (path,) = set(glob.glob(f"{root}/duplicate-rows-*")) - before
    table = pq.read_table(path)
    assert table.column_names == ["_id", "_block", "_same"]
    assert {len(x) for c in ("_block", "_same") for x in table[c].to_pylist()} == {16}


def test_grid_points_do_not_move(spark):
    from molspark.operators.grid import esp_grid, grid_boxes, point_charge_esp
    a = _atoms(spark)
    boxes = grid_boxes(a, spacing=1.5, padding=3.0)
    g = esp_grid(a, rcut=3.0, spacing=1.5, probe=1.1, boxes=boxes)
    assert not re.search(r"hashpartitioning\([^)]*grid_idx", _plan(g))
    e = point_charge_esp(g, a, sizes=boxes.select("unique_id", "n_lattice"))
    assert not re.search(r"hashpartitioning\([^)]*grid_idx", _plan(e))


def test_potential_in_many_tiles(spark):
    from molspark.operators.grid import point_charge_esp
    rng = np.random.default_rng(4)
    xyz, q, points = rng.uniform(0, 5, (50, 3)), rng.uniform(-1, 1, 50), rng.uniform(6, 9, (40, 3))
    atoms = spark.createDataFrame([("m", i, *map(float, p), float(c)) for i, (p, c) in enumerate(zip(xyz, q))] + [("m", 50, None, 0.0, 0.0, 1.0)],
                                  "unique_id string, atom_idx int, x double, y double, z double, q double")
    grid = spark.createDataFrame([("m", i * 3, *map(float, p)) for i, p in enumerate(points)],
                                 "unique_id string, grid_idx long, gx double, gy double, gz double").repartition(3)
    got = {r.grid_idx: r.esp for r in point_charge_esp(grid, atoms, "q", block_size=8).collect()}
    want = (q / np.linalg.norm(points[:, None] - xyz, axis=2)).sum(axis=1)
    assert sorted(got) == [3 * i for i in range(40)]
    assert np.allclose([got[3 * i] for i in range(40)], want)


def test_potential_reads_atoms_once_and_tests_reach_only(spark):
    from molspark.operators.esp_blocks import _accessible, _Block, esp_blocks
    assert len(re.findall(r"Range \(", _plan(esp_blocks(_atoms(spark), spacing=1.5)))) == 1
    rng = np.random.default_rng(7)
    atoms = [*rng.uniform(0, 6, (3, 9)), rng.uniform(1, 4, 9), rng.uniform(0, 9, 9)]
    box = {"nx": 23, "ny": 21, "nz": 25, "ox": -3.0, "oy": -2.5, "oz": -3.2, "sx": 0.5, "sy": 0.55, "sz": 0.5}
    for first, last in ((0, 23 * 21 * 25), (700, 5000), (11000, 12075), (100, 400)):  # the last at once
        slow = _Block(box, first, last)
        slow.add(atoms, 1e-8, True)
        points, _ = slow.kept(3.0, 1e-8)
        found, r2 = _accessible(box, first, last, atoms, 3.0, 1e-8)
        assert all(len(f) == len(p) and (f == p).all() for f, p in zip(found, points))
        assert r2.shape == (9, len(points[0]))


def test_input_of_duplicates_is_derived_once(spark, tmp_path, monkeypatch):
    from pyspark.sql.readwriter import DataFrameWriter

    from molspark.operators import structure
    from molspark.plans import queries as q
    spark.range(30).selectExpr("id AS o_orderkey", "id AS o_custkey", "1.0D AS o_totalprice", "'F' AS o_orderstatus",
                               "'1' AS o_orderpriority").write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(90).selectExpr("id % 30 AS l_orderkey", "CAST(id AS INT) AS l_linenumber", "id AS l_partkey", "id AS l_suppkey",
                               "1.0D AS l_extendedprice", "id * 1.0D AS l_quantity", "0.05D AS l_discount", "0.02D AS l_tax"
                               ).write.parquet(f"{tmp_path}/lineitem.parquet")
    plans, writer = [], DataFrameWriter.parquet

    def parquet(self, path, *args, **kwargs):
        if "/duplicates-" in path or "/conformers-" in path:
            plans.append(self._df._jdf.queryExecution().optimizedPlan().toString())
        return writer(self, path, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    monkeypatch.setattr(structure, "structural_duplicates", lambda mols, atoms: (mols, atoms))
    from molspark.plans.queries_structure import q_conformer_duplicates
    for query in (q.q_duplicates, q_conformer_duplicates):
        mols, atoms = query(spark, str(tmp_path))
        assert sorted(r.unique_id for r in mols.collect()) == sorted(r.unique_id for r in atoms.select("unique_id").distinct().collect())
    assert [p.count("Relation") for p in plans] == [1, 1]


def test_images_are_told_after_the_join(spark):
    from molspark.operators.pairs import periodic_neighbours
    a = _atoms(spark)
    cells = a.select("unique_id").distinct().select("unique_id", *[
        F.lit(6.0 if n[0] == "abc"[int(n[1]) - 1] else 0.0).alias(n) for n in (f"{x}{k}" for x in "abc" for k in (1, 2, 3))])
    p = periodic_neighbours(a, cells, cutoff=3.0)
    assert _plan(p).index("Generate explode(sequence(_la") < _plan(p).index("SortMergeJoin")
    cols = ["unique_id", "atom_idx_i", "atom_idx_j", "sa", "sb", "sc"]
    salted = periodic_neighbours(a, cells, cutoff=3.0, large_system=3)
    assert sorted(map(tuple, p.select(*cols).collect())) == sorted(map(tuple, salted.select(*cols).collect()))


def test_small_ranges_share_tasks(spark, tmp_path):
    from molspark.session import few_tasks
    spark.range(40_000).selectExpr("CAST(id AS STRING)").coalesce(1).write.text(str(tmp_path / "t"))
    own = spark.newSession()
    own.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    own.conf.set("spark.sql.files.openCostInBytes", "1b")
    scan = own.read.text(str(tmp_path / "t")).selectExpr("value", "_metadata.file_block_start AS at")
    few = few_tasks(scan)
    assert scan.rdd.getNumPartitions() > 100 and few.rdd.getNumPartitions() == 4 * spark.sparkContext.defaultParallelism
    assert few.select("at").distinct().count() == scan.select("at").distinct().count() and few.distinct().count() == 40_000
