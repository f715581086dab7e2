"""What stays on disk, what moves, and what is worked out of it."""

import glob
import time

import numpy as np
from pyspark.sql import functions as F


def _shuffle_files(spark):
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for d in dirs for f in glob.glob(f"{d.getPath()}/**/shuffle_*.data", recursive=True)}


def _freed(spark, before):
    for _ in range(50):
        if not _shuffle_files(spark) - before:
            return True
        time.sleep(0.2)
    return False


def _molecules(spark, n, atoms):
    """Molecules of one formula that differ in the last atom only, every tenth with a near copy."""
    m = spark.range(n).select(F.format_string("%05d", "id").alias("unique_id"), (F.col("id") / 100.0).alias("u"))
    every = m.union(m.where("CAST(unique_id AS INT) % 10 = 0").select(F.concat("unique_id", F.lit("n")), F.col("u") + 1e-9))
    i = F.explode(F.sequence(F.lit(0), F.lit(atoms - 1)))
    rows = every.select("unique_id", "u", i.alias("atom_idx")).select(
        "unique_id", "atom_idx", F.lit("C").alias("element"), F.when(F.col("atom_idx") == atoms - 1, F.col("u")).otherwise(1.0).alias("x"),
        F.col("atom_idx").cast("double").alias("y"), F.lit(0.0).alias("z"))
    return every.select("unique_id"), rows


def test_molecules_that_differ_in_any_atom_do_not_meet(spark, monkeypatch):
    from molspark.operators import structure as S
    mols, atoms = _molecules(spark, 400, 60)
    met, before = [], S.duplicate_candidates
    monkeypatch.setattr(S, "duplicate_candidates", lambda *a, **k: met.append(before(*a, **k)) or met[-1])
    got = {(r.unique_id, r.rep_id) for r in S.structural_duplicates(mols, atoms).collect()}
    assert got == {(f"{i:05d}n", f"{i:05d}") for i in range(0, 400, 10)}
    pairs = [(r._a, r._b) for m in met for r in m.collect()]
    assert len(pairs) == len(set(pairs)) and set(pairs) >= got and len(pairs) <= 120


def test_shuffles_of_duplicates_are_removed(spark):
    from molspark.operators.structure import structural_duplicates
    mols, atoms = _molecules(spark, 50, 3)
    before = _shuffle_files(spark)
    out = structural_duplicates(mols, atoms)
    assert _freed(spark, before)
    assert out.count() == 5


def test_points_of_one_share_are_on_disk(spark, tmp_path, monkeypatch):
    from molspark.plans import queries as q
    from molspark.session import ensure_checkpoint_dir
    spark.range(90).selectExpr("id % 30 AS l_orderkey", "CAST(id AS INT) AS l_linenumber", "id AS l_partkey", "id AS l_suppkey",
                               "1.0D AS l_extendedprice", "id % 50 * 1.0D AS l_quantity", "id % 11 / 100.0D AS l_discount",
                               "id % 9 / 100.0D AS l_tax").write.parquet(f"{tmp_path}/lineitem.parquet")
    want = sorted(map(tuple, q.q_esp_grid_coarse(spark, str(tmp_path)).collect()))
    root = ensure_checkpoint_dir(spark).removeprefix("file:")
    for atoms in (16_000_000, 40):  # one share and three
        monkeypatch.setattr(q, "SHARE_ATOMS", atoms)
        tables, shuffles = set(glob.glob(f"{root}/esp-points-*")), _shuffle_files(spark)
        out = q.q_esp_grid(spark, str(tmp_path))
        assert _freed(spark, shuffles) and set(glob.glob(f"{root}/esp-points-*")) == tables
        assert sorted(map(tuple, out.collect())) == want and len(want) == 30


def test_many_molecules_at_once_equal_each_alone():
    from molspark.operators.esp_blocks import _accessible, _usual
    rng = np.random.default_rng(3)
    for k, step, rcut in ((1, 0.5, 3.0), (4, 0.5, 3.0), (5, 1.5, 3.0), (3, 0.7, 1.0)):
        atoms = [np.round(rng.uniform(-2, 3, (9, k)), 1) for _ in range(3)] + [rng.choice([0.0, 1.1, 2.3, 2.8, 4.5], (9, k)), rng.uniform(-1, 8, (9, k))]
        box = {f"{n}{c}": v for c, at in zip("xyz", atoms) for n, v in (
            ("n", np.floor((at.max(1) - at.min(1) + 6.0) / step).astype(int) + 1), ("o", at.min(1) - 3.0), ("s", np.full(9, step)))}
        counts, points, esp = _usual(box, atoms, rcut, 1e-8, True)
        ends = np.cumsum(counts)
        for m, (end, n) in enumerate(zip(ends, counts)):
            own = {c: v[m].item() for c, v in box.items()}
            one, r2 = _accessible(own, 0, int(own["nx"] * own["ny"] * own["nz"]), [v[m] for v in atoms], rcut, 1e-8)
            assert all((p[end - n:end] == o).all() and len(o) == n for p, o in zip(points, one))
            assert np.allclose(esp[end - n:end], (atoms[4][m][:, None] / np.sqrt(r2)).sum(axis=0), rtol=1e-13)
