"""Periodic neighbours against every image of every atom."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from molspark.operators.pairs import periodic_neighbours

CELLS = {
    "cube": [[12.0, 0, 0], [0, 12.0, 0], [0, 0, 12.0]],
    "triclinic": [[9.0, 0.5, -0.3], [3.0, 8.0, 0.2], [-2.0, 1.5, 10.0]],
    "small": [[2.1, 0.3, 0.0], [0.4, 1.9, 0.2], [-0.3, 0.5, 2.4]],  # lower than the cutoff along every axis
    "flat": [[15.0, 0, 0], [4.0, 2.0, 0], [0, 0, 7.0]],
    "left-handed": [[0, 6.5, 0], [6.5, 0, 0], [0, 0, 3.3]],
}


def brute(xyz, cell, cutoff, least):
    inv = np.linalg.inv(cell)
    n = np.ceil(cutoff * np.linalg.norm(inv, axis=0)).astype(int) + int(np.ceil(np.ptp(xyz @ inv, axis=0).max())) + 1
    out = set()
    for s in itertools.product(*[range(-k, k + 1) for k in n]):
        move = np.array(s) @ cell
        d = np.linalg.norm(xyz[None, :, :] + move - xyz[:, None, :], axis=2)
        out |= {(int(i), int(j), *s) for i, j in np.argwhere((d > least) & (d < cutoff))}
    return out


@pytest.mark.parametrize("cutoff", [3.0, 5.5])
def test_every_image(spark, cutoff):
    r = np.random.default_rng(6)
    cells = {k: np.array(v, float) for k, v in CELLS.items()}
    # Some atoms lie outside their cell, some on its faces, some twice.
    frac = {k: np.concatenate([r.uniform(-1.5, 2.5, size=(14, 3)), [[0, 0, 0], [1, 1, 1], [0.5, 0, 1]]]) for k in cells}
    xyz = {k: frac[k] @ cells[k] for k in cells}
    atoms = spark.createDataFrame([(k, i, f"E{i}", *map(float, p)) for k in cells for i, p in enumerate(xyz[k])],
                                  "unique_id string, atom_idx int, element string, x double, y double, z double")
    rows = spark.createDataFrame([(k, *map(float, c.ravel())) for k, c in cells.items()],
                                 "unique_id string, " + ", ".join(f"{n}{k} double" for n in "abc" for k in (1, 2, 3)))
    got = periodic_neighbours(atoms, rows, cutoff, cols=["element"]).collect()
    for k in cells:
        mine = [x for x in got if x.unique_id == k]
        found = [(x.atom_idx_i, x.atom_idx_j, x.sa, x.sb, x.sc) for x in mine]
        assert len(found) == len(set(found)) and set(found) == brute(xyz[k], cells[k], cutoff, 0.1), k
        for x in mine:
            image = xyz[k][x.atom_idx_j] + np.array([x.sa, x.sb, x.sc]) @ cells[k]
            assert np.allclose([x.x_j, x.y_j, x.z_j], image) and x.d == pytest.approx(np.linalg.norm(image - xyz[k][x.atom_idx_i]))
            assert (x.element_i, x.element_j) == (f"E{x.atom_idx_i}", f"E{x.atom_idx_j}")


def test_one_large_system_is_many_keys(spark):
    side, n = 40, 40 ** 3
    atoms = spark.range(n).select(F.lit("big").alias("unique_id"), F.col("id").cast("int").alias("atom_idx"), *[
        (F.floor(F.col("id") / side ** k) % side).cast("double").alias(c) for k, c in enumerate("xyz")])
    cell = spark.createDataFrame([("big", 40.0, 0.0, 0.0, 0.0, 40.0, 0.0, 0.0, 0.0, 40.0)],
                                 "unique_id string, " + ", ".join(f"{a}{k} double" for a in "abc" for k in (1, 2, 3)))
    p = periodic_neighbours(atoms, cell, 1.2)
    r = p.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("atom_idx_i").alias("atoms")).first()
    assert (r.n, r.atoms) == (6 * n, n)  # a periodic simple cubic lattice
