"""Volumes by column runs against every lattice point tested one by one."""

import math

import numpy as np
import pytest

from molspark.operators import volume as V
from molspark.operators.grid import vdw_volume
from molspark.refdata import VDW_RADII_ANGSTROM

RADII = {"H": VDW_RADII_ANGSTROM[1], "C": VDW_RADII_ANGSTROM[6], "O": VDW_RADII_ANGSTROM[8]}

SCHEMA = "unique_id long, element string, z_num int, x double, y double, z double"


def lattice(points, n, padding=0.001):
    """(points inside, volume) by testing all n^3 points."""
    xyz, r = np.array([p[:3] for p in points]), np.array([p[3] for p in points])
    lo, hi = xyz.min(axis=0) - r.max() - padding, xyz.max(axis=0) + r.max() + padding
    step = (hi - lo) / n
    g = [lo[d] + step[d] * (np.arange(n) + 0.5) for d in range(3)]
    inside = np.zeros((n, n, n), bool)
    for p, q in zip(xyz, r):
        d = [(g[k] - p[k]) ** 2 for k in range(3)]
        inside |= (d[0][:, None, None] + d[1][None, :, None]) + d[2][None, None, :] <= q * q
    return inside.sum(), step.prod() * inside.sum()


def molecules():
    r = np.random.default_rng(24)
    out = {1: [("C", 6, 0.0, 0.0, 0.0)], 2: [("O", 8, 0.0, 0.0, 0.0), ("O", 8, 0.0, 0.0, 0.0), ("H", 1, 0.96, 0.0, 0.0)]}
    out[3] = [("C", 6, *r.normal(size=3).tolist()) for _ in range(40)]
    out[4] = [("H", 1, *(r.normal(size=3) * 0.2).tolist()) for _ in range(60)] + [("C", 6, 50.0, -40.0, 30.0)]  # crowded corner, far atom
    out[5] = [("C", 6, float(i), 0.0, 0.0) for i in range(80)]
    out[6] = [("C", 6, 0.0, 0.0, float(i) / 4) for i in range(30)]  # all in the same columns
    return out


@pytest.mark.parametrize("n,block,chunk", [(20, 256, 4096), (20, 4, 8), (13, 2, 3), (31, 1, 1)])
def test_equals_the_lattice(spark, n, block, chunk):
    data = molecules()
    atoms = spark.createDataFrame([(k, *a) for k, rows in data.items() for a in rows], SCHEMA)
    got = {r[0]: r[1] for r in vdw_volume(atoms, n_per_axis=n, block_atoms=block, chunk_atoms=chunk).collect()}
    assert set(got) == set(data)
    for k, rows in data.items():
        _, want = lattice([(*a[2:], RADII[a[0]]) for a in rows], n)
        assert got[k] == pytest.approx(want, rel=1e-12), k


def test_portions_change_nothing(spark, monkeypatch):
    data = molecules()
    box = {k: lattice([(*a[2:], RADII[a[0]]) for a in rows], 25)[0] for k, rows in data.items()}
    import pyarrow as pa
    rows = []
    for k, atoms in data.items():
        xyz, r = np.array([a[2:] for a in atoms], float), np.array([RADII[a[0]] for a in atoms])
        lo, hi = xyz.min(axis=0) - r.max() - 0.001, xyz.max(axis=0) + r.max() + 0.001
        rows.append({"unique_id": k, "_nb": 1, "bx": 0, "by": 0, "_chunks": 1,
                     **{f"o{c}": lo[d] for d, c in enumerate("xyz")}, **{f"s{c}": (hi[d] - lo[d]) / 25 for d, c in enumerate("xyz")},
                     "spheres": np.column_stack([xyz, r]).ravel().tolist()})
    batch = pa.RecordBatch.from_pylist(rows)
    for size in (1, 500, 1 << 20):
        monkeypatch.setattr(V, "ENTRIES", size)
        out = {r["unique_id"]: r["hi"] + 1 for b in V.column_runs(25)([batch]) for r in b.to_pylist()}
        assert out == box


def test_a_crowd_is_spread_over_tasks(spark):
    from pyspark.sql import functions as F
    n = 100_000
    atoms = spark.range(n).select(F.lit(7).alias("unique_id"), F.lit("C").alias("element"), F.lit(6).alias("z_num"),
                                  *[(F.rand(s) * 3).alias(c) for s, c in enumerate("xyz")])
    far = spark.createDataFrame([(7, "C", 6, 300.0, 300.0, 300.0)], atoms.schema)
    v = vdw_volume(atoms.union(far), n_per_axis=40).first()[1]
    step = (300 + 2 * RADII["C"]) / 40
    assert 0 < v <= 8 * step ** 3  # the crowd fills a lattice point or two of a coarse lattice
    assert math.isfinite(v)


def test_lone_groups_are_counted_in_squares():
    """Blocks that end inside spheres, a lattice of three words, no sphere at all and one without a place."""
    rng = np.random.default_rng(5)
    n, spheres, group, boxes, first, stop, want = 130, [], [], [], [], [], []
    for g in range(12):
        own = np.column_stack([rng.uniform(0, 6, (g % 5, 3)), rng.choice([0.0, 1.1, 1.7, 2.5], g % 5)])
        box = np.array([v for o in rng.uniform(-3, 0, 3) for v in (o, rng.uniform(0.05, 0.09))])
        lo = rng.integers(0, 60, 2)
        hi = rng.integers(60, n + 1, 2)
        c = [box[2 * d] + box[2 * d + 1] * (np.arange(n) + 0.5) for d in range(3)]
        c = [c[0][lo[0]:hi[0]], c[1][lo[1]:hi[1]], c[2]]
        hit = np.zeros([len(x) for x in c], bool)
        for x, y, z, r in own:
            hit |= ((c[0] - x)[:, None, None] ** 2 + (c[1] - y)[None, :, None] ** 2) + (c[2] - z)[None, None, :] ** 2 <= r * r
        want.append(int(hit.sum()))
        own = np.vstack([own, [[np.nan, 1.0, 1.0, 1.7]]])
        spheres.append(own)
        group += [g] * len(own)
        boxes.append(box)
        first.append(lo)
        stop.append(hi)
    got = V.lone_counts(np.vstack(spheres), np.array(group), np.array(boxes), np.array(first), np.array(stop), n)
    assert got.tolist() == want
