import math

import pytest
from pyspark.sql import functions as F

from molspark.functions import kernels as K
from molspark.functions.units import COULOMB_EV_ANGSTROM, HARTREE_EV
from molspark.operators import geometry as G
from molspark.operators import levels as L
from molspark.operators import pairs as P

ORB = "unique_id string, spin int, orb_idx int, energy double, occ double"
ATOMS = "unique_id string, atom_idx int, element string, z_num int, x double, y double, z double, charge double"


@pytest.fixture(scope="module")
def orbitals(spark):
    rows = []
    for i, (e, o) in enumerate([(-0.5, 1), (-0.2, 1), (0.1, 0), (0.3, 0)]):
        rows.append(("open", 0, i, e, float(o)))
    for i, (e, o) in enumerate([(-0.4, 1), (-0.1, 0), (0.05, 0), (0.4, 0)]):
        rows.append(("open", 1, i, e, float(o)))
    for i, (e, o) in enumerate([(-0.6, 2), (-0.3, 2), (0.2, 0)]):
        rows.append(("closed", 0, i, e, float(o)))
    return spark.createDataFrame(rows, ORB)


def test_frontier(orbitals):
    r = {x["unique_id"]: x for x in L.frontier_levels(orbitals).collect()}
    assert r["open"]["homo_ev"] == pytest.approx(-0.2 * HARTREE_EV)
    assert r["open"]["lumo_ev"] == pytest.approx(-0.1 * HARTREE_EV)
    assert r["closed"]["homo_ev"] == pytest.approx(-0.3 * HARTREE_EV)
    assert r["closed"]["lumo_ev"] == pytest.approx(0.2 * HARTREE_EV)


def test_frontier_avg_and_effective(orbitals):
    a = {x["unique_id"]: x for x in L.frontier_levels_avg(orbitals).collect()}
    assert a["open"]["homo_avg_ev"] == pytest.approx(-0.3 * HARTREE_EV)
    assert a["open"]["lumo_avg_ev"] == pytest.approx(0.0, abs=1e-12)
    assert a["closed"]["homo_avg_ev"] is None
    e = {x["unique_id"]: x for x in L.frontier_levels_effective(orbitals).collect()}
    assert e["open"]["homo_eff_ev"] == pytest.approx(-0.2 * HARTREE_EV)
    assert e["open"]["lumo_eff_ev"] == pytest.approx(0.1 * HARTREE_EV)
    assert "closed" not in e


@pytest.fixture(scope="module")
def dimer(spark):
    return spark.createDataFrame([("d", 0, "N", 7, 0.0, 0.0, 0.0, 0.5),
                                  ("d", 1, "N", 7, 0.0, 0.0, 10.0, -0.5)], ATOMS)


def test_coulomb_pair(dimer):
    e = P.coulomb_energy(dimer).first()["coulomb_lr_ev"]
    assert e == pytest.approx(COULOMB_EV_ANGSTROM * -0.25 / 10.0, rel=1e-6)
    assert e == pytest.approx(-0.3599911, abs=1e-5)
    assert P.coulomb_energy_sr(dimer).count() == 0       # beyond 4.6 A


def test_pairs_count_and_tiles(spark):
    rows = [("big", i, "C", 6, float(i % 7), float(i % 5), float(i // 35), 0.0) for i in range(40)]
    rows += [("s", 0, "H", 1, 0.0, 0.0, 0.0, 0.0), ("s", 1, "H", 1, 0.74, 0.0, 0.0, 0.0)]
    a = spark.createDataFrame(rows, ATOMS)
    # block size 8 forces 5 tiles for the 40-atom molecule
    p = P.atom_pairs(a, block_size=8)
    counts = {r["unique_id"]: r["count"] for r in p.groupBy("unique_id").count().collect()}
    assert counts["big"] == 40 * 39 // 2 and counts["s"] == 1
    assert P.atom_pairs(a, directed=True, block_size=8).count() == 2 * (40 * 39 // 2 + 1)
    # cell path (large molecules) equals brute force within the cutoff
    nl = P.neighbour_list(a, cutoff=2.5).filter("unique_id = 'big'")
    brute = p.filter("unique_id = 'big' and d < 2.5")
    key = ["atom_idx_i", "atom_idx_j"]
    assert sorted(map(tuple, nl.select(*key).collect())) == sorted(map(tuple, brute.select(*key).collect()))


def test_sparse_indices_lose_no_pair(spark):
    a = spark.createDataFrame([("g", i, "H", 1, float(i) / 300.0, 0.0, 0.0, 0.5) for i in (0, 300, 900, 5000)], ATOMS)
    assert P.atom_pairs(a, block_size=2).count() == 6
    near = P.neighbour_list(a, cutoff=2.5)
    assert sorted((r.atom_idx_i, r.atom_idx_j) for r in near.collect()) == [(0, 300), (300, 900)]
    grid = spark.createDataFrame([("g", 0, 0.0, 1.0, 0.0)], "unique_id string, grid_idx long, gx double, gy double, gz double")
    from molspark.operators.grid import point_charge_esp
    want = sum(0.5 / ((i / 300.0) ** 2 + 1.0) ** 0.5 for i in (0, 300, 900, 5000))
    assert point_charge_esp(grid, a, "charge", block_size=2).first()["esp"] == pytest.approx(want)


def test_cells_against_all_pairs(spark):
    import random
    r = random.Random(1)
    rows = [(f"m{m}", 3 * i, "H", 1, r.uniform(-9, 9), r.uniform(0, 20), r.uniform(0, 1), 0.1)
            for m, n in enumerate((60, 9, 1)) for i in range(n)]
    a = spark.createDataFrame(rows, ATOMS)
    near = P.neighbour_list(a, cutoff=3.0).select("unique_id", "atom_idx_i", "atom_idx_j")
    brute = P.atom_pairs(a).filter("d < 3.0").select("unique_id", "atom_idx_i", "atom_idx_j")
    assert sorted(map(tuple, near.collect())) == sorted(map(tuple, brute.collect()))


def test_coincident_and_unknown_atoms_are_reported(spark):
    a = spark.createDataFrame([("m", 0, "H", 1, 0.0, 0.0, 0.0, 0.5), ("m", 1, "H", 1, 0.0, 0.0, 0.0, 0.5),
                               ("m", 2, "X", 0, 2.0, 0.0, 0.0, -1.0)], ATOMS)
    r = P.coulomb_energy_dsf(a).first()
    assert r["n_coincident"] == 1 and r["coulomb_dsf_ev"] is not None
    prm = spark.createDataFrame([("H", 1.0, 2.0), ("H", 1.0, 2.0)], "element string, alpha double, zeff double")
    r = P.short_range_repulsion(a, prm).first()
    assert (r["repulsion"], r["n_missing"], r["n_coincident"]) == (None, 2, 1)
    r = P.short_range_repulsion(a.filter("element = 'H'"), prm).first()
    assert (r["repulsion"], r["n_missing"], r["n_coincident"]) == (0.0, 0, 1)


def test_dispersion_of_one_pair(spark):
    a = spark.createDataFrame([("m", 0, "C", 6, 0.0, 0.0, 0.0, 0.0), ("m", 1, "O", 8, 3.0, 0.0, 0.0, 0.0)], ATOMS)
    ref = spark.createDataFrame([("C", 46.6, 12.0), ("O", 15.6, 5.4)], "element string, c6 double, alpha double")
    a = P.scaled_dispersion_params(a.withColumns({"c6_mult": F.lit(0.1), "alpha_mult": F.lit(9.0)}), ref)
    prm = spark.createDataFrame([("C", 3.1), ("O", 2.4)], "element string, r4r2 double")
    import math
    from molspark.functions.units import BOHR_ANGSTROM, HARTREE_EV
    ci, cj, ai, aj = 46.6 * math.exp(0.1), 15.6 * math.exp(0.1), 12.0 * math.exp(4), 5.4 * math.exp(4)
    c6 = 2 * ci * cj / (ci * aj / ai + cj * ai / aj)
    q, d = 3 * 3.1 * 2.4, 3.0 / BOHR_ANGSTROM
    r0 = 0.4 * math.sqrt(q) + 5.0
    want = -HARTREE_EV * c6 * (1 / (d ** 6 + r0 ** 6) + q / (d ** 8 + r0 ** 8))
    r = P.pair_dispersion(a, prm).first()
    assert r["dispersion"] == pytest.approx(want, rel=1e-9) and r["n_missing"] == 0


def test_translation_invariance(spark):
    base = [("m", 0, "O", 8, 0.0, 0.0, 0.0, -0.8), ("m", 1, "H", 1, 0.96, 0.0, 0.0, 0.4),
            ("m", 2, "H", 1, -0.24, 0.93, 0.0, 0.4)]
    moved = [(u, i, e, z, x + 3.0, y - 2.0, zz + 1.0, q) for (u, i, e, z, x, y, zz, q) in base]
    e1 = P.coulomb_energy(spark.createDataFrame(base, ATOMS)).first()[1]
    e2 = P.coulomb_energy(spark.createDataFrame(moved, ATOMS)).first()[1]
    assert e1 == pytest.approx(e2, rel=1e-9)
    d1 = G.dipole(spark.createDataFrame(base, ATOMS)).first()
    d2 = G.dipole(spark.createDataFrame(moved, ATOMS)).first()
    assert d1["dipole_debye"] == pytest.approx(d2["dipole_debye"], rel=1e-9)   # neutral molecule


def test_dipole_quadrupole(dimer, spark):
    a = spark.createDataFrame([("d", 0, "N", 7, 0.0, 0.0, 0.0, 0.5),
                               ("d", 1, "N", 7, 0.0, 0.0, 1.1, -0.5)], ATOMS)
    d = G.dipole(a).first()
    assert d["dipole_z"] == pytest.approx(-0.55)
    q = G.quadrupole(a).first()
    assert q["quad_xx"] + q["quad_yy"] + q["quad_zz"] == pytest.approx(0.0, abs=1e-12)


def test_equilibrate_and_centroid(spark):
    a = spark.createDataFrame([("m", 0, 0.2, 1.0, 0.0, 0.0, 0.0), ("m", 1, 0.2, 3.0, 1.0, 0.0, 0.0)],
                              "unique_id string, atom_idx int, charge double, f double, x double, y double, z double")
    m = spark.createDataFrame([("m", 0)], "unique_id string, charge int")
    r = sorted(G.equilibrate_charges(a, m, f_col="f").select("atom_idx", "charge_eq").collect())
    assert r[0][1] == pytest.approx(0.1, abs=1e-6) and r[1][1] == pytest.approx(-0.1, abs=1e-6)
    assert sum(x[1] for x in r) == pytest.approx(0.0, abs=1e-6)
    c = G.centroid(a).first()
    assert c["cx"] == pytest.approx(0.5)


def test_kernels(spark):
    df = spark.createDataFrame([(0.5,), (4.6,), (10.0,)], "d double")
    r = df.select(K.cosine_cutoff("d", 4.6).alias("c"), K.exp_cutoff("d", 4.6).alias("e"),
                  K.erfc_approx(F.col("d")).alias("erfc")).collect()
    assert r[1]["c"] == pytest.approx(0.0, abs=1e-12) and r[2]["e"] == pytest.approx(0.0, abs=1e-12)
    assert r[0]["erfc"] == pytest.approx(math.erfc(0.5), abs=2e-7)
    s = spark.createDataFrame([(-1.0,), (0.5,), (2.0,)], "x double").select(
        K.smoothstep("x").alias("s"), K.huber("x").alias("h"), K.softplus_gap(F.lit(0.0), "x").alias("g"))
    v = s.collect()
    assert v[0]["s"] == 0.0 and v[2]["s"] == 1.0 and v[1]["s"] == pytest.approx(0.5)
    assert v[1]["h"] == pytest.approx(0.125) and v[2]["h"] == pytest.approx(1.5)
    assert all(x["g"] > 0 for x in v)


def test_pooling_gap(spark):
    a = spark.createDataFrame([("m", 0, 1.0, 5.0, 0.1), ("m", 1, 2.0, -3.0, 0.2)],
                              "unique_id string, atom_idx int, lo double, hi double, logit double")
    r = G.pooled_levels(a, "lo", "hi", "logit").first()
    assert r["hi"] > r["lo"]


def test_volume_single_atom(spark):
    from molspark.operators.grid import vdw_volume
    a = spark.createDataFrame([("m", 0, "C", 6, 0.0, 0.0, 0.0, 0.0)], ATOMS)
    v = vdw_volume(a, n_per_axis=40).first()["vdw_volume_angstrom3"]
    assert v == pytest.approx(4.0 / 3.0 * math.pi * 0.77 ** 3, rel=0.02)


def test_radial_descriptor_shape(spark, dimer):
    g = P.radial_descriptor(dimer, rc=12.0).collect()
    assert len(g) == 2 and all(len(r["g"]) == 16 for r in g)


def test_principal_frame_preserves_distances(spark):
    from molspark.operators.grid import principal_frame
    rows = [("m", 0, "C", 6, 0.0, 0.0, 0.0, 0.0), ("m", 1, "C", 6, 1.0, 1.0, 0.0, 0.0),
            ("m", 2, "C", 6, 2.0, 2.5, 0.3, 0.0), ("m", 3, "C", 6, 0.5, 3.0, 1.0, 0.0)]
    a = spark.createDataFrame(rows, ATOMS)
    p = sorted(principal_frame(a).select("atom_idx", "x", "y", "z").collect())

    def dist(u, v):
        return math.dist((u[1], u[2], u[3]), (v[1], v[2], v[3]))
    orig = sorted((r[1], r[4], r[5], r[6]) for r in rows)
    assert dist(p[0], p[2]) == pytest.approx(dist(orig[0], orig[2]), rel=1e-9)


def test_volume_blocks_agree(spark):
    from molspark.operators.grid import vdw_volume
    rows = [("w", 0, "O", 8, 0.0, 0.0, 0.0, 0.0), ("w", 1, "H", 1, 0.96, 0.0, 0.0, 0.0),
            ("w", 2, "H", 1, -0.24, 0.93, 0.0, 0.0), ("s", 0, "S", 16, 1.0, 2.0, 3.0, 0.0),
            ("s", 1, "F", 9, 2.6, 2.0, 3.0, 0.0)]
    a = spark.createDataFrame(rows, ATOMS)
