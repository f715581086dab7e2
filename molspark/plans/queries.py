"""Registered queries: each reads the driver's tables through the bridge and
runs one operator family end to end. ``SPARK`` maps names to callables
``(spark, sf_dir) -> DataFrame``; ``ORACLE`` maps the same names to DuckDB
SQL over the raw tables (bridge views inlined as CTEs)."""

from __future__ import annotations

from pyspark.sql import functions as F

from molspark.functions.units import HARTREE_EV
from molspark.operators import energetics as en
from molspark.plans import bridge as br
from molspark.plans import sqlgen

SPARK = {}
ORACLE = {}


def _positive_zero_rounds(sql: str) -> str:
    """Wrap every ``round(...)`` as ``(0.0 + round(...))``: DuckDB keeps the
    sign of a rounded negative zero, Spark does not."""
    out, i, low = [], 0, sql.lower()
    while True:
        k = low.find("round(", i)
        if k < 0 or (k > 0 and (low[k - 1].isalnum() or low[k - 1] == "_")):
            if k < 0:
                out.append(sql[i:])
                return "".join(out)
            out.append(sql[i:k + 6])
            i = k + 6
            continue
        depth, j = 0, k + 5
        while j < len(sql):
            if sql[j] == "(":
                depth += 1
            elif sql[j] == ")":
                depth -= 1
                if depth == 0:
                    break
            j += 1
        inner = _positive_zero_rounds(sql[k + 6:j])
        out.append(sql[i:k] + "(0.0 + round(" + inner + "))")
        i = j + 1


def register(name, sql=None):
    def deco(fn):
        SPARK[name] = fn
        if sql is not None:
            ORACLE[name] = _positive_zero_rounds(sql)
        return fn
    return deco


def r4(c):
    return F.round(c, 4)


# --- combustion heat (A1, A2, A3, A4, P17, P19) -----------------------------
_dem, _prod, _hal, _eo2, _terms = sqlgen.combustion_parts()
_COMBUSTION_SQL = br.with_views(f"""
SELECT unique_id,
       CAST(num_atoms AS BIGINT) AS num_atoms,
       round(CASE WHEN status = 'ok' THEN heat ELSE 0.0 END, 4) AS combustion_heat_ev,
       CASE WHEN status = 'ok' THEN '1.00 * ' || formula || ' + ' || printf('%.2f', demand / 2.0)
            || ' * O2 -> ' || concat_ws(' + ', {_terms}) ELSE '' END AS combustion_reaction,
       status AS combustion_status
FROM (
  SELECT m.unique_id, c.num_atoms, c.formula,
         CASE WHEN c.num_atoms IS NULL THEN 'no_atoms'
              WHEN c.n_unsupported > 0 THEN 'unsupported_element'
              WHEN c.n_H <> 0 AND ({_hal}) >= c.n_H THEN 'nonflammable_halogen'
              WHEN c.demand <= 0 THEN 'nonflammable' ELSE 'ok' END AS status,
         c.demand,
         c.products - (coalesce(m.energy_hartree * {HARTREE_EV!r}, 0.0) + c.demand / 2.0 * {_eo2!r})
           AS heat,
         c.n_H, c.n_F, c.n_Cl, c.n_Br, c.n_I, c.n_C, c.n_O, c.n_N, c.n_S, c.n_P, c.n_Si, c.n_B,
         c.n_Li, c.n_Be, c.n_Na, c.n_K
  FROM molecules m LEFT JOIN counts c ON m.unique_id = c.unique_id) t
""", "molecules", "atoms", ctes=[
    ("counts0", f"SELECT unique_id, {sqlgen.count_aggs()} FROM atoms GROUP BY unique_id"),
    ("counts", f"SELECT *, {_dem} AS demand, {_prod} AS products, "
               f"{sqlgen.hill_formula_sql()} AS formula FROM counts0"),
])


@register("combustion_heat", _COMBUSTION_SQL)
def q_combustion_heat(spark, sf_dir):
    m = br.molecules(spark, sf_dir).withColumn(
        "energy_ev", F.col("energy_hartree") * F.lit(HARTREE_EV))
    a = br.atoms(spark, sf_dir, with_z=False)
    out = en.combustion_heat(m, a, mol_energy_col="energy_ev", smiles_col=None)
    return out.select("unique_id", F.col("num_atoms").cast("long").alias("num_atoms"),
                      r4(F.col("combustion_heat_ev")).alias("combustion_heat_ev"),
                      "combustion_reaction", "combustion_status")


def rk(c, k):
    return F.round(c, k)


# --- composition: element counts, parity, closed shell (A1, A2, A5, P7) -----
@register("element_counts", br.with_views(f"""
SELECT unique_id, n_C, n_H, n_N, n_O, n_F, n_S, num_atoms, n_unsupported,
       {sqlgen.hill_formula_sql()} AS formula
FROM (SELECT unique_id, {sqlgen.count_aggs()} FROM atoms GROUP BY unique_id) c""", "atoms"))
def q_element_counts(spark, sf_dir):
    from molspark.operators.composition import element_counts, hill_formula
    c = element_counts(br.atoms(spark, sf_dir, with_z=False))
    return c.select("unique_id", "n_C", "n_H", "n_N", "n_O", "n_F", "n_S", "num_atoms",
                    "n_unsupported", hill_formula().alias("formula"))


_PARITY_SQL = """
SELECT m.unique_id, m.charge,
       CAST(((coalesce(p.zpar, 0) - ((m.charge % 2) + 2) % 2) % 2 + 2) % 2 AS INTEGER)
         AS unpaired_electrons,
       CAST(1 + ((coalesce(p.zpar, 0) - ((m.charge % 2) + 2) % 2) % 2 + 2) % 2 AS INTEGER)
         AS multiplicity
FROM molecules m LEFT JOIN (SELECT unique_id, sum(z_num % 2) AS zpar FROM atoms GROUP BY 1) p
  ON m.unique_id = p.unique_id"""


@register("electron_parity", br.with_views(_PARITY_SQL, "molecules", "atoms"))
def q_electron_parity(spark, sf_dir):
    from molspark.operators.composition import unpaired_electrons
    m = unpaired_electrons(br.molecules(spark, sf_dir), br.atoms(spark, sf_dir))
    return m.select("unique_id", "charge", "unpaired_electrons", "multiplicity")


@register("closed_shell_filter", br.with_views(f"""
SELECT unique_id, charge FROM ({_PARITY_SQL}) t WHERE unpaired_electrons = 0""",
                                               "molecules", "atoms"))
def q_closed_shell(spark, sf_dir):
    from molspark.operators.composition import unpaired_electrons
    from molspark.operators.qc import closed_shell
    ok, _open = closed_shell(unpaired_electrons(br.molecules(spark, sf_dir),
                                                br.atoms(spark, sf_dir)))
    return ok.select("unique_id", "charge")


# --- pair layer (J4, J5, A15, A16, A38) ---------------------------------------
_PAIRS_CTE = ("pairs", """
  SELECT a.unique_id, a.atom_idx AS i, b.atom_idx AS j, a.charge AS qi, b.charge AS qj,
         sqrt((b.x - a.x) * (b.x - a.x) + (b.y - a.y) * (b.y - a.y) + (b.z - a.z) * (b.z - a.z)) AS d
  FROM atoms a JOIN atoms b ON a.unique_id = b.unique_id AND a.atom_idx < b.atom_idx""")


def _exp_cut_sql(d, rc):
    u = f"least(greatest({d} / {rc!r}, 0.0), {1.0 - 1e-6!r})"
    return f"(exp(-1.0 / (1.0 - {u} * {u})) / {__import__('math').exp(-1.0)!r})"


@register("coulomb_lr", br.with_views(f"""
SELECT unique_id, round(coalesce(sum((1.0 - {_exp_cut_sql('d', 4.6)}) * qi * qj / d) FILTER (d > 0), 0) * {COULOMB!r}, 4)
         AS coulomb_lr_ev, count(*) FILTER (d = 0) AS n_coincident
FROM pairs GROUP BY unique_id""", "atoms", ctes=[_PAIRS_CTE])
          if (COULOMB := __import__("molspark.functions.units", fromlist=["x"]).COULOMB_EV_ANGSTROM)
          else None)
def q_coulomb_lr(spark, sf_dir):
    from molspark.operators.pairs import coulomb_energy
    e = coulomb_energy(br.atoms(spark, sf_dir, with_z=False))
    return e.select("unique_id", rk(F.col("coulomb_lr_ev"), 4).alias("coulomb_lr_ev"), "n_coincident")


@register("coulomb_sr", br.with_views(f"""
SELECT unique_id, round(coalesce(sum({_exp_cut_sql('d', 4.6)} * qi * qj / d) FILTER (d > 0), 0) * {COULOMB!r}, 4)
         AS coulomb_sr_ev, count(*) FILTER (d = 0) AS n_coincident
FROM pairs WHERE d < 4.6 GROUP BY unique_id""", "atoms", ctes=[_PAIRS_CTE]))
def q_coulomb_sr(spark, sf_dir):
    from molspark.operators.pairs import coulomb_energy_sr
    e = coulomb_energy_sr(br.atoms(spark, sf_dir, with_z=False))
    return e.select("unique_id", rk(F.col("coulomb_sr_ev"), 4).alias("coulomb_sr_ev"), "n_coincident")


@register("neighbour_counts", br.with_views("""
SELECT unique_id, CAST(max(n) AS BIGINT) AS max_neighbours, CAST(sum(n) AS BIGINT) AS sum_neighbours
FROM (SELECT unique_id, atom_idx, count(*) AS n FROM (
        SELECT unique_id, i AS atom_idx FROM pairs WHERE d < 5.0
        UNION ALL SELECT unique_id, j AS atom_idx FROM pairs WHERE d < 5.0) e
      GROUP BY 1, 2) c
GROUP BY unique_id""", "atoms", ctes=[_PAIRS_CTE]))
def q_neighbour_counts(spark, sf_dir):
    from molspark.operators.pairs import neighbour_counts, neighbour_list
    nl = neighbour_list(br.atoms(spark, sf_dir, with_z=False), cutoff=5.0)
    return neighbour_counts(nl)


# --- moments and forces (A10, A11, A12, A19, A20) ----------------------------
@register("dipole_moment", br.with_views(f"""
SELECT unique_id, round(sx, 4) AS dipole_x, round(sy, 4) AS dipole_y, round(sz, 4) AS dipole_z,
       round(sqrt(sx * sx + sy * sy + sz * sz) * {4.80320471!r}, 4) AS dipole_debye
FROM (SELECT unique_id, sum(charge * x) AS sx, sum(charge * y) AS sy, sum(charge * z) AS sz
      FROM atoms GROUP BY 1) t""", "atoms"))
def q_dipole(spark, sf_dir):
    from molspark.operators.geometry import dipole
    d = dipole(br.atoms(spark, sf_dir, with_z=False))
    return d.select("unique_id", *[rk(F.col(c), 4).alias(c) for c in
                                   ("dipole_x", "dipole_y", "dipole_z", "dipole_debye")])


@register("quadrupole_moment", br.with_views("""
SELECT unique_id, round(xx - (xx + yy + zz) / 3.0, 6) AS quad_xx,
       round(yy - (xx + yy + zz) / 3.0, 6) AS quad_yy, round(zz - (xx + yy + zz) / 3.0, 6) AS quad_zz,
       round(xy, 6) AS quad_xy, round(yz, 6) AS quad_yz, round(zx, 6) AS quad_zx
FROM (SELECT unique_id, sum(charge * x * x) AS xx, sum(charge * y * y) AS yy,
             sum(charge * z * z) AS zz, sum(charge * x * y) AS xy, sum(charge * y * z) AS yz,
             sum(charge * z * x) AS zx FROM atoms GROUP BY 1) t""", "atoms"))
def q_quadrupole(spark, sf_dir):
    from molspark.operators.geometry import quadrupole
    d = quadrupole(br.atoms(spark, sf_dir, with_z=False))
    return d.select("unique_id", *[rk(F.col(c), 6).alias(c) for c in
                                   ("quad_xx", "quad_yy", "quad_zz", "quad_xy", "quad_yz",
                                    "quad_zx")])


@register("centre_of_mass", br.with_views("""
SELECT a.unique_id, round(sum(p.mass * a.x) / sum(p.mass), 6) AS cx,
       round(sum(p.mass * a.y) / sum(p.mass), 6) AS cy,
       round(sum(p.mass * a.z) / sum(p.mass), 6) AS cz
FROM atoms a JOIN periodic p ON a.z_num = p.z_num GROUP BY a.unique_id""", "atoms",
                                          ctes=[("periodic", "SELECT * FROM " + __import__(
                                              "molspark.refdata", fromlist=["x"]).sql_values_periodic())]))
def q_centre_of_mass(spark, sf_dir):
    from molspark.operators.geometry import centroid
    from molspark.refdata import periodic_ref
    a = br.atoms(spark, sf_dir).join(F.broadcast(periodic_ref(spark).select("z_num", "mass")),
                                     "z_num")
    c = centroid(a, mass_col="mass")
    return c.select("unique_id", *[rk(F.col(k), 6).alias(k) for k in ("cx", "cy", "cz")])


@register("charge_equilibration", br.with_views("""
SELECT a.unique_id, round(sum(abs(a.charge + a.f / (t.sf + 1e-6) * (coalesce(m.charge, 0) - t.sq))), 6)
         AS sum_abs_q, round(sum(a.charge + a.f / (t.sf + 1e-6) * (coalesce(m.charge, 0) - t.sq)), 4)
         AS total_q
FROM (SELECT *, 1.0 + z_num / 10.0 AS f FROM atoms) a
JOIN (SELECT unique_id, sum(1.0 + z_num / 10.0) AS sf, sum(charge) AS sq FROM atoms GROUP BY 1) t
  ON a.unique_id = t.unique_id
LEFT JOIN molecules m ON a.unique_id = m.unique_id
GROUP BY a.unique_id""", "molecules", "atoms"))
def q_charge_equilibration(spark, sf_dir):
    from molspark.operators.geometry import equilibrate_charges
    a = br.atoms(spark, sf_dir).withColumn("f", F.lit(1.0) + F.col("z_num") / 10.0)
    eq = equilibrate_charges(a, br.molecules(spark, sf_dir), f_col="f")
    return eq.groupBy("unique_id").agg(
        rk(F.sum(F.abs("charge_eq")), 6).alias("sum_abs_q"), rk(F.sum("charge_eq"), 4).alias("total_q"))


@register("max_force", br.with_views("""
SELECT unique_id, round(max(sqrt(forces_x * forces_x + forces_y * forces_y + forces_z * forces_z)), 8)
         AS fmax,
       max(sqrt(forces_x * forces_x + forces_y * forces_y + forces_z * forces_z)) < 0.005 AS converged
FROM atoms GROUP BY unique_id""", "atoms"))
def q_max_force(spark, sf_dir):
    from molspark.operators.geometry import converged_by_forces
    c = converged_by_forces(br.atoms(spark, sf_dir, with_z=False), fmax=0.005)
    return c.select("unique_id", rk(F.col("fmax"), 8).alias("fmax"), "converged")


# --- frontier levels (A29-A32) --------------------------------------------------
_SPIN_CTE = ("per_spin", """
  SELECT unique_id, spin, arg_max(energy, orb_idx) FILTER (WHERE occ > 0) AS homo,
         arg_min(energy, orb_idx) FILTER (WHERE occ = 0) AS lumo
  FROM orbitals GROUP BY 1, 2""")


@register("frontier_levels", br.with_views(f"""
SELECT unique_id, round(max(homo) * {HARTREE_EV!r}, 4) AS homo_ev,
       round(min(lumo) * {HARTREE_EV!r}, 4) AS lumo_ev, CAST(count(*) AS INTEGER) AS n_spin
FROM per_spin GROUP BY unique_id""", "orbitals", ctes=[_SPIN_CTE]))
def q_frontier(spark, sf_dir):
    from molspark.operators.levels import frontier_levels
    f = frontier_levels(br.orbitals(spark, sf_dir))
    return f.select("unique_id", rk(F.col("homo_ev"), 4).alias("homo_ev"),
                    rk(F.col("lumo_ev"), 4).alias("lumo_ev"), "n_spin")


@register("frontier_levels_avg", br.with_views(f"""
SELECT unique_id,
       round(CASE WHEN count(*) = 2 THEN avg(homo) * {HARTREE_EV!r} END, 4) AS homo_avg_ev,
       round(CASE WHEN count(*) = 2 THEN avg(lumo) * {HARTREE_EV!r} END, 4) AS lumo_avg_ev
FROM per_spin GROUP BY unique_id""", "orbitals", ctes=[_SPIN_CTE]))
def q_frontier_avg(spark, sf_dir):
    from molspark.operators.levels import frontier_levels_avg
    f = frontier_levels_avg(br.orbitals(spark, sf_dir))
    return f.select("unique_id", rk(F.col("homo_avg_ev"), 4).alias("homo_avg_ev"),
                    rk(F.col("lumo_avg_ev"), 4).alias("lumo_avg_ev"))


@register("frontier_levels_effective", br.with_views(f"""
SELECT unique_id,
       round(arg_max(least(e_a, e_b), orb_idx) FILTER (WHERE o_a + o_b >= 1.0) * {HARTREE_EV!r}, 4)
         AS homo_eff_ev,
       round(arg_min(greatest(e_a, e_b), orb_idx) FILTER (WHERE o_a + o_b < 1.0) * {HARTREE_EV!r}, 4)
         AS lumo_eff_ev
FROM (SELECT unique_id, orb_idx, max(CASE WHEN spin = 0 THEN energy END) AS e_a,
             max(CASE WHEN spin = 1 THEN energy END) AS e_b,
             max(CASE WHEN spin = 0 THEN occ END) AS o_a, max(CASE WHEN spin = 1 THEN occ END) AS o_b
      FROM orbitals GROUP BY 1, 2) p
WHERE e_a IS NOT NULL AND e_b IS NOT NULL
GROUP BY unique_id""", "orbitals"))
def q_frontier_eff(spark, sf_dir):
    from molspark.operators.levels import frontier_levels_effective
    f = frontier_levels_effective(br.orbitals(spark, sf_dir))
    return f.select("unique_id", rk(F.col("homo_eff_ev"), 4).alias("homo_eff_ev"),
                    rk(F.col("lumo_eff_ev"), 4).alias("lumo_eff_ev"))


# --- fluoride BDE chain (P15, P16, J10, W5, W9, J9, A33) -----------------------
_BDE_SQL = br.with_views(f"""
SELECT v.unique_id, v.unique_id || '_defluorined' AS child_id, v.f_idx, v.partner AS old_f_bonded_atom,
       CAST(m.charge + 1 AS INTEGER) AS child_charge,
       CAST(ca.n AS BIGINT) AS child_num_atoms,
       round((c.energy_hartree + {en.F_ANION_ENERGY_HARTREE!r} - m.energy_hartree) * {HARTREE_EV!r}, 4)
         AS fluoride_bde_ev
FROM victims v
JOIN molecules m ON m.unique_id = v.unique_id
LEFT JOIN child_energies c ON c.unique_id = v.unique_id || '_defluorined'
JOIN (SELECT a.unique_id, count(*) AS n FROM atoms a JOIN victims v2 ON a.unique_id = v2.unique_id
      WHERE a.atom_idx <> v2.f_idx GROUP BY 1) ca ON ca.unique_id = v.unique_id""",
    "molecules", "atoms", "bonds", "child_energies", ctes=[
        ("eligible", """SELECT m.unique_id FROM molecules m WHERE coalesce(m.charge, 0) <= 0
                        AND EXISTS (SELECT 1 FROM atoms a WHERE a.unique_id = m.unique_id
                                    AND a.element = 'F')"""),
        ("fb", """SELECT b.unique_id, b.bond_idx, ai.element AS el_i, aj.element AS el_j,
                         sqrt((aj.x - ai.x) * (aj.x - ai.x) + (aj.y - ai.y) * (aj.y - ai.y)
                              + (aj.z - ai.z) * (aj.z - ai.z)) AS length,
                         CASE WHEN ai.element = 'F' THEN b.i ELSE b.j END AS f_idx,
                         CASE WHEN ai.element = 'F' THEN aj.element ELSE ai.element END AS partner
                  FROM bonds b
                  JOIN atoms ai ON ai.unique_id = b.unique_id AND ai.atom_idx = b.i
                  JOIN atoms aj ON aj.unique_id = b.unique_id AND aj.atom_idx = b.j
                  WHERE (ai.element = 'F' OR aj.element = 'F')
                    AND b.unique_id IN (SELECT unique_id FROM eligible)"""),
        ("victims", """SELECT unique_id, f_idx, partner FROM (
                         SELECT *, row_number() OVER (PARTITION BY unique_id
                                                      ORDER BY length DESC, bond_idx) AS rn
                         FROM fb) t WHERE rn = 1"""),
    ])


@register("fluoride_bde", _BDE_SQL)
def q_fluoride_bde(spark, sf_dir):
    m = br.molecules(spark, sf_dir)
    a = br.atoms(spark, sf_dir)
    b = br.bonds(a)
    kids, kid_atoms = en.defluorinate(m, a, b)
    kid_n = kid_atoms.groupBy("unique_id").agg(F.count(F.lit(1)).cast("long").alias("child_num_atoms"))
    kids = kids.join(kid_n, "unique_id", "left")
    kids_e = kids.drop("energy_hartree").join(br.child_energies(spark, sf_dir), "unique_id", "left")
    bde = en.fluoride_bde(m.join(kids.select(F.col("parent_id").alias("unique_id")), "unique_id",
                                 "left_semi"), kids_e)
    out = bde.join(kids.select(F.col("parent_id").alias("unique_id"), "old_f_bonded_atom",
                               F.col("charge").cast("int").alias("child_charge"), "child_num_atoms",
                               F.col("removed_atom_idx").alias("f_idx")),
                   "unique_id")
    return out.select(
        "unique_id", "child_id", "f_idx", "old_f_bonded_atom", "child_charge", "child_num_atoms",
        rk(F.col("fluoride_bde_ev"), 4).alias("fluoride_bde_ev"))


# --- bond-length QC (J10, P9) ---------------------------------------------------
@register("bond_length_qc", br.with_views("""
SELECT b.unique_id,
       CAST(count(*) FILTER (WHERE l < 0.5 OR l > 3.5) AS BIGINT) AS n_bad_bonds,
       coalesce(string_agg(printf('%.4f', l), ', ' ORDER BY l) FILTER (WHERE l < 0.5 OR l > 3.5), '')
         AS bad_lengths,
       CAST(count(*) AS BIGINT) AS n_bonds
FROM (SELECT b.unique_id, sqrt((aj.x - ai.x) * (aj.x - ai.x) + (aj.y - ai.y) * (aj.y - ai.y)
                               + (aj.z - ai.z) * (aj.z - ai.z)) AS l
      FROM bonds b JOIN atoms ai ON ai.unique_id = b.unique_id AND ai.atom_idx = b.i
                   JOIN atoms aj ON aj.unique_id = b.unique_id AND aj.atom_idx = b.j) b
GROUP BY b.unique_id""", "atoms", "bonds"))
def q_bond_length_qc(spark, sf_dir):
    from molspark.operators.structure import bond_geometry
    a = br.atoms(spark, sf_dir, with_z=False)
    g = bond_geometry(br.bonds(a), a)
    ln = F.col("length")
    bad = (ln < 0.5) | (ln > 3.5)
    agg = g.groupBy("unique_id").agg(
        F.count_if(bad).cast("long").alias("n_bad_bonds"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.when(bad, ln))),
                                 lambda v: F.format_string("%.4f", v)), ", ").alias("bad_lengths"),
        F.count(F.lit(1)).cast("long").alias("n_bonds"))
    return agg


# --- conformers, trajectories, ensembles (W6, W8, A21) --------------------------
@register("lowest_conformer", br.with_views("""
SELECT unique_id, CAST(arg_min(conf_id, (energy_kcal, conf_id, l_partkey, l_suppkey)) AS INTEGER)
         AS conf_id,
       round(min(energy_kcal), 6) AS energy_kcal, CAST(count(*) AS BIGINT) AS num_conformers
FROM conformers GROUP BY unique_id""", "conformers"))
def q_lowest_conformer(spark, sf_dir):
    c = en.lowest_conformer(br.conformers(spark, sf_dir),
                            order_cols=("conf_id", "l_partkey", "l_suppkey"))
    return c.select("unique_id", F.col("conf_id").cast("int"), rk(F.col("energy_kcal"), 6)
                    .alias("energy_kcal"), "num_conformers")


@register("last_trajectory_step", br.with_views("""
SELECT unique_id, arg_max(energy, (ts, event_id)) AS final_energy,
       round(arg_max(gradient_norm, (ts, event_id)), 6) AS final_gradient_norm,
       CAST(count(*) AS BIGINT) AS num_steps
FROM trajectory GROUP BY unique_id""", "trajectory"))
def q_last_step(spark, sf_dir):
    s = en.last_step(br.trajectory(spark, sf_dir), step_cols=("ts", "event_id"))
    return s.select("unique_id", F.col("energy").alias("final_energy"),
                    rk(F.col("gradient_norm"), 6).alias("final_gradient_norm"), "num_steps")


@register("ensemble_stats", br.with_views("""
SELECT unique_id, round(avg(energy), 8) AS energy_mean, round(stddev_samp(energy), 8) AS energy_std,
       CAST(count(*) AS BIGINT) AS n_models
FROM predictions GROUP BY unique_id""", "predictions"))
def q_ensemble(spark, sf_dir):
    from molspark.operators.structure import ensemble_stats
    e = ensemble_stats(br.predictions(spark, sf_dir), ["energy"])
    return e.select("unique_id", rk(F.col("energy_mean"), 8).alias("energy_mean"),
                    rk(F.col("energy_std"), 8).alias("energy_std"), "n_models")


# --- batch layout (W1, W2, W3, W7) over the order list --------------------------
def _indexed_orders(spark, sf_dir):
    from molspark.operators.batches import dense_index
    o = br.table(spark, sf_dir, "orders").select("o_orderkey")
    return dense_index(o, ["o_orderkey"])


@register("distribute_jobs", """
SELECT CAST(job_id AS INTEGER) AS job_id, CAST(count(*) AS BIGINT) AS n_inputs,
       min(o_orderkey) AS first_key, max(o_orderkey) AS last_key
FROM (SELECT o_orderkey, ntile(7) OVER (ORDER BY o_orderkey) - 1 AS job_id FROM orders) t
GROUP BY job_id""")
def q_distribute(spark, sf_dir):
    from molspark.operators.batches import distribute
    d = distribute(_indexed_orders(spark, sf_dir), 7)
    return d.groupBy("job_id").agg(F.count(F.lit(1)).cast("long").alias("n_inputs"),
                                   F.min("o_orderkey").alias("first_key"),
                                   F.max("o_orderkey").alias("last_key"))


@register("chunk_batches", """
SELECT 'batch_' || CAST(c * 1024 AS VARCHAR) || '-' ||
         CAST(least(c * 1024 + 1024, (SELECT count(*) FROM orders)) - 1 AS VARCHAR) AS batch_label,
       ['node0', 'node1', 'node2'][CAST(c % 3 AS INTEGER) + 1] AS node,
       CAST(count(*) AS BIGINT) AS n_inputs, min(o_orderkey) AS first_key
FROM (SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // 1024 AS c FROM orders) t
GROUP BY c""")
def q_chunk(spark, sf_dir):
    from molspark.operators.batches import chunk
    c = chunk(_indexed_orders(spark, sf_dir), 1024, nodes=["node0", "node1", "node2"])
    return c.groupBy("batch_label", "node").agg(F.count(F.lit(1)).cast("long").alias("n_inputs"),
                                                F.min("o_orderkey").alias("first_key"))


@register("row_range", """
SELECT o_orderkey, CAST(idx AS BIGINT) AS idx FROM (
  SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS idx FROM orders) t
WHERE idx >= (SELECT count(*) FROM orders) / 3 AND idx < (SELECT count(*) FROM orders) / 3 + 2000""")
def q_row_range(spark, sf_dir):
    from molspark.operators.batches import row_range
    o = _indexed_orders(spark, sf_dir)
    n = br.table(spark, sf_dir, "orders").count()
    return row_range(o, n // 3, 2000).select("o_orderkey", "idx")


# --- text ingest and lexical SMILES checks over whole documents
_WS = "[ \\t\\n\\r]+"
_TOKEN_SQL = r"\[[^\[\]]+\]|Br|Cl|[BCNOPSFI]|[bcnops]|[=#$:/\\.\-]|[()]|%[0-9]{2}|[0-9]"
_LOOKS_SQL = r"^[A-Za-z0-9\[\]()=#\-+@/\\%.]+$"


def _lexical_reason_sql(s):
    p = f"regexp_replace({s}, '[^()]', '', 'g')"
    labels = f"regexp_extract_all(regexp_replace({s}, '\\[[^\\]]*\\]', '', 'g'), '(%[0-9]{{2}}|[0-9])', 1)"
    depth_ok = (f"coalesce(list_bool_and(list_transform(range(1, length({p}) + 1), lambda k: "
                f"length(replace(left({p}, k), ')', '')) >= length(replace(left({p}, k), '(', '')))), true)")
    odd = (f"coalesce(list_bool_or(list_transform(list_distinct({labels}), lambda lab: "
           f"len(list_filter({labels}, lambda x: x = lab)) % 2 = 1)), false)")
    residue = f"regexp_replace({s}, '{_TOKEN_SQL}', '', 'g')"
    opens = f"(length({s}) - length(replace({s}, '(', '')))"
    closes = f"(length({s}) - length(replace({s}, ')', '')))"
    return (f"CASE WHEN {s} IS NULL OR trim({s}) = '' THEN 'empty' "
            f"WHEN NOT (length(trim({s})) > 0 AND regexp_matches(trim({s}), '{_LOOKS_SQL}')) "
            f"THEN 'bad_characters' "
            f"WHEN length({residue}) > 0 THEN 'unknown_token: ' || {residue} "
            f"WHEN {opens} <> {closes} OR NOT {depth_ok} THEN 'unbalanced_parentheses' "
            f"WHEN {odd} THEN 'unpaired_ring_closure' END")


def _formal_charge_sql(s):
    one = ("CASE WHEN left(regexp_extract(b, '([+-]+)\\d*\\]$', 1), 1) = '-' THEN -1 "
           "WHEN left(regexp_extract(b, '([+-]+)\\d*\\]$', 1), 1) = '+' THEN 1 ELSE 0 END * "
           "CASE WHEN regexp_extract(b, '([+-])(\\d+)\\]$', 2) <> '' "
           "THEN CAST(regexp_extract(b, '([+-])(\\d+)\\]$', 2) AS INTEGER) "
           "ELSE length(regexp_extract(b, '([+-]+)\\d*\\]$', 1)) END")
    return (f"coalesce(list_sum(list_transform(regexp_extract_all({s}, '(\\[[^\\]]*\\])', 1), "
            f"lambda b: {one})), 0)")


@register("smiles_token_qc", f"""
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_tokens,
       CAST(count(*) FILTER (WHERE looks) AS BIGINT) AS n_smiles_like,
       CAST(count(*) FILTER (WHERE reason IS NULL) AS BIGINT) AS n_valid,
       CAST(count(*) FILTER (WHERE reason IS NULL AND charge <> 0) AS BIGINT) AS n_charged,
       CAST(count(*) FILTER (WHERE reason IS NULL AND instr(tok, '.') > 0) AS BIGINT) AS n_fragmented,
       CAST(count(*) FILTER (WHERE reason LIKE 'unknown_token%') AS BIGINT) AS n_unknown_token,
       CAST(count(*) FILTER (WHERE reason = 'unpaired_ring_closure') AS BIGINT) AS n_ring_errors
FROM (SELECT doc_id, tok,
             length(trim(tok)) > 0 AND regexp_matches(trim(tok), '{_LOOKS_SQL}') AS looks,
             {_lexical_reason_sql('tok')} AS reason, {_formal_charge_sql('tok')} AS charge
      FROM (SELECT doc_id, unnest(regexp_split_to_array(text, '{_WS}')) AS tok FROM documents) d
      WHERE tok <> '') t
GROUP BY doc_id""")
def q_smiles_token_qc(spark, sf_dir):
    from molspark.operators import qc
    d = br.table(spark, sf_dir, "documents").select("doc_id", "text")
    t = d.select("doc_id", F.explode(F.split("text", _WS)).alias("tok")).filter(F.col("tok") != "")
    t = t.select("doc_id", "tok", qc.looks_like_smiles("tok").alias("looks"),
                 qc.smiles_lexical_reason(F.col("tok")).alias("reason"))
    # formal charges only for tokens that passed the lexical check
    t = t.withColumn("charge", F.when(F.col("reason").isNull(), qc.formal_charge(F.col("tok"))))
    ok = F.col("reason").isNull()
    return t.groupBy("doc_id").agg(
        F.count(F.lit(1)).cast("long").alias("n_tokens"),
        F.count_if("looks").cast("long").alias("n_smiles_like"),
        F.count_if(ok).cast("long").alias("n_valid"),
        F.count_if(ok & (F.col("charge") != 0)).cast("long").alias("n_charged"),
        F.count_if(ok & qc.has_fragments(F.col("tok"))).cast("long").alias("n_fragmented"),
        F.count_if(F.col("reason").startswith("unknown_token")).cast("long").alias("n_unknown_token"),
        F.count_if(F.col("reason") == "unpaired_ring_closure").cast("long").alias("n_ring_errors"))


@register("text_lines_ingest", """
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines,
       CAST(sum(length(trim(line, ' \t\n\r'))) AS BIGINT) AS n_chars
FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) t
WHERE NOT starts_with(line, '#') AND trim(line, ' \t\n\r') <> ''
GROUP BY doc_id""")
def q_text_lines(spark, sf_dir):
    d = br.table(spark, sf_dir, "documents").select("doc_id", "text")
    lines = d.select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    kept = lines.filter(~F.col("line").startswith("#")).select(
        "doc_id", F.trim(F.col("line"), F.lit(" \t\n\r")).alias("s")).filter(F.col("s") != "")
    return kept.groupBy("doc_id").agg(F.count(F.lit(1)).cast("long").alias("n_lines"),
                                      F.sum(F.length("s")).cast("long").alias("n_chars"))


# --- XYZ text out and back in (K6, S8, K7, F16) ---------------------------------
@register("xyz_roundtrip", br.with_views("""
SELECT a.unique_id, CAST(count(*) AS BIGINT) AS num_atoms, CAST(m.charge AS INTEGER) AS charge,
       1 AS multiplicity, round(sum(a.x), 6) AS sum_x, round(sum(a.y), 6) AS sum_y,
       round(sum(a.z), 6) AS sum_z, string_agg(a.element, '' ORDER BY a.atom_idx) AS elements
FROM atoms a JOIN molecules m ON a.unique_id = m.unique_id
GROUP BY a.unique_id, m.charge""", "molecules", "atoms"))
def q_xyz_roundtrip(spark, sf_dir):
    from molspark.sinks.tables import xyz_blocks
    from molspark.sources.xyz import parse_xyz
    m = br.molecules(spark, sf_dir).select("unique_id", "charge")
    a = br.atoms(spark, sf_dir, with_z=False)
    blocks = xyz_blocks(m, a, energy_col=None)
    # molecule fields ride on the atom rows: the text is parsed once
    _pm, pa, _fail = parse_xyz(blocks.select("xyz_block"), "xyz_block", mode="tokens",
                               carry=("charge", "multiplicity"))
    return pa.groupBy("unique_id").agg(
        F.count(F.lit(1)).cast("long").alias("num_atoms"),
        F.first("charge").cast("int").alias("charge"), F.first("multiplicity").alias("multiplicity"),
        rk(F.sum("x"), 6).alias("sum_x"), rk(F.sum("y"), 6).alias("sum_y"), rk(F.sum("z"), 6).alias("sum_z"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("atom_idx", "element"))),
                                 lambda s: s["element"]), "").alias("elements"))


@register("extract_xyz", br.with_views("""
SELECT unique_id,
       CAST(count(*) AS VARCHAR) || chr(10) || ' unique_id:' || unique_id || ' AddtionalColumns:charge'
         || chr(10) || string_agg(printf('%-2s %15.6f %15.6f %15.6f %15.6f', element, x, y, z, charge),
                                  chr(10) ORDER BY atom_idx) AS xyz_text
FROM atoms GROUP BY unique_id""", "atoms"))
def q_extract_xyz(spark, sf_dir):
    from molspark.sinks.tables import extract_xyz
    a = br.atoms(spark, sf_dir, with_z=False).select("unique_id", "atom_idx", "element", "x", "y",
                                                     "z", "charge")
    return extract_xyz(a, extended=True)


# --- accounting (J14, A36, A37, P7, P9, P12) -------------------------------------
_REASON_SQL = """
  SELECT m.unique_id,
         CASE WHEN c.n IS NULL THEN 'no atoms'
              WHEN ((c.zpar - ((m.charge % 2) + 2) % 2) % 2 + 2) % 2 <> 0 THEN 'open shell'
              WHEN coalesce(b.n_bad, 0) > 0 THEN 'bond length out of range' END AS reason
  FROM molecules m
  LEFT JOIN (SELECT unique_id, count(*) AS n, sum(z_num % 2) AS zpar FROM atoms GROUP BY 1) c
    ON m.unique_id = c.unique_id
  LEFT JOIN (SELECT b.unique_id, count(*) FILTER (WHERE l < 0.5 OR l > 3.5) AS n_bad FROM (
               SELECT b.unique_id, sqrt((aj.x - ai.x) * (aj.x - ai.x) + (aj.y - ai.y) * (aj.y - ai.y)
                                        + (aj.z - ai.z) * (aj.z - ai.z)) AS l
               FROM bonds b JOIN atoms ai ON ai.unique_id = b.unique_id AND ai.atom_idx = b.i
                            JOIN atoms aj ON aj.unique_id = b.unique_id AND aj.atom_idx = b.j) b
             GROUP BY 1) b ON m.unique_id = b.unique_id"""


def _qc_reasons(spark, sf_dir):
    from molspark.operators.qc import bond_length_qc
    from molspark.operators.structure import bond_geometry
    m = br.molecules(spark, sf_dir)
    a = br.atoms(spark, sf_dir)
    # atom count and electron parity in one aggregation of the atom table
    per = a.groupBy("unique_id").agg(F.count(F.lit(1)).alias("_n"),
                                     F.sum(F.pmod(F.col("z_num"), F.lit(2))).alias("_zpar"))
    parity = F.pmod(F.col("_zpar") - F.pmod(F.col("charge"), F.lit(2)), F.lit(2))
    bq = bond_length_qc(bond_geometry(br.bonds(a), a)).select("unique_id", "n_bad_bonds")
    t = m.join(per, "unique_id", "left").join(bq, "unique_id", "left")
    reason = (F.when(F.col("_n").isNull(), "no atoms")
              .when(parity != 0, "open shell")
              .when(F.coalesce(F.col("n_bad_bonds"), F.lit(0)) > 0, "bond length out of range"))
    return t.select("unique_id", reason.alias("reason"))


@register("qc_failure_counts", br.with_views(f"""
SELECT 'sanitize' AS stage, reason, CAST(count(*) AS BIGINT) AS n_failures
FROM ({_REASON_SQL}) r WHERE reason IS NOT NULL GROUP BY reason""", "molecules", "atoms", "bonds"))
def q_failure_counts(spark, sf_dir):
    from molspark.operators.batches import failure_counts
    r = _qc_reasons(spark, sf_dir).filter(F.col("reason").isNotNull()).withColumn(
        "stage", F.lit("sanitize"))
    return failure_counts(r, ["stage", "reason"])


@register("run_summary", br.with_views(f"""
SELECT CAST(count(*) AS BIGINT) AS n_inputs,
       CAST(count(*) FILTER (WHERE reason IS NULL) AS BIGINT) AS n_outputs,
       round(count(*) FILTER (WHERE reason IS NULL) * 100.0 / count(*), 4) AS success_pct,
       round((SELECT sum(o_totalprice / 1000.0) FROM orders), 4) AS total_time,
       round((SELECT sum(o_totalprice / 1000.0) FROM orders)
             / count(*) FILTER (WHERE reason IS NULL), 6) AS time_per_structure
FROM ({_REASON_SQL}) r""", "molecules", "atoms", "bonds"))
def q_run_summary(spark, sf_dir):
    from molspark.operators.batches import run_summary
    r = _qc_reasons(spark, sf_dir)
    meta = br.table(spark, sf_dir, "orders").select((F.col("o_totalprice") / 1000.0).alias("total_time"))
    s = run_summary(r, F.col("reason").isNull(), meta)
    return s.select("n_inputs", "n_outputs", rk(F.col("success_pct"), 4).alias("success_pct"),
                    rk(F.col("total_time"), 4).alias("total_time"),
                    rk(F.col("time_per_structure"), 6).alias("time_per_structure"))


@register("dropped_inputs", br.with_views("""
SELECT m.unique_id FROM molecules m WHERE NOT EXISTS (
  SELECT 1 FROM atoms a WHERE a.unique_id = m.unique_id)""", "molecules", "atoms"))
def q_dropped(spark, sf_dir):
    from molspark.operators.batches import dropped_inputs
    return dropped_inputs(br.molecules(spark, sf_dir).select("unique_id"),
                          br.atoms(spark, sf_dir, with_z=False).select("unique_id"))


@register("human_size", """
SELECT page_id, printf('%.2f', round(n / pow(1024.0, e), 2)) || ' ' || ['B', 'KB', 'MB', 'GB', 'TB'][e + 1]
         AS size_text
FROM (SELECT page_id, CAST(length(html) AS DOUBLE) * 37.0 AS n,
             CASE WHEN length(html) * 37.0 >= 1099511627776.0 THEN 4
                  WHEN length(html) * 37.0 >= 1073741824.0 THEN 3
                  WHEN length(html) * 37.0 >= 1048576.0 THEN 2
                  WHEN length(html) * 37.0 >= 1024.0 THEN 1 ELSE 0 END AS e FROM pages) t""")
def q_human_size(spark, sf_dir):
    from molspark.operators.batches import human_size
    p = br.table(spark, sf_dir, "pages")
    return p.select("page_id", human_size(F.length("html").cast("double") * 37.0).alias("size_text"))


# --- pooling, descriptors, damped Coulomb, periodic images
@register("attention_pool", br.with_views("""
SELECT unique_id, round(lo, 6) AS lo,
       round(lo + CASE WHEN hi_raw - lo > 20 THEN hi_raw - lo ELSE ln(1 + exp(hi_raw - lo)) END, 6) AS hi
FROM (SELECT a.unique_id,
             sum(exp(a.z_num / 10.0 - m.mx) * a.forces_x * 100.0) / sum(exp(a.z_num / 10.0 - m.mx)) * 2.0 - 1.0
               AS lo,
             sum(exp(a.z_num / 10.0 - m.mx) * a.charge) / sum(exp(a.z_num / 10.0 - m.mx)) * 3.0 + 0.5
               AS hi_raw
      FROM atoms a JOIN (SELECT unique_id, max(z_num / 10.0) AS mx FROM atoms GROUP BY 1) m
        ON a.unique_id = m.unique_id GROUP BY a.unique_id) t""", "atoms"))
def q_attention_pool(spark, sf_dir):
    from molspark.operators.geometry import pooled_levels
    a = (br.atoms(spark, sf_dir).withColumn("logit", F.col("z_num") / 10.0)
         .withColumn("v_lo", F.col("forces_x") * 100.0))
    p = pooled_levels(a, "v_lo", "charge", "logit", mean=(-1.0, 0.5), std=(2.0, 3.0))
    return p.select("unique_id", rk(F.col("lo"), 6).alias("lo"), rk(F.col("hi"), 6).alias("hi"))


def _radial_sql(nshifts=16, rmin=0.8, rc=5.0):
    import math
    eta = (nshifts / (rc - rmin)) ** 2
    shifts = [rmin + k * (rc - rmin) / nshifts for k in range(nshifts)]
    fc = f"(0.5 * (cos({math.pi!r} * least(greatest(d, 1e-06), {rc!r}) / {rc!r}) + 1.0))"
    terms = " + ".join(f"exp({-eta!r} * (d - {s!r}) * (d - {s!r}))" for s in shifts)
    return f"({terms}) * {fc}", f"exp({-eta!r} * (d - {shifts[0]!r}) * (d - {shifts[0]!r})) * {fc}"


_RS, _R0 = _radial_sql()


@register("radial_descriptor", br.with_views(f"""
SELECT unique_id, atom_idx, round(sum({_RS}), 6) AS g_total, round(sum({_R0}), 6) AS g_first
FROM (SELECT unique_id, i AS atom_idx, d FROM pairs WHERE d < 5.0
      UNION ALL SELECT unique_id, j AS atom_idx, d FROM pairs WHERE d < 5.0) e
GROUP BY unique_id, atom_idx""", "atoms", ctes=[_PAIRS_CTE]))
def q_radial(spark, sf_dir):
    from molspark.operators.pairs import radial_descriptor
    g = radial_descriptor(br.atoms(spark, sf_dir, with_z=False))
    return g.select("unique_id", "atom_idx",
                    rk(F.aggregate("g", F.lit(0.0), lambda acc, v: acc + v), 6).alias("g_total"),
                    rk(F.element_at("g", 1), 6).alias("g_first"))


def _dsf_sql(rc=15.0, alpha=0.2, sr_rc=4.6):
    import math
    erfc_rc = math.erfc(alpha * rc)
    shift = erfc_rc / rc
    slope = erfc_rc / rc ** 2 + 2 * alpha / math.sqrt(math.pi) * math.exp(-(alpha * rc) ** 2) / rc
    x = f"({alpha!r} * d)"
    t = f"(1.0 / (1.0 + 0.3275911 * abs({x})))"
    poly = (f"{t} * (0.254829592 + {t} * (-0.284496736 + {t} * (1.421413741 + {t} * "
            f"(-1.453152027 + {t} * 1.061405429))))")
    erfc = f"CASE WHEN {x} >= 0 THEN {poly} * exp(-{x} * {x}) ELSE 2.0 - {poly} * exp(-{x} * {x}) END"
    kern = f"CASE WHEN d <= {rc!r} THEN ({erfc}) / d - {shift!r} + (d - {rc!r}) * {slope!r} ELSE 0.0 END"
    sr = f"CASE WHEN d < {sr_rc!r} THEN {_exp_cut_sql('d', sr_rc)} / d ELSE 0.0 END"
    return f"qi * qj * (({kern}) - ({sr}))"


@register("coulomb_dsf", br.with_views(f"""
SELECT unique_id, round(coalesce(sum({_dsf_sql()}) FILTER (d > 0), 0) * {COULOMB!r}, 4) AS coulomb_dsf_ev,
       count(*) FILTER (d = 0) AS n_coincident
FROM pairs WHERE d < 15.0 GROUP BY unique_id""", "atoms", ctes=[_PAIRS_CTE]))
def q_coulomb_dsf(spark, sf_dir):
    from molspark.operators.pairs import coulomb_energy_dsf
    e = coulomb_energy_dsf(br.atoms(spark, sf_dir, with_z=False))
    return e.select("unique_id", rk(F.col("coulomb_dsf_ev"), 4).alias("coulomb_dsf_ev"), "n_coincident")


@register("periodic_neighbours", br.with_views("""
SELECT a.unique_id, CAST(count(*) AS BIGINT) AS n_pairs, round(sum(sqrt(
         (b.x + s.sa * 6.0 - a.x) * (b.x + s.sa * 6.0 - a.x) + (b.y + s.sb * 6.0 - a.y) * (b.y + s.sb * 6.0 - a.y)
         + (b.z + s.sc * 6.0 - a.z) * (b.z + s.sc * 6.0 - a.z))), 4) AS sum_d
FROM atoms a JOIN atoms b ON a.unique_id = b.unique_id
CROSS JOIN (SELECT x.v AS sa, y.v AS sb, z.v AS sc FROM (VALUES (-1), (0), (1)) x(v),
            (VALUES (-1), (0), (1)) y(v), (VALUES (-1), (0), (1)) z(v)) s
WHERE sqrt((b.x + s.sa * 6.0 - a.x) * (b.x + s.sa * 6.0 - a.x) + (b.y + s.sb * 6.0 - a.y) * (b.y + s.sb * 6.0 - a.y)
           + (b.z + s.sc * 6.0 - a.z) * (b.z + s.sc * 6.0 - a.z)) > 0.1
  AND sqrt((b.x + s.sa * 6.0 - a.x) * (b.x + s.sa * 6.0 - a.x) + (b.y + s.sb * 6.0 - a.y) * (b.y + s.sb * 6.0 - a.y)
           + (b.z + s.sc * 6.0 - a.z) * (b.z + s.sc * 6.0 - a.z)) < 3.0
GROUP BY a.unique_id""", "atoms"))
def q_periodic(spark, sf_dir):
    from molspark.operators.pairs import periodic_neighbours
    a = br.atoms(spark, sf_dir, with_z=False)
    cells = a.select("unique_id").distinct().select(
        "unique_id", *[F.lit(v).alias(n) for n, v in (("a1", 6.0), ("a2", 0.0), ("a3", 0.0),
                                                      ("b1", 0.0), ("b2", 6.0), ("b3", 0.0),
                                                      ("c1", 0.0), ("c2", 0.0), ("c3", 6.0))])
    p = periodic_neighbours(a, cells, cutoff=3.0)
    return p.groupBy("unique_id").agg(F.count(F.lit(1)).cast("long").alias("n_pairs"),
                                      rk(F.sum("d"), 4).alias("sum_d"))


# --- thermo, clipping (A40, P24) ------------------------------------------------
_THERMO_MAP = {"click": "ZPE", "view": "E_0K", "purchase": "E_tot", "signup": "H_tot", "error": "Cv_tot"}


@register("thermo_to_ev", f"""
SELECT unique_id, round(max(CASE WHEN q = 'ZPE' THEN v * {HARTREE_EV!r} END), 6) AS "ZPE_eV",
       round(max(CASE WHEN q = 'E_0K' THEN v * {HARTREE_EV!r} END), 6) AS "E_0K_eV",
       round(max(CASE WHEN q = 'E_tot' THEN v * {HARTREE_EV!r} END), 6) AS "E_tot_eV",
       round(max(CASE WHEN q = 'H_tot' THEN v * {HARTREE_EV!r} END), 6) AS "H_tot_eV",
       round(max(CASE WHEN q = 'Cv_tot' THEN v END), 6) AS "Cv_tot"
FROM (SELECT CAST(user_id AS VARCHAR) AS unique_id,
             CASE event_type WHEN 'click' THEN 'ZPE' WHEN 'view' THEN 'E_0K' WHEN 'purchase' THEN 'E_tot'
                             WHEN 'signup' THEN 'H_tot' ELSE 'Cv_tot' END AS q,
             avg(value) / 1000.0 AS v
      FROM events GROUP BY 1, 2) t
GROUP BY unique_id""")
def q_thermo(spark, sf_dir):
    ev = br.table(spark, sf_dir, "events")
    q = F.col("event_type")
    qexpr = F.when(q == "click", "ZPE").when(q == "view", "E_0K").when(q == "purchase", "E_tot") \
        .when(q == "signup", "H_tot").otherwise("Cv_tot")
    long = ev.groupBy(F.col("user_id").cast("string").alias("unique_id"), qexpr.alias("quantity")) \
        .agg((F.avg("value") / 1000.0).alias("value_hartree"))
    w = en.thermo_to_ev(long, quantities=("ZPE", "E_0K", "E_tot", "H_tot"))
    return w.select("unique_id", *[rk(F.col(c), 6).alias(c) for c in
                                   ("ZPE_eV", "E_0K_eV", "E_tot_eV", "H_tot_eV", "Cv_tot")])


@register("clip_predictions", br.with_views("""
SELECT model_id, CAST(count(*) FILTER (WHERE energy < 100.0 OR energy > 300.0) AS BIGINT) AS n_clipped,
       round(sum(greatest(100.0, least(300.0, energy))), 4) AS sum_clipped
FROM predictions GROUP BY model_id""", "predictions"))
def q_clip(spark, sf_dir):
    from molspark.operators.qc import clip
    c = clip(br.predictions(spark, sf_dir), ["energy"], lo=100.0, hi=300.0)
    return c.groupBy("model_id").agg(F.count_if("energy_clipped").cast("long").alias("n_clipped"),
                                     rk(F.sum("energy"), 4).alias("sum_clipped"))


# --- grids: vdW volume, ESP grid, nuclear ESP, ESP range, near-minimum sites -----
_PERIODIC_CTE = ("periodic", "SELECT * FROM " + __import__("molspark.refdata", fromlist=["x"])
                 .sql_values_periodic())


@register("vdw_volume_coarse", br.with_views("""
SELECT b.unique_id, round(b.box_volume * coalesce(c.n_inside, 0) / 512.0, 4) AS vdw_volume_angstrom3
FROM box b LEFT JOIN (
  SELECT p.unique_id, count(*) AS n_inside FROM (
    SELECT DISTINCT p.unique_id, p.gi
    FROM pts p JOIN ra a ON a.unique_id = p.unique_id
    WHERE (p.gx - a.x) * (p.gx - a.x) + (p.gy - a.y) * (p.gy - a.y) + (p.gz - a.z) * (p.gz - a.z)
          <= a.r * a.r) p GROUP BY 1) c ON b.unique_id = c.unique_id""", "atoms", ctes=[
    _PERIODIC_CTE,
    ("ra", "SELECT a.unique_id, a.x, a.y, a.z, coalesce(p.vdw_radius, 0.0) AS r FROM atoms a "
           "LEFT JOIN periodic p ON a.z_num = p.z_num"),
    ("box0", "SELECT unique_id, min(x) - max(r) - 0.001 AS ox, min(y) - max(r) - 0.001 AS oy, "
             "min(z) - max(r) - 0.001 AS oz, max(x) + max(r) + 0.001 AS hx, "
             "max(y) + max(r) + 0.001 AS hy, max(z) + max(r) + 0.001 AS hz FROM ra GROUP BY 1"),
    ("box", "SELECT unique_id, ox, oy, oz, (hx - ox) / 8 AS sx, (hy - oy) / 8 AS sy, (hz - oz) / 8 AS sz, "
            "(hx - ox) / 8 * ((hy - oy) / 8) * ((hz - oz) / 8) * 512.0 AS box_volume FROM box0"),
    ("pts", "SELECT unique_id, iz * 64 + iy * 8 + ix AS gi, ox + sx * (ix + 0.5) AS gx, "
            "oy + sy * (iy + 0.5) AS gy, oz + sz * (iz + 0.5) AS gz FROM box, range(8) t1(ix), "
            "range(8) t2(iy), range(8) t3(iz)"),
]))
def q_vdw_volume_coarse(spark, sf_dir):
    """The volume operator on a lattice that SQL can enumerate."""
    from molspark.operators.grid import vdw_volume
    v = vdw_volume(br.atoms(spark, sf_dir), n_per_axis=8)
    return v.select("unique_id", rk(F.col("vdw_volume_angstrom3"), 4).alias("vdw_volume_angstrom3"))


@register("vdw_volume")
def q_vdw_volume(spark, sf_dir):
    """At full resolution, a million points per molecule (too many for SQL; held
    against brute force in the tests)."""
    from molspark.operators.grid import vdw_volume
    v = vdw_volume(br.atoms(spark, sf_dir))
    return v.select("unique_id", rk(F.col("vdw_volume_angstrom3"), 4).alias("vdw_volume_angstrom3"))


_ESP_GRID_CTES = [
    _PERIODIC_CTE,
    ("ra", "SELECT a.unique_id, a.x, a.y, a.z, a.z_num, coalesce(p.vdw_radius, 0.0) + 1.1 AS r "
           "FROM atoms a LEFT JOIN periodic p ON a.z_num = p.z_num"),
    ("box", "SELECT unique_id, min(x) - 3.0 AS ox, min(y) - 3.0 AS oy, min(z) - 3.0 AS oz, "
            "CAST(floor((max(x) - min(x) + 6.0) / 1.5) + 1 AS INTEGER) AS nx, "
            "CAST(floor((max(y) - min(y) + 6.0) / 1.5) + 1 AS INTEGER) AS ny, "
            "CAST(floor((max(z) - min(z) + 6.0) / 1.5) + 1 AS INTEGER) AS nz FROM ra GROUP BY 1"),
    ("pts", "SELECT unique_id, iz * ny * nx + iy * nx + ix AS gi, ox + 1.5 * ix AS gx, oy + 1.5 * iy AS gy, "
            "oz + 1.5 * iz AS gz FROM (SELECT *, unnest(range(nx)) AS ix FROM box) b1, "
            "LATERAL (SELECT unnest(range(b1.ny)) AS iy) t2, LATERAL (SELECT unnest(range(b1.nz)) AS iz) t3"),
    ("grid", """SELECT p.unique_id, p.gi, p.gx, p.gy, p.gz FROM pts p JOIN ra a ON a.unique_id = p.unique_id
               GROUP BY p.unique_id, p.gi, p.gx, p.gy, p.gz
               HAVING NOT bool_or(a.r * a.r - ((p.gx - a.x) * (p.gx - a.x) + (p.gy - a.y) * (p.gy - a.y)
                                             + (p.gz - a.z) * (p.gz - a.z)) > 1e-08)
                  AND 9.0 - min((p.gx - a.x) * (p.gx - a.x) + (p.gy - a.y) * (p.gy - a.y)
                                + (p.gz - a.z) * (p.gz - a.z)) > 1e-08"""),
    ("esp", """SELECT g.unique_id, g.gi, sum(a.z_num / sqrt((g.gx - a.x) * (g.gx - a.x) + (g.gy - a.y) * (g.gy - a.y)
                                                       + (g.gz - a.z) * (g.gz - a.z))) AS esp
               FROM grid g JOIN ra a ON a.unique_id = g.unique_id GROUP BY 1, 2"""),
]


_ESP_GRID_COARSE = br.with_views("""
SELECT e.unique_id, CAST(count(*) AS BIGINT) AS n_grid, round(min(e.esp), 6) AS esp_min,
       round(max(e.esp), 6) AS esp_max,
       CAST(count(*) FILTER (WHERE e.esp <= m.mn + 0.01 * abs(m.mn)) AS BIGINT) AS n_near_min
FROM esp e JOIN (SELECT unique_id, min(esp) AS mn FROM esp GROUP BY 1) m ON e.unique_id = m.unique_id
GROUP BY e.unique_id""", "atoms", ctes=_ESP_GRID_CTES)


def _esp_ranges(spark, sf_dir, spacing):
    import uuid
    from molspark.operators.esp_blocks import esp_blocks, esp_summary
    from molspark.session import scratch_path
    path = scratch_path(spark, f"esp-{uuid.uuid4().hex[:12]}")
    esp_blocks(br.atoms(spark, sf_dir), spacing=spacing).write.parquet(path)  # read twice
    return esp_summary(spark.read.parquet(path)).filter("n_grid > 0").select(
        "unique_id", F.col("n_grid").cast("long").alias("n_grid"), rk(F.col("esp_min"), 6).alias("esp_min"),
        rk(F.col("esp_max"), 6).alias("esp_max"), F.col("n_near_min").cast("long").alias("n_near_min"))


@register("esp_grid_range")
def q_esp_grid_range(spark, sf_dir):
    """At the spacing of the operator, 27 times the points of the coarse grid (too
    many for SQL; held against brute force in the tests)."""
    return _esp_ranges(spark, sf_dir, 0.5)


@register("esp_grid_coarse", _ESP_GRID_COARSE)
def q_esp_grid_coarse(spark, sf_dir):
    """The same operator on a grid that SQL can enumerate."""
    return _esp_ranges(spark, sf_dir, 1.5)


#: Atoms of the molecules whose points are on disk at one time.
SHARE_ATOMS = 16_000_000


@register("esp_grid_points", _ESP_GRID_COARSE)
def q_esp_grid(spark, sf_dir):
    """The operators that return the points themselves, on the coarse grid. The
    points of one share of the molecules are written at a time and dropped when
    their results are, so that disk follows the share and not the table."""
    import math
    import uuid

    from molspark.operators.geometry import near_minimum_sites
    from molspark.operators.grid import esp_grid, grid_boxes, point_charge_esp
    from molspark.session import freed_shuffles, scratch_path
    from molspark.sinks.tables import drop_stage
    atoms = br.atoms(spark, sf_dir)
    shares = max(1, math.ceil(br.table(spark, sf_dir, "lineitem").count() / SHARE_ATOMS))
    out = scratch_path(spark, f"esp-ranges-{uuid.uuid4().hex[:12]}")
    for share in range(shares):
        a = atoms.where(F.pmod(F.xxhash64("unique_id"), F.lit(shares)) == share)
        boxes = grid_boxes(a, spacing=1.5, padding=3.0)
        g = esp_grid(a, rcut=3.0, spacing=1.5, probe=1.1, boxes=boxes)
        path = scratch_path(spark, f"esp-points-{uuid.uuid4().hex[:12]}")
        with freed_shuffles(spark):
            point_charge_esp(g, a, charge_col="z_num", sizes=boxes.select("unique_id", "n_lattice")).write.parquet(path)  # read three times
            e = spark.read.parquet(path)
            stats = e.groupBy("unique_id").agg(F.count(F.lit(1)).cast("long").alias("n_grid"),
                                               F.min("esp").alias("esp_min"), F.max("esp").alias("esp_max"))
            near = near_minimum_sites(e, "esp", 0.01).groupBy("unique_id").agg(
                F.count(F.lit(1)).cast("long").alias("n_near_min"))
            stats.join(near, "unique_id").select(
                "unique_id", "n_grid", rk(F.col("esp_min"), 6).alias("esp_min"),
                rk(F.col("esp_max"), 6).alias("esp_max"), "n_near_min").write.mode("append").parquet(out)
        drop_stage(spark, path)
    return spark.read.parquet(out)


# --- structural duplicates (J12), fragments (P10 graph), principal frame (A28) ----
_COPIES = "CAST(unique_id AS BIGINT) % {} = 0"


# Every fifth molecule has an exact copy, every seventh a copy within the
# tolerance and every ninth one just outside, under larger ids.
@register("structural_duplicates", br.with_views("""
SELECT b.unique_id, min(a.unique_id) AS rep_id
FROM sig b JOIN sig a ON a.sig_key = b.sig_key AND a.unique_id < b.unique_id
  AND abs(b.x - a.x) <= 1e-08 + 1e-05 * abs(a.x) AND abs(b.y - a.y) <= 1e-08 + 1e-05 * abs(a.y)
  AND abs(b.z - a.z) <= 1e-08 + 1e-05 * abs(a.z)
WHERE NOT EXISTS (
  SELECT 1 FROM aa p JOIN aa r ON r.unique_id = a.unique_id AND r.atom_idx = p.atom_idx
  WHERE p.unique_id = b.unique_id AND NOT (
        abs(p.x - r.x) <= 1e-08 + 1e-05 * abs(r.x)
        AND abs(p.y - r.y) <= 1e-08 + 1e-05 * abs(r.y) AND abs(p.z - r.z) <= 1e-08 + 1e-05 * abs(r.z)))
GROUP BY b.unique_id""", "molecules", "atoms", ctes=[
    ("aa", "SELECT unique_id, atom_idx, element, x, y, z FROM atoms " + "".join(
        f"UNION ALL SELECT unique_id || '{tail}', atom_idx, element, x + {shift}, y, z FROM atoms "
        f"WHERE {_COPIES.format(n)} " for tail, n, shift in (("b", 5, 0.0), ("c", 7, 1e-9), ("d", 9, 1e-3)))),
    ("sig", "SELECT a.unique_id, CAST(count(*) AS VARCHAR) || '|' || "
            "string_agg(a.element, ',' ORDER BY a.atom_idx) || '|' || coalesce(CAST(m.charge AS VARCHAR), '') "
            "AS sig_key, arg_min(a.x, a.atom_idx) AS x, arg_min(a.y, a.atom_idx) AS y, "
            "arg_min(a.z, a.atom_idx) AS z FROM aa a JOIN molecules m "
            "ON rtrim(a.unique_id, 'bcd') = m.unique_id GROUP BY a.unique_id, m.charge"),
]))
def q_duplicates(spark, sf_dir):
    import uuid
    from molspark.operators.structure import structural_duplicates
    from molspark.session import freed_shuffles, scratch_path
    m = br.molecules(spark, sf_dir).select("unique_id", "charge")
    a = br.atoms(spark, sf_dir, with_z=False).select("unique_id", "atom_idx", "element", "x", "y", "z")
    tails = (("b", 5, 0.0), ("c", 7, 1e-9), ("d", 9, 1e-3))
    mols = m
    for tail, n, _ in tails:
        mols = mols.union(m.filter(F.expr(_COPIES.format(n))).select(F.concat("unique_id", F.lit(tail)).alias("unique_id"), "charge"))
    # The copies of an atom beside it, so the atoms are derived once.
    copies = F.array(F.struct(F.lit("").alias("tail"), F.col("x").alias("x"), F.lit(True).alias("there")), *[
        F.struct(F.lit(tail).alias("tail"), (F.col("x") + F.lit(shift)).alias("x"), F.expr(_COPIES.format(n)).alias("there"))
        for tail, n, shift in tails])
    atoms = (a.withColumn("copy", F.explode(F.filter(copies, lambda c: c["there"])))
             .select(F.concat("unique_id", "copy.tail").alias("unique_id"), "atom_idx", "element", "copy.x", "y", "z"))
    path = scratch_path(spark, f"duplicates-{uuid.uuid4().hex[:12]}")
    with freed_shuffles(spark):
        atoms.write.parquet(path)  # a table, as a user has it
    return structural_duplicates(mols, spark.read.parquet(path))


@register("fragment_count", br.with_views("""
SELECT unique_id, CAST(count(DISTINCT label) AS BIGINT) AS n_components FROM (
  SELECT unique_id, src, min(dst) AS label FROM reach GROUP BY 1, 2) t GROUP BY unique_id""", "atoms",
    ctes=[_PAIRS_CTE,
          ("edges", "SELECT unique_id, i AS src, j AS dst FROM pairs WHERE d < 1.0 "
                    "UNION ALL SELECT unique_id, j, i FROM pairs WHERE d < 1.0"),
          ("reach", "SELECT unique_id, atom_idx AS src, atom_idx AS dst FROM atoms")]).replace(
    "WITH ", "WITH RECURSIVE ", 1).replace(
    "reach AS (SELECT unique_id, atom_idx AS src, atom_idx AS dst FROM atoms)",
    "reach(unique_id, src, dst) AS (SELECT unique_id, atom_idx, atom_idx FROM atoms UNION "
    "SELECT r.unique_id, r.src, e.dst FROM reach r JOIN edges e ON r.unique_id = e.unique_id "
    "AND r.dst = e.src)"))
def q_fragments(spark, sf_dir):
    from molspark.operators.pairs import neighbour_list
    from molspark.operators.structure import component_count
    a = br.atoms(spark, sf_dir, with_z=False)
    bonds = neighbour_list(a, cutoff=1.0).select(
        "unique_id", F.col("atom_idx_i").alias("i"), F.col("atom_idx_j").alias("j"))
    return component_count(a, bonds)


@register("principal_frame")
def q_principal_frame(spark, sf_dir):
    """A28 (no SQL oracle: needs a 3x3 eigen-solver)."""
    from molspark.operators.grid import principal_frame
    p = principal_frame(br.atoms(spark, sf_dir, with_z=False))
    return p.select("unique_id", "atom_idx", rk(F.col("x"), 6).alias("x"), rk(F.col("y"), 6).alias("y"),
                    rk(F.col("z"), 6).alias("z"))


# --- batch merge (S12, S13, F20, U1, U6) ----------------------------------------
def write_bridge_batches(spark, sf_dir, root: str, batches=range(1, 6)) -> None:
    """Per-batch result CSVs derived from ``orders``: the order priority picks
    the batch folder; odd batches write ``unique_id,smiles,homo,note,code``,
    even ones ``homo,unique_id,esp_min,smiles,code`` (two header groups, columns
    swapped). Every value is text, as a batch job writes it: ids keep leading
    zeros, notes are quoted and span lines, and odd batches have codes that
    are no numbers."""
    o = br.table(spark, sf_dir, "orders")
    k = F.substring("o_orderpriority", 1, 1).cast("int")
    base = o.select(
        k.alias("_k"), F.lpad(F.col("o_orderkey").cast("string"), 8, "0").alias("unique_id"),
        F.col("o_orderstatus").alias("smiles"),
        F.format_string("%.4f", -F.col("o_totalprice") / 100.0).alias("homo"),
        F.concat(F.lit('say "'), F.col("o_orderstatus"), F.lit('", then\n  1 2, end')).alias("note"),
        F.format_string("%.4f", F.col("o_totalprice") / 10.0).alias("esp_min"),
        F.when(k % 2 == 1, "n/a").otherwise(F.col("o_custkey").cast("string")).alias("code"))
    for odd, cols in ((1, ["unique_id", "smiles", "homo", "note", "code"]),
                      (0, ["homo", "unique_id", "esp_min", "smiles", "code"])):
        mine = [b for b in batches if b % 2 == odd]
        if mine:
            (base.filter(F.col("_k").isin(mine)).select("_k", *cols).write.partitionBy("_k").mode("overwrite")
             .option("header", True).option("escape", '"').csv(f"{root}/raw-{odd}"))
            _as_batches(spark, f"{root}/raw-{odd}", "_k", root, "molecule_property.csv")


def _as_batches(spark, written: str, column: str, root: str, name: str) -> None:
    """The partitions of a written table as ``<root>/batch_<value>/<name>`` folders."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path
    fs = path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for st in fs.listStatus(path(written)):
        part = st.getPath().getName()
        if part.startswith(f"{column}="):
            to = path(f"{root}/batch_{part.partition('=')[2]}/{name}")
            fs.mkdirs(to.getParent())
            fs.rename(st.getPath(), to)


@register("combine_batches", """
SELECT lpad(CAST(o_orderkey AS VARCHAR), 8, '0') AS unique_id, o_orderstatus AS smiles,
       CAST(printf('%.4f', -o_totalprice / 100.0) AS DOUBLE) AS homo,
       CASE WHEN k % 2 = 1 THEN 'say "' || o_orderstatus || '", then' || chr(10) || '  1 2, end' END AS note,
       CASE WHEN k % 2 = 0 THEN CAST(printf('%.4f', o_totalprice / 10.0) AS DOUBLE) END AS esp_min,
       CASE WHEN k % 2 = 1 THEN 'n/a' ELSE CAST(o_custkey AS VARCHAR) END AS code,
       'batch_' || CAST(k AS VARCHAR) AS batch_id
FROM (SELECT *, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS k FROM orders) t""")
def q_combine_batches(spark, sf_dir):
    import uuid
    from molspark.operators.merge import combine_batches
    from molspark.session import scratch_path
    root = scratch_path(spark, f"batches-{uuid.uuid4().hex[:12]}")
    write_bridge_batches(spark, sf_dir, root)
    return combine_batches(spark, root, "molecule_property.csv")


# --- more molecule aggregates (A7, A8, A9, A23, J2, P18, J15) ---------------------
@register("total_charge", br.with_views("""
SELECT unique_id, CAST(round_even(sum(charge), 0) AS INTEGER) AS total_charge,
       round(sum(forces_z), 8) AS sum_forces_z
FROM atoms GROUP BY unique_id""", "atoms"))
def q_total_charge(spark, sf_dir):
    from molspark.operators.composition import molecule_sum, total_charge
    a = br.atoms(spark, sf_dir, with_z=False)
    return total_charge(a).join(molecule_sum(a, "forces_z"), "unique_id").select(
        "unique_id", "total_charge", rk(F.col("sum_forces_z"), 8).alias("sum_forces_z"))


# shifts per element for A9 (user-supplied table in real use; here a fixed test table)
_SHIFTS = [("H", -0.5), ("C", -37.8), ("N", -54.6), ("O", -75.1), ("F", -99.7), ("S", -398.1)]


@register("atomic_shift_sum", br.with_views(f"""
SELECT a.unique_id, round(sum(a.charge + coalesce(s.shift, 0.0)), 6) AS energy_shifted
FROM atoms a LEFT JOIN (VALUES {", ".join(f"('{e}', CAST({v!r} AS DOUBLE))" for e, v in _SHIFTS)}) s(element, shift)
  ON a.element = s.element
GROUP BY a.unique_id""", "atoms"))
def q_atomic_shift(spark, sf_dir):
    from molspark.operators.composition import atomic_shift_sum
    from molspark.refdata import literal_table
    from pyspark.sql import types as T
    shifts = literal_table(spark, _SHIFTS, T.StructType([T.StructField("element", T.StringType()),
                                                         T.StructField("shift", T.DoubleType())]))
    s = atomic_shift_sum(br.atoms(spark, sf_dir, with_z=False), shifts, value_col="charge")
    return s.select("unique_id", rk(F.col("energy_shifted"), 6).alias("energy_shifted"))


@register("bounding_box", br.with_views("""
SELECT unique_id, round(min(x) - 0.5, 6) AS xmin, round(max(x) + 0.5, 6) AS xmax,
       round(min(y) - 0.5, 6) AS ymin, round(max(y) + 0.5, 6) AS ymax,
       round(min(z) - 0.5, 6) AS zmin, round(max(z) + 0.5, 6) AS zmax,
       round((max(x) - min(x) + 1.0) * (max(y) - min(y) + 1.0) * (max(z) - min(z) + 1.0), 6) AS box_volume
FROM atoms GROUP BY unique_id""", "atoms"))
def q_bounding_box(spark, sf_dir):
    from molspark.operators.geometry import bounding_box
    b = bounding_box(br.atoms(spark, sf_dir, with_z=False), padding=0.5)
    return b.select("unique_id", *[rk(F.col(c), 6).alias(c) for c in
                                   ("xmin", "xmax", "ymin", "ymax", "zmin", "zmax", "box_volume")])


@register("element_products", br.with_views(f"""
SELECT a.unique_id, CAST(count(*) FILTER (WHERE r.element IS NULL) AS BIGINT) AS n_unmatched,
       string_agg(DISTINCT r.product, ',' ORDER BY r.product) AS products,
       round(sum(r.product_ratio * r.e_tot_ev), 6) AS product_energy_ev
FROM atoms a LEFT JOIN (SELECT * FROM {__import__("molspark.refdata", fromlist=["x"]).sql_values_element_ref()}) r
  ON a.element = r.element
GROUP BY a.unique_id""", "atoms"))
def q_element_products(spark, sf_dir):
    from molspark.operators.structure import join_element_ref
    j = join_element_ref(br.atoms(spark, sf_dir, with_z=False), "b3lypg_6311g*_e_tot_ev")
    return j.groupBy("unique_id").agg(
        F.count_if(F.col("ord").isNull()).cast("long").alias("n_unmatched"),
        F.array_join(F.array_sort(F.collect_set("product")), ",").alias("products"),
        rk(F.sum(F.col("product_ratio") * F.col("`b3lypg_6311g*_e_tot_ev`")), 6).alias("product_energy_ev"))


@register("element_whitelist", br.with_views("""
SELECT unique_id, string_agg(DISTINCT element, ',' ORDER BY element) AS bad_elements
FROM atoms WHERE element NOT IN ('C', 'H', 'N', 'O') GROUP BY unique_id""", "atoms"))
def q_element_whitelist(spark, sf_dir):
    from molspark.operators.qc import elements_in
    e = elements_in(br.atoms(spark, sf_dir, with_z=False), ["C", "H", "N", "O"])
    return e.select("unique_id", F.array_join("bad_elements", ",").alias("bad_elements"))


@register("atom_order_check", br.with_views("""
SELECT unique_id, CAST(count(*) FILTER (WHERE NOT (z1 IS NOT DISTINCT FROM z2)) AS BIGINT) AS n_mismatch
FROM (SELECT coalesce(a.unique_id, b.unique_id) AS unique_id, a.z_num AS z1, b.z2
      FROM atoms a FULL JOIN (SELECT unique_id, atom_idx,
                                     CASE WHEN atom_idx = 0 AND element = 'C' THEN 7 ELSE z_num END AS z2
                              FROM atoms) b
        ON a.unique_id = b.unique_id AND a.atom_idx = b.atom_idx) t
GROUP BY unique_id""", "atoms"))
def q_atom_order(spark, sf_dir):
    from molspark.operators.structure import assert_atom_order
    a = br.atoms(spark, sf_dir)
    other = a.select("unique_id", "atom_idx", F.when((F.col("atom_idx") == 0) & (F.col("element") == "C"),
                                                     F.lit(7)).otherwise(F.col("z_num")).alias("z_num"))
    return assert_atom_order(a, other)


# --- pair energies with per-element parameters (A18, A41) -----------------------
_R4R2 = [("H", 2.0073), ("C", 3.1038), ("N", 2.7152), ("O", 2.4426), ("F", 2.1613), ("S", 4.1246)]
_REP = [("H", 2.21, 1.1), ("C", 1.25, 4.2), ("N", 1.19, 5.2), ("O", 1.12, 6.1), ("F", 1.05, 7.0),
        ("S", 0.94, 9.3)]


def _param_cte(name, rows, cols):
    vals = ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else f"CAST({v!r} AS DOUBLE)"
                                     for v in r) + ")" for r in rows)
    return (name, f"SELECT * FROM (VALUES {vals}) t({', '.join(cols)})")


_PAIRS_P_CTE = ("pp", """
  SELECT a.unique_id, sqrt((b.x - a.x) * (b.x - a.x) + (b.y - a.y) * (b.y - a.y) + (b.z - a.z) * (b.z - a.z)) AS d,
         a.element AS ei, b.element AS ej, a.charge AS qi, b.charge AS qj
  FROM atoms a JOIN atoms b ON a.unique_id = b.unique_id AND a.atom_idx < b.atom_idx""")


@register("pair_dispersion", br.with_views("""
SELECT unique_id,
       CASE WHEN count(*) = count(qq) THEN round(-27.211386245981 * sum(
         2.0 * ci * cj / greatest(ci * aj / ai + cj * ai / aj, 1e-4)
         * (1.0 / (pow(b, 6) + pow(r0, 6)) + qq / (pow(b, 8) + pow(r0, 8)))), 6) END AS dispersion,
       count(*) - count(qq) AS n_missing
FROM (SELECT p.unique_id, p.d / 0.529177210544 AS b, 3.0 * pi.r4r2 * pj.r4r2 AS qq,
             0.4 * sqrt(3.0 * pi.r4r2 * pj.r4r2) + 5.0 AS r0,
             (1.0 + abs(p.qi)) * exp(least(greatest(p.qi * 8.0, -4.0), 4.0)) AS ci,
             (1.0 + abs(p.qj)) * exp(least(greatest(p.qj * 8.0, -4.0), 4.0)) AS cj,
             2.0 * exp(least(greatest(-p.qi, -4.0), 4.0)) AS ai, 2.0 * exp(least(greatest(-p.qj, -4.0), 4.0)) AS aj
      FROM pp p LEFT JOIN prm pi ON p.ei = pi.element LEFT JOIN prm pj ON p.ej = pj.element) t
GROUP BY unique_id""", "atoms", ctes=[_PAIRS_P_CTE, _param_cte("prm", _R4R2, ["element", "r4r2"])]))
def q_pair_dispersion(spark, sf_dir):
    from molspark.operators.pairs import pair_dispersion, scaled_dispersion_params
    from molspark.refdata import literal_table
    from pyspark.sql import types as T
    prm = literal_table(spark, _R4R2, T.StructType([T.StructField("element", T.StringType()),
                                                    T.StructField("r4r2", T.DoubleType())]))
    a = br.atoms(spark, sf_dir, with_z=False)
    unit = a.select("element").distinct().select("element", F.lit(1.0).alias("c6"), F.lit(2.0).alias("alpha"))
    a = scaled_dispersion_params(a.withColumns({"c6_mult": F.col("charge") * 8.0, "alpha_mult": -F.col("charge")}), unit)
    a = a.withColumn("c6", F.col("c6") * (F.lit(1.0) + F.abs("charge")))
    d = pair_dispersion(a, prm, s6=1.0, s8=1.0, a1=0.4, a2=5.0)
    return d.select("unique_id", rk(F.col("dispersion"), 6).alias("dispersion"), "n_missing")


@register("short_range_repulsion", br.with_views("""
SELECT unique_id, CASE WHEN count(*) = count(zz) THEN
         round(2.0 * coalesce(sum(exp(-aa * pow(d, 1.5)) * zz / d) FILTER (d > 0), 0), 6) END AS repulsion,
       count(*) - count(zz) AS n_missing, count(*) FILTER (d = 0) AS n_coincident
FROM (SELECT p.unique_id, p.d, pi.alpha * pj.alpha AS aa, pi.zeff * pj.zeff AS zz
      FROM pp p LEFT JOIN prm pi ON p.ei = pi.element LEFT JOIN prm pj ON p.ej = pj.element) t
GROUP BY unique_id""", "atoms", ctes=[_PAIRS_P_CTE, _param_cte("prm", _REP, ["element", "alpha", "zeff"])]))
def q_repulsion(spark, sf_dir):
    from molspark.operators.pairs import short_range_repulsion
    from molspark.refdata import literal_table
    from pyspark.sql import types as T
    prm = literal_table(spark, _REP, T.StructType([T.StructField("element", T.StringType()),
                                                   T.StructField("alpha", T.DoubleType()),
                                                   T.StructField("zeff", T.DoubleType())]))
    r = short_range_repulsion(br.atoms(spark, sf_dir, with_z=False), prm)
    return r.select("unique_id", rk(F.col("repulsion"), 6).alias("repulsion"), "n_missing", "n_coincident")


# --- batches and convergence (A35, T2, P13, W6) -----------------------------------
@register("batch_stats", br.with_views("""
SELECT m.batch_id, CAST(count(*) AS BIGINT) AS n_molecules, CAST(min(n) AS BIGINT) AS min_atoms,
       CAST(max(n) AS BIGINT) AS max_atoms, CAST(sum(n) AS BIGINT) AS total_atoms
FROM molecules m JOIN (SELECT unique_id, count(*) AS n FROM atoms GROUP BY 1) c ON m.unique_id = c.unique_id
GROUP BY m.batch_id""", "molecules", "atoms"))
def q_batch_stats(spark, sf_dir):
    from molspark.operators.batches import batch_stats
    from molspark.operators.composition import atom_counts
    m = br.molecules(spark, sf_dir).join(atom_counts(br.atoms(spark, sf_dir, with_z=False)), "unique_id")
    return batch_stats(m)


@register("convergence_progress", br.with_views("""
SELECT batch_id, CAST(count(*) FILTER (WHERE converged) AS BIGINT) AS n_done,
       CAST(count(*) FILTER (WHERE NOT converged) AS BIGINT) AS n_failed
FROM molecules GROUP BY batch_id""", "molecules"))
def q_progress(spark, sf_dir):
    from molspark.operators.batches import progress
    from molspark.operators.qc import split_converged
    m = br.molecules(spark, sf_dir)
    ok, bad = split_converged(m)
    tagged = ok.withColumn("ok", F.lit(True)).unionByName(bad.withColumn("ok", F.lit(False)))
    return progress(tagged, "batch_id", "ok")


@register("conformer_ranks", br.with_views("""
SELECT unique_id, conf_rank, CAST(count(*) AS BIGINT) AS n FROM (
  SELECT unique_id, CAST(row_number() OVER (PARTITION BY unique_id
                        ORDER BY energy_kcal, conf_id, l_partkey, l_suppkey) AS INTEGER) AS conf_rank
  FROM conformers) t
GROUP BY unique_id, conf_rank""", "conformers"))
def q_conformer_ranks(spark, sf_dir):
    c = en.rank_conformers(br.conformers(spark, sf_dir), order_cols=("conf_id", "l_partkey", "l_suppkey"))
    return c.groupBy("unique_id", F.col("conf_rank").cast("int").alias("conf_rank")).agg(
        F.count(F.lit(1)).cast("long").alias("n"))


# --- nested export and JSON text (K9, F19) ----------------------------------------
@register("nested_export", br.with_views("""
SELECT a.unique_id, CAST(len(list(element ORDER BY atom_idx)) AS BIGINT) AS n_elements,
       string_agg(element, '' ORDER BY atom_idx) AS elements,
       CAST(count(*) * 3 AS BIGINT) AS n_xyz_flat, round(sum(x + y + z), 6) AS xyz_sum,
       round(max(m.energy_hartree), 6) AS property_energy_hartree
FROM atoms a JOIN molecules m ON a.unique_id = m.unique_id
GROUP BY a.unique_id""", "molecules", "atoms"))
def q_nested_export(spark, sf_dir):
    from molspark.sinks.tables import nested_export
    n = nested_export(br.molecules(spark, sf_dir), br.atoms(spark, sf_dir, with_z=False),
                      property_cols=["energy_hartree"])
    return n.select("unique_id", F.size("elements").cast("long").alias("n_elements"),
                    F.array_join("elements", "").alias("elements"),
                    F.size("xyz_flat").cast("long").alias("n_xyz_flat"),
                    rk(F.aggregate("xyz_flat", F.lit(0.0), lambda acc, v: acc + v), 6).alias("xyz_sum"),
                    rk(F.col("property_energy_hartree"), 6).alias("property_energy_hartree"))


@register("combine_stream", """
SELECT lpad(CAST(o_orderkey AS VARCHAR), 8, '0') AS unique_id, o_orderstatus AS smiles,
       CAST(printf('%.4f', -o_totalprice / 100.0) AS DOUBLE) AS homo,
       CASE WHEN k % 2 = 1 THEN 'say "' || o_orderstatus || '", then' || chr(10) || '  1 2, end' END AS note,
       CASE WHEN k % 2 = 0 THEN CAST(printf('%.4f', o_totalprice / 10.0) AS DOUBLE) END AS esp_min,
       CASE WHEN k % 2 = 0 THEN CAST(o_custkey AS DOUBLE) END AS code,
       'batch_' || CAST(k AS VARCHAR) AS batch_id
FROM (SELECT *, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS k FROM orders) t""")
def q_combine_stream(spark, sf_dir):
    """Batch files with different headers picked up by a file stream in two
    runs (each file once, state in the checkpoint folder), merged per epoch."""
    import uuid
    from molspark.session import scratch_path
    from molspark.streaming.combine import combine_stream
    root = scratch_path(spark, f"stream-{uuid.uuid4().hex[:12]}")
    schema = "unique_id string, smiles string, homo double, note string, esp_min double, code double"
    for batches in ((1, 2), (3, 4, 5)):
        write_bridge_batches(spark, sf_dir, f"{root}/in", batches)
        combine_stream(spark, f"{root}/in", "molecule_property.csv", schema, f"{root}/merged",
                       f"{root}/_stream_checkpoint")
    return spark.read.parquet(f"{root}/merged").drop("epoch")
