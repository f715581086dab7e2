"""Energetics: combustion heat (A3/A4), fluoride BDE (A33), thermo.

Combustion heat needs only per-molecule element counts, so the whole atom
table is reduced by one map-side-combined aggregation before anything is
shuffled; the 16-row element table enters as literals (it is a fixed
dimension), which keeps the formula inside generated code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from molspark.functions.units import HARTREE_EV
from molspark.operators.batches import group_rank
from molspark.operators.composition import count_col, element_counts, hill_formula
from molspark.refdata import DEFAULT_ENERGY_COLUMN, ENERGY_COLUMNS, element_ref_rows
from molspark.session import ensure_checkpoint_dir

HALOGENS = ("F", "Cl", "Br", "I")
# FIXED VALUE: fluoride anion energy (hartree) used when none is supplied.
F_ANION_ENERGY_HARTREE = -99.96280459477289


def _ref_table(energy_col: str) -> list[dict]:
    if energy_col not in ENERGY_COLUMNS:
        raise NotImplementedError(f'Energy column "{energy_col}" is not in the element table.')
    k = ENERGY_COLUMNS.index(energy_col)
    out = []
    for r in element_ref_rows():
        out.append(dict(ord=r[0], element=r[1], product=r[2], o2=r[3], ratio=r[4],
                        energy=r[5 + k]))
    return out


def combustion_heat(molecules: DataFrame, atoms: DataFrame,
                    energy_col: str = DEFAULT_ENERGY_COLUMN,
                    mol_energy_col: str = "energy_ev", smiles_col: str | None = "smiles",
                    key: str = "unique_id") -> DataFrame:
    """Heat of combustion (eV) and reaction text for every molecule.

    Rules, per molecule: an element outside the table gives 0.0 and '';
    halogens at least as many as a non-zero H count give 0.0 and ''; H is
    reduced by the halogen count (it may go negative when there is no H);
    oxygen demand <= 0 gives 0.0 and ''; otherwise
    heat = sum(n * ratio * E_product) - (E_mol + demand/2 * E_O2), products with
    no energy skipped. A missing molecule energy counts as 0.0.

    Output: molecules columns + ``combustion_heat_ev``, ``combustion_reaction``,
    ``combustion_status`` and the formula used when SMILES is absent.
    """
    ref = _ref_table(energy_col)
    by_el = {r["element"]: r for r in ref}
    counts = element_counts(atoms, key=key)
    n = {r["element"]: F.col(count_col(r["element"])) for r in ref}
    hal = sum((n[h] for h in HALOGENS), F.lit(0))
    n_eff = dict(n)
    n_eff["H"] = n["H"] - hal
    demand = sum((n_eff[e] * F.lit(by_el[e]["o2"]) for e in n_eff), F.lit(0.0))
    products = sum((n_eff[e] * F.lit(by_el[e]["ratio"] * by_el[e]["energy"])
                    for e in n_eff if by_el[e]["energy"] is not None), F.lit(0.0))
    e_o2 = by_el["O"]["energy"]

    m = molecules.join(counts, key, "left")
    mol_e = F.coalesce(F.col(mol_energy_col), F.lit(0.0)) if mol_energy_col in molecules.columns \
        else F.lit(0.0)
    heat = products - (mol_e + demand / F.lit(2.0) * F.lit(e_o2))

    status = (F.when(F.col("num_atoms").isNull(), F.lit("no_atoms"))
              .when(F.col("n_unsupported") > 0, F.lit("unsupported_element"))
              .when((n["H"] != 0) & (hal >= n["H"]), F.lit("nonflammable_halogen"))
              .when(demand <= 0, F.lit("nonflammable"))
              .otherwise(F.lit("ok")))

    formula = hill_formula()
    if smiles_col and smiles_col in molecules.columns:
        name = F.coalesce(F.nullif(F.trim(F.col(smiles_col)), F.lit("")), formula)
    else:
        name = formula
    terms = [F.when(n_eff[r["element"]] * F.lit(r["ratio"]) > 0,
                    F.format_string("%.2f * %s", n_eff[r["element"]] * F.lit(r["ratio"]),
                                    F.lit(r["product"])))
             for r in ref]
    reaction = F.concat(F.lit("1.00 * "), name, F.lit(" + "),
                        F.format_string("%.2f", demand / F.lit(2.0)), F.lit(" * O2 -> "),
                        F.concat_ws(" + ", *terms))
    ok = status == "ok"
    return (m.withColumn("combustion_status", status)
             .withColumn("combustion_heat_ev", F.when(ok, heat).otherwise(F.lit(0.0)))
             .withColumn("combustion_reaction", F.when(ok, reaction).otherwise(F.lit("")))
             .withColumn("formula", formula)
             .drop(*[count_col(r["element"]) for r in ref], "n_unsupported"))


def fluoride_bde(parents: DataFrame, children: DataFrame,
                 e_f_anion_hartree: float = F_ANION_ENERGY_HARTREE,
                 energy_col: str = "energy_hartree", key: str = "unique_id") -> DataFrame:
    """``(E_child + E_F- - E_parent) * Eh`` for parents paired with their
    defluorinated child (J9: child id = parent id + '_defluorined').

    A parent without an energy gets a null BDE and status ``missing_energy``
    (the reference raises)."""
    p = parents.select(F.col(key), F.col(energy_col).alias("_e_parent"))
    c = children.select(F.col(key).alias("child_id"), F.col(energy_col).alias("_e_child"))
    j = p.join(c, F.concat(p[key], F.lit("_defluorined")) == c["child_id"], "left")
    bde = (F.col("_e_child") + F.lit(e_f_anion_hartree) - F.col("_e_parent")) * F.lit(HARTREE_EV)
    return j.select(
        key, "child_id", bde.alias("fluoride_bde_ev"),
        F.when(F.col("_e_parent").isNull(), "missing_energy")
         .when(F.col("_e_child").isNull(), "missing_child").otherwise("ok").alias("bde_status"))


def bde_eligible(molecules: DataFrame, atoms: DataFrame, key: str = "unique_id",
                 charge_col: str = "charge") -> DataFrame:
    """Molecules that contain fluorine and have charge <= 0."""
    f_ids = atoms.filter(F.col("element") == "F").select(key)
    return molecules.filter(F.coalesce(F.col(charge_col), F.lit(0)) <= 0).join(
        f_ids, key, "left_semi")


def fluorine_bonds(bonds: DataFrame, atoms: DataFrame, sulfur_only: bool = False,
                   key: str = "unique_id") -> DataFrame:
    """P16 + J10: bonds with an F end, with both elements and the bond length.

    ``f_idx`` is the begin atom when it is F, else the end atom; ``partner``
    is the other element."""
    a_i = atoms.select(key, F.col("atom_idx").alias("i"), F.col("element").alias("el_i"),
                       F.col("x").alias("xi"), F.col("y").alias("yi"), F.col("z").alias("zi"))
    a_j = atoms.select(key, F.col("atom_idx").alias("j"), F.col("element").alias("el_j"),
                       F.col("x").alias("xj"), F.col("y").alias("yj"), F.col("z").alias("zj"))
    b = bonds.join(a_i, [key, "i"]).join(a_j, [key, "j"])
    b = b.filter((F.col("el_i") == "F") | (F.col("el_j") == "F"))
    if sulfur_only:
        b = b.filter(((F.col("el_i") == "S") & (F.col("el_j") == "F"))
                     | ((F.col("el_j") == "S") & (F.col("el_i") == "F")))
    dx, dy, dz = F.col("xj") - F.col("xi"), F.col("yj") - F.col("yi"), F.col("zj") - F.col("zi")
    return b.select(
        key, "bond_idx", "i", "j", "el_i", "el_j",
        F.sqrt(dx * dx + dy * dy + dz * dz).alias("length"),
        F.when(F.col("el_i") == "F", F.col("i")).otherwise(F.col("j")).alias("f_idx"),
        F.when(F.col("el_i") == "F", F.col("el_j")).otherwise(F.col("el_i")).alias("partner"))


def longest_bond(bonds_with_length: DataFrame, key: str = "unique_id") -> DataFrame:
    """The longest bond per molecule; the first bond (lowest bond_idx)
    wins ties. ``max_by`` over a (length, -bond_idx) struct keeps it a plain
    aggregate: partial aggregation, no per-molecule sort."""
    cols = [c for c in bonds_with_length.columns if c != key]
    order = F.struct(F.col("length"), (-F.col("bond_idx")).alias("nb"))
    best = F.max_by(F.struct(*[F.col(c) for c in cols]), order).alias("_best")
    return bonds_with_length.groupBy(key).agg(best).select(key, "_best.*")


def defluorinate(molecules: DataFrame, atoms: DataFrame, bonds: DataFrame,
                 sulfur_only: bool = False, key: str = "unique_id"):
    """Children of BDE-eligible parents: the longest F bond is broken and that
    F atom removed; atoms above it shift down by one (W9); the child gets
    charge + 1, the parent's multiplicity and id ``<id>_defluorined``; the
    parent's index of the removed atom is kept as ``removed_atom_idx``. Energies
    are the parent's and don't go to the child; ``num_atoms`` is one less.

    Returns ``(child_molecules, child_atoms)``."""
    elig = bde_eligible(molecules, atoms, key)
    fb = fluorine_bonds(bonds, atoms, sulfur_only, key).join(elig.select(key), key, "left_semi")
    victim = longest_bond(fb, key).select(key, "f_idx", F.col("partner").alias("old_f_bonded_atom"))
    # one row per eligible molecule, read by both outputs and their
    # consumers: materialise it once (shared checkpoint folder) instead of
    # re-running the bond joins per reader
    ensure_checkpoint_dir(molecules.sparkSession)
    victim = victim.checkpoint(eager=True)
    child_atoms = (atoms.join(victim, key)
                   .filter(F.col("atom_idx") != F.col("f_idx"))
                   .withColumn("atom_idx", F.when(F.col("atom_idx") > F.col("f_idx"),
                                                  F.col("atom_idx") - 1)
                               .otherwise(F.col("atom_idx")))
                   .withColumn(key, F.concat(F.col(key), F.lit("_defluorined")))
                   .drop("f_idx", "old_f_bonded_atom"))
    fewer = {"num_atoms": F.col("num_atoms") - 1}
    if "num_atoms" in child_atoms.columns:
        child_atoms = child_atoms.withColumns(fewer)
    keep = [c for c in elig.columns if c != "charge" and not c.startswith(("energy", "triton_energy"))]
    if "num_atoms" in keep:
        elig = elig.withColumns(fewer)
    child_mols = (elig.select(*keep, (F.col("charge") + 1).alias("charge"))
                  .join(victim, key)
                  .withColumn("parent_id", F.col(key))
                  .withColumn(key, F.concat(F.col(key), F.lit("_defluorined")))
                  .withColumnRenamed("f_idx", "removed_atom_idx"))
    return child_mols, child_atoms


def thermo_to_ev(thermo: DataFrame, quantities=("ZPE", "E_0K", "E_tot", "H_tot", "G_tot"),
                 key: str = "unique_id", name_col: str = "quantity",
                 value_col: str = "value_hartree") -> DataFrame:
    """Long (id, quantity, value in hartree) -> wide ``<q>_eV`` columns;
    ``Cv_tot`` keeps its unit and is passed through unconverted."""
    wanted = list(quantities) + ["Cv_tot"]
    t = thermo.filter(F.col(name_col).isin(*wanted))
    aggs = [F.max(F.when(F.col(name_col) == q, F.col(value_col) * F.lit(HARTREE_EV)))
            .alias(f"{q}_eV") for q in quantities]
    aggs.append(F.max(F.when(F.col(name_col) == "Cv_tot", F.col(value_col))).alias("Cv_tot"))
    return t.groupBy(key).agg(*aggs)


def thermo_gate(frequencies: DataFrame, thermo: DataFrame, key: str = "unique_id",
                freq_col: str = "frequency") -> DataFrame:
    """P20: drop thermochemistry rows of molecules with any negative frequency."""
    bad = frequencies.filter(F.col(freq_col) < 0).select(key)
    return thermo.join(bad, key, "left_anti")


def rank_conformers(conformers: DataFrame, energy_col: str = "energy_kcal",
                    order_cols=("conf_id",), key: str = "unique_id") -> DataFrame:
    """Rank conformers by energy ascending (stable on ``order_cols``). The
    rank comes from a range-partitioned sort, so a molecule with a large share
    of all conformers is spread over many tasks."""
    ranked = group_rank(conformers, [key], [energy_col, *order_cols], out="conf_rank")
    return ranked.withColumn("conf_rank", F.col("conf_rank") + 1)


def lowest_conformer(conformers: DataFrame, energy_col: str = "energy_kcal",
                     order_cols=("conf_id",), key: str = "unique_id") -> DataFrame:
    """W6 keep-lowest as one aggregate: ``min_by`` on (energy, order columns).
    No per-molecule sort, partial aggregation before the shuffle."""
    cols = [c for c in conformers.columns if c != key]
    order = F.struct(F.col(energy_col), *[F.col(c) for c in order_cols])
    return (conformers.groupBy(key)
            .agg(F.min_by(F.struct(*[F.col(c) for c in cols]), order).alias("_b"),
                 F.count(F.lit(1)).cast("long").alias("num_conformers"))
            .select(key, "_b.*", "num_conformers"))


def last_step(trajectory: DataFrame, step_cols=("step",), key: str = "unique_id") -> DataFrame:
    """Final row of each trajectory (largest step) as one aggregate."""
    cols = [c for c in trajectory.columns if c != key]
    order = F.struct(*[F.col(c) for c in step_cols])
    return (trajectory.groupBy(key)
            .agg(F.max_by(F.struct(*[F.col(c) for c in cols]), order).alias("_l"),
                 F.count(F.lit(1)).cast("long").alias("num_steps"))
            .select(key, "_l.*", "num_steps"))
