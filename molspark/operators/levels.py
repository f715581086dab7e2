"""Frontier orbital levels from a long ``orbitals`` table.

``orbitals(unique_id, spin, orb_idx, energy [hartree], occ)``; closed-shell
molecules have a single spin channel (0), open-shell ones two (0, 1). Every
rule is a plain aggregation with ``max_by``/``min_by`` on the orbital index,
so no per-molecule sort is needed and partial aggregation applies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from molspark.functions.units import HARTREE_EV


def _per_spin(orbitals: DataFrame, key: str) -> DataFrame:
    occ, idx, e = F.col("occ"), F.col("orb_idx"), F.col("energy")
    return orbitals.groupBy(key, "spin").agg(
        F.max_by(e, F.when(occ > 0, idx)).alias("homo"),
        F.min_by(e, F.when(occ == 0, idx)).alias("lumo"))


def frontier_levels(orbitals: DataFrame, key: str = "unique_id") -> DataFrame:
    """A29 + A30: HOMO = last occupied orbital by index, LUMO = first empty
    one, per spin; for two spins the higher HOMO and the lower LUMO. eV."""
    s = _per_spin(orbitals, key)
    return s.groupBy(key).agg(
        (F.max("homo") * F.lit(HARTREE_EV)).alias("homo_ev"),
        (F.min("lumo") * F.lit(HARTREE_EV)).alias("lumo_ev"),
        F.count(F.lit(1)).cast("int").alias("n_spin"))


def frontier_levels_avg(orbitals: DataFrame, key: str = "unique_id") -> DataFrame:
    """Mean of the alpha and beta frontier levels; null for closed shell."""
    s = _per_spin(orbitals, key)
    two = F.count(F.lit(1)) == 2
    return s.groupBy(key).agg(
        F.when(two, F.avg("homo") * F.lit(HARTREE_EV)).alias("homo_avg_ev"),
        F.when(two, F.avg("lumo") * F.lit(HARTREE_EV)).alias("lumo_avg_ev"))


def frontier_levels_effective(orbitals: DataFrame, homo_threshold: float = 1.0,
                              lumo_threshold: float = 1.0, key: str = "unique_id") -> DataFrame:
    """Spins paired on orbital index; total occupancy >= homo_threshold
    marks HOMO candidates (last one wins, level = lower of the two spin
    energies), total < lumo_threshold marks LUMO candidates (first one wins,
    level = higher of the two). Only indices present in both spins count;
    closed-shell molecules get nulls."""
    sp, e, occ = F.col("spin"), F.col("energy"), F.col("occ")
    paired = orbitals.groupBy(key, "orb_idx").agg(
        F.max(F.when(sp == 0, e)).alias("e_a"), F.max(F.when(sp == 1, e)).alias("e_b"),
        F.max(F.when(sp == 0, occ)).alias("o_a"), F.max(F.when(sp == 1, occ)).alias("o_b"))
    paired = paired.filter(F.col("e_a").isNotNull() & F.col("e_b").isNotNull())
    tot = F.col("o_a") + F.col("o_b")
    idx = F.col("orb_idx")
    out = paired.groupBy(key).agg(
        F.max_by(F.least("e_a", "e_b"), F.when(tot >= homo_threshold, idx)).alias("_h"),
        F.min_by(F.greatest("e_a", "e_b"), F.when(tot < lumo_threshold, idx)).alias("_l"))
    return out.select(key, (F.col("_h") * F.lit(HARTREE_EV)).alias("homo_eff_ev"),
                      (F.col("_l") * F.lit(HARTREE_EV)).alias("lumo_eff_ev"))
