"""Per-molecule composition: element counts, atom counts, formula, parity.

Every function aggregates the long ``atoms`` table (one row per atom) by
``unique_id`` with a single hash aggregate. Spark combines map-side first, so
a molecule with millions of atoms reaches the shuffle as one partial row per
map task: hot molecules do not overload a reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from molspark.refdata import ELEMENT_VOCAB


def count_col(element: str) -> str:
    return f"n_{element}"


def element_counts(atoms: DataFrame, vocab: Sequence[str] = ELEMENT_VOCAB,
                   key: str = "unique_id") -> DataFrame:
    """A1 + A2: one row per molecule with ``n_<El>`` for every vocabulary
    element (zeros kept), ``num_atoms`` and ``n_unsupported`` (atoms whose
    element is outside the vocabulary)."""
    el = F.col("element")
    aggs = [F.count_if(el == e).cast("long").alias(count_col(e)) for e in vocab]
    aggs.append(F.count(F.lit(1)).cast("long").alias("num_atoms"))
    aggs.append(F.count_if(~el.isin(*vocab) | el.isNull()).cast("long").alias("n_unsupported"))
    return atoms.groupBy(key).agg(*aggs)


def atom_counts(atoms: DataFrame, key: str = "unique_id") -> DataFrame:
    """A2: number of atoms per molecule."""
    return atoms.groupBy(key).agg(F.count(F.lit(1)).cast("long").alias("num_atoms"))


def distinct_ids(atoms: DataFrame, key: str = "unique_id") -> DataFrame:
    """The distinct molecule ids of a long table."""
    return atoms.select(key).distinct()


def hill_formula(vocab: Sequence[str] = ELEMENT_VOCAB) -> Column:
    """Molecular formula in Hill order from ``n_<El>`` columns: C first and H
    second when carbon is present, otherwise every element alphabetically."""
    def part(e: str) -> Column:
        n = F.col(count_col(e))
        return F.when(n > 0, F.concat(F.lit(e), F.when(n > 1, n.cast("string"))
                                                  .otherwise(F.lit(""))))
    others = sorted(e for e in vocab if e not in ("C", "H"))
    with_c = F.concat_ws("", part("C"), part("H"), *[part(e) for e in others])
    no_c = F.concat_ws("", *[part(e) for e in sorted(vocab)])
    return F.when(F.col(count_col("C")) > 0, with_c).otherwise(no_c)


def unpaired_electrons(molecules: DataFrame, atoms: DataFrame,
                       key: str = "unique_id", charge_col: str = "charge") -> DataFrame:
    """A5: ``(sum(Z mod 2) - charge mod 2) mod 2`` with non-negative modulo.

    Returns molecules with ``unpaired_electrons`` and ``multiplicity`` = 1 +
    parity. Parity is summed per atom before the shuffle (map-side combine)."""
    par = atoms.groupBy(key).agg(F.sum(F.pmod(F.col("z_num"), F.lit(2))).alias("_zpar"))
    m = molecules.join(par, key, "left")
    parity = F.pmod(F.coalesce(F.col("_zpar"), F.lit(0))
                    - F.pmod(F.coalesce(F.col(charge_col), F.lit(0)), F.lit(2)), F.lit(2))
    return (m.withColumn("unpaired_electrons", parity.cast("int"))
             .withColumn("multiplicity", (F.lit(1) + parity).cast("int"))
             .drop("_zpar"))


def radical_parity(atoms: DataFrame, radical_col: str = "num_radical_electrons",
                   key: str = "unique_id") -> DataFrame:
    """Sum of radical electrons per molecule, mod 2."""
    return atoms.groupBy(key).agg(
        F.pmod(F.sum(F.col(radical_col)), F.lit(2)).cast("int").alias("radical_parity"),
        F.sum(F.col(radical_col)).cast("long").alias("num_radical_electrons"))


def total_charge(atoms: DataFrame, charge_col: str = "charge", key: str = "unique_id") -> DataFrame:
    """Molecular charge = half-even rounded sum of partial charges."""
    return atoms.groupBy(key).agg(
        F.bround(F.sum(F.col(charge_col)), 0).cast("int").alias("total_charge"))


def molecule_sum(atoms: DataFrame, col: str, out: str | None = None,
                 key: str = "unique_id") -> DataFrame:
    """Per-molecule sum of an atom column."""
    return atoms.groupBy(key).agg(F.sum(F.col(col)).alias(out or f"sum_{col}"))


def atomic_shift_sum(atoms: DataFrame, shifts: DataFrame, value_col: str | None = None,
                     out: str = "energy_shifted", key: str = "unique_id") -> DataFrame:
    """Add a per-element shift (``shifts(element, shift)``, one row per
    element, so bounded by the periodic table) to each atom and sum per
    molecule. Without ``value_col`` the result is the sum of shifts."""
    j = atoms.join(F.broadcast(shifts.select("element", "shift")), "element", "left")
    v = F.coalesce(F.col("shift"), F.lit(0.0))
    if value_col:
        v = F.col(value_col) + v
    return j.groupBy(key).agg(F.sum(v).alias(out))
