"""Unit constants and conversions (F2) as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# FIXED VALUES: physical constants (CODATA 2022 hartree in eV; Bohr radius in
# angstrom; Coulomb constant e^2/(4 pi eps0) in eV*angstrom; e*angstrom in debye).
HARTREE_EV = 27.211386245981
BOHR_ANGSTROM = 0.529177210544
ANGSTROM_TO_BOHR = 1.0 / BOHR_ANGSTROM
COULOMB_EV_ANGSTROM = HARTREE_EV * BOHR_ANGSTROM
EANG_TO_DEBYE = 4.80320471


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hartree_to_ev(c) -> Column:
    return _c(c) * F.lit(HARTREE_EV)


def ev_to_hartree(c) -> Column:
    return _c(c) / F.lit(HARTREE_EV)


def angstrom_to_bohr(c) -> Column:
    return _c(c) * F.lit(ANGSTROM_TO_BOHR)


def bohr_to_angstrom(c) -> Column:
    return _c(c) * F.lit(BOHR_ANGSTROM)
