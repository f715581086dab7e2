"""Deterministic molecule ids (F1) and element lookups."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from molspark.refdata import CHEMICAL_SYMBOLS

ID_LENGTH = 16


def molecule_id(*key_cols) -> Column:
    """a 16-digit decimal id derived from the row content (stable under
    task retries, unlike a random UUID). 56 bits of SHA-256 give 16-17
    decimal digits; the first 16 are kept and left-padded. Use the full hash
    (``molecule_key``) as the join key at large scale: 16 digits collide by
    the birthday bound near 1e8 rows."""
    h = molecule_key(*key_cols)
    dec = F.conv(F.substring(h, 1, 14), 16, 10)
    return F.lpad(F.substring(dec, 1, ID_LENGTH), ID_LENGTH, "0")


def molecule_key(*key_cols) -> Column:
    cols = [F.col(c) if isinstance(c, str) else c for c in key_cols]
    return F.sha2(F.concat_ws("\u0001", *[F.coalesce(c.cast("string"), F.lit("")) for c in cols]), 256)


def _symbol_map() -> Column:
    pairs = []
    for z, s in enumerate(CHEMICAL_SYMBOLS):
        pairs += [F.lit(s), F.lit(z)]
    return F.create_map(*pairs)


def symbol_to_z(c) -> Column:
    """element symbol -> atomic number (null when unknown)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.try_element_at(_symbol_map(), c)


def z_to_symbol(c) -> Column:
    """atomic number -> element symbol."""
    c = F.col(c) if isinstance(c, str) else c
    arr = F.array(*[F.lit(s) for s in CHEMICAL_SYMBOLS])
    return F.when((c >= 0) & (c < len(CHEMICAL_SYMBOLS)), F.element_at(arr, (c + 1).cast("int")))
