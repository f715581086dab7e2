"""Text helpers: SMILES features (F14) and fixed-width XYZ lines (F16)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from molspark.operators.qc import formal_charge, has_fragments


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(col) -> Column:
    """Text without white space at both ends: tabs, line ends and Unicode
    spaces as well as blanks. Most texts begin and end with a printable ASCII
    character and are not searched."""
    c = _c(col)
    ends = F.ascii(c).between(33, 126) & F.ascii(F.right(c, F.lit(1))).between(33, 126)
    return F.when(ends, c).otherwise(F.regexp_replace(c, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", ""))


def smiles_features(col) -> Column:
    """structure flags read from SMILES text (no toolkit): bracket atom
    count, formal charge, heavy-atom count (organic-subset and bracket atoms
    other than H), fragment count, and whether stereo marks are present."""
    s = _c(col)
    brackets = F.regexp_extract_all(s, F.lit(r"(\[[^\]]*\])"), 1)
    no_br = F.regexp_replace(s, r"\[[^\]]*\]", "")
    organic = F.regexp_extract_all(no_br, F.lit(r"(Br|Cl|[BCNOPSFI]|[bcnops])"), 1)
    heavy_br = F.filter(brackets, lambda b: ~b.rlike(r"^\[[0-9]*H[^a-z]"))
    return F.struct(
        F.size(brackets).alias("n_bracket_atoms"),
        formal_charge(s).alias("formal_charge"),
        (F.size(organic) + F.size(heavy_br)).alias("n_heavy_atoms"),
        F.size(F.split(s, r"\.")).alias("n_fragments"),
        ((F.instr(s, "@") > 0) | s.rlike(r"[/\\]")).alias("has_stereo"),
        has_fragments(s).alias("fragmented"))


def xyz_line(element, x, y, z, *extra) -> Column:
    """F16: ``%-2s %15.6f %15.6f %15.6f`` plus ``%15.6f`` per extra column.
    Java rounds exact decimal ties up where C rounds to even; only exact
    ties at the sixth decimal can differ."""
    fmt = "%-2s %15.6f %15.6f %15.6f" + " %15.6f" * len(extra)
    return F.format_string(fmt, _c(element), _c(x), _c(y), _c(z), *[_c(e) for e in extra])
