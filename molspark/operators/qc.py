"""Validation and quality-control rules (P1-P26) as column expressions.

Each rule yields a reason string (null = pass); a chain of rules is one
``coalesce`` so the first failing rule wins, and splitting into kept rows
and failure rows is two filters over the same plan.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# FIXED VALUES: the characters a SMILES string may consist of (comment
# sniffing rule) and the column names accepted for SMILES, in priority order.
SMILES_CHARS_PATTERN = r"^[A-Za-z0-9\[\]()=#\-+@/\\%.]+$"
SMILES_COLUMN_ALIASES = ("smiles", "Smiles", "SMILES", "canonical_smiles", "smile", "SMILE",
                         "canonical_smile", "smi", "CANONICAL SMILES", "CANONICAL_SMILES")

# Lexical SMILES tokens: bracket atoms, two-letter organic-subset atoms,
# one-letter atoms (aromatic lower case too), bonds, branches, ring closures,
# dot-disconnection.
_TOKEN = (r"\[[^\[\]]+\]|Br|Cl|[BCNOPSFI]|[bcnops]|[=#$:/\\.\-]|[()]|%[0-9]{2}|[0-9]")
# Superset of the token alphabet outside brackets (Br/Cl letters included):
# failing it proves an unknown token without building the residue.
_TOKEN_CHARS = r"^(?:\[[^\[\]]+\]|[BCNOPSFIbcnopsrl=#$:/\\.\-()%0-9])+$"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def resolve_smiles_column(columns: Iterable[str]) -> str:
    """First alias present, in priority order (case-sensitive)."""
    cols = list(columns)
    for name in SMILES_COLUMN_ALIASES:
        if name in cols:
            return name
    raise ValueError(f"No SMILES column found; expected one of {SMILES_COLUMN_ALIASES}")


def require_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Fail early when required columns are missing."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
    return df


def drop_empty(df: DataFrame, col: str = "smiles") -> DataFrame:
    """Drop null and empty values (pushed down to Parquet scans)."""
    return df.filter(F.col(col).isNotNull() & (F.col(col) != ""))


def looks_like_smiles(col) -> Column:
    """Non-empty after trim and only SMILES characters."""
    t = F.trim(_c(col))
    return (F.length(t) > 0) & t.rlike(SMILES_CHARS_PATTERN)


def formal_charge(col) -> Column:
    """Sum of formal charges written in bracket atoms (``[N+]``,
    ``[O-]``, ``[Fe+3]``, ``[O--]``)."""
    brackets = F.regexp_extract_all(_c(col), F.lit(r"(\[[^\]]*\])"), 1)

    def one(b):
        num = F.regexp_extract(b, r"([+-])(\d+)\]$", 2)
        sign = F.regexp_extract(b, r"([+-]+)\d*\]$", 1)
        mag = F.when(num != "", num.cast("int")).otherwise(F.length(sign))
        return F.when(F.substring(sign, 1, 1) == "-", -mag).when(
            F.substring(sign, 1, 1) == "+", mag).otherwise(F.lit(0))
    return F.aggregate(F.transform(brackets, one), F.lit(0), lambda acc, v: acc + v)


def smiles_lexical_reason(col) -> Column:
    """P5: lexical validity (weaker than chemical sanitisation): only SMILES
    tokens, balanced brackets and parentheses, ring-closure digits paired.
    Returns null when the text passes, otherwise the reason
    (``unknown_token`` alone when a character outside every token occurs,
    ``unknown_token: <rest>`` with the uncovered text otherwise)."""
    s = _c(col)
    residue = F.regexp_replace(s, _TOKEN, "")
    opens = F.length(s) - F.length(F.regexp_replace(s, r"\(", ""))
    closes = F.length(s) - F.length(F.regexp_replace(s, r"\)", ""))
    # ring closures: digits outside bracket atoms, each label used an even number of times
    no_brackets = F.regexp_replace(s, r"\[[^\]]*\]", "")
    labels = F.regexp_extract_all(no_brackets, F.lit(r"(%[0-9]{2}|[0-9])"), 1)
    odd_label = F.exists(F.array_distinct(labels),
                         lambda lab: F.size(F.filter(labels, lambda x: x == lab)) % 2 == 1)
    # a branch may never close before it opens: running depth >= 0
    chars = F.split(F.regexp_replace(s, r"[^()]", ""), "")
    depth_ok = F.aggregate(
        chars, F.struct(F.lit(0).alias("d"), F.lit(True).alias("ok")),
        lambda acc, ch: F.struct(
            (acc["d"] + F.when(ch == "(", 1).when(ch == ")", -1).otherwise(0)).alias("d"),
            (acc["ok"] & ((acc["d"] + F.when(ch == "(", 1).when(ch == ")", -1).otherwise(0)) >= 0))
            .alias("ok")))["ok"]
    return (F.when(s.isNull() | (F.trim(s) == ""), F.lit("empty"))
            .when(~looks_like_smiles(s), F.lit("bad_characters"))
            # cheap necessary test first: a character no token can use
            .when(~s.rlike(_TOKEN_CHARS), F.lit("unknown_token"))
            .when(F.length(residue) > 0, F.concat(F.lit("unknown_token: "), residue))
            .when((opens != closes) | ~depth_ok, F.lit("unbalanced_parentheses"))
            .when(odd_label, F.lit("unpaired_ring_closure")))


def has_fragments(col) -> Column:
    """P10 (text form): more than one component ('.' present)."""
    return F.instr(_c(col), ".") > 0


def validate_inputs(df: DataFrame, smiles_col: str = "smiles",
                    require_any: bool = False) -> tuple[DataFrame, DataFrame]:
    """Split into (valid, failures) with the first failing reason:
    invalid SMILES, then non-zero formal charge, then an open shell (an
    ``unpaired_electrons`` column, where there is one, that is odd). Failures
    carry ``stage='validate'`` and ``reason``. With ``require_any`` an input
    without any valid row is an error."""
    s = F.col(smiles_col)
    ch = formal_charge(s)
    reason = F.coalesce(
        F.concat(F.lit("invalid SMILES: "), smiles_lexical_reason(s)),
        F.when(ch != 0, F.concat(F.lit("charged molecule: charge = "), ch.cast("string"))),
        F.when(F.pmod("unpaired_electrons", F.lit(2)) != 0,
               F.concat(F.lit("open shell: num_unpaired_electron = "), F.col("unpaired_electrons").cast("string")))
        if "unpaired_electrons" in df.columns else F.lit(None).cast("string"))
    tagged = df.withColumn("_reason", reason)
    ok = tagged.filter(F.col("_reason").isNull()).drop("_reason")
    bad = tagged.filter(F.col("_reason").isNotNull()).select(
        F.lit("validate").alias("stage"), "*").withColumnRenamed("_reason", "reason")
    if require_any and ok.isEmpty():
        raise ValueError("no valid SMILES found")
    return ok, bad


def closed_shell(molecules_with_parity: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(closed shell, open shell) by ``unpaired_electrons`` (A5)."""
    m = molecules_with_parity
    return (m.filter(F.col("unpaired_electrons") == 0),
            m.filter(F.col("unpaired_electrons") != 0))


def bond_length_qc(bond_lengths: DataFrame, lo: float = 0.5, hi: float = 3.5,
                   key: str = "unique_id") -> DataFrame:
    """Per molecule, the sorted list of bond lengths outside [lo, hi]
    and a reason when there is any."""
    ln = F.col("length")
    bad = (ln < lo) | (ln > hi)
    agg = bond_lengths.groupBy(key).agg(
        F.sort_array(F.collect_list(F.when(bad, F.round(ln, 4)))).alias("bad_lengths"),
        F.count_if(bad).cast("long").alias("n_bad_bonds"))
    return agg.withColumn("bond_reason", F.when(
        F.col("n_bad_bonds") > 0,
        F.concat(F.lit("bond length out of range: "), F.array_join(
            F.transform("bad_lengths", lambda v: v.cast("string")), ", "))))


def sanitize(molecules: DataFrame, bond_qc: DataFrame | None = None,
             smiles_col: str | None = "canonical_smiles", radical_col: str | None = None,
             key: str = "unique_id") -> tuple[DataFrame, DataFrame, DataFrame]:
    """P12 + K12: ordered rule chain, first failure wins: invalid -> bond
    lengths -> fragments -> radicals. Returns (kept, radicals side output,
    failures)."""
    m = molecules
    if bond_qc is not None:
        m = m.join(bond_qc.select(key, "bond_reason"), key, "left")
    invalid = F.when(F.col(smiles_col).isNull() | (F.trim(F.col(smiles_col)) == ""),
                     F.lit("invalid structure")) if smiles_col else F.lit(None).cast("string")
    bonds = F.col("bond_reason") if bond_qc is not None else F.lit(None).cast("string")
    frag = F.when(has_fragments(F.col(smiles_col)), F.lit("disconnected fragments")) \
        if smiles_col else F.lit(None).cast("string")
    reason = F.coalesce(invalid, bonds, frag)
    t = m.withColumn("reason", reason)
    failures = t.filter(F.col("reason").isNotNull()).withColumn("stage", F.lit("sanitize"))
    passed = t.filter(F.col("reason").isNull()).drop("reason")
    if bond_qc is not None:
        passed = passed.drop("bond_reason")
        failures = failures.drop("bond_reason")
    if radical_col:
        rad = passed.filter(F.col(radical_col) > 0)
        kept = passed.filter(~(F.col(radical_col) > 0) | F.col(radical_col).isNull())
    else:
        rad = passed.limit(0)
        kept = passed
    return kept, rad, failures


def split_converged(df: DataFrame, col: str = "converged") -> tuple[DataFrame, DataFrame]:
    """(converged is true, converged is false); null goes to neither."""
    return df.filter(F.col(col)), df.filter(~F.col(col))


def elements_in(atoms: DataFrame, allowed: Sequence[str], key: str = "unique_id") -> DataFrame:
    """Molecules with an element outside ``allowed`` and the offenders."""
    bad = atoms.filter(~F.col("element").isin(*allowed) | F.col("element").isNull())
    return bad.groupBy(key).agg(F.sort_array(F.collect_set("element")).alias("bad_elements"))


def clip(df: DataFrame, cols: Sequence[str], lo: float = -20.0, hi: float = 20.0) -> DataFrame:
    """Clamp columns into [lo, hi]; null and NaN pass through unchanged.
    ``<c>_clipped`` marks values strictly outside the range."""
    out = df
    for c in cols:
        v = F.col(c)
        valid = v.isNotNull() & ~F.isnan(v)
        out = out.withColumn(f"{c}_clipped", valid & ((v < lo) | (v > hi)))
        out = out.withColumn(c, F.when(valid, F.greatest(F.lit(lo), F.least(F.lit(hi), v)))
                             .otherwise(v))
    return out


def count_clipped(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """How many values each column had clipped."""
    return df.agg(*[F.count_if(F.col(f"{c}_clipped")).cast("long").alias(f"n_clipped_{c}")
                    for c in cols])


# FIXED VALUES: optional property names and the default selection.
PROPERTY_CHOICES = ("esp_range", "combustion_heat", "gradient", "chelpg_charge", "freq",
                    "vdw_volume", "polarizability", "fluoride_bde", "quadrupole")
DEFAULT_PROPERTIES = ("esp_range", "combustion_heat", "gradient", "chelpg_charge", "freq",
                      "vdw_volume", "polarizability")


def property_selection(props: Iterable[str] | None = None) -> list[str]:
    """Validate a property selection; unknown names are an error,
    duplicates removed, order kept; ``None`` gives the default set."""
    if props is None:
        return list(DEFAULT_PROPERTIES)
    out = []
    for p in props:
        if p not in PROPERTY_CHOICES:
            raise ValueError(f"Unknown property {p!r}; choose from {PROPERTY_CHOICES}")
        if p not in out:
            out.append(p)
    return out


def select_properties(df: DataFrame, props: Iterable[str] | None = None) -> DataFrame:
    """The table without the columns of properties that are not selected.
    A property's columns are those named like it or with it as a prefix
    (``esp_range`` also has ``esp_min``, ``esp_max``)."""
    stems = {p: {"esp_range": ("esp_min", "esp_max", "esp_range"), "freq": ("freq", "frequency")}.get(p, (p,))
             for p in PROPERTY_CHOICES}
    wanted = property_selection(props)
    off = tuple(s for p in PROPERTY_CHOICES if p not in wanted for s in stems[p])
    return df.select(*[F.col(f"`{c}`") for c in df.columns if not c.startswith(off)]) if off else df


# Names used by the two flows for the same quantity -> one canonical name.
CANONICAL_NAMES = {
    "homo_eV": "homo_ev", "lumo_eV": "lumo_ev", "homo": "homo_ev", "lumo": "lumo_ev",
    "esp_min_eV": "esp_min_ev", "esp_max_eV": "esp_max_ev", "esp_min": "esp_min_ev",
    "esp_max": "esp_max_ev", "combustion_heat_eV": "combustion_heat_ev",
    "fluoride_bde_eV": "fluoride_bde_ev",
}


def canonical_names(df: DataFrame, mapping: dict | None = None) -> DataFrame:
    """Rename flow-specific property names to the canonical ones; when
    both spellings exist they are merged with ``coalesce``."""
    mapping = mapping or CANONICAL_NAMES
    out = df
    for src, dst in mapping.items():
        if src not in out.columns:
            continue
        if dst in out.columns:
            out = out.withColumn(dst, F.coalesce(F.col(dst), F.col(src))).drop(src)
        else:
            out = out.withColumnRenamed(src, dst)
    return out


def level_string(functional, basis) -> Column:
    """``lower(functional_basis)`` with '-' removed."""
    return F.replace(F.lower(F.concat_ws("_", _c(functional), _c(basis))), F.lit("-"), F.lit(""))


def closed_shell_only(df: DataFrame, cols: Sequence[str], mult_col: str = "multiplicity") -> DataFrame:
    """Properties defined only for closed shell are nulled elsewhere."""
    return df.withColumns({c: F.when(F.col(mult_col) == 1, F.col(c)) for c in cols})


def flag_radicals(atoms: DataFrame, radical_col: str = "num_radical_electrons",
                  key: str = "unique_id") -> DataFrame:
    """Molecules with radical electrons (kept in a side output, K12),
    with their count."""
    per = atoms.groupBy(key).agg(F.sum(F.col(radical_col)).cast("long").alias("num_radical_electrons"))
    return per.filter(F.col("num_radical_electrons") > 0)


def check_manifest(manifest: DataFrame, inventory: DataFrame, buckets: DataFrame,
                   mode: str = "upload") -> tuple[DataFrame, DataFrame]:
    """Manifest rows against the object inventory. Uploads need the
    target key absent, downloads need it present; the bucket must exist.
    ``inventory(bucket, key)``, ``buckets(bucket)``. Returns (ok, failures
    with reason). The inventory is merged, never sent to every task: it grows
    with the stored objects, and its size in files says little of that in memory.
    The buckets are few and are sent, so that none of them is one task."""
    m = manifest.withColumn("_b_ok", F.lit(True))
    b = buckets.select("bucket").distinct().withColumn("_has_bucket", F.lit(True))
    inv = inventory.select("bucket", F.col("key").alias("remote_path")).distinct() \
        .withColumn("_exists", F.lit(True))
    j = m.join(F.broadcast(b), "bucket", "left").join(inv.hint("merge"), ["bucket", "remote_path"], "left")
    missing_bucket = F.col("_has_bucket").isNull()
    exists = F.coalesce(F.col("_exists"), F.lit(False))
    reason = (F.when(missing_bucket, F.lit("bucket does not exist"))
              .when(exists if mode == "upload" else ~exists,
                    F.lit("object already exists" if mode == "upload" else "object not found")))
    t = j.withColumn("reason", reason).drop("_b_ok", "_has_bucket", "_exists")
    return t.filter(F.col("reason").isNull()).drop("reason"), t.filter(F.col("reason").isNotNull())
