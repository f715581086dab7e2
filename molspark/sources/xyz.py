"""XYZ text ingest (S5-S10): files or a column of XYZ blocks -> molecules,
atoms and failures.

Parsing is narrow: each molecule is one row of text, split into lines and
tokens with array functions, so nothing is shuffled. ``atom_idx`` is the
line position (``posexplode``), which gives every later per-molecule
operator a dense, stable atom order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from molspark.functions.ids import molecule_id, symbol_to_z
from molspark.functions.text import strip as strip_text
from molspark.operators.qc import looks_like_smiles, smiles_lexical_reason

# FIXED VALUES: comment-line patterns of annotated XYZ files.
UID_PATTERN = r"unique_id:\s*(\S+)"
CHARGE_PATTERN = r"charge:\s*(-?\d+)"
MULT_PATTERN = r"multiplicity:\s*(\d+)"
ENERGY_PATTERN = r"energy_hartree:\s*([-+]?\d*\.?\d+(?:[eE][-+]?\d+)?)"


def _lines(text: Column, strip: bool) -> Column:
    t = F.replace(text, F.lit("\r"), F.lit(""))
    if strip:
        t = strip_text(t)
    return F.split(t, "\n")


def _atom_lines(lines: Column) -> Column:
    """Lines after the count and comment lines without white space at their ends,
    blank lines dropped."""
    body = F.slice(lines, 3, 1 << 30)  # to the end, as no text has as many lines
    return F.filter(F.transform(body, strip_text), lambda l: l != "")


def _words(text: Column) -> Column:
    """Runs of other characters than ASCII white space."""
    return F.regexp_extract_all(text, F.lit(r"\S+"), F.lit(0))


def _parity_multiplicity(elements: Column, charge: Column) -> Column:
    zs = F.transform(elements, lambda e: F.coalesce(symbol_to_z(e), F.lit(0)))
    zpar = F.aggregate(zs, F.lit(0), lambda acc, z: acc + F.pmod(z, F.lit(2)))
    return (F.lit(1) + F.pmod(zpar - F.pmod(charge, F.lit(2)), F.lit(2))).cast("int")


def parse_xyz(df: DataFrame, text_col: str = "text", mode: str = "annotated",
              charge_col_idx: int | None = None, id_col: str | None = None,
              infer_multiplicity: bool = False,
              carry: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Parse XYZ text, one molecule per row.

    ``mode``:
      * ``basic`` (S6): comment becomes the SMILES only if it looks like one;
        multiplicity = 1 + electron parity at charge 0.
      * ``annotated`` (S7): SMILES = text before ``unique_id:`` (only when the
        key is present); ``unique_id``, ``charge``, ``multiplicity`` and
        ``energy_hartree`` from the comment, defaults 0 / 1.
      * ``tokens`` (S8): first comment token is the SMILES when it passes the
        lexical check; ``charge:``, ``multiplicity:``, ``unique_id:`` tokens
        (last one wins). With ``charge_col_idx`` (S9, 0-based column of
        partial charges) rows with exactly 4 columns are skipped, a shorter
        row is an error, the total charge is the half-even rounded sum and the
        comment is then ignored.

    ``id_col`` overrides the id (file stem for directories). ``carry``
    copies molecule-level columns (e.g. ``charge``) onto every atom row, so a
    consumer that needs both levels can read the atom output alone (one
    parse instead of two). Returns ``(molecules, atoms, failures)``; a
    molecule with a malformed atom line goes to failures only."""
    strip = mode == "tokens"
    lines = _lines(F.col(text_col), strip)
    comment = F.coalesce(F.element_at("_lines", 2), F.lit(""))
    toks = F.transform(_atom_lines(F.col("_lines")), _words)
    bad_line = F.exists("_toks", lambda t: (F.size(t) < 4)
                        | F.element_at(t, 2).try_cast("double").isNull()
                        | F.element_at(t, 3).try_cast("double").isNull()
                        | F.element_at(t, 4).try_cast("double").isNull())
    elements = F.transform("_toks", lambda t: F.element_at(t, 1))
    keep = [c for c in df.columns if c != text_col]
    # Lines and tokens are split in generators of one row each, else every use of
    # them (filters among them) would split them again.
    told = _words(F.trim(comment)) if strip else F.lit(None)
    base = (df.select(*keep, F.col(text_col).alias("_text"), F.explode(F.array(lines)).alias("_lines"))
            .select(*keep, "_text", comment.alias("_comment"),
                    F.explode(F.array(F.struct(toks.alias("toks"), told.alias("told")))).alias("_split"))
            .select(*keep, "_text", "_comment", F.col("_split.toks").alias("_toks"), F.col("_split.told").alias("_told"))
            .select("*", bad_line.alias("_bad"), elements.alias("_els")))
    cm = F.col("_comment")
    gen_id = molecule_id(F.col("_text"))
    if mode == "basic":
        smiles = F.when(looks_like_smiles(cm), F.trim(cm)).otherwise(F.lit(""))
        uid = gen_id
        charge = F.lit(0)
        mult = _parity_multiplicity(F.col("_els"), F.lit(0))
        energy = F.lit(None).cast("double")
    elif mode == "annotated":
        t = F.trim(cm)
        smiles = F.when(F.instr(t, "unique_id:") > 0,
                        F.trim(F.substring_index(t, "unique_id:", 1))).otherwise(F.lit(""))
        uid = F.coalesce(F.nullif(F.regexp_extract(t, UID_PATTERN, 1), F.lit("")), gen_id)
        charge = F.coalesce(F.nullif(F.regexp_extract(t, CHARGE_PATTERN, 1), F.lit("")).cast("int"),
                            F.lit(0))
        mult = F.coalesce(F.nullif(F.regexp_extract(t, MULT_PATTERN, 1), F.lit("")).cast("int"),
                          _parity_multiplicity(F.col("_els"), charge) if infer_multiplicity
                          else F.lit(1))
        energy = F.nullif(F.regexp_extract(t, ENERGY_PATTERN, 1), F.lit("")).cast("double")
    elif mode == "tokens":
        ct = F.col("_told")
        first = F.element_at(ct, 1)

        def last_tag(tag):
            vals = F.transform(F.filter(ct, lambda x: x.startswith(tag)),
                               lambda x: F.element_at(F.split(x, ":"), 2))
            return F.when(F.size(vals) > 0, F.element_at(vals, -1))
        smiles = F.when(first.isNotNull() & smiles_lexical_reason(first).isNull(), first) \
            .otherwise(F.lit(""))
        uid = F.coalesce(last_tag("unique_id:"), gen_id)
        charge = F.coalesce(last_tag("charge:").cast("int"), F.lit(0))
        mult = F.coalesce(last_tag("multiplicity:").cast("int"), F.lit(1))
        energy = F.lit(None).cast("double")
    else:
        raise ValueError(f"unknown mode {mode!r}")

    if charge_col_idx is not None and mode == "tokens":
        k = charge_col_idx + 1
        charged = F.filter(F.col("_toks"), lambda t: F.size(t) != 4)
        short = F.exists(charged, lambda t: F.size(t) < k)
        qs = F.transform(charged, lambda t: F.element_at(t, k).try_cast("double"))
        has_q = F.size(qs) > 0
        total = F.bround(F.aggregate(qs, F.lit(0.0), lambda a, v: a + v), 0).cast("int")
        bad = F.col("_bad") | short
        smiles = F.when(has_q, F.lit("")).otherwise(smiles)
        uid = F.when(has_q, gen_id).otherwise(uid)
        mult = F.when(has_q, F.lit(1)).otherwise(mult)
        charge = F.when(has_q, total).otherwise(charge)
        reason_extra = F.when(short, F.lit("row too short for the charge column"))
    else:
        bad = F.col("_bad")
        reason_extra = F.lit(None).cast("string")

    if id_col:
        uid = F.col(id_col).cast("string")
    parsed = base.select(*keep, "_text", "_toks", uid.alias("unique_id"), smiles.alias("smiles"),
                         charge.alias("charge"), mult.alias("multiplicity"),
                         energy.alias("energy_hartree"), bad.alias("_bad"),
                         reason_extra.alias("_why"), F.size("_toks").alias("num_atoms"))
    ok = parsed.filter(~F.col("_bad"))
    failures = parsed.filter(F.col("_bad")).select(
        F.lit("parse_xyz").alias("stage"), "unique_id", "smiles",
        F.coalesce(F.col("_why"), F.lit("malformed atom line")).alias("reason"))
    molecules = ok.drop("_text", "_toks", "_bad", "_why")
    atoms = ok.select("unique_id", *carry, F.posexplode("_toks").alias("atom_idx", "_t")).select(
        "unique_id", *carry, F.col("atom_idx").cast("int"), F.element_at("_t", 1).alias("element"),
        F.element_at("_t", 2).cast("double").alias("x"),
        F.element_at("_t", 3).cast("double").alias("y"),
        F.element_at("_t", 4).cast("double").alias("z"),
        *([F.element_at("_t", charge_col_idx + 1).try_cast("double").alias("partial_charge")]
          if charge_col_idx is not None else []))
    atoms = atoms.withColumn("z_num", symbol_to_z("element"))
    return molecules, atoms, failures


def read_xyz_dir(spark: SparkSession, path: str, mode: str = "annotated"):
    """Every ``*.xyz`` file of a folder, one molecule per file; the file
    stem becomes ``unique_id``. Returns (molecules, atoms, failures)."""
    df = spark.read.text(path.rstrip("/") + "/*.xyz", wholetext=True)
    df = df.select(F.col("value").alias("text"),
                   F.regexp_replace(F.col("_metadata.file_name"), r"\.xyz$", "").alias("_stem"),
                   F.col("_metadata.file_path").alias("from_xyz_file"))
    return parse_xyz(df, "text", mode=mode, id_col="_stem")


def read_xyz_table(df: DataFrame, start: int | None = None, length: int | None = None,
                   xyz_col: str = "xyz_block", smiles_col: str = "smiles",
                   order_cols=None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A table with an ``xyz_block`` column (and optionally ``smiles``),
    optionally a row range (W7) in ``order_cols`` order, or else in the order
    in which the table is read (file order). The table's ``smiles`` column
    overrides the parsed one (null when absent)."""
    from molspark.operators.batches import dense_index, row_range
    from molspark.operators.qc import require_columns
    require_columns(df, [xyz_col])
    if start is not None:
        if not order_cols:
            df, order_cols = df.withColumn("_read", F.monotonically_increasing_id()), ["_read"]
        df = row_range(dense_index(df, order_cols), start, length)
    sm = F.col(smiles_col) if smiles_col in df.columns else F.lit(None).cast("string")
    src = df.select(F.col(xyz_col).alias("_xyz"), sm.alias("_smiles_in"))
    m, a, f = parse_xyz(src, "_xyz", mode="tokens")
    m = m.withColumn("smiles", F.col("_smiles_in")).drop("_smiles_in")
    return m, a, f.drop("_smiles_in") if "_smiles_in" in f.columns else f


def read_xyz_rows(spark: SparkSession, path: str, start: int = 0, length: int | None = None, xyz_col: str = "xyz_block",
                  smiles_col: str = "smiles") -> tuple[DataFrame, DataFrame, DataFrame]:
    """S10 + W7: rows ``start .. start + length - 1`` of a Parquet table with an
    ``xyz_block`` column, in file order; files outside the range are not read."""
    from molspark.operators.qc import require_columns
    from molspark.sources.files import parquet_row_range
    require_columns(spark.read.parquet(path), [xyz_col])
    return read_xyz_table(parquet_row_range(spark, path, start, length), xyz_col=xyz_col, smiles_col=smiles_col)
