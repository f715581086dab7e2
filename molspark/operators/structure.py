"""Structure-level relations: duplicates (J12), fragments (P10 graph form),
ensembles (A21), bond geometry (J10), atom-order checks (J15) and joins of
atoms with molecules / reference tables (J1-J3, J9, J11)."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from molspark.refdata import element_ref, periodic_ref
from molspark.session import ensure_checkpoint_dir, freed_shuffles, scratch_path


def atoms_with_molecules(atoms: DataFrame, molecules: DataFrame, key: str = "unique_id") -> DataFrame:
    """Equi-join atoms to their molecule's columns."""
    return atoms.join(molecules, key)


def join_element_ref(atoms: DataFrame, energy_col: str | None = None) -> DataFrame:
    """Atoms with their combustion product data (16-row broadcast)."""
    ref = element_ref(atoms.sparkSession)
    cols = ["element", "ord", "product", "o2_consumption", "product_ratio"]
    if energy_col:
        cols.append(energy_col)
    return atoms.join(F.broadcast(ref.select(*[F.col(f"`{c}`") for c in cols])), "element", "left")


def join_periodic(atoms: DataFrame, on: str = "element") -> DataFrame:
    """Atoms with Z, vdW radius and mass (119-row broadcast), joined on
    ``element`` (symbol) or ``z_num``."""
    p = periodic_ref(atoms.sparkSession)
    if on == "element":
        p = p.withColumnRenamed("symbol", "element")
        if "z_num" in atoms.columns:
            p = p.drop("z_num")
    else:
        p = p.drop("symbol") if "element" in atoms.columns else p.withColumnRenamed("symbol", "element")
    return atoms.join(F.broadcast(p), on, "left")


def bond_geometry(bonds: DataFrame, atoms: DataFrame, key: str = "unique_id") -> DataFrame:
    """Bond ends joined to atom coordinates and elements, with length."""
    ai = atoms.select(key, F.col("atom_idx").alias("i"), F.col("element").alias("el_i"),
                      F.col("x").alias("xi"), F.col("y").alias("yi"), F.col("z").alias("zi"))
    aj = atoms.select(key, F.col("atom_idx").alias("j"), F.col("element").alias("el_j"),
                      F.col("x").alias("xj"), F.col("y").alias("yj"), F.col("z").alias("zj"))
    b = bonds.join(ai, [key, "i"]).join(aj, [key, "j"])
    dx, dy, dz = F.col("xj") - F.col("xi"), F.col("yj") - F.col("yi"), F.col("zj") - F.col("zi")
    d = F.sqrt(dx * dx + dy * dy + dz * dz)
    return b.withColumn("length", d)


def pair_children(molecules: DataFrame, children: DataFrame, key: str = "unique_id",
                  suffix: str = "_defluorined") -> DataFrame:
    """Parent rows next to their child rows (child id = parent id + suffix)."""
    c = children.select(*[F.col(x).alias(f"child_{x}") for x in children.columns])
    return molecules.join(c, F.concat(molecules[key], F.lit(suffix)) == c[f"child_{key}"], "left")


def assemble_properties(molecules: DataFrame, *tables: DataFrame, key: str = "unique_id") -> DataFrame:
    """Left-join optional property tables; a missing property is null
    and the molecule survives."""
    return functools.reduce(lambda m, t: m.join(t, key, "left"), tables, molecules)


def assert_atom_order(atoms: DataFrame, other: DataFrame, key: str = "unique_id") -> DataFrame:
    """Per molecule the number of atoms whose atomic number differs
    between the input and a model's output (0 means the order matches)."""
    o = other.select(key, "atom_idx", F.col("z_num").alias("_z2"))
    j = atoms.select(key, "atom_idx", "z_num").join(o, [key, "atom_idx"], "full")
    return j.groupBy(key).agg(F.count_if(~F.col("z_num").eqNullSafe(F.col("_z2")))
                              .cast("long").alias("n_mismatch"))


def ensemble_stats(predictions: DataFrame, cols: Sequence[str], key: str = "unique_id",
                   by: Sequence[str] = ()) -> DataFrame:
    """Mean and sample standard deviation over ensemble members
    (``<c>_mean``, ``<c>_std``; std is null for a single member). ``by``
    adds grouping columns, e.g. ``atom_idx`` for per-atom outputs."""
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"{c}_mean"), F.stddev_samp(c).alias(f"{c}_std")]
    aggs.append(F.count(F.lit(1)).cast("long").alias("n_models"))
    return predictions.groupBy(key, *by).agg(*aggs)


#: Features of a molecule, width of a grid cell in tolerances, how far two
#: features may differ (with room for the rounding of sums in any order), and
#: shares in which the cells are joined.
_GRID, _CELL, _REACH, _SHARES = 3, 16.0, 1.01, 4


def _features(rtol: float, atol: float) -> dict[str, Column]:
    """Aggregates of a molecule: averages of all its coordinates in tolerances,
    with weights from 0.5 to 1 and signs by a hash of the atom's index. Where
    every coordinate agrees within its tolerance, so does the average; a change of
    any atom moves it, also in centred molecules."""
    x, y, z = (_in_tolerances(F.col(c), max(rtol, 1e-6), max(atol, 1e-9)) for c in "xyz")
    out = {}
    for i, v in enumerate((x + y + z, x - y + z, x + y - z)):
        h = F.xxhash64(F.lit(i), "atom_idx")
        weight = F.lit(0.5) + h.bitwiseAND(F.lit(0xFFFFFF)).cast("double") / F.lit(float(1 << 25))
        signed = F.when(h.bitwiseAND(F.lit(1 << 30)) == 0, weight).otherwise(-weight)
        out[f"_f{i}"] = F.sum(signed * v) / (F.lit(3.0) * F.count(F.lit(1)))
    return out


def _in_tolerances(v: Column, rtol: float, atol: float) -> Column:
    """``v`` on the scale on which the tolerance ``atol + rtol * |v|`` is 1
    everywhere (its reciprocal's integral)."""
    return F.signum(v) * F.log1p(F.abs(v) * F.lit(rtol / atol)) / F.lit(rtol)


def duplicate_candidates(classes: DataFrame, features: list[str], rtol: float, shares: int = 1, share: int = 0) -> DataFrame:
    """(_a, _b) with _b < _a: classes of a block that agree within tolerance in
    each of the ``features``, which are in tolerances (``_in_tolerances``), so one
    far molecule widens no cell. Cells are some tolerances wide; one side goes to
    its own cell, the other to all that its tolerance touches, so a pair meets
    once and molecules that differ in any feature do not, however many share a
    formula or a mean. Cells are told by a hash; a pair must be near besides.
    Of ``shares`` of the cells, the pairs of one."""
    reach = _REACH / (1.0 - max(rtol, 1e-6))  # the tolerance of a pair is that of one side's value
    cell = lambda v: F.floor(v / F.lit(_CELL * reach)).cast("long")
    place = F.xxhash64("_block", *[f"_c{i}" for i in range(_GRID)]).alias("_cell")
    one, other = classes, classes
    for i, f in enumerate(features):
        one = one.withColumn(f"_c{i}", cell(F.col(f)))
        other = other.withColumn(f"_c{i}", F.explode(F.sequence(cell(F.col(f) - reach), cell(F.col(f) + reach))))
    one = one.select("_block", place, F.col("_rep").alias("_a"), *[F.col(f).alias(f"_a{i}") for i, f in enumerate(features)])
    other = other.select("_block", place, F.col("_rep").alias("_b"), *[F.col(f).alias(f"_b{i}") for i, f in enumerate(features)])
    near = functools.reduce(lambda p, q: p & q, [F.abs(F.col(f"_a{i}") - F.col(f"_b{i}")) <= F.lit(reach) for i in range(_GRID)])
    one, other = (side.where(F.pmod("_cell", F.lit(shares)) == share) for side in (one, other))
    return one.join(other, ["_block", "_cell"]).where((F.col("_b") < F.col("_a")) & near).select("_a", "_b")


def _written(name: str, *tables: DataFrame) -> DataFrame:
    """The rows of the tables, written to the shared folder one table after the
    other and read back; what was shuffled for a table is removed before the next."""
    spark = tables[0].sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")
    with freed_shuffles(spark):
        for table in tables:
            table.write.mode("append").option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


def structural_duplicates(molecules: DataFrame, atoms: DataFrame, rtol: float = 1e-5,
                          atol: float = 1e-8, property_cols: Sequence[str] = (),
                          key: str = "unique_id", array_cols: Sequence[str] = ()) -> DataFrame:
    """Every molecule that equals one with a smaller id, as ``(unique_id,
    rep_id)`` with the smallest such id.

    Two molecules are equal when element sequence, SMILES, charge, multiplicity
    and the listed properties are, and every coordinate and every entry of the
    listed array properties of the larger id lies within ``atol + rtol *
    |other|``; arrays of other lengths differ, and an array that only the smaller
    id has is not compared. Molecules with the very same coordinates and arrays
    are one class first (by aggregate hashes), so copies are never paired; the
    classes of a block meet in a grid of three averages of their coordinates
    (``duplicate_candidates``) and are then compared atom by atom."""
    def coordinates(seed: int) -> list[Column]:
        same = [F.when(F.col(c) == 0, F.lit(0.0)).otherwise(F.col(c)) for c in "xyz"]  # -0.0 is 0.0
        h = F.xxhash64(F.lit(seed), "atom_idx", *same)
        return [F.sum(F.shiftrightunsigned(h, 32)), F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF)))]  # in halves: no overflow

    if not 0 <= rtol < 1 or atol < 0:
        raise ValueError("rtol must be from 0 to 1 and atol not negative")
    features = _features(rtol, atol)
    tagged = F.pmod(F.xxhash64(F.col("atom_idx"), F.col("element")), F.lit(2147483647))
    sums = [*coordinates(1), *coordinates(2)]
    sig = atoms.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.sum(tagged).alias("_h"),
                                 *[c.alias(f"_g{i}") for i, c in enumerate(sums)])
    same = [c for c in ("smiles", "charge", "multiplicity") if c in molecules.columns] + list(property_cols)
    arrays = F.array(*[F.xxhash64(F.lit(i), F.size(c), c) for c in array_cols for i in (1, 2)]).cast("array<string>")
    block = F.sha2(F.concat_ws("\u0001", F.col("_n").cast("string"), F.col("_h").cast("string"), *[
        F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in same]), 256)
    exact = F.sha2(F.concat_ws("\u0001", "_hex", *[F.coalesce(F.col(f"_g{i}").cast("string"), F.lit("\u0000"))
                                                   for i in range(len(sums))], "_arrays"), 256)
    short = lambda c: F.unhex(F.substring(c, 1, 32))  # noqa: E731  (128 bits)
    # Three narrow columns a molecule; they are read twice.
    rows = _written("duplicate-rows", molecules.select(key, *same, *[c for c in array_cols if c not in same]).join(sig, key)
                    .select(F.col(key).alias("_id"), block.alias("_hex"), *[f"_g{i}" for i in range(len(sums))], arrays.alias("_arrays"))
                    .select("_id", short(F.col("_hex")).alias("_block"), short(exact).alias("_same")))
    classes = _written("duplicate-classes", rows.groupBy("_same").agg(F.min("_block").alias("_block"), F.min("_id").alias("_rep"),
                                                                      F.count(F.lit(1)).alias("_k")))
    placed = atoms.select(F.col(key).alias("id"), "atom_idx", "x", "y", "z")
    # A task's atoms are averaged before they move.
    found = placed.groupBy(F.col("id").alias("_rep")).agg(*[c.alias(f) for f, c in features.items()])
    places = _written("duplicate-places", classes.select("_block", "_rep").join(found, "_rep"))
    # Two sides and the neighbouring cells of one of them move: a share at a time.
    pairs = _written("duplicate-pairs", *[duplicate_candidates(places, list(features), rtol, _SHARES, s) for s in range(_SHARES)])
    close = lambda p, q: F.abs(p - q) <= F.lit(atol) + F.lit(rtol) * F.abs(q)
    if array_cols:
        mine = molecules.select(F.col(key).alias("_a"), *[F.col(c).alias(f"_p{i}") for i, c in enumerate(array_cols)])
        theirs = molecules.select(F.col(key).alias("_b"), *[F.col(c).alias(f"_q{i}") for i, c in enumerate(array_cols)])
        pairs = pairs.join(mine, "_a").join(theirs, "_b")
        for i in range(len(array_cols)):
            p, q = F.col(f"_p{i}"), F.col(f"_q{i}")
            entries = F.forall(F.zip_with(p, q, close), lambda x: F.coalesce(x, F.lit(False)))
            pairs = pairs.where(p.isNull() | F.coalesce((F.size(p) == F.size(q)) & entries, F.lit(False)))
        pairs = pairs.select("_a", "_b")
    # Both molecules of a pair meet their atoms in one join; a side without an atom is null there.
    sides = pairs.select("_a", "_b", F.explode(F.array(F.struct(F.col("_a").alias("id"), F.lit(True).alias("first")), F.struct(
        F.col("_b").alias("id"), F.lit(False).alias("first")))).alias("s")).select("_a", "_b", "s.*")
    met = sides.join(placed, "id").groupBy("_a", "_b", "atom_idx").agg(*[
        F.max(F.when(F.col("first") == side, F.col(c))).alias(f"_{c}{n}") for c in "xyz" for n, side in (("a", True), ("b", False))])
    agree = functools.reduce(lambda p, q: p & q, [close(F.col(f"_{c}a"), F.col(f"_{c}b")) for c in "xyz"])
    equal = met.groupBy("_a", "_b").agg(F.bool_and(F.coalesce(agree, F.lit(False))).alias("_eq")).filter("_eq")
    nearest = _written("duplicate-nearest", equal.groupBy(F.col("_a").alias("_rep")).agg(F.min("_b").alias("_other")))
    told = classes.join(nearest, "_rep", "left").where("_k > 1 OR _other IS NOT NULL").select("_same", "_rep", "_other")
    named = rows.select("_id", "_same").join(told, "_same")
    rep = F.least(F.col("_rep"), F.coalesce(F.col("_other"), F.col("_rep")))
    return named.filter(F.col("_id") != rep).select(F.col("_id").alias(key), rep.alias("rep_id"))


def component_count(atoms: DataFrame, bonds: DataFrame, key: str = "unique_id") -> DataFrame:
    """P10 (graph form): connected components of each molecule's bond graph.

    Alternating large and small stars: every atom is hung onto the least of its
    neighbours until the edges form stars and nothing changes any more. The
    rounds grow with the logarithm of the longest chain; each one is a
    ``checkpoint()`` in the shared folder. A finished star has one edge per atom
    that is not its centre, so components are atoms less edges."""
    ensure_checkpoint_dir(atoms.sparkSession)

    def star(edges: DataFrame, small: bool) -> DataFrame:
        if small:
            around = edges.select(key, F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        else:
            around = edges.select(key, "u", "v").union(edges.select(key, "v", "u"))
        least = around.groupBy(key, "u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        met = around.join(least, [key, "u"])
        if small:
            new = met.select(key, F.col("v").alias("u"), F.col("m").alias("v")).union(
                least.select(key, "u", F.col("m").alias("v")))
        else:
            new = met.filter("v > u").select(key, F.col("v").alias("u"), F.col("m").alias("v"))
        return new.filter("u <> v").distinct()

    def mark(edges: DataFrame):
        return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64(key, "u", "v").cast("decimal(38,0)"))).first()

    edges = (bonds.select(key, F.col("i").alias("u"), F.col("j").alias("v")).filter("u <> v")
             .distinct().checkpoint(eager=True))
    seen = mark(edges)
    while seen[0]:
        edges = star(star(edges, False), True).checkpoint(eager=True)
        now = mark(edges)
        if now == seen:
            break
        seen = now
    n = atoms.groupBy(key).agg(F.countDistinct("atom_idx").alias("_n"))
    e = edges.groupBy(key).agg(F.count(F.lit(1)).alias("_e"))
    return n.join(e, key, "left").select(key, (F.col("_n") - F.coalesce(F.col("_e"), F.lit(0)))
                                         .cast("long").alias("n_components"))
