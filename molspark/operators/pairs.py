"""Atom pairs inside molecules (J4, J5, J6) and the pair energies built on
them (A15-A18, A34, A38, A41).

Layouts:

* **Tiles** (all pairs). Atoms are dealt into blocks of about ``block_size``
  by a hash of ``atom_idx`` (indices may have gaps); block pairs ``(ti, tj)``
  with ``ti <= tj`` are the join key, so a molecule with a huge atom count is
  spread over many tasks instead of one. For the usual small molecule (one
  block) this is exactly one equi self-join on ``(unique_id, 0, 0)``.
* **Cells** (pairs within a cutoff). Each molecule's bounding box is cut into
  as many cells per axis as are at least a cutoff wide; an atom meets its own
  cell and the neighbours that come after it (a half stencil). A molecule
  smaller than two cutoffs is one cell and its atoms are not repeated.

The molecule key is always part of the join key, so Spark never plans a
Cartesian product. Pair rows are aggregated right after they are formed.
Joins whose sides come out of an ``explode`` carry a ``merge`` hint: the
optimizer cannot see the fan-out of a generator and would otherwise try to
broadcast a side that is many times larger than its estimate.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from molspark.functions import kernels as K
from molspark.functions.units import BOHR_ANGSTROM, COULOMB_EV_ANGSTROM, HARTREE_EV

DEFAULT_BLOCK = 256


def _side(atoms: DataFrame, key: str, cols: Sequence[str], suffix: str) -> DataFrame:
    return atoms.select(key, F.col("atom_idx").alias(f"atom_idx{suffix}"),
                        "_blk", "_nb", *[F.col(c).alias(f"{c}{suffix}") for c in cols])


def _with_blocks(atoms: DataFrame, cols: Sequence[str], key: str, block_size: int) -> DataFrame:
    """Atoms with ``_nb``, the number of blocks of their molecule. A
    ``num_atoms`` column (known at ingest; after a filter of atoms it is an
    upper bound, which serves as well) gives it per row; otherwise atoms are
    counted per molecule (map-side combined) and the count is joined back."""
    if "num_atoms" in atoms.columns:
        n = F.greatest(F.coalesce(F.col("num_atoms"), F.lit(1)), F.lit(1))
        return atoms.select(key, "atom_idx", *cols, F.ceil(n / F.lit(block_size)).cast("int").alias("_nb"))
    counts = atoms.groupBy(key).agg(
        F.ceil(F.count(F.lit(1)) / F.lit(block_size)).cast("int").alias("_nb"))
    return atoms.select(key, "atom_idx", *cols).join(counts, key)


def _ordered(p: DataFrame, cols: Sequence[str], key: str) -> DataFrame:
    """Pairs with the smaller ``atom_idx`` as i."""
    turn = F.col("atom_idx_i") > F.col("atom_idx_j")
    out = [F.col(key)]
    for c in ("atom_idx", *cols):
        i, j = F.col(f"{c}_i"), F.col(f"{c}_j")
        out += [F.when(turn, j).otherwise(i).alias(f"{c}_i"), F.when(turn, i).otherwise(j).alias(f"{c}_j")]
    return p.select(*out)


def _tile_pairs(atoms: DataFrame, cols: Sequence[str], key: str, block_size: int) -> DataFrame:
    """Unordered pairs i < j of every molecule, tiled by atom blocks."""
    a = _with_blocks(atoms, cols, key, block_size)
    a = a.withColumn("_blk", F.pmod(F.xxhash64("atom_idx"), F.col("_nb")).cast("int"))
    left = _side(a, key, cols, "_i").withColumn(
        "_tj", F.explode(F.sequence(F.col("_blk"), F.col("_nb") - 1))).withColumnRenamed(
        "_blk", "_ti")
    right = _side(a, key, cols, "_j").withColumn(
        "_ti", F.explode(F.sequence(F.lit(0), F.col("_blk")))).withColumnRenamed("_blk", "_tj")
    p = left.hint("merge").join(right.drop("_nb"), [key, "_ti", "_tj"])
    p = p.filter((F.col("_ti") < F.col("_tj")) | (F.col("atom_idx_i") < F.col("atom_idx_j")))
    return _ordered(p, cols, key)


def _cell_pairs(atoms: DataFrame, cols: Sequence[str], key: str, cutoff: float) -> DataFrame:
    """Unordered pairs i < j of atoms in the same or in neighbouring cells,
    which holds every pair closer than ``cutoff``. Cells are a hair wider than
    the cutoff so rounding can never separate a pair by two cells."""
    side = cutoff * (1.0 + 1e-9)
    axes = ("x", "y", "z")
    box = atoms.groupBy(key).agg(*[F.min(c).alias(f"_{c}0") for c in axes],
                                 *[F.max(c).alias(f"_{c}1") for c in axes])
    for c in axes:
        extent = F.col(f"_{c}1") - F.col(f"_{c}0")
        box = box.withColumn(f"_n{c}", F.greatest(F.floor(extent / F.lit(side)), F.lit(1)).cast("long"))
    a = atoms.select(key, "atom_idx", *cols).join(box, key)
    for c in axes:
        width = F.greatest((F.col(f"_{c}1") - F.col(f"_{c}0")) / F.col(f"_n{c}"), F.lit(side))
        a = a.withColumn(f"_c{c}", F.least(F.col(f"_n{c}") - 1, F.floor(
            (F.col(c) - F.col(f"_{c}0")) / width)).cast("long"))
    cell = lambda x, y, z: (x * F.col("_ny") + y) * F.col("_nz") + z
    a = a.withColumn("_cell", cell(F.col("_cx"), F.col("_cy"), F.col("_cz")))
    left = a.select(key, F.col("atom_idx").alias("atom_idx_i"), "_cell",
                    *[F.col(c).alias(f"{c}_i") for c in cols])
    near = a
    for c in axes:
        near = near.withColumn(f"_o{c}", F.explode(F.sequence(
            F.greatest(F.col(f"_c{c}") - 1, F.lit(0)), F.least(F.col(f"_c{c}") + 1, F.col(f"_n{c}") - 1))))
    near = near.withColumn("_of", cell(F.col("_ox"), F.col("_oy"), F.col("_oz"))).filter("_of <= _cell")
    right = near.select(key, F.col("atom_idx").alias("atom_idx_j"), F.col("_of").alias("_cell"),
                        (F.col("_of") == F.col("_cell")).alias("_own"),
                        *[F.col(c).alias(f"{c}_j") for c in cols])
    p = left.hint("merge").join(right, [key, "_cell"]).filter(
        ~F.col("_own") | (F.col("atom_idx_i") < F.col("atom_idx_j")))
    return _ordered(p, cols, key)


def _geometry(p: DataFrame) -> DataFrame:
    dx = F.col("x_j") - F.col("x_i")
    dy = F.col("y_j") - F.col("y_i")
    dz = F.col("z_j") - F.col("z_i")
    return (p.withColumn("dx", dx).withColumn("dy", dy).withColumn("dz", dz)
             .withColumn("d", F.sqrt(dx * dx + dy * dy + dz * dz)))


def _needed(cols: Sequence[str]) -> list[str]:
    out = ["x", "y", "z"]
    out += [c for c in cols if c not in out]
    return out


def atom_pairs(atoms: DataFrame, cols: Sequence[str] = (), directed: bool = False,
               key: str = "unique_id", block_size: int = DEFAULT_BLOCK,
               min_distance: float | None = None) -> DataFrame:
    """Every atom pair of every molecule, self pairs excluded.

    Columns: key, atom_idx_i, atom_idx_j, ``<c>_i``/``<c>_j`` for x, y, z and
    ``cols``, then dx, dy, dz, d. ``directed=True`` returns both (i, j) and
    (j, i). ``min_distance`` drops coincident atoms before 1/d kernels."""
    need = _needed(cols)
    p = _geometry(_tile_pairs(atoms, need, key, block_size))
    if min_distance is not None:
        p = p.filter(F.col("d") > F.lit(min_distance))
    return _mirror(p, need, key) if directed else p


def _mirror(p: DataFrame, need: Sequence[str], key: str) -> DataFrame:
    """Both orientations of each unordered pair, without another shuffle."""
    flip = F.explode(F.array(F.lit(False), F.lit(True)))
    q = p.withColumn("_flip", flip)

    def pick(a, b):
        return F.when(F.col("_flip"), F.col(b)).otherwise(F.col(a))
    sel = [key, pick("atom_idx_i", "atom_idx_j").alias("atom_idx_i"),
           pick("atom_idx_j", "atom_idx_i").alias("atom_idx_j")]
    for c in need:
        sel += [pick(f"{c}_i", f"{c}_j").alias(f"{c}_i"), pick(f"{c}_j", f"{c}_i").alias(f"{c}_j")]
    sign = F.when(F.col("_flip"), F.lit(-1.0)).otherwise(F.lit(1.0))
    sel += [(F.col("dx") * sign).alias("dx"), (F.col("dy") * sign).alias("dy"),
            (F.col("dz") * sign).alias("dz"), "d"]
    return q.select(*sel)


def neighbour_list(atoms: DataFrame, cutoff: float = 5.0, cols: Sequence[str] = (),
                   directed: bool = False, key: str = "unique_id",
                   min_distance: float | None = None) -> DataFrame:
    """Pairs closer than ``cutoff`` inside each molecule, by the cell join;
    its candidates grow with local density only."""
    need = _needed(cols)
    p = _geometry(_cell_pairs(atoms, need, key, cutoff)).filter(F.col("d") < F.lit(cutoff))
    if min_distance is not None:
        p = p.filter(F.col("d") > F.lit(min_distance))
    return _mirror(p, need, key) if directed else p


def periodic_neighbours(atoms: DataFrame, cells: DataFrame, cutoff: float,
                        cols: Sequence[str] = (), key: str = "unique_id",
                        min_distance: float = 0.1, large_system: int = 100_000) -> DataFrame:
    """Neighbours under periodic boundary conditions.

    ``cells`` holds one row per system with the 3x3 cell as ``a1..a3``,
    ``b1..b3``, ``c1..c3`` (rows are lattice vectors). Pairs (including an atom
    with its own image) are kept when ``min_distance < d < cutoff``; atoms may
    lie outside their cell. Directed output with shift columns ``sa, sb, sc``:
    ``x_j`` is that of the image, ``r_j + sa * a + sb * b + sc * c``.

    A cell list in fractional space: along each axis the system is cut into as
    many bins as are at least a cutoff high, or one bin in a cell that is lower.
    Atoms are wrapped into the cell; an atom is offered to the bins around its
    own modulo the number of bins, and how often that wraps around is the shift.
    The join key is (system, bin), so a large system is as many keys as bins."""
    need = _needed(cols)
    axes, reach = "abc", cutoff * (1.0 + 1e-9)

    def cross(u: str, v: str) -> list[Column]:
        (ux, uy, uz), (vx, vy, vz) = ([F.col(f"{w}{k}") for k in (1, 2, 3)] for w in (u, v))
        return [uy * vz - uz * vy, uz * vx - ux * vz, ux * vy - uy * vx]

    dual = {"a": cross("b", "c"), "b": cross("c", "a"), "c": cross("a", "b")}
    det = functools.reduce(lambda p, q: p + q, [F.col(f"a{k + 1}") * dual["a"][k] for k in range(3)])
    lattice = cells.select(key, *[f"{n}{k}" for n in axes for k in (1, 2, 3)],
                           *[(dual[n][k] / det).alias(f"_r{n}{k + 1}") for n in axes for k in range(3)])
    for n in axes:
        # Bins along an axis, and how many of them the cutoff reaches.
        slope = F.lit(reach) * K.norm3(*[F.col(f"_r{n}{k}") for k in (1, 2, 3)])
        lattice = lattice.withColumn(f"_m{n}", F.greatest(F.floor(1.0 / slope), F.lit(1)).cast("long")) \
            .withColumn(f"_n{n}", F.ceil(F.col(f"_m{n}") * slope).cast("long"))
    # The one row of a system that may hold a third of all atoms is met in 32 places; few systems are so large.
    salts = 32
    large = (atoms.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > large_system)
             .select(key, F.lit(salts).alias("_salts")))
    own = F.coalesce("_salts", F.lit(1))
    lattice = lattice.join(large, key, "left").withColumn("_s", F.explode(F.sequence(F.lit(0), own - 1))).drop("_salts")
    a = (atoms.select(key, "atom_idx", *need).join(large, key, "left")
         .withColumn("_s", F.pmod(F.xxhash64("atom_idx"), own).cast("int")).drop("_salts").join(lattice, [key, "_s"]))
    xyz = ("x", "y", "z")
    for n in axes:
        f = functools.reduce(lambda p, q: p + q, [F.col(c) * F.col(f"_r{n}{k + 1}") for k, c in enumerate(xyz)])  # noqa: B023
        a = a.withColumn(f"_f{n}", f).withColumn(f"_w{n}", F.floor(f"_f{n}").cast("long")).withColumn(
            f"_b{n}", F.least(F.floor((F.col(f"_f{n}") - F.col(f"_w{n}")) * F.col(f"_m{n}")), F.col(f"_m{n}") - 1).cast("long"))

    def moved(turns: dict[str, Column], k: int) -> Column:
        return functools.reduce(lambda p, q: p + q, [turns[n] * F.col(f"{n}{k}") for n in axes])

    home = {n: F.col(f"_w{n}") for n in axes}
    left = a.select(key, F.col("atom_idx").alias("atom_idx_i"), *[F.col(c).alias(f"{c}_i") for c in need],
                    *[moved(home, k).alias(f"_o{k}") for k in (1, 2, 3)],
                    *[F.col(f"_w{n}").alias(f"_w{n}i") for n in axes], *[F.col(f"_b{n}").alias(f"_c{n}") for n in axes])
    # An atom moves once to each bin it is offered to; its images there are told after the join.
    offers = {n: F.sequence(F.col(f"_b{n}") - F.col(f"_n{n}"), F.col(f"_b{n}") + F.col(f"_n{n}")) for n in axes}
    right = a
    for n in axes:
        right = right.withColumn(f"_c{n}", F.explode(F.array_distinct(F.transform(offers[n], lambda t: F.pmod(t, F.col(f"_m{n}"))))))  # noqa: B023
    right = right.select(key, F.col("atom_idx").alias("atom_idx_j"), *[F.col(c).alias(f"{c}_j") for c in need],
                         *[f"{n}{k}" for n in axes for k in (1, 2, 3)], *[f"_{x}{n}" for x in "wc" for n in axes],
                         *[F.ceil((F.col(f"_b{n}") - F.col(f"_n{n}") - F.col(f"_c{n}")) / F.col(f"_m{n}")).alias(f"_l{n}") for n in axes],
                         *[F.floor((F.col(f"_b{n}") + F.col(f"_n{n}") - F.col(f"_c{n}")) / F.col(f"_m{n}")).alias(f"_h{n}") for n in axes])
    p = left.hint("merge").join(right, [key, *[f"_c{n}" for n in axes]])
    for n in axes:
        p = p.withColumn(f"_k{n}", F.explode(F.sequence(f"_l{n}", f"_h{n}")))
    turns = {n: F.col(f"_w{n}") + F.col(f"_k{n}") for n in axes}
    moves = [moved(turns, k) for k in (1, 2, 3)]
    p = p.select(key, "atom_idx_i", "atom_idx_j", *[f"{c}_i" for c in need],
                 *[(F.col(f"{c}_j") - moves[xyz.index(c)] if c in xyz else F.col(f"{c}_j")).alias(f"{c}_j") for c in need],
                 "_o1", "_o2", "_o3", *[f"_w{n}i" for n in axes], *[turns[n].alias(f"_u{n}") for n in axes], *[f"_c{n}" for n in axes])
    for k, c in enumerate(xyz):
        p = p.withColumn(f"{c}_j", F.col(f"{c}_j") + F.col(f"_o{k + 1}"))
    for n in axes:
        p = p.withColumn(f"s{n}", (F.col(f"_w{n}i") - F.col(f"_u{n}")).cast("int"))
    p = _geometry(p.drop(*[f"_{x}{n}" for n in axes for x in ("c", "u")], *[f"_w{n}i" for n in axes], "_o1", "_o2", "_o3"))
    return p.filter((F.col("d") > F.lit(min_distance)) & (F.col("d") < F.lit(cutoff)))


# ---------------------------------------------------------------------------
# Pair energies (eV for charges in e and distances in angstrom)
# ---------------------------------------------------------------------------
def _per_molecule(p: DataFrame, term: Column, out: str, key: str, factor: float) -> DataFrame:
    """Sum of a term with 1/d over the pairs of each molecule. Coincident atoms
    (d = 0) have no such term; they are counted in ``n_coincident``."""
    apart = F.when(F.col("d") > 0, term)
    return p.groupBy(key).agg((F.coalesce(F.sum(apart), F.lit(0.0)) * F.lit(factor)).alias(out),
                              F.count_if(F.col("d") == 0).alias("n_coincident"))


def _inverse_distance() -> Column:
    return F.lit(1.0) / F.nullif(F.col("d"), F.lit(0.0))


def coulomb_energy(atoms: DataFrame, charge_col: str = "charge", rc: float = 4.6,
                   key: str = "unique_id", block_size: int = DEFAULT_BLOCK) -> DataFrame:
    """Long-range Coulomb ``1/2 * Eh * a0 * sum_{i!=j} (1 - fc(d)) q_i q_j / d``
    with the exponential cutoff ``fc`` (F8). Summed over i < j, so the 1/2
    cancels. Molecules with a single atom get no row."""
    p = atom_pairs(atoms, [charge_col], key=key, block_size=block_size)
    d = F.col("d")
    term = ((F.lit(1.0) - K.exp_cutoff(d, rc)) * F.col(f"{charge_col}_i") * F.col(f"{charge_col}_j")
            * _inverse_distance())
    return _per_molecule(p, term, "coulomb_lr_ev", key, COULOMB_EV_ANGSTROM)


def coulomb_energy_sr(atoms: DataFrame, charge_col: str = "charge", rc: float = 4.6,
                      key: str = "unique_id") -> DataFrame:
    """Short-range part ``sum fc(d) q_i q_j / d``; fc vanishes beyond rc so
    only the cutoff neighbour list is needed."""
    p = neighbour_list(atoms, rc, [charge_col], key=key)
    term = (K.exp_cutoff(F.col("d"), rc) * F.col(f"{charge_col}_i") * F.col(f"{charge_col}_j")
            * _inverse_distance())
    return _per_molecule(p, term, "coulomb_sr_ev", key, COULOMB_EV_ANGSTROM)


def coulomb_energy_dsf(atoms: DataFrame, charge_col: str = "charge", rc: float = 15.0,
                       alpha: float = 0.2, sr_rc: float = 4.6, key: str = "unique_id",
                       damped: bool = True) -> DataFrame:
    """Damped shifted force (or plain shifted force, ``damped=False``)
    Coulomb within ``rc``, minus the short-range part A16."""
    p = neighbour_list(atoms, rc, [charge_col], key=key).withColumn("_d", F.nullif(F.col("d"), F.lit(0.0)))
    d = F.col("_d")
    qq = F.col(f"{charge_col}_i") * F.col(f"{charge_col}_j")
    kern = K.dsf_kernel(d, rc, alpha) if damped else K.sf_kernel(d, rc)
    sr = F.when(d < sr_rc, K.exp_cutoff(d, sr_rc) / d).otherwise(F.lit(0.0))
    term = qq * (kern - sr)
    return _per_molecule(p, term, "coulomb_dsf_ev" if damped else "coulomb_sf_ev", key,
                         COULOMB_EV_ANGSTROM)


def _element_params(atoms: DataFrame, params: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Atoms with per-element parameters. One row per element is made sure of
    first (the smallest value of each parameter), so the table is no larger than
    the periodic table and may be broadcast; an unknown element gets nulls."""
    one = params.groupBy("element").agg(*[F.min(c).alias(c) for c in cols])
    return atoms.drop(*cols).join(F.broadcast(one), "element", "left")


def short_range_repulsion(atoms: DataFrame, params: DataFrame, rc: float = 5.2,
                          cutoff_fn: str | None = None, per_atom: bool = False,
                          key: str = "unique_id", block_size: int = DEFAULT_BLOCK) -> DataFrame:
    """``sum_{i!=j} exp(-alpha_i alpha_j d^1.5) Z_i Z_j / d`` with per-element
    ``params(element, alpha, zeff)``, an optional cosine/exp cutoff, per molecule
    or per atom. Pairs of an element without parameters make the sum null and
    are counted in ``n_missing``, coincident pairs in ``n_coincident``."""
    cols = ["alpha", "zeff"]
    a = _element_params(atoms, params, cols)
    if cutoff_fn:
        p = neighbour_list(a, rc, cols, key=key)
    else:
        p = atom_pairs(a, cols, key=key, block_size=block_size)
    d = F.col("d")
    e = F.exp(-F.col("alpha_i") * F.col("alpha_j") * F.pow(d, F.lit(1.5))) \
        * F.col("zeff_i") * F.col("zeff_j") * _inverse_distance()
    if cutoff_fn == "cos":
        e = e * K.cosine_cutoff(d, rc)
    elif cutoff_fn == "exp":
        e = e * K.exp_cutoff(d, rc)
    known = F.col("alpha_i").isNotNull() & F.col("alpha_j").isNotNull() \
        & F.col("zeff_i").isNotNull() & F.col("zeff_j").isNotNull()
    rows = p.select(key, "atom_idx_i", "atom_idx_j", e.alias("_e"), (~known).alias("_odd"), (d == 0).alias("_same"))
    by, factor = [key], 2.0
    if per_atom:
        rows = rows.withColumn("atom_idx", F.explode(F.array("atom_idx_i", "atom_idx_j")))
        by, factor = [key, "atom_idx"], 1.0
    return rows.groupBy(*by).agg(
        F.when(~F.bool_or("_odd"), F.coalesce(F.sum("_e"), F.lit(0.0)) * F.lit(factor)).alias("repulsion"),
        F.count_if("_odd").alias("n_missing"), F.count_if("_same").alias("n_coincident"))


def scaled_dispersion_params(atoms: DataFrame, params: DataFrame) -> DataFrame:
    """Per-atom ``c6`` and ``alpha``: the element's reference values (``params``
    with element, c6, alpha) times ``exp(clip(m, -4, 4))`` of the atom's
    predicted logarithms ``c6_mult`` and ``alpha_mult``."""
    def scaled(c: str) -> Column:
        m = F.least(F.greatest(F.col(f"{c}_mult"), F.lit(-4.0)), F.lit(4.0))
        return F.col(c) * F.exp(m)

    return _element_params(atoms, params, ["c6", "alpha"]).withColumns(
        {"c6": scaled("c6"), "alpha": scaled("alpha")})


def pair_dispersion(atoms: DataFrame, params: DataFrame, s6: float = 1.0, s8: float = 1.0,
                    a1: float = 0.4, a2: float = 5.0, key: str = "unique_id",
                    block_size: int = DEFAULT_BLOCK) -> DataFrame:
    """Damped pair dispersion in eV, ``-Eh/2 sum_{i!=j} C6 (s6 / (d^6 + R0^6)
    + s8 q / (d^8 + R0^8))`` with distances in Bohr, ``q = 3 r4r2_i r4r2_j``,
    ``R0 = a1 sqrt(q) + a2`` and the Tkatchenko-Scheffler combination
    ``C6 = 2 c6_i c6_j / max(c6_i alpha_j / alpha_i + c6_j alpha_i / alpha_j, 1e-4)``.

    Atoms carry ``c6`` and ``alpha`` in atomic units; ``params(element, r4r2)``.
    A pair with a missing parameter makes the energy null and is counted in
    ``n_missing``."""
    cols = ["c6", "alpha", "r4r2"]
    p = atom_pairs(_element_params(atoms, params, ["r4r2"]), cols, key=key, block_size=block_size)
    d = F.col("d") / F.lit(BOHR_ANGSTROM)
    ci, cj, ai, aj = (F.col(c) for c in ("c6_i", "c6_j", "alpha_i", "alpha_j"))
    c6 = F.lit(2.0) * ci * cj / F.greatest(ci * aj / ai + cj * ai / aj, F.lit(1e-4))
    qq = F.lit(3.0) * F.col("r4r2_i") * F.col("r4r2_j")
    r0 = F.lit(a1) * F.sqrt(qq) + F.lit(a2)
    known = F.lit(True)
    for c in cols:
        known = known & F.col(f"{c}_i").isNotNull() & F.col(f"{c}_j").isNotNull()
    e = F.when(known, c6 * (F.lit(s6) / (F.pow(d, 6) + F.pow(r0, 6))
                            + F.lit(s8) * qq / (F.pow(d, 8) + F.pow(r0, 8))))
    return p.groupBy(key).agg(F.when(F.bool_and(known), -F.sum(e) * F.lit(HARTREE_EV)).alias("dispersion"),
                              F.count_if(~known).alias("n_missing"))


def neighbour_counts(pairs: DataFrame, key: str = "unique_id") -> DataFrame:
    """Neighbours per atom (both ends counted) and the max per molecule."""
    ends = pairs.select(key, F.explode(F.array(F.col("atom_idx_i"), F.col("atom_idx_j")))
                        .alias("atom_idx"))
    per_atom = ends.groupBy(key, "atom_idx").agg(F.count(F.lit(1)).alias("n_neighbours"))
    return per_atom.groupBy(key).agg(
        F.max("n_neighbours").cast("long").alias("max_neighbours"),
        F.sum("n_neighbours").cast("long").alias("sum_neighbours"))


def radial_descriptor(atoms: DataFrame, rmin: float = 0.8, rc: float = 5.0, nshifts: int = 16,
                      eta: float | None = None, key: str = "unique_id") -> DataFrame:
    """Per atom ``g_k = sum_j exp(-eta (d - s_k)^2) * fc(d)`` over neighbours
    within rc (cosine cutoff), shifts evenly spaced on [rmin, rc);
    eta defaults to (nshifts / (rc - rmin))^2. Output: key, atom_idx,
    ``g ARRAY<DOUBLE>`` of length nshifts."""
    shifts = [rmin + k * (rc - rmin) / nshifts for k in range(nshifts)]
    eta = eta if eta is not None else (nshifts / (rc - rmin)) ** 2
    p = neighbour_list(atoms, rc, key=key)
    both = p.select(key, F.explode(F.array(F.col("atom_idx_i"), F.col("atom_idx_j"))).alias("atom_idx"),
                    "d")
    fc = K.cosine_cutoff(F.col("d"), rc)
    sums = [F.sum(F.exp(F.lit(-eta) * (F.col("d") - F.lit(s)) * (F.col("d") - F.lit(s))) * fc)
            .alias(f"g{k}") for k, s in enumerate(shifts)]
    agg = both.groupBy(key, "atom_idx").agg(*sums)
    return agg.select(key, "atom_idx", F.array(*[F.col(f"g{k}") for k in range(nshifts)]).alias("g"))
