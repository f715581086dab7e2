"""Further registered queries: ingest and sink round trips, gates, joins,
unions, expression helpers and user stages, each through its operator."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from molspark.plans import bridge as br
from molspark.plans.queries import register, rk
from molspark.session import scratch_path


def _scratch(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


# --- ingest (S1-S4, S6-S8, S10, S16, S19, K6, J13) --------------------------------
@register("smiles_ingest", """
SELECT f.fmt, o.smiles, count(*) AS n
FROM (VALUES ('csv'), ('parquet'), ('txt')) f(fmt)
CROSS JOIN (SELECT o_orderstatus AS smiles FROM orders WHERE o_orderstatus IS NOT NULL AND o_orderstatus <> '') o
GROUP BY 1, 2""")
def q_smiles_ingest(spark, sf_dir):
    from molspark.sources.smiles import read_input
    root = _scratch(spark, "smiles")
    o = br.table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("smiles"), "o_orderkey")
    o.write.option("header", True).csv(f"{root}/list.csv")
    o.write.parquet(f"{root}/list.parquet")
    line = F.concat(F.lit(" \t"), "smiles", F.lit("\t "))
    (o.select(F.explode(F.array(line, F.lit("\t"), F.concat(F.lit("# "), "smiles"))).alias("value"))
     .write.text(f"{root}/list.txt"))
    out = None
    for fmt in ("csv", "parquet", "txt"):
        part = read_input(spark, f"{root}/list.{fmt}").groupBy("smiles").agg(F.count(F.lit(1)).alias("n")) \
            .select(F.lit(fmt).alias("fmt"), "smiles", "n")
        out = part if out is None else out.union(part)
    return out


@register("xyz_modes", br.with_views("""
SELECT m.unique_id, f.mode, CASE WHEN f.mode = 'basic' THEN '' ELSE 'CO' END AS smiles,
       CASE WHEN f.mode = 'basic' THEN 0 ELSE m.charge END AS charge,
       CASE WHEN f.mode = 'basic' THEN CAST(1 + c.par AS INTEGER) ELSE 3 END AS multiplicity, c.num_atoms, c.sum_x
FROM molecules m JOIN (SELECT unique_id, CAST(count(*) AS INTEGER) AS num_atoms, sum(z_num % 2) % 2 AS par,
                              round(sum(x), 4) AS sum_x FROM atoms GROUP BY 1) c ON m.unique_id = c.unique_id
CROSS JOIN (VALUES ('basic'), ('annotated'), ('tokens')) f(mode)""", "molecules", "atoms"))
def q_xyz_modes(spark, sf_dir):
    from molspark.sinks.tables import xyz_blocks
    from molspark.sources.xyz import parse_xyz
    m = br.molecules(spark, sf_dir).select("unique_id", "charge", F.lit(3).alias("multiplicity"), F.lit("CO").alias("smiles"))
    path = _scratch(spark, "xyz-blocks")  # a table, as a user has it, written once for the six readings of it
    xyz_blocks(m, br.atoms(spark, sf_dir, with_z=False)).withColumnRenamed("unique_id", "src").write.parquet(path)
    blocks = spark.read.parquet(path)
    out = None
    for mode in ("basic", "annotated", "tokens"):
        mols, atoms, _ = parse_xyz(blocks, "xyz_block", mode=mode, id_col="src")
        sums = atoms.groupBy("unique_id").agg(rk(F.sum("x"), 4).alias("sum_x"))
        part = mols.join(sums, "unique_id").select("unique_id", F.lit(mode).alias("mode"), "smiles", "charge",
                                                   "multiplicity", "num_atoms", "sum_x")
        out = part if out is None else out.union(part)
    return out


@register("manifest_check", """
SELECT bucket, remote_path, local_path,
       CASE WHEN bucket = 'b2' THEN 'bucket does not exist'
            WHEN k % 2 = 0 THEN 'object already exists' END AS reason
FROM (SELECT o_orderkey AS k, 'b' || CAST(o_custkey % 3 AS VARCHAR) AS bucket,
             'in, ' || CAST(o_orderkey AS VARCHAR) AS local_path,
             'out/' || CAST(o_orderkey AS VARCHAR) AS remote_path FROM orders) t""")
def q_manifest(spark, sf_dir):
    from molspark.operators.qc import check_manifest
    from molspark.sources.files import read_manifest
    root = _scratch(spark, "manifest")
    o = br.table(spark, sf_dir, "orders")
    k = F.col("o_orderkey").cast("string")
    bucket = F.concat(F.lit("b"), (F.col("o_custkey") % 3).cast("string"))
    o.select(F.concat(bucket, F.lit(',"in, '), k, F.lit('", out/'), k).alias("value")).write.text(root)
    rows, _ = read_manifest(spark, root)
    stored = o.filter("o_orderkey % 2 = 0").select(bucket.alias("bucket"), F.concat(F.lit("out/"), k).alias("key"))
    buckets = spark.sql("SELECT * FROM VALUES ('b0'), ('b1') AS t(bucket)")
    good, bad = check_manifest(rows, stored, buckets)
    cols = ["bucket", "remote_path", "local_path", "reason"]
    return good.withColumn("reason", F.lit(None).cast("string")).select(*cols).union(bad.select(*cols))


# --- sinks read back (K1, K2, K4, K5, K8, K13) -------------------------------------
@register("sink_tables", br.with_views("""
SELECT 'molecules' AS tab, count(*) AS n, CAST(sum(charge) AS DOUBLE) AS s FROM molecules
UNION ALL SELECT 'atoms', count(*), round(sum(x), 2) FROM atoms
UNION ALL SELECT 'metadata', (SELECT count(*) FROM molecules), CAST((SELECT count(*) FROM atoms) AS DOUBLE)
UNION ALL SELECT 'json', count(DISTINCT unique_id), CAST(count(*) AS DOUBLE) FROM atoms
UNION ALL SELECT 'failures', 2 * count(*), CAST(sum(length(unique_id)) * 2 AS DOUBLE) FROM molecules WHERE NOT converged
UNION ALL SELECT 'children', count(*), CAST(sum(charge) AS DOUBLE) FROM molecules WHERE charge = 1""",
                                       "molecules", "atoms"))
def q_sinks(spark, sf_dir):
    from molspark.sinks import tables as K
    root = _scratch(spark, "sinks")
    m = br.molecules(spark, sf_dir).withColumn("smiles", F.lit("CO"))
    a = br.atoms(spark, sf_dir).drop("num_atoms")
    K.write_molecules(m, f"{root}/molecules")
    K.write_atoms(a, f"{root}/atoms", table_metadata={"functional": "b3lyp"})
    K.write_metadata(m, a, f"{root}/metadata")
    K.write_json(m, a, f"{root}/json", warn_above=1 << 62)
    failed = m.filter("NOT converged").select(F.lit("opt").alias("stage"), "unique_id", "smiles", F.lit("r").alias("reason"))
    for _ in range(2):
        K.write_failures(failed, f"{root}/failures")
    kids = m.withColumn("parent_id", F.when(F.col("charge") == 1, F.col("unique_id")))
    K.write_children(kids, a, f"{root}/children")
    read = spark.read
    sums = [("molecules", read.parquet(f"{root}/molecules"), F.sum("charge").cast("double")),
            ("atoms", read.parquet(f"{root}/atoms"), rk(F.sum("x"), 2)),
            ("metadata", read.parquet(f"{root}/metadata"), F.sum("num_atoms").cast("double")),
            ("json", read.json(f"{root}/json"), F.sum(F.size("elements")).cast("double")),
            ("failures", read.parquet(f"{root}/failures"), F.sum(F.length("unique_id")).cast("double")),
            ("children", read.parquet(f"{root}/children/defluorined_molecule_property"), F.sum("charge").cast("double"))]
    out = None
    for name, df, s in sums:
        part = df.agg(F.count(F.lit(1)).alias("n"), s.alias("s")).select(F.lit(name).alias("tab"), "n", "s")
        out = part if out is None else out.union(part)
    return out


# --- gates (P8, P11, P12, P20, P21, P25, P26, K12, A6, A26) -------------------------
_SMILES = "CASE c.custkey % 7 WHEN 0 THEN NULL WHEN 1 THEN ' ' WHEN 2 THEN 'C.C' WHEN 3 THEN '[NH4+]' ELSE 'CO' END"


@register("sanitize_chain", f"""
SELECT unique_id, CASE WHEN s IS NULL OR trim(s) = '' THEN 'invalid structure'
                       WHEN s = 'C.C' THEN 'disconnected fragments'
                       WHEN custkey % 5 = 0 THEN 'radical' ELSE 'kept' END AS outcome
FROM (SELECT *, {_SMILES} AS s FROM (SELECT CAST(o_orderkey AS VARCHAR) AS unique_id, o_custkey AS custkey FROM orders) c) t""")
def q_sanitize(spark, sf_dir):
    from molspark.operators.qc import sanitize
    c = br.table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("unique_id"),
                                                  F.col("o_custkey").alias("custkey")).alias("c")
    m = c.select("unique_id", F.expr(_SMILES).alias("canonical_smiles"),
                 F.when(F.col("custkey") % 5 == 0, 1).otherwise(0).alias("num_radical_electrons"))
    kept, radicals, failures = sanitize(m, radical_col="num_radical_electrons")
    return (kept.select("unique_id", F.lit("kept").alias("outcome"))
            .union(radicals.select("unique_id", F.lit("radical"))).union(failures.select("unique_id", "reason")))


@register("validate_inputs", f"""
SELECT unique_id, CASE WHEN s = '[NH4+]' THEN 'charged molecule: charge = 1'
                       WHEN custkey % 2 = 1 THEN 'open shell: num_unpaired_electron = 1' ELSE 'valid' END AS outcome
FROM (SELECT *, coalesce(nullif(trim({_SMILES}), ''), 'CC') AS s
      FROM (SELECT CAST(o_orderkey AS VARCHAR) AS unique_id, o_custkey AS custkey FROM orders) c) t""")
def q_validate(spark, sf_dir):
    from molspark.operators.qc import validate_inputs
    c = br.table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("unique_id"),
                                                  F.col("o_custkey").alias("custkey")).alias("c")
    m = c.select("unique_id", F.expr(f"coalesce(nullif(trim({_SMILES}), ''), 'CC')").alias("smiles"),
                 (F.col("custkey") % 2).cast("int").alias("unpaired_electrons"))
    ok, bad = validate_inputs(m, require_any=True)
    return ok.select("unique_id", F.lit("valid").alias("outcome")).union(bad.select("unique_id", "reason"))


@register("radical_flags", br.with_views("""
SELECT unique_id, CAST(sum(r) % 2 AS INTEGER) AS radical_parity, CAST(sum(r) AS BIGINT) AS num_radical_electrons
FROM (SELECT unique_id, CASE WHEN element = 'N' THEN atom_idx % 3 ELSE 0 END AS r FROM atoms) t
GROUP BY 1 HAVING sum(r) > 0""", "atoms"))
def q_radicals(spark, sf_dir):
    from molspark.operators.composition import radical_parity
    from molspark.operators.qc import flag_radicals
    a = br.atoms(spark, sf_dir, with_z=False).select("unique_id", F.when(
        F.col("element") == "N", F.col("atom_idx") % 3).otherwise(0).alias("num_radical_electrons"))
    return radical_parity(a).join(flag_radicals(a).select("unique_id"), "unique_id", "left_semi")


@register("esp_gate", """
SELECT unique_id, round(min(v) * 27.211386245981, 4) AS esp_min_ev, round(max(v) * 27.211386245981, 4) AS esp_max_ev,
       abs(min(v) * 27.211386245981) > 55 OR abs(max(v) * 27.211386245981) > 55 AS esp_suspicious,
       CASE WHEN max(u) % 2 = 0 THEN round(min(v) * 27.211386245981, 4) END AS closed_min
FROM (SELECT CAST(user_id AS VARCHAR) AS unique_id, user_id AS u,
             CASE WHEN event_id % 2 = 0 THEN value / 100.0 ELSE 0 END - value / 150.0 AS v FROM events) t
GROUP BY 1""")
def q_esp_gate(spark, sf_dir):
    from molspark.operators.geometry import esp_range, flag_esp
    from molspark.operators.qc import closed_shell_only
    ev = br.table(spark, sf_dir, "events")
    g = ev.select(F.col("user_id").cast("string").alias("unique_id"),
                  F.when(F.col("event_id") % 2 == 0, F.col("value") / 100.0).alias("esp_alpha"),
                  (-F.col("value") / 150.0).alias("esp_beta"))
    r = flag_esp(esp_range(g))
    r = r.withColumns({"multiplicity": (F.col("unique_id").cast("long") % 2 + 1), "closed_min": F.col("esp_min_ev")})
    return closed_shell_only(r, ["closed_min"]).select(
        "unique_id", rk(F.col("esp_min_ev"), 4).alias("esp_min_ev"), rk(F.col("esp_max_ev"), 4).alias("esp_max_ev"),
        "esp_suspicious", rk(F.col("closed_min"), 4).alias("closed_min"))


@register("thermo_gate", """
SELECT CAST(o_orderkey AS VARCHAR) AS unique_id, o_totalprice AS enthalpy FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_quantity - 3.0 < 0)""")
def q_thermo_gate(spark, sf_dir):
    from molspark.operators.energetics import thermo_gate
    o = br.table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("unique_id"),
                                                  F.col("o_totalprice").alias("enthalpy"))
    li = br.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("unique_id"),
                                                    (F.col("l_quantity") - 3.0).alias("frequency"))
    return thermo_gate(li, o)


@register("canonical_properties", """
SELECT CAST(o_orderkey AS VARCHAR) AS unique_id, coalesce(CASE WHEN o_custkey % 2 = 0 THEN o_totalprice END, 1.5) AS homo_ev,
       o_totalprice / 2 AS esp_min_ev
FROM orders""")
def q_canonical(spark, sf_dir):
    from molspark.operators.qc import canonical_names, select_properties
    o = br.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("unique_id"),
        F.when(F.col("o_custkey") % 2 == 0, F.col("o_totalprice")).alias("homo_ev"), F.lit(1.5).alias("homo_eV2"),
        (F.col("o_totalprice") / 2).alias("esp_min"), F.lit(1.0).alias("vdw_volume_angstrom3"))
    named = canonical_names(o.withColumnRenamed("homo_eV2", "homo"))
    return select_properties(named, ["esp_range"])


# --- joins and unions (J1, J3, J9, J11, A39, U2-U5, O4) ------------------------------
@register("molecule_joins", br.with_views("""
SELECT m.unique_id, c.n AS num_atoms, round(c.q * m.charge, 4) AS charge_product, c.sum_z,
       round(k.energy_hartree - m.energy_hartree, 6) AS child_gap
FROM molecules m JOIN (SELECT unique_id, count(*) AS n, sum(charge) AS q, CAST(sum(z_num) AS BIGINT) AS sum_z FROM atoms GROUP BY 1) c
  ON m.unique_id = c.unique_id LEFT JOIN child_energies k ON k.unique_id = m.unique_id || '_defluorined'""",
                                          "molecules", "atoms", "child_energies"))
def q_joins(spark, sf_dir):
    from molspark.operators.composition import distinct_ids
    from molspark.operators.structure import assemble_properties, atoms_with_molecules, join_periodic, pair_children
    m = br.molecules(spark, sf_dir)
    a = br.atoms(spark, sf_dir, with_z=False)
    both = atoms_with_molecules(a.withColumnRenamed("charge", "q"), m).groupBy("unique_id").agg(
        F.count(F.lit(1)).alias("num_atoms"), rk(F.sum("q") * F.max("charge"), 4).alias("charge_product"))
    z = join_periodic(a).groupBy("unique_id").agg(F.sum("z_num").cast("long").alias("sum_z"))
    kids = pair_children(m, br.child_energies(spark, sf_dir)).select(
        "unique_id", rk(F.col("child_energy_hartree") - F.col("energy_hartree"), 6).alias("child_gap"))
    return assemble_properties(distinct_ids(a), both, z, kids)


@register("unions", """
SELECT CAST(o_orderkey AS VARCHAR) AS unique_id, CASE WHEN o_custkey % 2 = 0 THEN o_totalprice END AS a,
       CASE WHEN o_custkey % 2 = 1 THEN o_orderstatus END AS b, 'a,b' AS extra
FROM orders""")
def q_unions(spark, sf_dir):
    from molspark.operators.batches import extra_columns, union_diagonal, union_strict
    o = br.table(spark, sf_dir, "orders").withColumn("unique_id", F.col("o_orderkey").cast("string"))
    even = o.filter("o_custkey % 2 = 0").select("unique_id", F.col("o_totalprice").alias("a"))
    odd = o.filter("o_custkey % 2 = 1").select(F.col("o_orderstatus").alias("b"), "unique_id")
    low, high = odd.filter("unique_id < '5'"), odd.filter("unique_id >= '5'").select("unique_id", "b")
    df = union_diagonal(even, union_strict(low, high))
    return df.select("unique_id", "a", "b", F.lit(",".join(extra_columns(df, ["unique_id"]))).alias("extra"))


# --- expressions over atoms (F3, F9, F11, F13, F15, F17, F18, F22-F24, A13, A14) ------
@register("tensor_parts", br.with_views("""
SELECT unique_id, atom_idx, x AS t_xx, y AS t_yy, z AS t_zz, y AS t_xy, z AS t_xz, x AS t_yz,
       (x + y + z) / 3.0 AS iso, x + y + z AS row1, y + y + x AS col2, z AS p_z3
FROM atoms""", "atoms"))
def q_tensor(spark, sf_dir):
    from molspark.functions.arrays import flatten_xyz
    from molspark.operators.geometry import axis_split, isotropic, quadrupole_components
    a = br.atoms(spark, sf_dir, with_z=False)
    row = lambda *c: F.array(*[F.col(x) for x in c])
    t = a.withColumn("t", F.array(row("x", "y", "z"), row("y", "y", "x"), row("z", "x", "z")))
    t = axis_split(isotropic(quadrupole_components(t, "t", "t"), "t", "iso"), "t", "p")
    flat = flatten_xyz("t")
    add = lambda i, j, k: F.get(flat, F.lit(i)) + F.get(flat, F.lit(j)) + F.get(flat, F.lit(k))
    return t.select("unique_id", "atom_idx", "t_xx", "t_yy", "t_zz", "t_xy", "t_xz", "t_yz", "iso",
                    add(0, 1, 2).alias("row1"), add(1, 4, 7).alias("col2"), F.element_at("p_z", 3).alias("p_z3"))


@register("atom_expressions", br.with_views("""
SELECT unique_id, atom_idx, round(CASE WHEN abs(x) < 1.0 THEN 0.5 * x * x ELSE abs(x) - 0.5 END, 8) AS huber,
       round(exp(-2.0 * (x - 0.5) * (x - 0.5)) + exp(-2.0 * (x - 1.5) * (x - 1.5)), 8) AS gauss,
       round(x - 1.37 * floor(x / 1.37), 6) AS wx, round(z - 1.37 * floor(z / 1.37), 6) AS wz, element AS symbol,
       round(z - x, 4) AS dt, 'b3lyp_631g' AS level, CASE WHEN element = 'C' THEN CAST(atom_idx AS DOUBLE) END AS k_c,
       CASE element WHEN 'C' THEN 'IEF-PCM' WHEN 'H' THEN 'C-PCM' END AS solvent_model,
       CAST(CASE element WHEN 'C' THEN 20.0 WHEN 'H' THEN 4.5 END AS DOUBLE) AS solvent_eps
FROM atoms""", "atoms"))
def q_expressions(spark, sf_dir):
    from molspark.functions import arrays as A
    from molspark.functions import ids, kernels
    from molspark.operators.batches import elapsed
    from molspark.operators.qc import level_string
    a = br.atoms(spark, sf_dir, with_z=False)
    cell = {f"{r}{i}": 1.37 if r == "abc"[i - 1] else 0.0 for r in "abc" for i in (1, 2, 3)}
    wrapped = A.wrap_to_cell(a.select("unique_id", "atom_idx", F.col("x").alias("x0"), F.col("z").alias("z0"), "element", "x", "y", "z",
                                      *[F.lit(v).alias(k) for k, v in cell.items()]))
    e = wrapped.select(
        "unique_id", "atom_idx", rk(kernels.huber("x0"), 8).alias("huber"),
        rk(F.aggregate(kernels.gaussian_expand("x0", [0.5, 1.5], 2.0), F.lit(0.0), lambda s, v: s + v), 8).alias("gauss"),
        rk(F.col("x"), 6).alias("wx"), rk(F.col("z"), 6).alias("wz"), ids.z_to_symbol(ids.symbol_to_z("element")).alias("symbol"),
        elapsed("x0", "z0").alias("dt"), level_string(F.lit("B3LYP"), F.lit("6-31G")).alias("level"),
        F.create_map(F.concat(F.lit("k_"), F.lower("element")), F.col("atom_idx").cast("double")).alias("m"),
        F.when(F.col("element") == "C", "true").when(F.col("element") == "H", "C-PCM, 4.5").otherwise("false").alias("solvent"))
    return A.resolve_solvent(A.expand_map(e, "m", keys=["k_c"])).drop("solvent")


# --- user stages (X1-X4) ---------------------------------------------------------------
@register("user_stages", br.with_views("""
SELECT unique_id, stage, outcome FROM (
  SELECT unique_id, 'each' AS stage, CASE WHEN charge = 1 THEN 'ValueError: charged' ELSE CAST(charge * 2 AS VARCHAR) END AS outcome FROM molecules
  UNION ALL SELECT unique_id, 'either', CASE WHEN charge = 1 THEN 'b' ELSE 'a' END FROM molecules
  UNION ALL SELECT unique_id, 'batches', CAST(charge + 10 AS VARCHAR) FROM molecules
  UNION ALL SELECT unique_id, 'model', CAST(charge * 3 AS VARCHAR) FROM molecules) t""", "molecules"))
def q_stages(spark, sf_dir):
    from molspark.operators import stages as X
    m = br.molecules(spark, sf_dir).select("unique_id", "charge")

    def double(row):
        if row["charge"] == 1:
            raise ValueError("charged")
        return {"v": row["charge"] * 2}

    one, failed = X.apply_stage(m, double, "unique_id string, v int", stage="each")
    either, _ = X.apply_with_fallback(m, double, lambda row: {"v": 0}, "unique_id string, v int", stage="either")
    batches, _ = X.enrich_batched(m, lambda pdf: pdf.assign(v=pdf.charge + 10), "unique_id string, v int", stage="batches")
    model = X.batch_inference(m, lambda: lambda pdf: pdf.assign(v=pdf.charge * 3)[["unique_id", "v"]], "unique_id string, v int")

    def told(df, stage, outcome):
        return df.select("unique_id", F.lit(stage).alias("stage"), F.col(outcome).cast("string").alias("outcome"))
    return (told(one, "each", "v").union(told(failed, "each", "reason")).union(told(either, "either", "method"))
            .union(told(batches, "batches", "v")).union(told(model, "model", "v")))


# --- principal frame by its invariants (A28) -------------------------------------------
@register("principal_invariants", br.with_views("""
SELECT unique_id, n, round(cx + 1e-9, 4) AS cx, round(sxx + syy + szz + 1e-9, 6) AS trace,
       round(sxx * syy + syy * szz + sxx * szz - sxy * sxy - sxz * sxz - syz * syz + 1e-9, 6) AS minors,
       round(sxx * (syy * szz - syz * syz) - sxy * (sxy * szz - syz * sxz) + sxz * (sxy * syz - syy * sxz) + 1e-8, 5) AS det,
       TRUE AS diagonal, TRUE AS descending
FROM (SELECT unique_id, count(*) AS n, avg(x) AS cx, covar_pop(x, x) AS sxx, covar_pop(y, y) AS syy, covar_pop(z, z) AS szz,
             covar_pop(x, y) AS sxy, covar_pop(x, z) AS sxz, covar_pop(y, z) AS syz FROM atoms GROUP BY 1) t""", "atoms"))
def q_principal_invariants(spark, sf_dir):
    """The rotated molecule keeps its centroid and the three invariants of its
    covariance, which is diagonal and descending in the new frame."""
    from molspark.operators.grid import principal_frame
    p = principal_frame(br.atoms(spark, sf_dir, with_z=False).select("unique_id", "atom_idx", "x", "y", "z"))
    c = p.groupBy("unique_id").agg(
        F.count(F.lit(1)).alias("n"), F.avg("x").alias("cx"), *[F.covar_pop(i, j).alias(f"s{i}{j}")
                                                                for i, j in ("xx", "yy", "zz", "xy", "xz", "yz")])
    xx, yy, zz = (F.col(f"s{i}") for i in ("xx", "yy", "zz"))
    off = F.greatest(*[F.abs(F.col(f"s{i}")) for i in ("xy", "xz", "yz")])
    return c.select("unique_id", "n", rk(F.col("cx") + 1e-9, 4).alias("cx"), rk(xx + yy + zz + 1e-9, 6).alias("trace"),
                    rk(xx * yy + yy * zz + xx * zz + 1e-9, 6).alias("minors"), rk(xx * yy * zz + 1e-8, 5).alias("det"),
                    (off < 1e-6).alias("diagonal"), ((xx >= yy - 1e-6) & (yy >= zz - 1e-6)).alias("descending"))
