import pandas as pd
import pytest
from pyspark.sql import functions as F

from molspark.operators import batches as B
from molspark.operators import qc as Q
from molspark.operators import stages as X
from molspark.operators.merge import combine_batches, combine_failures
from molspark.operators.structure import component_count, structural_duplicates


def test_distribute_and_chunks(spark):
    assert B.job_sizes(10, 3) == [4, 3, 3] and B.job_sizes(2, 3) == [1, 1, 0]
    df = B.dense_index(spark.range(10).withColumnRenamed("id", "k"), ["k"])
    assert sorted(r["idx"] for r in df.collect()) == list(range(10))
    sizes = B.distribute(df, 3).groupBy("job_id").count().orderBy("job_id").collect()
    assert [r["count"] for r in sizes] == [4, 3, 3]
    c4 = B.dense_index(spark.range(4).withColumnRenamed("id", "k"), ["k"])
    assert B.chunk(c4, 4).select("chunk_id").distinct().count() == 1
    assert B.chunk(c4, 1).select("chunk_id").distinct().count() == 4
    labels = sorted(r[0] for r in B.chunk(c4, 3, nodes=["a", "b"]).select("batch_label").distinct().collect())
    assert labels == ["batch_0-2", "batch_3-3"]
    assert B.row_range(df, 3, 4).count() == 4
    assert B.clamped_batch_size(100, 8, 32, 4096) == 32 and B.optimal_partitions(1000, 10, 4) == 8


def test_human_size(spark):
    df = spark.createDataFrame([(1023,), (1024,), (1288490,)], "n long")
    assert [r[0] for r in df.select(B.human_size("n")).collect()] == ["1023.00 B", "1.00 KB", "1.23 MB"]


def test_unions_and_accounting(spark):
    a = spark.createDataFrame([("1", 1.0)], "unique_id string, homo double")
    b = spark.createDataFrame([("2", 2.0)], "unique_id string, esp_min double")
    u = B.union_diagonal(a, b)
    assert sorted(u.columns) == ["esp_min", "homo", "unique_id"] and u.count() == 2
    with pytest.raises(ValueError):
        B.union_strict(a, b)
    assert B.dropped_inputs(u, a).first()["unique_id"] == "2"
    s = B.run_summary(u, a).first()
    assert s["success_pct"] == pytest.approx(50.0)
    empty = B.run_summary(u, a.limit(0)).first()
    assert empty["n_outputs"] == 0 and empty["time_per_structure"] is None
    f = spark.createDataFrame([("s", "r1"), ("s", "r1"), ("t", "r2")], "stage string, reason string")
    assert {(r[0], r[1]): r[2] for r in B.failure_counts(f).collect()}[("s", "r1")] == 2


def test_combine_batches_sniff(spark, tmp_path):
    root = tmp_path / "run"
    (root / "batch_0").mkdir(parents=True)
    (root / "batch_1").mkdir()
    (root / "fs-sn-2").mkdir()
    (root / "batch_0" / "molecule_property.csv").write_text(
        "unique_id,smiles,homo,num\n0012,C,-1.5,1.5\n0013,CC,-2,-2\n")
    # eleventh value not numeric -> null; exponent first -> text; all-null stays text
    vals = [str(i) for i in range(10)] + ["n/a"]
    (root / "batch_1" / "molecule_property.csv").write_text(
        "unique_id,smiles,homo,esp_min,expo,empty\n" + "".join(
            f"{i:04d},C,{v},{v},{'1e-5' if i == 0 else '2'},\n" for i, v in enumerate(vals)))
    (root / "fs-sn-2" / "molecule_property.csv").write_text("unique_id,smiles,homo\n9,N,3.25\n")
    (root / "batch_0" / "failed_inputs.txt").write_text("C1CC: bad\n")
    df = combine_batches(spark, str(root), "molecule_property.csv", out=str(tmp_path / "out"))
    types = dict(df.dtypes)
    assert types["unique_id"] == "string" and types["homo"] == "double" and types["esp_min"] == "double"
    assert types["expo"] == "string" and types["empty"] == "string" and types["num"] == "double"
    rows = {r["unique_id"]: r for r in df.collect()}
    assert "0012" in rows and rows["0010"]["esp_min"] is None and rows["9"]["batch_id"] == "fs-sn-2"
    assert spark.read.parquet(str(tmp_path / "out")).count() == 14
    assert combine_failures(spark, str(root)).first()["line"] == "C1CC: bad"


def test_smiles_rules(spark):
    df = spark.createDataFrame([(s,) for s in ["CCO", "C1CC1", "C1CC", "C(C", "C)(C", "[NH4+]",
                                               "[O-]C(=O)[O-]", "[Fe+3]", "CC.O", "Xx", "A B", ""]], "s string")
    r = {x["s"]: x for x in df.select("s", Q.smiles_lexical_reason(F.col("s")).alias("why"),
                                      Q.formal_charge(F.col("s")).alias("q"),
                                      Q.has_fragments(F.col("s")).alias("frag")).collect()}
    assert r["CCO"]["why"] is None and r["C1CC1"]["why"] is None
    assert r["C1CC"]["why"] == "unpaired_ring_closure"
    assert r["C(C"]["why"] == "unbalanced_parentheses" and r["C)(C"]["why"] == "unbalanced_parentheses"
    assert r["[NH4+]"]["q"] == 1 and r["[O-]C(=O)[O-]"]["q"] == -2 and r["[Fe+3]"]["q"] == 3
    assert r["CC.O"]["frag"] and r["Xx"]["why"].startswith("unknown_token")
    assert r["A B"]["why"] == "bad_characters" and r[""]["why"] == "empty"
    ok, bad = Q.validate_inputs(df.withColumnRenamed("s", "smiles"))
    assert ok.count() + bad.count() == df.count()
    assert bad.filter("smiles = '[NH4+]'").first()["reason"] == "charged molecule: charge = 1"


def test_fragment_truth_table(spark):
    df = spark.createDataFrame([("CCCOC[C]F.FF", True), ("FC1COC(=O)O1", False),
                                ("[CH2]OC(=O)O[CH]F", False), ("CCCOCC(F)(F)F", False)], "s string, e boolean")
    assert all(r[0] == r[1] for r in df.select(Q.has_fragments(F.col("s")), "e").collect())


def test_clip_converged_bonds(spark):
    df = spark.createDataFrame([(-20.0,), (20.0,), (20.1,), (None,), (float("nan"),)], "v double")
    c = Q.clip(df, ["v"])
    assert Q.count_clipped(c, ["v"]).first()[0] == 1
    vals = [r["v"] for r in c.collect()]
    assert vals[2] == 20.0 and vals[3] is None
    conv = spark.createDataFrame([("a", True), ("b", False), ("c", None)], "unique_id string, converged boolean")
    ok, bad = Q.split_converged(conv)
    assert [r[0] for r in ok.collect()] == ["a"] and [r[0] for r in bad.collect()] == ["b"]
    bl = spark.createDataFrame([("m", 0.49), ("m", 0.5), ("m", 3.5), ("m", 3.51), ("n", 1.0)],
                               "unique_id string, length double")
    q = {r["unique_id"]: r for r in Q.bond_length_qc(bl).collect()}
    assert q["m"]["n_bad_bonds"] == 2 and q["n"]["bond_reason"] is None


def test_select_and_rename(spark):
    assert Q.property_selection(["vdw_volume", "vdw_volume", "freq"]) == ["vdw_volume", "freq"]
    with pytest.raises(ValueError):
        Q.property_selection(["nope"])
    df = spark.createDataFrame([(1.0, None, 2.0)], "homo double, homo_ev double, esp_min_eV double")
    out = Q.canonical_names(df)
    assert sorted(out.columns) == ["esp_min_ev", "homo_ev"] and out.first()["homo_ev"] == 1.0


def test_duplicates_and_components(spark):
    schema = "unique_id string, atom_idx int, element string, x double, y double, z double"
    atoms = spark.createDataFrame([
        ("a", 0, "O", 0.0, 0.0, 0.0), ("a", 1, "H", 1.0, 0.0, 0.0), ("a", 2, "H", 0.0, 1.0, 0.0),
        ("b", 0, "O", 0.0, 0.0, 1e-9), ("b", 1, "H", 1.0, 0.0, 0.0), ("b", 2, "H", 0.0, 1.0, 0.0),
        ("c", 0, "O", 0.0, 0.0, 0.5), ("c", 1, "H", 1.0, 0.0, 0.0), ("c", 2, "H", 0.0, 1.0, 0.0)], schema)
    mols = spark.createDataFrame([("a", "O", 0), ("b", "O", 0), ("c", "O", 0)],
                                 "unique_id string, smiles string, charge int")
    d = structural_duplicates(mols, atoms).collect()
    assert [(r[0], r[1]) for r in d] == [("b", "a")]
    bonds = spark.createDataFrame([("a", 0, 1), ("b", 0, 1), ("b", 0, 2)], "unique_id string, i int, j int")
    cc = {r[0]: r[1] for r in component_count(atoms.filter("unique_id != 'c'"), bonds).collect()}
    assert cc == {"a": 2, "b": 1}


def test_duplicates_that_are_not_of_the_smallest_id(spark):
    def molecule(uid, x):
        return [(uid, 0, "C", x, 0.0, -0.0), (uid, 5, "O", 1.0, 2.0 * x, 0.0)]
    rows = molecule("a", 1.0) + molecule("b", 2.0) + molecule("b2", 2.0) + molecule("b3", 2.00001) \
        + molecule("b4", 2.01) + molecule("z", 1.0 + 1e-6)
    atoms = spark.createDataFrame(rows, "unique_id string, atom_idx int, element string, x double, y double, z double")
    mols = spark.createDataFrame([(u, "CO", 0) for u in ("a", "b", "b2", "b3", "b4", "z")],
                                 "unique_id string, smiles string, charge int")
    got = sorted((r[0], r[1]) for r in structural_duplicates(mols, atoms).collect())
    assert got == [("b2", "b"), ("b3", "b"), ("z", "a")]


def test_array_properties_within_tolerance(spark):
    atoms = spark.createDataFrame([(u, 0, "C", 0.0, 0.0, 0.0) for u in "abcdefgh"],
                                  "unique_id string, atom_idx int, element string, x double, y double, z double")
    freq = {"a": [1.0, 2.0], "b": [1.0, 2.0 + 1e-6], "c": [1.0, 2.1], "d": [1.0], "e": None, "f": [float("nan"), 2.0],
            "g": [1.0, 2.0], "h": [1.0, None]}
    mols = spark.createDataFrame([(u, "C", f, "p" if u != "g" else "q") for u, f in freq.items()],
                                 "unique_id string, smiles string, freq array<double>, level string")
    got = {(r[0], r[1]) for r in structural_duplicates(mols, atoms, property_cols=["level"], array_cols=["freq"]).collect()}
    assert got == {("b", "a"), ("e", "a")}  # an array that only the smaller id has is not compared
    assert len(structural_duplicates(mols, atoms, property_cols=["level"]).collect()) == 6


def test_centred_conformers_do_not_all_meet(spark):
    from molspark.operators import structure as S
    n = 3000
    rows = (spark.range(n).select(F.format_string("%05d", "id").alias("unique_id"), F.rand(1).alias("u"), F.rand(2).alias("v"))
            .checkpoint())
    near = rows.where("unique_id < '00300'").select(F.concat("unique_id", F.lit("n")).alias("unique_id"), F.col("u") + 1e-9, "v")
    far = rows.limit(1).select(F.lit("far").alias("unique_id"), F.lit(1e6).alias("u"), F.lit(-1e6).alias("v"))  # widens every spread
    every = rows.union(near).union(far)
    atoms = every.select("unique_id", F.explode(F.expr("""array(
        named_struct('atom_idx', 0, 'element', 'C', 'x', u, 'y', v, 'z', 0D),
        named_struct('atom_idx', 1, 'element', 'C', 'x', -u, 'y', -v, 'z', 0D))""")).alias("a")).select("unique_id", "a.*")
    mols = every.select("unique_id", F.lit("CC").alias("smiles"))
    seen = []
    before = S.duplicate_candidates

    def spy(*a, **k):
        out = before(*a, **k)
        seen.append(out)
        return out
    S.duplicate_candidates = spy
    try:
        got = structural_duplicates(mols, atoms).collect()
    finally:
        S.duplicate_candidates = before
    assert {(r[0], r[1]) for r in got} >= {(f"{i:05d}n", f"{i:05d}") for i in range(300)}
    assert len(got) <= 310 and seen[0].count() <= 10 * len(got)


def test_components_of_a_long_chain(spark):
    atoms = spark.range(1000).select(F.lit("p").alias("unique_id"), F.col("id").cast("int").alias("atom_idx"))
    bonds = spark.range(999).filter("id <> 700").select(F.lit("p").alias("unique_id"), F.col("id").cast("int").alias("i"),
                                                         (F.col("id") + 1).cast("int").alias("j"))
    assert component_count(atoms, bonds).first()["n_components"] == 2


def test_stages(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", -1.0)], "unique_id string, v double")

    def solver(rec):
        if rec["v"] < 0:
            raise ValueError("no convergence")
        return {"unique_id": rec["unique_id"], "v": rec["v"] * 2}
    ok, fails = X.apply_stage(df, solver, "unique_id string, v double")
    assert [tuple(r) for r in ok.collect()] == [("a", 2.0)]
    assert fails.first()["reason"].startswith("ValueError")
    kept, _ = X.apply_stage(df, solver, "unique_id string, v double", on_error="keep")
    assert kept.count() == 2
    fb, _ = X.apply_with_fallback(df, solver, lambda r: {"unique_id": r["unique_id"], "v": 0.0},
                                  "unique_id string, v double")
    assert {r["unique_id"]: r["method"] for r in fb.collect()} == {"a": "a", "b": "b"}

    calls = []

    def remote(pdf):
        calls.append(len(pdf))
        return pdf.assign(v=pdf.v + 1)
    four = spark.createDataFrame([(str(i), float(i)) for i in range(4)], "unique_id string, v double").coalesce(1)
    assert X.enrich_batched(four, remote, "unique_id string, v double", batch_size=3)[0].count() == 4

    def flaky(pdf):
        raise RuntimeError("down")
    out, failed = X.enrich_batched(four, flaky, "unique_id string, v double", batch_size=2, retries=2,
                                   backoff=0.0, sleep=lambda s: None)
    assert out.count() == 0
    assert sorted((r["unique_id"], r["reason"]) for r in failed.collect()) == [
        (str(i), "RuntimeError: down") for i in range(4)]

    def make_model():
        return lambda pdf: pdf.assign(v=pdf.v * 10)
    inf = X.batch_inference(four.withColumn("num_atoms", F.lit(3)), make_model,
                            "unique_id string, v double, num_atoms int", batch_size=2)
    assert sorted(r["v"] for r in inf.collect()) == [0.0, 10.0, 20.0, 30.0]
    pm = X.per_molecule(four, lambda pdf: pd.DataFrame({"unique_id": pdf.unique_id[:1], "n": [len(pdf)]}),
                        "unique_id string, n long")
    assert pm.count() == 4


def test_stream_merge(spark, tmp_path):
    from molspark.streaming.combine import combine_stream
    root = tmp_path / "run"
    (root / "batch_0").mkdir(parents=True)
    (root / "batch_0" / "molecule_property.csv").write_text("unique_id,smiles,homo\n001,C,-1.5\n002,CC,-2.5\n")
    out, ck, bad = str(tmp_path / "merged"), str(tmp_path / "ck"), str(tmp_path / "bad")
    schema = "unique_id string, smiles string, homo double, note string"

    def run():
        combine_stream(spark, str(root), "molecule_property.csv", schema, out, ck, dedupe_key="unique_id", rejects_out=bad)
        return spark.read.parquet(out)

    assert run().count() == 2
    (root / "batch_1").mkdir()  # other order, another column, a known key and a cell that is no number
    (root / "batch_1" / "molecule_property.csv").write_text(
        'homo,unique_id,extra,smiles,note\n-3.5,003,x,N,"two\nlines, ""quoted"""\n-1.5,001,x,C,\nn/a,004,x,O,\n')
    m = run()
    rows = {r["unique_id"]: r for r in m.collect()}
    assert dict(m.dtypes)["homo"] == "double" and set(rows) == {"001", "002", "003", "004"} and m.count() == 4
    assert (rows["003"]["smiles"], rows["003"]["homo"], rows["003"]["note"]) == ("N", -3.5, 'two\nlines, "quoted"')
    assert rows["004"]["homo"] is None
    assert [(r["column"], r["value"]) for r in spark.read.parquet(bad).collect()] == [("homo", "n/a")]
    assert run().count() == 4      # every file exactly once


def test_stream_merge_keeps_one_row_of_each_key_for_good(spark, tmp_path):
    from molspark.streaming.combine import combine_stream
    root, out, ck = tmp_path / "run", str(tmp_path / "merged"), str(tmp_path / "ck")
    root.mkdir()
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")

    def load(batch, text):
        (root / batch).mkdir()
        (root / batch / "molecule_property.csv").write_text("unique_id,homo\n" + text)

    def run():
        combine_stream(spark, str(root), "molecule_property.csv", "unique_id string, homo double", out, ck,
                       dedupe_key="unique_id", files_per_epoch=1)
        return sorted((r.unique_id or "", r.homo) for r in spark.read.schema(
            "unique_id string, homo double").parquet(out).collect())

    combine_stream(spark, str(root), "molecule_property.csv", "unique_id string, homo double", out, ck,
                   dedupe_key="unique_id")                       # nothing there yet
    load("batch_0", "a,1\na,1\n,5\n")
    assert run() == [("", 5.0), ("a", 1.0)]
    load("batch_1", "a,2\nb,3\n,6\n")
    load("batch_2", "b,3\na,9\nc,4\n")
    assert run() == run() == [("", 5.0), ("a", 1.0), ("b", 3.0), ("c", 4.0)]
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before


def test_small_helpers(spark):
    from molspark.functions import arrays as A
    from molspark.functions.text import smiles_features, xyz_line
    r = spark.createDataFrame([("C[C@H](O)[NH3+].[Cl-]",)], "s string").select(
        smiles_features(F.col("s")).alias("f")).first()["f"]
    assert r["n_bracket_atoms"] == 3 and r["formal_charge"] == 0 and r["n_fragments"] == 2
    assert r["has_stereo"] and r["n_heavy_atoms"] == 5
    line = spark.range(1).select(xyz_line(F.lit("C"), F.lit(0.0), F.lit(1.5), F.lit(-2.0))).first()[0]
    assert line == "C  %15.6f %15.6f %15.6f" % (0.0, 1.5, -2.0)
    df = spark.createDataFrame([([[1.0, 2.0, 3.0], [4.0, 5.0, 6.0]], {"a": 1.0})],
                               "xyz array<array<double>>, p map<string,double>")
    flat = df.select(A.flatten_xyz("xyz").alias("f")).first()["f"]
    assert flat == [1.0, 2.0, 3.0, 4.0, 5.0, 6.0]
    assert df.select(A.unflatten_xyz(A.flatten_xyz("xyz")).alias("u")).first()["u"] == [[1.0, 2.0, 3.0], [4.0, 5.0, 6.0]]
    e = A.expand_map(df, "p", "property_", keys=["a", "b"]).first()
    assert e["property_a"] == 1.0 and e["property_b"] is None
    cell = spark.createDataFrame([(7.5, -1.0, 13.0, 5.0, 0.0, 0.0, 0.0, 5.0, 0.0, 0.0, 0.0, 5.0)],
                                 "x double, y double, z double, a1 double, a2 double, a3 double, "
                                 "b1 double, b2 double, b3 double, c1 double, c2 double, c3 double")
    w = A.wrap_to_cell(cell).first()
    assert (w["x"], w["y"], w["z"]) == pytest.approx((2.5, 4.0, 3.0))
    sv = A.resolve_solvent(spark.createDataFrame([("true",), ("water,78.4",), ("x,-1",), ("false",)],
                                                 "solvent string")).collect()
    assert (sv[0]["solvent_model"], sv[0]["solvent_eps"]) == ("IEF-PCM", 20.0)
    assert sv[1]["solvent_eps"] == 78.4 and sv[2]["solvent_model"] is None and sv[3]["solvent_eps"] is None


def test_manifest_check_and_gates(spark):
    man = spark.createDataFrame([("b1", "/l/a", "r/a"), ("b1", "/l/b", "r/b"), ("zz", "/l/c", "r/c")],
                                "bucket string, local_path string, remote_path string")
    inv = spark.createDataFrame([("b1", "r/a")], "bucket string, key string")
    bk = spark.createDataFrame([("b1",)], "bucket string")
    ok, bad = Q.check_manifest(man, inv, bk, "upload")
    assert [r["remote_path"] for r in ok.collect()] == ["r/b"]
    reasons = {r["remote_path"]: r["reason"] for r in bad.collect()}
    assert reasons == {"r/a": "object already exists", "r/c": "bucket does not exist"}
    ok_d, _ = Q.check_manifest(man, inv, bk, "download")
    assert [r["remote_path"] for r in ok_d.collect()] == ["r/a"]
    df = spark.createDataFrame([(1, 2.0), (2, 3.0)], "multiplicity int, homo double")
    assert [r["homo"] for r in Q.closed_shell_only(df, ["homo"]).collect()] == [2.0, None]
    rad = spark.createDataFrame([("m", 1), ("m", 0), ("n", 0)], "unique_id string, num_radical_electrons int")
    assert [r["unique_id"] for r in Q.flag_radicals(rad).collect()] == ["m"]
    atoms = spark.createDataFrame([("m", 1, "CC"), ("m", 0, "C")], "unique_id string, atom_idx int, smiles string")
    assert B.representative_smiles(atoms).first()["smiles"] == "C"
    cols, rows = B.preview(atoms, 1)
    assert cols == ["unique_id", "atom_idx", "smiles"] and len(rows) == 1


def test_group_rank_matches_window(spark):
    from pyspark.sql import Window
    rows = [("hot", i % 7, i) for i in range(300)] + [(f"k{i}", i % 3, i) for i in range(50)]
    df = spark.createDataFrame(rows, "k string, a int, b int")
    ref = df.withColumn("r0", (F.row_number().over(Window.partitionBy("k").orderBy("a", "b")) - 1).cast("int"))
    got = B.group_rank(df, ["k"], ["a", "b"], out="r1", count_out="n", partitions=6)
    j = ref.join(got, ["k", "a", "b"])
    assert j.count() == 350 and j.filter("r0 != r1").count() == 0
    assert j.filter("k = 'hot'").select("n").distinct().first()[0] == 300


def test_header_groups(spark, tmp_path):
    from molspark.sources.files import group_by_header, header_columns
    paths = []
    for i in range(5):
        p = tmp_path / f"f{i}.csv"
        p.write_text(("a,b\n" if i % 2 else "a,c\r\n") + "1,2\n3,4\n")
        paths.append(str(p))
    (tmp_path / "empty.csv").write_text("")
    groups = group_by_header(spark, [*paths, str(tmp_path / "empty.csv")])
    assert {h: [f[-6:] for f in files] for h, files in groups.items()} == {
        "a,b": ["f1.csv", "f3.csv"], "a,c": ["f0.csv", "f2.csv", "f4.csv"]}
    assert header_columns('a, "b, ""c""",d') == ["a", 'b, "c"', "d"] or header_columns('a,"b, ""c""",d') == ["a", 'b, "c"', "d"]


def test_types_do_not_depend_on_header_groups(spark, tmp_path):
    root = tmp_path / "run"
    for i, text in enumerate(['id,v,block\n1,2.5,"a\nb"\n2,,"say ""hi"", ok"\n', "v,id\nx1,3\n", "id,v,w\n4,7,1\n5,8,oops\n"]):
        (root / f"batch_{i}").mkdir(parents=True)
        (root / f"batch_{i}" / "molecule_property.csv").write_text(text)
    df = combine_batches(spark, str(root), "molecule_property.csv", rejects_out=str(tmp_path / "rejects"))
    assert dict(df.dtypes)["v"] == "string" and dict(df.dtypes)["w"] == "string" and df.count() == 5
    rows = {r["id"]: r for r in df.withColumn("id", F.col("id").cast("int")).collect()}
    assert rows[1]["block"] == "a\nb" and rows[2]["block"] == 'say "hi", ok' and rows[3]["v"] == "x1"
    assert spark.read.parquet(str(tmp_path / "rejects")).count() == 0




def test_the_inventory_is_not_sent_to_every_task(spark):
    man = spark.createDataFrame([("b1", "/l/a", "r/a"), (None, "/l/b", "r/b")], "bucket string, local_path string, remote_path string")
    inv = spark.createDataFrame([("b1", "r/a"), ("b1", "r/a")], "bucket string, key string")
    ok, bad = Q.check_manifest(man, inv, spark.createDataFrame([("b1",)], "bucket string"))
    assert bad._jdf.queryExecution().executedPlan().toString().count("BroadcastExchange") == 1  # the buckets
    assert ok.count() == 0
    assert sorted((r["remote_path"], r["reason"]) for r in bad.collect()) == [
        ("r/a", "object already exists"), ("r/b", "bucket does not exist")]
