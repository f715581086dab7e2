import json
import os

import pytest
from pyspark.sql import functions as F

from molspark.operators.qc import SMILES_COLUMN_ALIASES, resolve_smiles_column
from molspark.sinks import tables as K
from molspark.sources import files as S
from molspark.sources.smiles import is_single_column, read_input, read_smiles, validate_sample
from molspark.sources.xyz import parse_xyz, read_xyz_dir

SMILES7 = ["C", "CC", "CCO", "c1ccccc1", "O=C=O", "N#N", "[Na+].[Cl-]"]


@pytest.mark.parametrize("alias", SMILES_COLUMN_ALIASES)
def test_read_smiles_csv_aliases(spark, tmp_path, alias):
    p = tmp_path / "in.csv"
    p.write_text(f"{alias},charge\n" + "".join(f"{s},0\n" for s in SMILES7) + ",1\n#comment,0\n\n")
    got = [r["smiles"] for r in read_smiles(spark, str(p)).collect()]
    assert got == SMILES7


def test_alias_priority():
    assert resolve_smiles_column(["SMILES", "smiles"]) == "smiles"
    with pytest.raises(ValueError):
        resolve_smiles_column(["foo"])


def test_read_smiles_text_and_parquet(spark, tmp_path):
    t = tmp_path / "in.txt"
    t.write_text("C\n\n#x\n #y\n  CC  \n")
    assert [r[0] for r in read_smiles(spark, str(t)).collect()] == ["C", "#y", "CC"]
    pq = str(tmp_path / "in.parquet")
    spark.createDataFrame([("C",), ("",), (None,), ("N",)], "smi string").write.parquet(pq)
    assert sorted(r[0] for r in read_input(spark, pq).collect()) == ["C", "N"]
    with pytest.raises(ValueError):
        read_input(spark, str(tmp_path / "x.sdf"))


def test_validators(spark, tmp_path):
    good = tmp_path / "g.txt"
    good.write_text("# header\nC\nCCO\n")
    bad = tmp_path / "b.txt"
    bad.write_text("C extra\n")
    assert is_single_column(spark, str(good)) and not is_single_column(spark, str(bad))
    c = tmp_path / "v.csv"
    c.write_text("smi\nC\nA(BC\n")
    ok, first_bad = validate_sample(spark, str(c))
    assert not ok and first_bad == "A(BC"
    c2 = tmp_path / "n.csv"
    c2.write_text("name\nC\n")
    assert validate_sample(spark, str(c2))[0] is False


XYZ_ANNOTATED = """5
B(=O)OB=O unique_id:54355245865 charge:0 multiplicity:1 energy_hartree:-275.62039364954484
B 1.0E+00 0.0 0.0
O 2.0 0.0 0.0
O 0.0 1.0 0.0
B 0.0 2.0 0.0
O 0.0 3.0 1.5e-1
"""


def test_parse_annotated_and_basic(spark):
    df = spark.createDataFrame([(XYZ_ANNOTATED,)], "text string")
    m, a, f = parse_xyz(df, "text", mode="annotated")
    r = m.first()
    assert r["unique_id"] == "54355245865" and r["smiles"] == "B(=O)OB=O"
    assert r["energy_hartree"] == pytest.approx(-275.62039364954484) and r["num_atoms"] == 5
    assert a.count() == 5 and f.count() == 0
    assert a.filter("atom_idx = 4").first()["z"] == pytest.approx(0.15)
    water = "3\nO\nO 0 0 0\nH 1 0 0\nH 0 1 0\n"
    mb, ab, _ = parse_xyz(spark.createDataFrame([(water,)], "text string"), "text", mode="basic")
    rb = mb.first()
    assert rb["smiles"] == "O" and rb["multiplicity"] == 1 and len(rb["unique_id"]) == 16


def test_parse_tokens_charge_column(spark):
    blocks = ["1\nXX\nF 0 0 0 -1\n",                 # extended: charge column 4 -> total -1
              "2\nX\nH 0 0 0 1.25\nH 0 0 1 1.25\n",  # 2.5 -> 2 (half even)
              "2\nC charge:-1 multiplicity:2 unique_id:abc\nC 0 0 0\nO 0 0 1.1\n",
              "2\nC\nC 0 0\nO 0 0 1.1\n"]            # truncated row -> failure
    df = spark.createDataFrame([(b,) for b in blocks], "t string")
    m, a, f = parse_xyz(df, "t", mode="tokens", charge_col_idx=4)
    charges = sorted(r["charge"] for r in m.collect())
    assert charges == [-1, -1, 2]
    tagged = m.filter("unique_id = 'abc'").first()
    assert tagged["multiplicity"] == 2 and tagged["smiles"] == "C"
    assert f.count() == 1


def test_xyz_dir_and_roundtrip(spark, tmp_path):
    d = tmp_path / "xyz"
    d.mkdir()
    (d / "mol1.xyz").write_text(XYZ_ANNOTATED)
    (d / "bad.xyz").write_text("2\nc\nC 0 0\n")
    m, a, f = read_xyz_dir(spark, str(d))
    assert [r["unique_id"] for r in m.collect()] == ["mol1"]
    assert [r["unique_id"] for r in f.collect()] == ["bad"]
    blocks = K.xyz_blocks(m, a)
    m2, a2, _ = parse_xyz(blocks.select("xyz_block"), "xyz_block", mode="annotated")
    assert m2.first()["unique_id"] == "mol1" and a2.count() == 5
    assert m2.first()["energy_hartree"] == pytest.approx(-275.62039364954484)


def test_extract_xyz_fixed_width(spark, tmp_path):
    a = spark.createDataFrame([("m", 0, "C", 0.0, 0.0, 0.0, "C", 0.1), ("m", 1, "O", 1.2, 0.0, 0.0, "C", -0.1)],
                              "unique_id string, atom_idx int, element string, x double, y double, z double, "
                              "smiles string, q double")
    t = K.extract_xyz(a).first()["xyz_text"].split("\n")
    assert t[0] == "2" and t[1] == "C unique_id:m AddtionalColumns:q"
    assert t[2] == "C  %15.6f %15.6f %15.6f %15.6f" % (0, 0, 0, 0.1)
    n = K.write_xyz_files(K.extract_xyz(a), str(tmp_path / "out"))
    assert n == 1 and os.path.isdir(tmp_path / "out" / "unique_id=m")


def test_molecule_atom_metadata_tables(spark, tmp_path):
    m = spark.createDataFrame([("12345678901", "C", 1, -40.528), ("12345678902", "N#N", 1, -109.556)],
                              "unique_id string, smiles string, multiplicity int, energy_hartree double")
    a = spark.createDataFrame(
        [("12345678901", 0, "C", 0.0, 0.0, 0.0)] + [("12345678901", i, "H", 0.629, 0.629, 0.629) for i in range(1, 5)]
        + [("12345678902", 0, "N", 0.0, 0.0, 0.0), ("12345678902", 1, "N", 0.0, 0.0, 1.1)],
        "unique_id string, atom_idx int, element string, x double, y double, z double")
    for fmt in ("csv", "parquet"):
        K.write_molecules(m, str(tmp_path / f"mol.{fmt}"), fmt)
        K.write_atoms(a, str(tmp_path / f"atom.{fmt}"), fmt)
    assert spark.read.option("header", True).csv(str(tmp_path / "mol.csv")).count() == 2
    assert spark.read.parquet(str(tmp_path / "atom.parquet")).count() == 7
    K.write_atoms(a, str(tmp_path / "meta.parquet"), table_metadata={"functional": "b3lyp", "basis": "def2"})
    md = spark.read.parquet(str(tmp_path / "meta.parquet")).schema["unique_id"].metadata
    assert md == {"functional": "b3lyp", "basis": "def2"}
    meta = {r["unique_id"]: r["num_atoms"] for r in K.metadata_table(m, a).collect()}
    assert meta == {"12345678901": 5, "12345678902": 2}
    with pytest.raises(ValueError):
        K.write_molecules(m, str(tmp_path / "x.xlsx"), "xlsx")


def test_json_roundtrip(spark, tmp_path):
    m = spark.createDataFrame([("a", "N#N", 0, 1)], "unique_id string, smiles string, charge int, multiplicity int")
    at = spark.createDataFrame([("a", 0, "N", 7, 0.0, 0.0, 0.0), ("a", 1, "N", 7, 0.0, 0.0, 1.1)],
                               "unique_id string, atom_idx int, element string, z_num int, x double, y double, z double")
    j = K.structures_json(m, at).first()
    p = tmp_path / "s.json"
    p.write_text(json.dumps([{"elements": j["elements"], "xyz": [list(v) for v in j["xyz"]],
                              "unique_id": "a", "smiles": "N#N", "charge": 0}]))
    mm, aa, bad = S.read_structures_json(spark, str(p))
    assert bad.count() == 0
    assert mm.first()["num_atoms"] == 2 and aa.filter("atom_idx = 1").first()["z"] == pytest.approx(1.1)
    (tmp_path / "one.json").write_text(json.dumps({"elements": ["H"], "xyz": [[0, 0, 0]], "unique_id": "h"}))
    assert S.read_structures_json(spark, str(tmp_path / "one.json"))[0].count() == 1


def test_nested_export_and_append(spark, tmp_path):
    m = spark.createDataFrame([("a", "N#N", -1.0)], "unique_id string, smiles string, homo_ev double")
    at = spark.createDataFrame([("a", 1, "N", 0.0, 0.0, 1.1), ("a", 0, "N", 0.0, 0.0, 0.0)],
                               "unique_id string, atom_idx int, element string, x double, y double, z double")
    e = K.nested_export(m, at, property_cols=["homo_ev", "lumo_ev"]).first()
    assert e["xyz_flat"] == [0.0, 0.0, 0.0, 0.0, 0.0, 1.1] and e["property_lumo_ev"] is None
    K.write_nested_export(K.nested_export(m, at), str(tmp_path / "n.parquet"), "zstd")
    spark.sql("DROP TABLE IF EXISTS appendtarget")
    spark.createDataFrame([], "Unique_ID string, SMILES string, extra double").write.saveAsTable("appendtarget")
    K.append_by_name(m, "appendtarget")
    r = spark.table("appendtarget").first()
    assert r["Unique_ID"] == "a" and r["SMILES"] == "N#N" and r["extra"] is None
    spark.sql("DROP TABLE appendtarget")


def test_manifest_and_inventory(spark, tmp_path):
    p = tmp_path / "m.csv"
    p.write_text("b1, /local/a , remote/a\n,,\nb1,only\n")
    good, bad = S.read_manifest(spark, str(p), "upload")
    assert [tuple(r) for r in good.collect()] == [("b1", "/local/a", "remote/a")]
    assert bad.count() == 1
    inv = S.file_inventory(spark, str(tmp_path))
    assert inv.filter(F.col("key").endswith("m.csv")).first()["size"] == p.stat().st_size


def test_with_stage(spark, tmp_path):
    calls = []

    def make():
        calls.append(1)
        return spark.range(3)
    path = str(tmp_path / "stage")
    assert K.with_stage(spark, make, path).count() == 3
    assert K.with_stage(spark, make, path).count() == 3
    assert len(calls) == 1
    K.drop_stage(spark, path)  # the job succeeded: the next run computes anew
    assert K.with_stage(spark, make, path).count() == 3 and len(calls) == 2


def test_white_space_and_file_order(spark, tmp_path):
    from molspark.sources import smiles as SM
    from molspark.sources.xyz import parse_xyz, read_xyz_table
    p = tmp_path / "s.txt"
    p.write_text("CC\t\n\t\n  \u00a0N \n# c\n")
    assert [r[0] for r in SM.read_smiles(spark, str(p)).collect()] == ["CC", "N"]
    (tmp_path / "five.txt").write_text("#a\n#b\n#c\n#d\n#e\nC C\n")
    assert SM.is_single_column(spark, str(tmp_path / "five.txt"))
    block = "\n2\nCC charge:0\nC 0 0 0\nC 0 0 1\n"
    m, a, bad = parse_xyz(spark.createDataFrame([(block,)], "text string"), mode="tokens")
    assert (m.count(), a.count(), bad.count()) == (1, 2, 0)
    t = spark.createDataFrame([(s, block.strip()) for s in ("S", "N", "C")], "smiles string, xyz_block string").coalesce(1)
    assert read_xyz_table(t, 0, 1)[0].first()["smiles"] == "S"


def test_broken_json_and_atom_properties(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"elements": ["H", "O"], "xyz": [[0, 0, 0], [0, 0, 1]], "unique_id": "h",
                                                 "atom_property": {"charge": [0.25, -0.25]}}))
    (tmp_path / "b.json").write_text("{nope")
    m, a, bad = S.read_structures_json(spark, str(tmp_path / "*.json"))
    assert m.count() == 1 and [r["atom_property"]["charge"] for r in a.orderBy("atom_idx").collect()] == [0.25, -0.25]
    assert [r["path"][-6:] for r in bad.collect()] == ["b.json"]


def test_quoted_manifest(spark, tmp_path):
    (tmp_path / "m.csv").write_text('b1,"x, y",k/1\n\n b2 , p , "say ""q"""\nonly,two\n')
    rows, bad = S.read_manifest(spark, str(tmp_path / "m.csv"))
    assert [tuple(r) for r in rows.collect()] == [("b1", "x, y", "k/1"), ("b2", "p", 'say "q"')] and bad.count() == 1


def test_xyz_lines_long_form(spark, tmp_path):
    a = spark.createDataFrame([("m", 1, "O", 1.2, 0.0, 0.0, "C", -0.1), ("m", 0, "C", 0.0, 0.0, 0.0, "C", 0.1)],
                              "unique_id string, atom_idx int, element string, x double, y double, z double, "
                              "smiles string, q double")
    lines = [r["line"] for r in K.xyz_lines(a).orderBy("line_no").collect()]
    block = K.extract_xyz(a).first()["xyz_text"].split("\n")
    assert lines == block
    K.write_xyz_lines(K.xyz_lines(a), str(tmp_path / "x"))
    files = list((tmp_path / "x" / "unique_id=m").glob("part-*"))
    text = "".join(f.read_text() for f in files if f.stat().st_size)
    assert text.splitlines() == block


def test_lines_of_a_block_are_split_once(spark):
    from molspark.sources.xyz import parse_xyz
    text = "2\nCO unique_id:a charge:1\nO 0 0 0.5\n\nH 0 0 1.5\n"
    df = spark.createDataFrame([("a", text), ("b", "1\nCO\nH 0 0"), ("c", None), ("d", "0\nx\n")], "src string, t string")
    for mode in ("basic", "annotated", "tokens"):
        m, a, bad = parse_xyz(df, "t", mode=mode, id_col="src")
        for x in (m, a.groupBy("unique_id").sum("z")):
            assert x._jdf.queryExecution().optimizedPlan().toString().count("split(regexp_replace(lambda") <= 1
        assert sorted((r.unique_id, r.num_atoms) for r in m.collect()) == [("a", 2), ("d", 0)]
        assert sorted((r.unique_id, r.atom_idx, r.z) for r in a.collect()) == [("a", 0, 0.5), ("a", 1, 1.5)]
        assert [r.unique_id for r in bad.collect()] == ["b"]


def test_comment_is_split_once_and_ends_of_plain_lines_are_not_searched(spark):
    from molspark.sources.xyz import parse_xyz
    text = "2\r\nCO \t charge:1  unique_id:a multiplicity:2\r\n\u00a0O 0\t0  0.5 \r\n \u2003\r\nH 0 0 1.5\u00a0"
    df = spark.createDataFrame([(text,), ("1\nCO unique_id:b\nH 0 0 x",), ("1\nCO unique_id:c\n H\u00a00 0 0 1",)], "t string")
    m, a, bad = parse_xyz(df, "t", mode="tokens")
    for x in (m, a):
        plan = x._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("regexp_extract_all(lambda") == 1 == plan.count("regexp_extract_all(trim(")
    assert sorted((r.unique_id, r.smiles, r.charge, r.multiplicity, r.num_atoms) for r in m.collect()) == \
        [("a", "CO", 1, 2, 2), ("c", "CO", 0, 1, 1)]
    assert sorted((r.unique_id, r.element, r.x, r.z) for r in a.collect()) == \
        [("a", "H", 0.0, 1.5), ("a", "O", 0.0, 0.5), ("c", "H\u00a00", 0.0, 1.0)]
    assert [r.unique_id for r in bad.collect()] == ["b"]


def test_xyz_row_range_orders_written_blocks(spark, tmp_path, monkeypatch):
    """The search for the borders of the ranges does not build the blocks again."""
    from molspark.plans.queries_structure import q_xyz_row_range
    orders = [(i, i, 10.0, "F", "1-URGENT") for i in range(40)]
    lines = [(i, 1 + j, i, j, 100.0, 10.0, 0.05, 0.02) for i in range(40) for j in range(2)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_totalprice double, o_orderstatus string, o_orderpriority string") \
        .write.parquet(str(tmp_path / "orders.parquet"))
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_extendedprice double, "
                          "l_quantity double, l_discount double, l_tax double").write.parquet(str(tmp_path / "lineitem.parquet"))
    kind = type(spark.range(1))
    plans, ranged = [], kind.repartitionByRange

    def seen(self, *args):
        plans.append(self._jdf.queryExecution().optimizedPlan().toString())
        return ranged(self, *args)

    monkeypatch.setattr(kind, "repartitionByRange", seen)
    got = [(r.smiles, r.num_atoms, r.sum_x) for r in q_xyz_row_range(spark, str(tmp_path)).collect()]
    assert got == [("CO", 2, 2.0)] * 20
    assert len(plans) == 1 and "Aggregate" not in plans[0] and "Window" not in plans[0]
