import pytest

from molspark.functions.units import HARTREE_EV
from molspark.operators import energetics as en
from molspark.refdata import resolve_energy_column
from tests.conftest import atoms_from_counts

ATOM_SCHEMA = "unique_id string, atom_idx int, element string, x double, y double, z double"

# Golden cases: smiles, element counts, molecule energy (eV), heat (eV), reaction products.
GOLDEN = [
    ("OC(O)(F)F", {"C": 1, "H": 2, "O": 2, "F": 2}, 0.0, 0.0, None),
    ("OO", {"H": 2, "O": 2}, 0.0, 0.0, None),
    ("CO", {"C": 1, "H": 4, "O": 1}, 0.0, -3158.019652569623,
     "1.00 * CO + 1.50 * O2 -> 2.00 * H2O + 1.00 * CO2"),
    ("[C-]#[O+]", {"C": 1, "O": 1}, 0.0, -3088.2150793075243,
     "1.00 * [C-]#[O+] + 0.50 * O2 -> 1.00 * CO2"),
    ("CN(C)S(=O)(=O)F", {"C": 2, "H": 6, "N": 1, "O": 2, "S": 1, "F": 1}, 0.0, -21327.63350042753,
     "1.00 * CN(C)S(=O)(=O)F + 3.25 * O2 -> 2.50 * H2O + 2.00 * CO2 + 0.50 * N2 + 1.00 * HF + 1.00 * SO2"),
    ("O=S(=O)(F)CCCCCF", {"C": 5, "H": 10, "O": 2, "S": 1, "F": 2}, -944.9859370316980 * HARTREE_EV,
     -38.37295288985479,
     "1.00 * O=S(=O)(F)CCCCCF + 7.00 * O2 -> 4.00 * H2O + 5.00 * CO2 + 2.00 * HF + 1.00 * SO2"),
    ("FC(Cl)OP(=S)(OC)F", {"C": 2, "H": 4, "O": 2, "P": 1, "S": 1, "F": 2, "Cl": 1}, 0.0,
     -44338.306357703754,
     "1.00 * FC(Cl)OP(=S)(OC)F + 3.50 * O2 -> 0.50 * H2O + 2.00 * CO2 + 2.00 * HF + 0.50 * P2O5 "
     "+ 1.00 * SO2 + 1.00 * HCl"),
    ("CN(C)C(=O)OP(=S)(F)Cl", {"C": 3, "H": 6, "N": 1, "O": 2, "P": 1, "S": 1, "F": 1, "Cl": 1}, 0.0,
     -44190.87101069842,
     "1.00 * CN(C)C(=O)OP(=S)(F)Cl + 5.25 * O2 -> 2.00 * H2O + 3.00 * CO2 + 0.50 * N2 + 1.00 * HF "
     "+ 0.50 * P2O5 + 1.00 * SO2 + 1.00 * HCl"),
    ("FC[Si](Cl)(Cl)OP(=S)(N)C=O", {"C": 2, "H": 5, "N": 1, "O": 2, "Si": 1, "P": 1, "S": 1, "F": 1,
                                    "Cl": 2}, 0.0, -63535.52364373139,
     "1.00 * FC[Si](Cl)(Cl)OP(=S)(N)C=O + 4.75 * O2 -> 1.00 * H2O + 2.00 * CO2 + 0.50 * N2 + 1.00 * HF "
     "+ 1.00 * SiO2 + 0.50 * P2O5 + 1.00 * SO2 + 2.00 * HCl"),
]


def _run(spark, cases):
    atoms, mols = [], []
    for i, (smi, counts, e, _h, _r) in enumerate(cases):
        uid = f"m{i}"
        atoms += atoms_from_counts(spark, counts, uid)
        mols.append((uid, smi, e))
    a = spark.createDataFrame(atoms, ATOM_SCHEMA)
    m = spark.createDataFrame(mols, "unique_id string, smiles string, energy_ev double")
    out = en.combustion_heat(m, a).orderBy("unique_id").collect()
    return {r["unique_id"]: r for r in out}


def test_combustion_golden(spark):
    got = _run(spark, GOLDEN)
    for i, (smi, _c, _e, heat, reaction) in enumerate(GOLDEN):
        r = got[f"m{i}"]
        assert r["combustion_heat_ev"] == pytest.approx(heat, abs=1e-6), smi
        assert r["combustion_reaction"] == (reaction or ""), smi


def test_combustion_edges(spark):
    cases = [
        ("CF4", {"C": 1, "F": 4}, 0.0, 0.0, None),          # oxygen demand 0
        ("C6F6", {"C": 6, "F": 6}, 0.0, None, None),        # negative H flows through
        ("AlX", {"C": 1, "Al": 1}, 0.0, 0.0, None),         # unsupported element
    ]
    got = _run(spark, cases)
    assert got["m0"]["combustion_heat_ev"] == 0.0 and got["m0"]["combustion_status"] == "nonflammable"
    assert got["m1"]["combustion_status"] == "ok" and got["m1"]["combustion_heat_ev"] != 0.0
    assert "4.50 * O2" in got["m1"]["combustion_reaction"]          # demand 12 - 3 = 9 -> 4.5
    assert got["m2"]["combustion_status"] == "unsupported_element"
    assert got["m2"]["combustion_reaction"] == ""


def test_unsupported_level():
    with pytest.raises(NotImplementedError):
        resolve_energy_column("wb97mv_def2tzvppd")
    assert resolve_energy_column("b3lypg_6311g*") == "b3lypg_6311g*_e_tot_hartree"


def test_fluoride_bde(spark):
    # O=C(F)N=S(F)F: parent and child energies in hartree
    parents = spark.createDataFrame([("123456", -865.8958017126204)],
                                    "unique_id string, energy_hartree double")
    kids = spark.createDataFrame([("123456_defluorined", -765.7816053641884)],
                                 "unique_id string, energy_hartree double")
    r = en.fluoride_bde(parents, kids, e_f_anion_hartree=-99.96280459477289).first()
    assert r["fluoride_bde_ev"] == pytest.approx(4.122, abs=1e-2)
    assert r["child_id"] == "123456_defluorined"


def test_defluorinate_longest_bond(spark):
    atoms = spark.createDataFrame([
        ("p", 0, "S", 0.0, 0.0, 0.0), ("p", 1, "F", 1.6, 0.0, 0.0), ("p", 2, "F", 0.0, 1.7, 0.0),
        ("p", 3, "O", 0.0, 0.0, 1.4),
        ("q", 0, "C", 0.0, 0.0, 0.0), ("q", 1, "O", 1.2, 0.0, 0.0)], 
        "unique_id string, atom_idx int, element string, x double, y double, z double")
    bonds = spark.createDataFrame([("p", 0, 0, 1), ("p", 1, 0, 2), ("p", 2, 0, 3), ("q", 0, 0, 1)],
                                  "unique_id string, bond_idx int, i int, j int")
    mols = spark.createDataFrame([("p", 0, 1), ("q", 0, 1)],
                                 "unique_id string, charge int, multiplicity int")
    kids, kid_atoms = en.defluorinate(mols, atoms, bonds)
    k = kids.collect()
    assert len(k) == 1 and k[0]["unique_id"] == "p_defluorined" and k[0]["charge"] == 1
    assert k[0]["old_f_bonded_atom"] == "S" and k[0]["multiplicity"] == 1
    ka = kid_atoms.orderBy("atom_idx").collect()
    assert [r["element"] for r in ka] == ["S", "F", "O"]     # F at index 2 (1.7 A) removed
    assert [r["atom_idx"] for r in ka] == [0, 1, 2]


def test_conformers_and_last_step(spark):
    c = spark.createDataFrame([("m", 0, 3.0), ("m", 1, 1.0), ("m", 2, 1.0), ("n", 0, 5.0)],
                              "unique_id string, conf_id int, energy_kcal double")
    low = {r["unique_id"]: r for r in en.lowest_conformer(c).collect()}
    assert low["m"]["conf_id"] == 1 and low["n"]["conf_id"] == 0
    ranked = en.rank_conformers(c).filter("unique_id = 'm'").orderBy("conf_rank").collect()
    assert [r["conf_id"] for r in ranked] == [1, 2, 0]
    t = spark.createDataFrame([("m", 0, -1.0), ("m", 2, -3.0), ("m", 1, -2.0)],
                              "unique_id string, step int, energy double")
    assert en.last_step(t).first()["energy"] == -3.0


def test_thermo(spark):
    t = spark.createDataFrame([("m", "ZPE", 0.1), ("m", "G_tot", -1.0), ("m", "Cv_tot", 7.0),
                               ("m", "other", 9.0)], "unique_id string, quantity string, value_hartree double")
    r = en.thermo_to_ev(t).first()
    assert r["ZPE_eV"] == pytest.approx(0.1 * HARTREE_EV) and r["Cv_tot"] == 7.0
    assert r["E_0K_eV"] is None
    f = spark.createDataFrame([("m", -5.0), ("n", 10.0)], "unique_id string, frequency double")
    th = spark.createDataFrame([("m", 1.0), ("n", 2.0)], "unique_id string, v double")
    assert [r["unique_id"] for r in en.thermo_gate(f, th).collect()] == ["n"]
