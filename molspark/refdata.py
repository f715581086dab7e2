"""Reference dimensions: element combustion data and the periodic table.

Both are fixed-size (16 and 119 rows), so broadcasting them is always safe.
"""

from __future__ import annotations

import csv
import io

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES: element combustion data. These numbers must equal the
# published combustion table row for row (element, main oxide product, O2
# consumed per atom, product molecules per atom, product energies at five
# levels of theory, product SMILES). Row order is the reaction-string order.
# ---------------------------------------------------------------------------
ELEMENT_COMBUSTION_CSV = """\
element,product,o2_consumption,product_ratio,b3lypg_6311g*_e_tot_hartree,b3lypg_6311g*_e_tot_ev,b3lypg_6311g*_H_tot_298K_ev,triton_energy_ev,AIMNET2_energy_ev,smiles
H,H2O,0.5,0.5,-76.43394949999470,-2079.87372215016000,-2079.1911502250800,-2081.046463877110,-2081.026123046880,O
Li,Li2O,0.5,0.5,,,,,,
Be,BeO,1.0,1.0,,,,,,
B,B2O3,1.5,0.5,-275.6203997779360,-7500.0131556291100,-7499.345319467760,-7503.026077420300,-7502.9189453125,B(=O)OB=O
C,CO2,2.0,1.0,-188.64112502114000,-5133.18651482663000,-5132.7708438762900,-5135.280630180840,-5135.2392578125,O=C=O
N,N2,0.0,0.5,-109.55592982017600,-2981.16872187440000,-2981.0659515918300,-2982.7071774463100,-2982.68701171875,N#N
O,O2,-1.0,0.0,-150.30262824784600,-4089.94287103823000,-4089.840100755650,-4091.617410442260,-4091.6044921875,O=O
F,HF,0.0,1.0,-100.45856381467000,-2733.61678167752000,-2733.5140113949500,-2734.8608809629500,-2734.8544921875,F
Na,Na2O,0.5,1.0,,,,,,
Si,SiO2,2.0,1.0,-440.00053163156200,-11973.02441466340000,-11972.71758475890,-11975.797577705900,-11975.7490234375,O=[Si]=O
P,P2O5,2.5,0.5,-1059.1269734298700,-28820.3131575370000,-28819.438993393500,-28828.97465230520,-28828.50585938,O=P12OP3(=O)OP(=O)(O1)OP(=O)(O2)O3
S,SO2,2.0,1.0,-548.6559640401780,-14929.6893536583000,-14929.393961046900,-14933.345688050900,-14933.291015625,O=S=O
Cl,HCl,0.0,1.0,-460.82610075329400,-12539.71701982720000,-12539.614249544700,-12540.854552382700,-12540.83984375,Cl
K,K2O,0.5,1.0,,,,,,
Br,HBr,0.0,1.0,-2574.7474248325500,-70062.4466629634000,-70062.34389268090,-70062.8673958056,-70062.8515625,Br
I,HI,0.0,1.0,-6920.127908312790,-188306.273384692000,-188306.17061440900,-8119.497566806370,-8119.478515625,I
"""

DEFAULT_ENERGY_COLUMN = "b3lypg_6311g*_e_tot_ev"

# ---------------------------------------------------------------------------
# FIXED VALUES: periodic table. Symbols by atomic number (index 0 is the
# ghost atom "X"); van der Waals radii in angstrom for Z = 0..56 as used by
# the volume calculation; standard atomic weights (IUPAC, conventional) for
# Z = 1..56.
# ---------------------------------------------------------------------------
CHEMICAL_SYMBOLS = (
    "X H He Li Be B C N O F Ne Na Mg Al Si P S Cl Ar K Ca Sc Ti V Cr Mn Fe Co Ni Cu Zn "
    "Ga Ge As Se Br Kr Rb Sr Y Zr Nb Mo Tc Ru Rh Pd Ag Cd In Sn Sb Te I Xe Cs Ba La Ce Pr "
    "Nd Pm Sm Eu Gd Tb Dy Ho Er Tm Yb Lu Hf Ta W Re Os Ir Pt Au Hg Tl Pb Bi Po At Rn Fr "
    "Ra Ac Th Pa U Np Pu Am Cm Bk Cf Es Fm Md No Lr Rf Db Sg Bh Hs Mt Ds Rg Cn Nh Fl Mc "
    "Lv Ts Og"
).split()

VDW_RADII_ANGSTROM = (
    0,
    0.30, 1.22,
    1.23, 0.89, 0.88, 0.77, 0.70, 0.66, 0.58, 1.60,
    1.40, 1.36, 1.25, 1.17, 1.10, 1.04, 0.99, 1.91,
    2.03, 1.74,
    1.44, 1.32, 1.22, 1.19, 1.17, 1.17, 1.16, 1.15, 1.17, 1.25,
    1.25, 1.22, 1.21, 1.17, 1.14, 1.98,
    2.22, 1.92,
    1.62, 1.45, 1.34, 1.29, 1.27, 1.24, 1.25, 1.28, 1.34, 1.41,
    1.50, 1.40, 1.41, 1.37, 1.33, 2.09,
    2.35, 1.98,
)

ATOMIC_MASSES = (
    0.0,
    1.008, 4.0026, 6.94, 9.0122, 10.81, 12.011, 14.007, 15.999, 18.998, 20.180,
    22.990, 24.305, 26.982, 28.085, 30.974, 32.06, 35.45, 39.948, 39.098, 40.078,
    44.956, 47.867, 50.942, 51.996, 54.938, 55.845, 58.933, 58.693, 63.546, 65.38,
    69.723, 72.630, 74.922, 78.971, 79.904, 83.798, 85.468, 87.62, 88.906, 91.224,
    92.906, 95.95, 97.0, 101.07, 102.91, 106.42, 107.87, 112.41, 114.82, 118.71,
    121.76, 127.60, 126.90, 131.29, 132.91, 137.33,
)

ENERGY_COLUMNS = ("b3lypg_6311g*_e_tot_hartree", "b3lypg_6311g*_e_tot_ev",
                  "b3lypg_6311g*_H_tot_298K_ev", "triton_energy_ev", "AIMNET2_energy_ev")


def element_ref_rows() -> list[tuple]:
    """Rows of the combustion table with a 0-based ``ord`` for reaction order."""
    rows = []
    reader = csv.DictReader(io.StringIO(ELEMENT_COMBUSTION_CSV))
    for i, r in enumerate(reader):
        energies = [float(r[c]) if r[c] else None for c in ENERGY_COLUMNS]
        rows.append((i, r["element"], r["product"], float(r["o2_consumption"]),
                     float(r["product_ratio"]), *energies, r["smiles"] or None))
    return rows


ELEMENT_REF_SCHEMA = T.StructType(
    [T.StructField("ord", T.IntegerType(), False),
     T.StructField("element", T.StringType(), False),
     T.StructField("product", T.StringType(), False),
     T.StructField("o2_consumption", T.DoubleType(), False),
     T.StructField("product_ratio", T.DoubleType(), False)]
    + [T.StructField(c, T.DoubleType(), True) for c in ENERGY_COLUMNS]
    + [T.StructField("smiles", T.StringType(), True)])

ELEMENT_VOCAB = tuple(r[1] for r in element_ref_rows())


def _sql_literal(v, dtype: T.DataType) -> str:
    name = dtype.simpleString()
    if v is None:
        return f"CAST(NULL AS {name})"
    if isinstance(v, str):
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"CAST({v!r} AS {name})"


def literal_table(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """A small fixed table as a SQL inline ``VALUES`` table: Spark keeps it
    as a local relation in the JVM plan (no Python-backed scan, no generated
    code for the literals), so broadcasting a dimension is free."""
    body = ", ".join("(" + ", ".join(_sql_literal(v, f.dataType) for v, f in zip(r, schema.fields)) + ")"
                     for r in rows)
    cols = ", ".join(f"c{i}" for i in range(len(schema.fields)))
    df = spark.sql(f"SELECT * FROM VALUES {body} AS t({cols})")
    return df.select(*[F.col(f"c{i}").cast(f.dataType).alias(f.name) for i, f in enumerate(schema.fields)])


def element_ref(spark: SparkSession) -> DataFrame:
    """The 16-row combustion dimension."""
    return literal_table(spark, element_ref_rows(), ELEMENT_REF_SCHEMA)


def periodic_rows() -> list[tuple]:
    rows = []
    for z, sym in enumerate(CHEMICAL_SYMBOLS):
        radius = VDW_RADII_ANGSTROM[z] if z < len(VDW_RADII_ANGSTROM) else None
        mass = ATOMIC_MASSES[z] if z < len(ATOMIC_MASSES) else None
        rows.append((z, sym, None if radius is None else float(radius),
                     None if mass is None else float(mass)))
    return rows


PERIODIC_SCHEMA = T.StructType([
    T.StructField("z_num", T.IntegerType(), False),
    T.StructField("symbol", T.StringType(), False),
    T.StructField("vdw_radius", T.DoubleType(), True),
    T.StructField("mass", T.DoubleType(), True),
])


def periodic_ref(spark: SparkSession) -> DataFrame:
    """Symbol, atomic number, vdW radius and mass for Z = 0..118."""
    return literal_table(spark, periodic_rows(), PERIODIC_SCHEMA)


def resolve_energy_column(level: str) -> str:
    """The first reference energy column whose name contains ``level``."""
    for name in ENERGY_COLUMNS:
        if level in name:
            return name
    raise NotImplementedError(
        f'Combustion heat calculation for DFT level "{level}" is not available.')


def sql_values_element_ref() -> str:
    """The combustion table as a SQL VALUES list (for oracle queries)."""
    def lit(v):
        if v is None:
            return "NULL"
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        return f"CAST({float(v)!r} AS DOUBLE)" if isinstance(v, float) else str(v)
    body = ",\n".join("(" + ", ".join(lit(v) for v in r) + ")" for r in element_ref_rows())
    cols = ["ord", "element", "product", "o2_consumption", "product_ratio",
            "e_tot_hartree", "e_tot_ev", "h_tot_298k_ev", "triton_energy_ev",
            "aimnet2_energy_ev", "smiles"]
    return f"(VALUES {body}) AS element_ref({', '.join(cols)})"


def sql_values_periodic() -> str:
    def lit(v):
        if v is None:
            return "NULL"
        if isinstance(v, str):
            return "'" + v + "'"
        return f"CAST({v!r} AS DOUBLE)" if isinstance(v, float) else repr(v)
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in periodic_rows())
    return f"(VALUES {body}) AS periodic(z_num, symbol, vdw_radius, mass)"
