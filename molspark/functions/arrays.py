"""Array and map helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def flatten_xyz(col) -> Column:
    """``ARRAY<ARRAY<DOUBLE>>`` (n x 3) -> flat ``ARRAY<DOUBLE>`` of 3n."""
    return F.flatten(_c(col))


def unflatten_xyz(col) -> Column:
    """Inverse of F17: flat 3n array -> n x 3 array."""
    a = _c(col)
    n = (F.floor(F.size(a) / 3) - 1).cast("int")
    return F.transform(F.sequence(F.lit(0), n), lambda k: F.slice(a, k * 3 + 1, 3))


def expand_map(df: DataFrame, col: str, prefix: str = "", keys: list[str] | None = None) -> DataFrame:
    """map keys -> columns (missing -> null). The key set, when not
    given, is the distinct union of keys (one small aggregate; the key list
    is schema-sized)."""
    if keys is None:
        keys = sorted(r[0] for r in df.select(F.explode(F.map_keys(col))).distinct().collect())
    return df.select(*[c for c in df.columns if c != col],
                     *[F.try_element_at(F.col(col), F.lit(k)).alias(f"{prefix}{k}") for k in keys])


def wrap_to_cell(df: DataFrame, cell: dict[str, str] | None = None) -> DataFrame:
    """wrap x, y, z into the periodic cell: fractional coordinates
    ``r C^-1`` taken modulo 1 and mapped back with ``C``. The cell rows are
    columns a1..a3, b1..b3, c1..c3 (lattice vectors); the 3x3 inverse is
    written out as expressions."""
    n = cell or {k: k for k in ("a1", "a2", "a3", "b1", "b2", "b3", "c1", "c2", "c3")}
    m = [[F.col(n["a1"]), F.col(n["a2"]), F.col(n["a3"])],
         [F.col(n["b1"]), F.col(n["b2"]), F.col(n["b3"])],
         [F.col(n["c1"]), F.col(n["c2"]), F.col(n["c3"])]]
    det = (m[0][0] * (m[1][1] * m[2][2] - m[1][2] * m[2][1])
           - m[0][1] * (m[1][0] * m[2][2] - m[1][2] * m[2][0])
           + m[0][2] * (m[1][0] * m[2][1] - m[1][1] * m[2][0]))

    def cof(i, j):
        r = [k for k in range(3) if k != i]
        c = [k for k in range(3) if k != j]
        v = m[r[0]][c[0]] * m[r[1]][c[1]] - m[r[0]][c[1]] * m[r[1]][c[0]]
        return v if (i + j) % 2 == 0 else -v
    inv = [[cof(j, i) / det for j in range(3)] for i in range(3)]   # inverse = adj / det
    r = [F.col("x"), F.col("y"), F.col("z")]
    frac = [sum((r[k] * inv[k][j] for k in range(3)), F.lit(0.0)) for j in range(3)]
    frac = [f - F.floor(f) for f in frac]
    cart = [sum((frac[k] * m[k][j] for k in range(3)), F.lit(0.0)) for j in range(3)]
    return df.withColumns({"x": cart[0], "y": cart[1], "z": cart[2]})


# FIXED VALUES: solvent keyword -> (model, dielectric constant).
DEFAULT_SOLVENT = ("IEF-PCM", 20.0)


def resolve_solvent(df: DataFrame, col: str = "solvent") -> DataFrame:
    """a run's solvent option as (``solvent_model``, ``solvent_eps``):
    ``"true"`` -> the default model and dielectric, ``"<model>,<eps>"`` ->
    as given (eps must be positive, else null), ``"false"``/null -> nulls."""
    v = F.lower(F.trim(F.col(col).cast("string")))
    parts = F.split(F.col(col).cast("string"), ",")
    eps = F.trim(F.element_at(parts, 2)).try_cast("double")
    model = (F.when(v == "true", F.lit(DEFAULT_SOLVENT[0]))
             .when((F.size(parts) == 2) & (eps > 0), F.trim(F.element_at(parts, 1))))
    value = F.when(v == "true", F.lit(DEFAULT_SOLVENT[1])).when((F.size(parts) == 2) & (eps > 0), eps)
    return df.withColumn("solvent_model", model).withColumn("solvent_eps", value)
