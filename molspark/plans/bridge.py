"""Test bridge: chemistry tables derived from the driver's TPC-H-like tables.

The driver hands every query a folder of generic parquet tables. These
functions derive molecule-shaped tables from them with plain DataFrame
operations, and ``SQL`` holds the very same derivations as DuckDB/ANSI SQL so
the oracle sees identical inputs:

* ``molecules``  <- orders   (one order = one molecule)
* ``atoms``      <- lineitem (one line = one atom; element from the part key)
* ``bonds``      <- consecutive atoms of a molecule
* ``orbitals``   <- events   (one user = one molecule's orbital list)
* ``predictions``<- events   (event type = ensemble member)
* ``trajectory`` <- events   (event order = optimisation step)
* ``conformers`` <- lineitem (extended price = conformer energy)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from molspark.refdata import periodic_ref

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Element chosen from the part key; z numbers of the six elements used.
_ELEMENT_BY_PART = ("C", "H", "H", "H", "O", "N", "F", "S")


def _element_expr(partkey: str) -> F.Column:
    k = (F.col(partkey) % 8).cast("int")
    expr = F.when(k == 0, "C").when(k == 1, "H").when(k == 2, "H").when(k == 3, "H")
    return expr.when(k == 4, "O").when(k == 5, "N").when(k == 6, "F").otherwise("S")


def molecules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """unique_id, charge, multiplicity-free molecule table with an energy."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").cast("string").alias("unique_id"),
        ((F.col("o_custkey") % 3).cast("int") - 1).alias("charge"),
        (-F.col("o_totalprice") / 1000.0).alias("energy_hartree"),
        F.when(F.col("o_orderstatus") == "F", F.lit(True))
         .when(F.col("o_orderstatus") == "O", F.lit(False)).alias("converged"),
        F.col("o_orderpriority").alias("batch_id"),
    )


def _ranked(df: DataFrame, keys: list[str], order: list[str], out: str, size: str) -> DataFrame:
    return (df.withColumn(out, (F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1).cast("int"))
            .withColumn(size, F.count(F.lit(1)).over(Window.partitionBy(*keys))))


def atoms(spark: SparkSession, sf_dir: str, with_z: bool = True) -> DataFrame:
    """One atom per line item; atom_idx is the line's rank inside its order."""
    li = table(spark, sf_dir, "lineitem")
    base = li.select(
        F.col("l_orderkey").cast("string").alias("unique_id"),
        "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
        _element_expr("l_partkey").alias("element"),
        (F.col("l_quantity") / 10.0).alias("x"),
        (F.col("l_discount") * 50.0).alias("y"),
        (F.col("l_tax") * 50.0).alias("z"),
        ((F.col("l_discount") - 0.05) * 4.0).alias("charge"),
        ((F.col("l_tax") - 0.04) / 10.0).alias("forces_x"),
        ((F.col("l_discount") - 0.05) / 10.0).alias("forces_y"),
        ((F.col("l_quantity") - 25.0) / 1000.0).alias("forces_z"),
    )
    # atom_idx = rank of the line inside its order, the test data's stand-in
    # for what an XYZ ingest gets from posexplode and the list size
    out = _ranked(base, ["unique_id"], ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"],
                  "atom_idx", "num_atoms").drop("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    if with_z:
        ref = periodic_ref(spark).select(F.col("symbol").alias("element"), "z_num")
        out = out.join(F.broadcast(ref), "element", "left")
    return out.select("unique_id", "atom_idx", "element", *(["z_num"] if with_z else []),
                      "x", "y", "z", "charge", "forces_x", "forces_y", "forces_z", "num_atoms")


def bonds(atoms_df: DataFrame) -> DataFrame:
    """Bridge bonds: atom k is bonded to atom k+1 of the same molecule."""
    a = atoms_df.select("unique_id", F.col("atom_idx").alias("i"))
    b = atoms_df.select("unique_id", (F.col("atom_idx") - 1).alias("i"),
                        F.col("atom_idx").alias("j"))
    return a.join(b, ["unique_id", "i"]).select(
        "unique_id", F.col("i").alias("bond_idx"), "i", "j")


def orbitals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orbitals per user: even users are closed shell (spin 0 only), odd users
    split their events into two spin channels by event parity. The first half
    of each channel (in time order) is occupied."""
    ev = table(spark, sf_dir, "events")
    base = ev.select(
        F.col("user_id").cast("string").alias("unique_id"),
        F.when(F.col("user_id") % 2 == 0, F.lit(0))
         .otherwise((F.col("event_id") % 2).cast("int")).alias("spin"),
        "ts", "event_id",
        ((F.col("value") - 250.0) / 1000.0).alias("energy"),
    )
    r = _ranked(base, ["unique_id", "spin"], ["ts", "event_id"], "orb_idx", "_n")
    return r.select(
        "unique_id", "spin", "orb_idx", "energy",
        F.when(F.col("orb_idx") + 1 <= F.col("_n") / 2.0, F.lit(1.0)).otherwise(F.lit(0.0))
         .alias("occ"))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ensemble members: one model per event type, energy = mean event value."""
    ev = table(spark, sf_dir, "events")
    return (ev.groupBy(F.col("user_id").cast("string").alias("unique_id"),
                       F.col("event_type").alias("model_id"))
              .agg(F.avg("value").alias("energy")))


def trajectory(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(F.col("user_id").cast("string").alias("unique_id"),
                     "ts", "event_id", F.col("value").alias("energy"),
                     (F.col("value") / 100.0).alias("gradient_norm"))


def child_energies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Energies of defluorinated children, keyed ``<id>_defluorined``."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.concat(F.col("o_orderkey").cast("string"), F.lit("_defluorined")).alias("unique_id"),
        (-F.col("o_totalprice") / 1000.0 + 99.5 + (F.col("o_custkey") % 7) / 100.0)
        .alias("energy_hartree"))


def conformers(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_orderkey").cast("string").alias("unique_id"),
                     F.col("l_linenumber").alias("conf_id"), "l_partkey", "l_suppkey",
                     (F.col("l_extendedprice") / 1000.0).alias("energy_kcal"))


# ---------------------------------------------------------------------------
# The same views in SQL for the DuckDB oracle.
# ---------------------------------------------------------------------------
SQL = {
    "molecules": """
      SELECT CAST(o_orderkey AS VARCHAR) AS unique_id,
             CAST(o_custkey % 3 AS INTEGER) - 1 AS charge,
             -o_totalprice / 1000.0 AS energy_hartree,
             CASE o_orderstatus WHEN 'F' THEN TRUE WHEN 'O' THEN FALSE END AS converged,
             o_orderpriority AS batch_id
      FROM orders""",
    "atoms": """
      SELECT a.unique_id, a.atom_idx, a.element,
             CASE a.element WHEN 'H' THEN 1 WHEN 'C' THEN 6 WHEN 'N' THEN 7 WHEN 'O' THEN 8
                            WHEN 'F' THEN 9 WHEN 'S' THEN 16 END AS z_num,
             a.x, a.y, a.z, a.charge, a.forces_x, a.forces_y, a.forces_z
      FROM (
        SELECT CAST(l_orderkey AS VARCHAR) AS unique_id,
               CAST(row_number() OVER (PARTITION BY l_orderkey
                    ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 AS INTEGER)
                 AS atom_idx,
               CASE CAST(l_partkey % 8 AS INTEGER) WHEN 0 THEN 'C' WHEN 1 THEN 'H' WHEN 2 THEN 'H'
                    WHEN 3 THEN 'H' WHEN 4 THEN 'O' WHEN 5 THEN 'N' WHEN 6 THEN 'F' ELSE 'S' END
                 AS element,
               l_quantity / 10.0 AS x, l_discount * 50.0 AS y, l_tax * 50.0 AS z,
               (l_discount - 0.05) * 4.0 AS charge,
               (l_tax - 0.04) / 10.0 AS forces_x, (l_discount - 0.05) / 10.0 AS forces_y,
               (l_quantity - 25.0) / 1000.0 AS forces_z
        FROM lineitem) a""",
    "bonds": """
      SELECT a.unique_id, a.atom_idx AS bond_idx, a.atom_idx AS i, b.atom_idx AS j
      FROM atoms a JOIN atoms b ON a.unique_id = b.unique_id AND b.atom_idx = a.atom_idx + 1""",
    "orbitals": """
      SELECT unique_id, spin, CAST(rn - 1 AS INTEGER) AS orb_idx, energy,
             CASE WHEN rn <= cnt / 2.0 THEN 1.0 ELSE 0.0 END AS occ
      FROM (
        SELECT unique_id, spin, energy,
               row_number() OVER (PARTITION BY unique_id, spin ORDER BY ts, event_id) AS rn,
               count(*) OVER (PARTITION BY unique_id, spin) AS cnt
        FROM (SELECT CAST(user_id AS VARCHAR) AS unique_id,
                     CASE WHEN user_id % 2 = 0 THEN 0 ELSE CAST(event_id % 2 AS INTEGER) END AS spin,
                     ts, event_id, (value - 250.0) / 1000.0 AS energy
              FROM events) e) o""",
    "predictions": """
      SELECT CAST(user_id AS VARCHAR) AS unique_id, event_type AS model_id, avg(value) AS energy
      FROM events GROUP BY 1, 2""",
    "trajectory": """
      SELECT CAST(user_id AS VARCHAR) AS unique_id, ts, event_id, value AS energy,
             value / 100.0 AS gradient_norm
      FROM events""",
    "child_energies": """
      SELECT CAST(o_orderkey AS VARCHAR) || '_defluorined' AS unique_id,
             -o_totalprice / 1000.0 + 99.5 + (o_custkey % 7) / 100.0 AS energy_hartree
      FROM orders""",
    "conformers": """
      SELECT CAST(l_orderkey AS VARCHAR) AS unique_id, l_linenumber AS conf_id, l_partkey,
             l_suppkey, l_extendedprice / 1000.0 AS energy_kcal
      FROM lineitem""",
}


def with_views(sql: str, *names: str, ctes: list[tuple[str, str]] | None = None) -> str:
    """Prefix ``sql`` with the bridge views it needs as CTEs (dependency order),
    followed by any extra ``(name, body)`` CTEs of the query itself."""
    order = ["molecules", "atoms", "bonds", "orbitals", "predictions", "trajectory",
             "child_energies", "conformers"]
    need = set(names)
    if "bonds" in need:
        need.add("atoms")
    parts = [f"{n} AS ({SQL[n]})" for n in order if n in need]
    parts += [f"{n} AS ({body})" for n, body in (ctes or [])]
    return "WITH " + ",\n".join(parts) + "\n" + sql if parts else sql
