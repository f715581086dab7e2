"""The registered queries with SQL against DuckDB on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from molspark.llm.queries import ORACLE, SPARK

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def test_all_are_registered():
    assert set(SPARK) <= set(entry.queries()) and "pipeline" in entry.queries()
    assert {n.split("_")[0] for n in SPARK} == {f"op{i}" for i in range(1, 14)}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    cur = con.execute(ORACLE[name])
    names = [d[0] for d in cur.description]
    want = cur.fetchall()
    df = SPARK[name](spark, SF)
    assert sorted(df.columns) == sorted(names)
    got = df.select(*names).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
