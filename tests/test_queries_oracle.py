"""Every registered query against its DuckDB oracle on the smallest driver
tables (the same comparison the driver runs at sf0.01)."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from molspark.plans.bridge import TABLES
from tools.check_oracle import digest

SF = os.environ.get("MOLSPARK_TEST_SF", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "combustion_heat_ev" in df.columns


LIBRARY = {name for name, fn in entry.queries().items() if fn.__module__.startswith("molspark.plans")}


@pytest.mark.parametrize("name", sorted(LIBRARY))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    cols, rows = df.columns, [tuple(r) for r in df.collect()]
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert rows and len(set(cols)) == len(cols)
        assert all(v == v for r in rows for v in r)  # no NaN
        return
    cur = con.execute(sql)
    ocols, orows = [d[0] for d in cur.description], cur.fetchall()
    assert sorted(cols) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(cols, rows)[0] == digest(ocols, orows)[0]
