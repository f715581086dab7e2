import pytest
from pyspark.sql import types as T

from molspark.sinks.append import append_once, commit_batch, content_hash, matched_columns, read_appended, stage_batch

SCHEMA = T.StructType([T.StructField("unique_id", T.StringType()), T.StructField("energy", T.DoubleType())])


def rows(spark, table):
    return sorted((r.unique_id, r.energy) for r in read_appended(spark, table, SCHEMA).collect())


def test_a_batch_counts_once(spark, tmp_path):
    table = str(tmp_path / "t")
    one = spark.createDataFrame([(1.0, "a"), (2.0, "b")], "Energy double, UNIQUE_ID string")
    two = spark.createDataFrame([("b", 2), ("c", None)], "unique_id string, energy int")
    assert append_once(one, table, SCHEMA) and append_once(two, table, SCHEMA)
    assert not append_once(one.repartition(3), table, SCHEMA)  # other files and order, the same rows
    assert sorted(map(str, rows(spark, table))) == sorted(map(str, [("a", 1.0), ("b", 2.0), ("b", 2.0), ("c", None)]))
    assert append_once(one, table, SCHEMA, batch_id="again") and len(rows(spark, table)) == 6


def test_faults_before_and_after_the_commit(spark, tmp_path):
    table = str(tmp_path / "t")
    df = spark.createDataFrame([("a", 1.0)], SCHEMA)
    staged = stage_batch(df, table, SCHEMA)  # dies here
    with pytest.raises(Exception):
        rows(spark, table)  # nothing has been appended yet
    assert append_once(df, table, SCHEMA)  # runs again, dies after the commit, runs again
    assert not append_once(df, table, SCHEMA) and not commit_batch(spark, table, staged, SCHEMA)
    assert rows(spark, table) == [("a", 1.0)]


def test_hash_and_columns(spark):
    a = spark.createDataFrame([("a", 1.0), ("a", 1.0), (None, None)], SCHEMA)
    assert content_hash(a) == content_hash(a.repartition(4)) != content_hash(a.distinct())
    assert content_hash(a.limit(0)) == content_hash(a.limit(0))
    out = matched_columns(spark.createDataFrame([("x", 1)], "unique_ID string, other int"), SCHEMA)
    assert out.columns == ["unique_id", "energy"] and tuple(out.first()) == ("x", None)
