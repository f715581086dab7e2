import pytest
from pyspark.sql import functions as F

from molspark.sources.files import parquet_row_range
from molspark.sources.xyz import read_xyz_rows


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    (spark.range(1000).withColumn("v", F.col("id") * 2).repartitionByRange(7, "id").sortWithinPartitions("id")
     .write.option("parquet.block.size", 4096).parquet(path))
    return path


@pytest.mark.parametrize("start,length", [(0, 1000), (0, 1), (137, 400), (999, 5), (1000, 3), (0, 0), (700, None), (142, 2), (-3, 2)])
def test_ranges(spark, table, start, length):
    got = [r.id for r in parquet_row_range(spark, table, start, length, "idx").where("idx = id AND v = 2 * id").orderBy("id").collect()]
    lo = max(0, start)
    assert got == list(range(1000))[lo:None if length is None else lo + length]
    assert sorted(r.id for r in parquet_row_range(spark, table, start, length).collect()) == got


def test_nothing_is_sorted_and_other_files_stay_unread(spark, table):
    df = parquet_row_range(spark, table, 300, 100, "idx")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "rangepartitioning" not in plan and "Window" not in plan
    assert len(parquet_row_range(spark, table, 300, 100).inputFiles()) <= 2 < len(spark.read.parquet(table).inputFiles())


def test_xyz_rows(spark, tmp_path):
    path = str(tmp_path / "xyz.parquet")
    rows = [(i, f"1\nC charge:{i} multiplicity:1\nH 0 0 {i}\n", f"S{i}") for i in range(20)]
    spark.createDataFrame(rows, "k int, xyz_block string, smiles string").repartitionByRange(4, "k").sortWithinPartitions("k") \
        .drop("k").write.parquet(path)
    mols, atoms, failures = read_xyz_rows(spark, path, 5, 9)
    assert sorted(r.smiles for r in mols.collect()) == sorted(f"S{i}" for i in range(5, 14))
    assert sorted(r.z for r in atoms.collect()) == list(range(5, 14)) and failures.count() == 0
    with pytest.raises(ValueError):
        read_xyz_rows(spark, path, 0, 1, xyz_col="nope")
