import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
# the Python workers' path, wherever pytest was started
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, [os.environ.get("PYTHONPATH")])])


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession
    ckpt = str(tmp_path_factory.mktemp("ckpt"))
    s = (SparkSession.builder.master("local[4]")
         .config("spark.sql.shuffle.partitions", "4")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.driver.memory", "4g")
         .config("spark.checkpoint.dir", ckpt)
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s


def atoms_from_counts(spark, counts: dict, uid="m"):
    """Atom rows for a molecule given element counts (coordinates unused)."""
    rows, k = [], 0
    for el, n in counts.items():
        for _ in range(n):
            rows.append((uid, k, el, 0.0, 0.0, float(k)))
            k += 1
    return rows
