"""SparkSession helpers: one place for the settings every job relies on."""

from __future__ import annotations

import math
import os
import re
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "molspark") -> SparkSession:
    """Create (or reuse) a session with AQE on and the UI off.

    On a cluster the master and the shuffle width come from spark-submit; the
    arguments exist for local runs and tests.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    cores = os.cpu_count() or 8
    builder = (builder
               .config("spark.driver.memory", os.environ.get("MOLSPARK_DRIVER_MEMORY", "16g"))
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
               .config("spark.sql.adaptive.skewJoin.enabled", "true")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.execution.arrow.pyspark.enabled", "true")
               .config("spark.sql.shuffle.partitions",
                       str(shuffle_partitions or max(8, cores * 2))))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster must set it to a file system that driver and executors share;
    only a session with a local master (tests, bench) gets a folder of its own.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="molspark-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for written stage tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """The shuffles of every action within are removed when it ends, so that
    the next one has their disk. Only for steps whose results are written."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def few_tasks(scan: DataFrame, task_bytes: int = 32 << 20) -> DataFrame:
    """A scan of files in small byte ranges, many ranges to a task: about
    ``task_bytes`` each, and no fewer tasks than four per core. The ranges stay
    as they are and are read one after the other."""
    spark = scan.sparkSession
    size, unit = re.fullmatch(r"(\d+)([a-z]*)", spark.conf.get("spark.sql.files.maxPartitionBytes").strip().lower()).groups()
    range_bytes = int(size) << {"": 0, "b": 0, "k": 10, "m": 20, "g": 30, "t": 40}[unit.rstrip("b")[:1] or "b"]
    ranges = scan.rdd.getNumPartitions()
    tasks = max(4 * spark.sparkContext.defaultParallelism, math.ceil(ranges * range_bytes / task_bytes))
    return scan.coalesce(tasks) if tasks < ranges else scan
