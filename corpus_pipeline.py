"""A training corpus from ``documents``: language, near duplicates, benchmark
leaks, secrets, packing.

Every stage takes all rows that its predecessor kept. All but the last return
the columns of ``documents``; the last returns the packed pieces. ``run`` writes
each stage's result to the shared folder and reads it back for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from molspark.llm import decontaminate, language, near_duplicates, packing, secrets
from molspark.llm.common import scratch_path, stored
from molspark.llm.queries import tokenizer_path


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose language cannot be told: null, empty and letterless
    texts, and longer texts of words that the fitted model does not know."""
    return language.accept(docs, language.fit(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest doc_id of each group. Rows repeated
    under one doc_id are one document; rows without doc_id stay."""
    later = (near_duplicates.near_duplicates(docs).where(F.col("class_id") != F.col("doc_id"))
             .select("doc_id").distinct())
    return docs.join(later, "doc_id", "left_anti").select(*docs.columns)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold an item of the benchmark."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps every document; found secrets are replaced by a mark and n_chars
    is that of the new text."""
    found = secrets.scan_versions(docs, scratch_path(spark, "secret-ledger"), "doc_id")
    out = secrets.redact(docs, found)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), "n_chars"))
    return out


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 1024 tokens."""
    return packing.pack(docs.select("doc_id", "text"), tokenizer_path())


STAGES = [("language_id", identify_language), ("near_duplicates", drop_near_duplicates),
          ("decontamination", drop_benchmark_leaks), ("secrets", redact_secrets), ("packing", pack)]

#: No SQL: the stages fit models and run numerical searches. tests/llm holds
#: them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
