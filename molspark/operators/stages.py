"""Pluggable user stages (X1-X5): solvers and models are not part of this
library; they plug in as functions that Spark runs inside tasks.

* row functions (``apply_stage``/``apply_with_fallback``) run per row inside
  ``mapInPandas`` (Arrow batches, no per-row serialisation through Py4J);
* batch functions (``enrich_batched``/``batch_inference``) receive pandas
  frames of bounded size, load models once per task and retry with
  exponential backoff;
* ``per_molecule`` hands one molecule's atoms to a function
  (``applyInPandas``); memory per call is the molecule's size.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from molspark.session import scratch_path


def _with_error(schema: T.StructType) -> T.StructType:
    return T.StructType(list(schema.fields) + [T.StructField("_error", T.StringType())])


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def apply_stage(df: DataFrame, fn: Callable[[dict], dict], schema: T.StructType | str,
                on_error: str = "drop", stage: str = "stage") -> tuple[DataFrame, DataFrame]:
    """Call ``fn(row_dict) -> dict`` for every row; exceptions are caught
    per row. ``on_error="drop"`` removes failed rows from the output;
    ``"keep"`` keeps them with the output columns null. Returns
    ``(rows, failures)``; failures have ``stage, unique_id, reason``. The tagged
    result is written once to the shared scratch folder and both are read from
    there, so ``fn`` runs once per row however often they are used."""
    schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    out_schema = _with_error(schema)
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for rec in pdf.to_dict("records"):
                try:
                    res = fn(rec)
                    rows.append({**{n: res.get(n, rec.get(n)) for n in names}, "_error": None})
                except Exception as e:  # noqa: BLE001 - user code, logged per row
                    base = {n: (rec.get(n) if n in rec else None) for n in names}
                    rows.append({**base, "_error": f"{type(e).__name__}: {e}"})
            yield pd.DataFrame(rows, columns=names + ["_error"])

    res = _written(df.mapInPandas(run, out_schema), stage)
    ok = res.filter(F.col("_error").isNull()) if on_error == "drop" else res
    uid = F.col("unique_id") if "unique_id" in names else F.lit(None).cast("string")
    fails = res.filter(F.col("_error").isNotNull()).select(
        F.lit(stage).alias("stage"), uid.alias("unique_id"), F.col("_error").alias("reason"))
    return ok.drop("_error"), fails


def apply_with_fallback(df: DataFrame, fn_a: Callable[[dict], dict], fn_b: Callable[[dict], dict],
                        schema: T.StructType | str, stage: str = "stage") -> tuple[DataFrame, DataFrame]:
    """Try ``fn_a``; on error try ``fn_b``; ``method`` records which one
    produced the row ("a" / "b"). Rows failing both go to failures."""
    schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    schema_m = T.StructType(list(schema.fields) + [T.StructField("method", T.StringType())])

    def both(rec):
        try:
            return {**fn_a(rec), "method": "a"}
        except Exception:  # noqa: BLE001
            return {**fn_b(rec), "method": "b"}
    return apply_stage(df, both, schema_m, "drop", stage)


def enrich_batched(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame],
                   schema: T.StructType | str, batch_size: int = 1024, retries: int = 5,
                   backoff: float = 3.0, sleep=time.sleep,
                   stage: str = "enrich") -> tuple[DataFrame, DataFrame]:
    """Send rows to ``fn`` in groups of at most ``batch_size``; a failing
    call is retried ``retries`` times with delays ``backoff * 2**k``. Returns
    ``(rows, failures)``; each row of a group that still fails is a failure with
    ``stage, unique_id, reason``. ``fn`` runs once per group and attempt."""
    schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    names = [f.name for f in schema.fields]
    tagged = T.StructType(list(schema.fields) + [T.StructField("_failed_id", T.StringType()),
                                                 T.StructField("_error", T.StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for s in range(0, len(pdf), batch_size):
                part = pdf.iloc[s:s + batch_size]
                for k in range(retries + 1):
                    try:
                        yield fn(part)[names].assign(_failed_id=None, _error=None)
                        break
                    except Exception as e:  # noqa: BLE001 - user code, logged per row
                        if k < retries:
                            sleep(backoff * (2 ** k))
                            continue
                        ids = part["unique_id"].astype(str) if "unique_id" in part else [None] * len(part)
                        yield pd.DataFrame({**{n: [None] * len(part) for n in names}, "_failed_id": list(ids),
                                            "_error": f"{type(e).__name__}: {e}"})

    res = _written(df.mapInPandas(run, tagged), stage)
    fails = res.filter(F.col("_error").isNotNull()).select(
        F.lit(stage).alias("stage"), F.col("_failed_id").alias("unique_id"), F.col("_error").alias("reason"))
    return res.filter(F.col("_error").isNull()).select(*names), fails


_MODELS: dict[str, object] = {}  # of this Python worker


def worker_model(key: str, make_model: Callable[[], object], most: int = 2):
    """The model of ``key``, made once in this Python worker and kept for the
    tasks that come after; beyond ``most`` models the one used least lately goes."""
    model = _MODELS.pop(key) if key in _MODELS else make_model()
    while len(_MODELS) >= most:
        del _MODELS[next(iter(_MODELS))]
    _MODELS[key] = model
    return model


def packed_batches(frames: Iterator[pd.DataFrame], size_col: str | None, batch_size: int,
                   max_padded: int | None) -> Iterator[pd.DataFrame]:
    """Runs of consecutive rows, across the borders of ``frames``: at most
    ``batch_size`` rows whose number times largest size is at most
    ``max_padded``; a row above it is a run alone. Null sizes count as 0."""
    rest = None
    for pdf in frames:
        pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
        sizes = pdf[size_col].fillna(0).tolist() if size_col else [0] * len(pdf)
        begin, largest = 0, 0
        for i, size in enumerate(sizes):
            largest = max(largest, size)
            full = i - begin >= batch_size or max_padded is not None and (i - begin + 1) * largest > max_padded
            if full and i > begin:
                yield pdf.iloc[begin:i]
                begin, largest = i, size
        rest = pdf.iloc[begin:]
    if rest is not None and len(rest):
        yield rest


def batch_inference(df: DataFrame, make_model: Callable[[], Callable[[pd.DataFrame], pd.DataFrame]],
                    schema: T.StructType | str, batch_size: int = 2048,
                    size_col: str | None = "num_atoms", max_padded: int | None = None,
                    model_key: str | None = None) -> DataFrame:
    """Feed a model batches of rows of similar size.

    Rows are partitioned by ranges of ``size_col``, ties by a hash of the row (a
    size that very many molecules share fills several partitions), and sorted in
    them; a batch is the longest run of at most ``batch_size`` rows that pads to
    at most ``max_padded`` atoms. Without the column rows go as they come.
    ``model_key`` names the model: a worker then makes it once for all its tasks;
    otherwise once per task."""
    sized = size_col if size_col in df.columns else None
    if sized:
        spread = F.xxhash64(*[f"`{f.name}`" for f in df.schema if not _has_map(f.dataType)])
        df = (df.withColumn("_spread", spread).repartitionByRange(sized, "_spread")
              .sortWithinPartitions(sized, "_spread").drop("_spread"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = worker_model(model_key, make_model) if model_key else make_model()
        for part in packed_batches(batches, sized, batch_size, max_padded):
            yield model(part)
    return df.mapInPandas(run, schema)


def _has_map(kind: T.DataType) -> bool:
    """Spark hashes no maps."""
    if isinstance(kind, T.StructType):
        return any(_has_map(f.dataType) for f in kind)
    return isinstance(kind, (T.MapType, T.VariantType)) or isinstance(kind, T.ArrayType) and _has_map(kind.elementType)


def per_molecule(atoms: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame],
                 schema: T.StructType | str, key: str = "unique_id") -> DataFrame:
    """A grouped pandas function per molecule (custom geometry work).
    Prefer the aggregate-based operators where one exists (A28 is done with
    Spark sums plus a 3x3 eigen-solve); this hook gives the function a whole
    molecule at once."""
    return atoms.groupBy(key).applyInPandas(fn, schema)
