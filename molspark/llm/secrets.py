"""Secret scans over the versions of many paths with an incremental blob ledger.

Every version is addressed by the SHA-256 of its text. The ledger (Parquet
below one path) remembers which rule versions have scanned which blob; a run
scans each unseen (blob, rule version) pair once, appends to the ledger and
joins the findings back to every path that holds the blob. DataFrame functions
only; texts never leave the JVM.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import fresh


@dataclass(frozen=True)
class Rule:
    """``pattern``: a Java regular expression that matches at least one
    character and looks at nothing outside its match. Matches are leftmost and
    non-overlapping per rule; those are findings whose ``group`` has
    ``min_chars`` characters or more. ``version`` rises when any of it changes."""

    kind: str
    pattern: str
    group: int
    min_chars: int
    version: int = 1

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


#: FIXED VALUES: the first three patterns and lengths are given by contract. A
#: run of hexadecimal digits is matched from its first digit on and as a whole,
#: so asking for 24 digits in the pattern finds the same spans as dropping shorter
#: runs afterwards, without a row for every short run; likewise for access keys.
BASE_RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
)
EXTRA_RULES = (
    Rule("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", 0, 1),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 40),
)
RULES = BASE_RULES + EXTRA_RULES

_SCANNED = "blob binary, rules array<string>"
_TODO = "blob binary, path string, unnamed boolean, todo array<string>"
_FINDINGS = "blob binary, rule string, kind string, start bigint, end bigint"


def blob_id(text: Column) -> Column:
    """Content address of a text; null counts as empty."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def _ledger(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        # every run appends a folder of its own
        return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(path)
    except AnalysisException as e:  # a ledger that has no entries yet
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], T._parse_datatype_string(schema))


def find_spans(blobs: DataFrame, rules=RULES) -> DataFrame:
    """(blob, rule, kind, start, end) of all findings in ``blobs``
    (blob, text, todo: array of rule keys to apply). Offsets are code points,
    end exclusive.

    The pieces between matches and the matches themselves alternate, so a
    running sum of their lengths gives every position.
    """
    def one(rule: Rule) -> Column:
        found = F.when(
            F.array_contains("todo", rule.key) & F.col("text").rlike(rule.pattern),
            F.arrays_zip(
                F.transform(F.split("text", rule.pattern, -1), F.length).alias("gap"),
                F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(0)).alias("hit"),
                F.transform(F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(rule.group)),
                            F.length).alias("size")))
        return F.struct(F.lit(rule.key).alias("rule"), F.lit(rule.kind).alias("kind"),
                        F.lit(rule.min_chars).alias("least"),
                        F.transform(found, lambda x: F.struct(
                            x["gap"].alias("gap"), F.length(x["hit"]).alias("length"),
                            x["size"].alias("size"))).alias("found"))

    matches = (blobs.select("blob", F.explode(F.array(*map(one, rules))).alias("r"))
               .where(F.size("r.found") > 0)
               .select("blob", "r.rule", "r.kind", "r.least", F.posexplode("r.found")))
    before = Window.partitionBy("blob", "rule").orderBy("pos")
    end = F.sum(F.col("col.gap").cast("long") + F.coalesce("col.length", F.lit(0))).over(before)
    return (matches.select("blob", "rule", "kind", "least", "col", end.alias("end"))
            .where(F.col("col.size") >= F.col("least"))  # the last gap has no match: null
            .select("blob", "rule", "kind", (F.col("end") - F.col("col.length")).alias("start"),
                    "end"))


def scan_versions(versions: DataFrame, ledger: str, path: str = "path", text: str = "text",
                  rules=RULES) -> DataFrame:
    """Bring the ledger up to date for ``versions`` and return its findings for
    the blobs in them: (blob, rule, kind, start, end), each once.

    A null text is the empty text and has no findings. Repeated rows and equal
    texts under many paths are scanned once; other columns of ``versions`` are
    not read, so they may have any names. Findings are appended before the
    blobs are marked as scanned, so a run that dies in between scans again and
    loses nothing; doubled findings are merged on reading.

    What is to be scanned is written below the ledger first: a run that has
    nothing new moves no text.
    """
    spark, keys = versions.sparkSession, [r.key for r in rules]
    batch = uuid.uuid4().hex
    # The path as a key that is never null, so that joins and groups share one exchange.
    rows = versions.select(F.coalesce(F.col(path).cast("string"), F.lit("")).alias("path"),
                           F.col(path).isNull().alias("unnamed"),
                           F.coalesce(F.col(text), F.lit("")).alias("text")) \
        .withColumn("blob", blob_id(F.col("text")))
    held = (rows.select("path", "unnamed", "blob").groupBy("blob")
            .agg(F.min(F.struct("path", "unnamed")).alias("from")))  # one path that can hand over the text
    known = (_ledger(spark, f"{ledger}/scanned", _SCANNED)
             .groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("seen")))
    (held.join(known, "blob", "left")
     .withColumn("todo", F.array_except(F.array(*map(F.lit, keys)),
                                        F.coalesce("seen", F.array().cast("array<string>"))))
     .where(F.size("todo") > 0)
     .select("blob", "from.path", "from.unnamed", "todo")
     .write.parquet(f"{ledger}/todo/batch-{batch}"))
    todo = spark.read.schema(_TODO).parquet(f"{ledger}/todo/batch-{batch}")
    if not todo.isEmpty():
        # Rows repeated under one path become one in each task, before the exchange;
        # the path in the key spreads the copies of one text over all tasks.
        once = rows.groupBy("blob", "path", "unnamed").agg(F.first("text").alias("text"))
        unseen = once.join(todo.hint("shuffle_hash"), ["blob", "path", "unnamed"])
        (find_spans(unseen.select("blob", "text", "todo"), rules).distinct()
         .write.mode("append").parquet(f"{ledger}/findings/batch-{batch}"))
        (todo.select("blob", F.col("todo").alias("rules"))
         .write.mode("append").parquet(f"{ledger}/scanned/batch-{batch}"))
    return _ledger(spark, f"{ledger}/findings", _FINDINGS).where(F.col("rule").isin(keys)).distinct()


def scan_counts(spark: SparkSession, ledger: str) -> DataFrame:
    """(blob, scans): by how many runs each blob of the ledger was scanned."""
    return _ledger(spark, f"{ledger}/scanned", _SCANNED).groupBy("blob").agg(F.count(F.lit(1)).alias("scans"))


def findings_by_blob(findings: DataFrame, rules=RULES) -> DataFrame:
    """One row per blob with findings: ``spans``, an array of (start, place,
    kind, end) by start and then by the rules' order."""
    place = F.coalesce(*[F.when(F.col("kind") == r.kind, F.lit(i)) for i, r in enumerate(rules)])
    span = F.struct("start", place.alias("place"), "kind", "end")
    return findings.groupBy("blob").agg(F.sort_array(F.collect_list(span)).alias("spans"))


def findings_by_path(versions: DataFrame, findings: DataFrame, path: str = "path",
                     text: str = "text", rules=RULES, per_blob: DataFrame | None = None) -> DataFrame:
    """One row per version, repeated rows included: (path, spans, columns of
    ``per_blob``, a table with one row per blob); ``spans`` is empty where
    nothing was found. Groups of copies are a skewed left join whose large side
    is only (path, blob)."""
    rows = versions.select(F.col(path).alias("path"), blob_id(F.col(text)).alias("blob"))
    empty = F.array().cast("array<struct<start:bigint,place:int,kind:string,end:bigint>>")
    found, more = findings_by_blob(findings, rules), []
    if per_blob is not None:
        found, more = per_blob.join(found, "blob", "left"), [c for c in per_blob.columns if c != "blob"]
    return (rows.join(found, "blob", "left")
            .select("path", F.coalesce("spans", empty).alias("spans"), *more))


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


#: First word of a text that is no base64 of a key: of 16 characters or more, or
#: padded, or alone in its line. Escaped line ends count as base64.
_NO_KEY = r"(?<!\S)(?!(?:[A-Za-z0-9+/=\\]{16,}|[A-Za-z0-9+/\\]*=[=\\nr]*)(?!\S)|(?<=\n)[A-Za-z0-9+/\\]+[ \t]*(?:\r?\n|$))\S"
_KEY_HEADERS = r"^(?:\s*(?:Proc-Type|DEK-Info): [^\n]*\n){0,2}"


def _key_length(rest: Column) -> Column:
    """Characters of the key that ``rest``, the text after a marker of a private
    key, begins with: to its END marker, or else all lines of base64."""
    dashes = F.instr(rest, "-----")
    last = F.regexp_extract(F.substring(rest, dashes, F.lit(80)), r"^-----END [A-Z ]{0,40}PRIVATE KEY-----", 0)
    headers = F.length(F.regexp_extract(rest, _KEY_HEADERS, 0))
    lines = F.substring(rest, headers + 1, F.length(rest))
    other = F.regexp_instr(lines, F.lit(_NO_KEY))
    run = F.when(other > 0, F.substring(lines, F.lit(1), other - 1)).otherwise(lines)
    run = F.length(F.regexp_replace(run, r"\s+$", ""))
    return F.when((dashes > 0) & (last != ""), dashes - 1 + F.length(last)) \
        .when(run > 0, headers + run).otherwise(0).cast("long")


def redact(versions: DataFrame, findings: DataFrame, text: str = "text",
           mark: str = "[redacted]", rules=RULES) -> DataFrame:
    """``versions`` with every found span replaced by ``mark`` (overlapping
    spans by one mark) and, after the marker of a private key, the key itself;
    texts without findings stay as they are, null included."""
    spans, blob = fresh(versions, "_spans"), fresh(versions, "_blob")
    body = F.col(text)
    merged = F.aggregate(
        spans, F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at")),
        lambda acc, s: F.struct(
            F.when(s["start"] >= acc["at"],
                   F.concat(acc["out"], F.substring(body, (acc["at"] + 1).cast("int"),
                                                    (s["start"] - acc["at"]).cast("int")), F.lit(mark)))
            .otherwise(acc["out"]).alias("out"),
            F.greatest(acc["at"], F.when(s["kind"] == "pem", s["end"] + _key_length(
                F.substring(body, (s["end"] + 1).cast("int"), F.length(body)))).otherwise(s["end"])).alias("at")),
        lambda acc: F.concat(acc["out"], F.substring(body, (acc["at"] + 1).cast("int"), F.length(body))))
    found = findings_by_blob(findings, rules).select(F.col("blob").alias(blob), F.col("spans").alias(spans))
    return (versions.withColumn(blob, blob_id(body)).join(found, blob, "left")
            .withColumn(text, F.when(F.col(spans).isNull(), body).otherwise(merged))
            .select(*versions.columns))
