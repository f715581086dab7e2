"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (decontaminate, html, html_labelled, language, lm_score, near_duplicates, neighbours,
               packing, queries_repair, secrets, url_rules, warc)
from .common import scratch_path


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


#: The rules of the URL query: host, path, action.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"),
             ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op6_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _read(spark, sf_dir, "pages").select("page_id", "url")
    values = ", ".join(f"('{h}', '{p}', '{a}')" for h, p, a in URL_RULES)
    rules = spark.sql(f"SELECT * FROM VALUES {values} AS r(host, path, action)")
    return (url_rules.judge_urls(pages, rules)
            .select("page_id", "host", "path", "rule", "verdict"))


_OP6_SQL = """
WITH rest AS (
  SELECT page_id, CASE WHEN contains(url, '://')
                       THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r
  FROM pages),
parts AS (
  SELECT page_id,
         translate(regexp_extract(r, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rest),
fits AS (
  SELECT *, (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') AS a,
         (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') AS b,
         (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') AS c,
         (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') AS d
  FROM parts)
SELECT page_id, host, path,
       CASE WHEN a THEN 'example.net/en/' WHEN b THEN 'example.com/de/'
            WHEN c THEN 'org/fr/' WHEN d THEN 'net/' END AS rule,
       CASE WHEN a THEN 'allow' WHEN b THEN 'block' WHEN c THEN 'allow'
            WHEN d THEN 'block' ELSE 'allow' END AS verdict
FROM fits
"""



def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over one ledger: the second finds every blob in it, so each has
    been scanned by one run (column ``scans``)."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    ledger = scratch_path(spark, "secret-ledger")
    secrets.scan_versions(docs, ledger, "doc_id")
    found = secrets.scan_versions(docs, ledger, "doc_id")
    spans = F.col("spans")
    base = F.filter(spans, lambda s: s["place"] < len(secrets.BASE_RULES))

    def count(kind: str):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")

    return (secrets.findings_by_path(docs, found, "doc_id", per_blob=secrets.scan_counts(spark, ledger))
            .select(F.col("path").alias("doc_id"), count("assign").alias("n_assign"),
                    count("access").alias("n_access"), count("hex").alias("n_hex"),
                    F.sha2(secrets.span_text(base), 256).alias("base_sha256"),
                    secrets.span_text(spans).alias("spans"), "scans"))


def _duck_spans(kind: str, place: int, pattern: str, size: str) -> str:
    """Matches of one kind with positions: pieces between matches and matches
    alternate, so running sums of lengths give the starts."""
    pattern = pattern.replace("'", "''")
    return f"""
  SELECT blob, {place} AS place, '{kind}' AS kind, start, start + length(hit) AS stop
  FROM (SELECT blob, hit,
               sum(length(gap) + length(hit)) OVER (PARTITION BY blob ORDER BY i) - length(hit) AS start
        FROM (SELECT blob, unnest(gaps[:len(hits)]) AS gap, unnest(hits) AS hit,
                     unnest(range(len(hits))) AS i
              FROM (SELECT blob, string_split_regex(t, '{pattern}') AS gaps,
                           regexp_extract_all(t, '{pattern}') AS hits
                    FROM texts WHERE regexp_matches(t, '{pattern}'))))
  WHERE {size}"""


_ASSIGN = (r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"""
           r"""|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_PATTERNS = [
    ("assign", _ASSIGN, f"length(regexp_extract(hit, '{_ASSIGN.replace(chr(39), chr(39) * 2)}', 2)) >= 6"),
    ("access", "AKIA[A-Z0-9]+", "length(hit) >= 20"),
    ("hex", "[0-9a-f]+", "length(hit) >= 24"),
    ("pem", "-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", "true"),
    ("github", "gh[pousr]_[A-Za-z0-9]+", "length(hit) >= 40"),
    ("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", "length(hit) >= 40"),
]
_OP3_SQL = f"""
WITH docs AS (SELECT doc_id, sha256(coalesce(text, '')) AS blob, coalesce(text, '') AS t FROM documents),
texts AS (SELECT blob, any_value(t) AS t FROM docs GROUP BY blob),
found AS ({' UNION ALL '.join(_duck_spans(k, i, p, s) for i, (k, p, s) in enumerate(_PATTERNS))}),
joined AS (
  SELECT blob, count(*) FILTER (kind = 'assign') AS n_assign,
         count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, place)
           FILTER (place < 3) AS base,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, place) AS spans
  FROM found GROUP BY blob)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
       coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
       coalesce(spans, '') AS spans, CAST(1 AS BIGINT) AS scans
FROM docs LEFT JOIN joined USING (blob)
"""


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    model = language.fit(docs.where(~held_out))
    return (language.identify(docs, model)
            .select("doc_id", held_out.alias("held_out"), "lang_pred", "score"))


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = html.train(html_labelled.labelled_pages())
    return (html.extract(_read(spark, sf_dir, "pages"), model)
            .select("page_id", "url", "text", "n_chars"))


def tokenizer_path() -> str:
    """The byte-level BPE of the installed public vocabulary files."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_read(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path())


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = scratch_path(spark, "warc")
    warc.write_warc(_read(spark, sf_dir, "pages"), archives)
    return (warc.read_warc(spark, archives)
            .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "problem"))


_OP10_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body,
                  sha256(coalesce(html, '')) AS payload_digest FROM pages),
first AS (SELECT payload_digest, min(page_id) AS first FROM p GROUP BY payload_digest)
SELECT page_id, octet_length(body) AS payload_bytes, payload_digest,
       CASE WHEN octet_length(body) >= 100 AND page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN octet_length(body) >= 100 AND page_id > first THEN first END AS refers_to,
       CAST(NULL AS VARCHAR) AS problem
FROM p JOIN first USING (payload_digest)
"""

def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(_read(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op8_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target: documents labelled as of good quality; background: all documents."""
    good = (_read(spark, sf_dir, "labels").where("quality = 1").select("doc_id").distinct()
            .withColumn("target", F.lit(True)))
    # One way of joining at every size: the labels grow with the documents.
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text") \
        .join(good.hint("shuffle_hash"), "doc_id", "left")
    return lm_score.score(docs)


def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(_read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


SPARK = {"op1_language_id": op1_language_id, "op2_html_text": op2_html_text,
         "op3_secret_scan": op3_secret_scan, "op4_near_duplicates": op4_near_duplicates,
         "op5_decontamination": op5_decontamination, "op6_url_rules": op6_url_rules,
         "op7_packing": op7_packing, "op8_lm_score": op8_lm_score,
         "op9_neighbours": op9_neighbours, "op10_warc": op10_warc, **queries_repair.SPARK}
ORACLE = {"op3_secret_scan": _OP3_SQL, "op6_url_rules": _OP6_SQL, "op10_warc": _OP10_SQL, **queries_repair.ORACLE}
