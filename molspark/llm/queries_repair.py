"""Registered queries of conversation repair, collocation mining and the quality
classifier, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import collocations, conversations, quality


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def damaged(rows: DataFrame) -> DataFrame:
    """The contract's damage; dropped rows stay with ``present`` false, so that
    their conversation is known."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20
    return (rows.select("conv_id", "turn", fault.alias("fault"), text("role").alias("role"), text("text").alias("text"))
            .withColumn("role", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")))
            .withColumn("text", F.when(F.col("fault") == 1, "").when(
                F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")))
            .withColumn("copy", F.explode(F.sequence(F.lit(0), F.when(F.col("fault") == 3, 1).otherwise(0))))
            .select("conv_id", "turn", "role", "text", (F.col("fault") != 0).alias("present")))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = damaged(_read(spark, sf_dir, "conversations"))
    return conversations.repair(rows, present=F.col("present")).drop("system_first")


#: CRC-32 of a string of ASCII characters, bit by bit: of the eight steps of a
#: byte the first takes the byte in.
_CRC = """list_reduce(list_prepend(4294967295, flatten(list_transform(string_split({0}, ''),
    lambda ch: [ascii(ch)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
    lambda c, x: CASE WHEN xor(c, x) % 2 = 1 THEN xor(xor(c, x) // 2, 3988292384) ELSE xor(c, x) // 2 END)"""


def _least(*options: str) -> str:
    return f"list_min(list_filter([{', '.join(options)}], lambda o: o IS NOT NULL))"


def _edit(state: str, cost: str, letter: str, line: str | None) -> str:
    """``state`` (cost, audit, lines) after an edit; null stays null."""
    lines = f"{state}.o" if line is None else f"list_append({state}.o, {line})"
    return (f"CASE WHEN {state} IS NOT NULL THEN "
            f"struct_pack(c := {state}.c + {cost}, a := {state}.a || '{letter}', o := {lines}) END")


_TURN = "(5 * (CASE WHEN fault = 'truncated' THEN 1 ELSE 0 END))"
_LINE = "role || ':' || text"


def _keep(state: str, initial: str) -> str:
    edit = _edit(state, _TURN, "K", _LINE)
    return f"CASE WHEN alive AND left(role, 1) = '{initial}' THEN {edit} END"


def _rerole(state: str, role: str) -> str:
    edit = _edit(state, f"1 + {_TURN}", "R", f"'{role}:' || text")
    return f"CASE WHEN alive THEN {edit} END"


_NULL = "CAST(NULL AS STRUCT(c BIGINT, a VARCHAR, o VARCHAR[]))"
_OP11_SQL = f"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k
  FROM conversations),
hit AS (SELECT *, xor({_CRC.format('k')}, 4294967295) % 20 AS f FROM keyed),
rows AS (
  SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN f = 1 THEN '' WHEN f = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN f = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM hit WHERE f <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth,
         rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare
  FROM rows),
faults AS (
  SELECT conv_id, turn, role, text, i,
         CASE WHEN bare = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate'
              WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
         left(lag(role) OVER (PARTITION BY conv_id ORDER BY i), 1) || left(role, 1) AS pair,
         i > 1 AS later
  FROM placed),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (later AND pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM faults GROUP BY conv_id),
steps AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, n,
         struct_pack(c := CAST(0 AS BIGINT), a := '', o := CAST([] AS VARCHAR[])) AS e, {_NULL} AS s,
         struct_pack(c := CAST(5 AS BIGINT), a := 'I', o := ['user:']) AS u,
         struct_pack(c := CAST(10 AS BIGINT), a := 'II', o := ['user:', 'assistant:']) AS t
  FROM counted
  UNION ALL
  SELECT conv_id, i, n, de, ns, nu, {_least('dt', _edit('nu', '5', 'I', "'assistant:'"))} AS t
  FROM (
    SELECT conv_id, i, n, de, ns, dt,
           {_least('du', _edit('de', '5', 'I', "'user:'"), _edit('ns', '5', 'I', "'user:'"), _edit('dt', '5', 'I', "'user:'"))} AS nu
    FROM (
      SELECT conv_id, i, n, {_edit('e', '2', 'D', None)} AS de,
             {_least(_edit('s', '2', 'D', None), _keep('e', 's'))} AS ns,
             {_least(_edit('u', '2', 'D', None), _keep('e', 'u'), _keep('s', 'u'), _keep('t', 'u'),
                     _rerole('e', 'user'), _rerole('s', 'user'), _rerole('t', 'user'))} AS du,
             {_least(_edit('t', '2', 'D', None), _keep('u', 'a'), _rerole('u', 'assistant'))} AS dt
      FROM (SELECT p.conv_id, f.i, p.n, p.e, p.s, p.u, p.t, f.role, f.text, f.fault,
                   f.fault NOT IN ('blank', 'duplicate') AS alive
            FROM steps p JOIN faults f ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.i = p.i + 1)))),
best AS (SELECT conv_id, {_least('e', 't')} AS b FROM steps WHERE i = n),
convs AS (SELECT DISTINCT conv_id FROM conversations)
SELECT v.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(b.c, 0) AS cost,
       coalesce(b.a, '') AS audit, sha256(coalesce(array_to_string(b.o, chr(10)), '')) AS repaired_sha256
FROM convs v LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM v.conv_id
LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM v.conv_id
"""


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (collocations.collocations(_read(spark, sf_dir, "documents"))
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))


_OP12_SQL = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[.,;:!?\\n\\x0B\\f\\r]')) AS piece
  FROM documents),
split AS (SELECT lang, list_filter(string_split_regex(piece, '[ \\t]+'), lambda x: x <> '') AS w FROM pieces),
grams AS (
  SELECT lang, k, w[i:i + k - 1] AS g
  FROM (SELECT lang, k, w, unnest(range(1, len(w) - k + 2)) AS i
        FROM (SELECT lang, w, unnest(range(1, 6)) AS k FROM split) WHERE k <= len(w))),
f AS (SELECT lang, k, g, count(*) AS c FROM grams GROUP BY ALL),
total AS (SELECT lang, sum(c)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
cand AS (SELECT * FROM f WHERE k >= 2 AND c >= 100),
parts AS (
  SELECT lang, g[i:i + m - 1] AS g, max(c) AS most
  FROM (SELECT lang, g, c, m, unnest(range(1, k - m + 2)) AS i
        FROM (SELECT lang, g, c, k, unnest(range(2, k)) AS m FROM cand))
  GROUP BY ALL),
kept AS (
  SELECT cand.* FROM cand LEFT JOIN parts ON parts.lang = cand.lang AND parts.g = cand.g
  WHERE parts.most IS NULL OR 100 * parts.most < 100 * cand.c),
cuts AS (
  SELECT lang, g, c AS a, j, g[1:j] AS x, g[j + 1:] AS y
  FROM (SELECT lang, g, c, unnest(range(1, k)) AS j FROM kept)),
scored AS (
  SELECT cuts.lang, cuts.g, a, fx.c AS l, fy.c AS r, n, j,
         ((1000::HUGEINT * a * n) // (fx.c::HUGEINT * fy.c))::BIGINT AS score
  FROM cuts JOIN f fx ON fx.lang = cuts.lang AND fx.g = x JOIN f fy ON fy.lang = cuts.lang AND fy.g = y
  JOIN total ON total.lang = cuts.lang),
worst AS (
  SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, n, score FROM scored
  QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, j) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, n, score
FROM worst QUALIFY rank <= 2000
"""


def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    return quality.classify(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"), held_out)


SPARK = {"op11_conversation_repair": op11_conversation_repair, "op12_collocations": op12_collocations,
         "op13_quality": op13_quality}
ORACLE = {"op11_conversation_repair": _OP11_SQL, "op12_collocations": _OP12_SQL}
