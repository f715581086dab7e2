"""URL verdicts from host-and-path rules by hashed expressions.

Every URL is expanded into the host-suffix + path-prefix expressions that a
rule could name; expressions meet the rules in an equi-join on a short prefix
of their SHA-256, the full digests are confirmed, and the longest rule wins.
DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Hexadecimal digits of the digest that the join uses (32 bits).
SHORT = 8


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty when there is none."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def url_host(url: Column) -> Column:
    """Host: up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty for
    null or a string without ``://``."""
    host = F.regexp_extract(_rest(url), r"^([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    """Path: after the host up to ``?``, ``#`` or the end; empty as above."""
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def prepare_rules(rules: DataFrame) -> DataFrame:
    """One row per (host, path) of ``rules`` (host, path, action): rules without
    host or with another action than block/allow are left out, repeated ones
    merged; a contradiction is a block."""
    host = F.translate(F.col("host"), UPPER, LOWER)
    path = F.coalesce(F.col("path"), F.lit(""))
    merged = (rules.where((F.coalesce(F.col("host"), F.lit("")) != "")
                          & F.col("action").isin("block", "allow"))
              .groupBy(host.alias("rule_host"), path.alias("rule_path"))
              .agg(F.max("action").alias("action")))  # block sorts after allow
    rule = F.concat("rule_host", "rule_path")
    return merged.select(
        rule.alias("rule"), "action",
        (F.size(F.split("rule_host", r"\.", -1))).alias("labels"),
        F.length("rule_path").alias("path_chars"),
        F.length("rule_host").alias("host_chars"),
        F.sha2(rule, 256).alias("digest"))


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url",
               default: str = "allow") -> DataFrame:
    """``pages`` with host, path, rule and verdict.

    A rule fits its host and all subdomains when the URL's path starts with the
    rule's path. Precedence: longer rule, then longer host, then block. Without
    a fitting rule the rule is null and the verdict is ``default``. Null URLs
    and URLs without ``://`` have an empty host and path and fit no rule.
    Every input row gives one row; repeated rows stay; columns of ``pages``
    named like an output column are replaced. An empty table gives an empty one.

    The expressions follow the rules' shapes (label count of the host, length
    of the path): one per distinct shape, however long the URL is.
    """
    table = prepare_rules(rules)
    # Distinct shapes, not rules: at most 127 labels times the path lengths in use.
    shapes = [(r.labels, r.path_chars) for r in
              table.select("labels", "path_chars").distinct().collect()]
    parsed = (pages.withColumns({"host": url_host(F.col(url)), "path": url_path(F.col(url))})
              .drop("rule", "verdict"))
    if not shapes:
        return parsed.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    expressions = F.array_distinct(F.filter(F.array(*[
        F.when(F.length("path") >= n,
               F.concat(F.substring_index("host", ".", -k), F.substring("path", 1, n)))
        for k, n in sorted(shapes)]), lambda x: x.isNotNull()))
    expanded = (parsed.where(F.col("host") != "").select("host", "path")
                .select("host", "path", F.explode(expressions).alias("expression"))
                .withColumn("full", F.sha2("expression", 256))
                .withColumn("short", F.substring("full", 1, SHORT)))
    hits = (expanded.join(table.withColumn("short", F.substring("digest", 1, SHORT)), "short")
            .where((F.col("full") == F.col("digest")) & (F.col("expression") == F.col("rule"))))
    order = F.struct(F.length("rule"), "host_chars", "action", "rule")
    won = fresh(parsed, "_won")
    best = (hits.groupBy("host", "path")
            .agg(F.max_by(F.struct("rule", "action"), order).alias(won)))
    return (parsed.join(best, ["host", "path"], "left")
            .withColumns({"rule": F.col(f"{won}.rule"),
                          "verdict": F.coalesce(f"{won}.action", F.lit(default))})
            .select(*[c for c in parsed.columns if c not in ("host", "path")],
                    "host", "path", "rule", "verdict"))
