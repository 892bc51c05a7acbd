"""URL rules by hashed host-suffix and path-prefix expressions, in column functions only.

Every URL is expanded into the expressions it could be ruled by: each suffix of its host
that starts at a label, with each prefix of its path that ends in ``/``. Expressions meet
rules in an equi-join on a short prefix of their SHA-256; a full digest and the rest of the
rule's path confirm the match, and the longest rule wins.

A rule whose path does not end in ``/`` is filed under its path up to the last ``/`` and
confirmed by the whole path. A null URL, or one without ``://``, has an empty host and
path, which no rule fits. Rules of equal length are ranked by the longer host, then
``block`` before ``allow``. Repeated rows and repeated URLs are judged alike.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The rules of the registered query, as (verdict, host, path).
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
# Hex digits of the digest that the join is on.
SHORT = 8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    """Host: behind the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased."""
    at = F.instr(url, "://")
    host = F.regexp_extract(F.substr(url, at + 3), r"\A[^/?#]*", 0)
    return F.coalesce(F.when(at > 0, F.translate(host, UPPER, LOWER)), F.lit(""))


def url_path(url: Column) -> Column:
    """Path: behind the host up to ``?``, ``#`` or the end."""
    at = F.instr(url, "://")
    path = F.regexp_extract(F.substr(url, at + 3), r"\A[^/?#]*([^?#]*)", 1)
    return F.coalesce(F.when(at > 0, path), F.lit(""))


def _count(text: Column, sign: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(sign)))


def _sizes(rules: DataFrame, size: Column) -> list[int]:
    """Numbers of labels or path parts that occur among the rules."""
    return sorted(row[0] for row in rules.select(size).distinct().collect() if row[0] is not None)


def _expanded(pieces: list[tuple[Column, Column]]) -> Column:
    """Those of the pieces ``(fits, text)`` that fit."""
    chosen = [F.when(fits, text) for fits, text in pieces]
    return F.filter(F.array(*chosen, F.lit(None).cast("string")), lambda x: x.isNotNull())


def host_suffixes(host: Column, labels: list[int]) -> Column:
    """Suffixes of the given numbers of labels."""
    dots = _count(host, ".")
    return _expanded([(dots >= n - 1, F.substring_index(host, ".", -n)) for n in labels])


def path_prefixes(path: Column, parts: list[int]) -> Column:
    """Prefixes of the given numbers of parts, each ended by ``/``."""
    slashes = _count(path, "/")
    return _expanded([(slashes >= n, F.concat(F.substring_index(path, "/", n), F.lit("/"))) for n in parts])


def rule_table(rules: DataFrame) -> DataFrame:
    """Rules ``verdict, host, path`` with the expression they are filed under."""
    filed = F.regexp_extract("path", r"\A(.*/)", 1)
    digest = F.sha2(F.concat("host", filed), 256)
    return rules.select(
        F.col("verdict").alias("rule_verdict"),
        F.concat("host", "path").alias("rule_text"),
        F.col("path").alias("rule_path"),
        F.length("host").alias("rule_host_length"),
        digest.alias("rule_digest"),
        F.substring(digest, 1, SHORT).alias("short"),
    )


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every row of ``pages``."""
    parsed = pages.select(
        "page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path")
    )
    # Each different address is expanded once, however many pages have it, and only to the
    # numbers of labels and parts that rules have: a URL of many slashes costs no more.
    labels = _sizes(rules, _count(F.col("host"), ".") + 1)
    parts = _sizes(rules, _count(F.col("path"), "/"))
    addresses = parsed.select("host", "path").distinct()
    expressions = addresses.select(
        "host", "path", F.explode(host_suffixes(F.col("host"), labels)).alias("suffix")
    ).select("host", "path", "suffix", F.explode(path_prefixes(F.col("path"), parts)).alias("prefix"))
    digest = F.sha2(F.concat("suffix", "prefix"), 256)
    expressions = expressions.select(
        "host", "path", digest.alias("digest"), F.substring(digest, 1, SHORT).alias("short")
    )
    rank = F.struct(
        F.length("rule_text"), "rule_host_length", (F.col("rule_verdict") == "block").alias("blocks"), "rule_text"
    )
    winners = (
        expressions.join(rule_table(rules), "short")
        .where((F.col("digest") == F.col("rule_digest")) & F.startswith("path", F.col("rule_path")))
        .groupBy("host", "path")
        .agg(F.max_by(F.struct("rule_text", "rule_verdict"), rank).alias("won"))
    )
    return parsed.join(winners, ["host", "path"], "left").select(
        "page_id",
        "host",
        "path",
        F.col("won.rule_text").alias("rule"),
        F.coalesce("won.rule_verdict", F.lit(default)).alias("verdict"),
    )


def fixed_rules(spark, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "verdict string, host string, path string")
