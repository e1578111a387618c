"""URL filters: pattern rules indexed by their rarest literal token.

A URL's tokens fetch candidate rules by an equi-join; only those run regular
expressions.  Everything is DataFrame functions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values: (host and path, verdict).
RULES = (
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BREAKS = r"[^a-z0-9_-]+"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased; empty without ``://``."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*(/[^?#]*)", 1), F.lit(""))


def tokens(text: Column) -> Column:
    """Distinct lower-case runs of letters, digits, ``_`` and ``-``."""
    return F.array_distinct(F.array_remove(F.split(F.translate(text, UPPER, LOWER), _BREAKS), ""))


def rule_table(spark, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """(rule, verdict, patterns): a rule fits its host, all subdomains, and paths that begin with its path."""
    if not all(v in ("allow", "block") and "/" in r for r, v in rules):
        raise ValueError("a rule is host/path with verdict allow or block")
    return with_patterns(spark.createDataFrame(list(rules), "rule string, verdict string"))


def with_patterns(rules: DataFrame) -> DataFrame:
    """Add the regular expressions of host and path to rules (rule, verdict)."""
    slash = F.instr("rule", "/")
    host = F.translate(F.substr("rule", F.lit(1), slash - 1), UPPER, LOWER)
    path = F.substr("rule", slash)

    def quoted(c: Column) -> Column:
        return F.concat(F.lit(r"\Q"), F.regexp_replace(c, r"\\E", r"\\E\\\\E\\Q"), F.lit(r"\E"))

    return rules.select(
        "rule", "verdict", host.alias("rule_host"),
        F.concat(F.lit(r"(?s)\A(.*\.)?"), quoted(host), F.lit(r"\z")).alias("host_pattern"),
        F.concat(F.lit(r"(?s)\A"), quoted(path)).alias("path_pattern"),
    )


def index_rules(rules: DataFrame, seen: DataFrame) -> DataFrame:
    """Each rule under the one of its whole literal tokens that fewest URLs hold (``seen``: token, n).

    A path's last token may be the beginning of a longer one in a URL and is
    no key unless the path ends it with a break.  A rule without any key is
    filed under the empty token, which every URL has.
    """
    whole = F.regexp_replace(F.col("rule"), r"[A-Za-z0-9_-]+$", "")
    keys = rules.withColumn("token", F.explode(F.concat(F.array(F.lit("")), tokens(whole))))
    best = keys.join(seen, "token", "left").groupBy("rule", "verdict", "rule_host", "host_pattern", "path_pattern").agg(
        F.min(F.struct((F.col("token") == "").alias("last"), F.coalesce("n", F.lit(0)).alias("n"), "token")).alias("k")
    )
    return best.select("rule", "verdict", "rule_host", "host_pattern", "path_pattern", F.col("k.token").alias("token"))


def url_filter(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with host, path, rule and verdict of the longest rule that fits.

    Each distinct URL is judged once and joined back, so a URL or host with a
    third of all rows costs no more than another; only fitted URLs are joined.
    Ties of equal length go to the longer host; a rule listed with both verdicts blocks.
    A null URL, or one without ``://``, has empty host and path; no rule fits
    it and it gets ``default``.  Empty tables give empty results.  Columns of
    ``pages`` named like the four results are replaced.
    """
    part = pages.drop("host", "path", "rule", "verdict").withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    urls = part.select("host", "path").distinct()
    words = urls.select("host", "path", F.explode(F.concat(F.array(F.lit("")), tokens(F.concat_ws(" ", "host", "path")))).alias("token"))
    seen = words.groupBy("token").agg(F.count("*").alias("n"))
    fits = (
        words.join(index_rules(rules, seen), "token")
        .where(F.rlike("host", F.col("host_pattern")) & F.rlike("path", F.col("path_pattern")))
        .groupBy("host", "path")
        .agg(F.max(F.struct(F.length("rule").alias("n"), F.length("rule_host").alias("h"), F.struct("rule", "verdict").alias("r"))).alias("b"))
        .select("host", "path", "b.r.rule", "b.r.verdict")
    )
    return part.join(fits, ["host", "path"], "left").select(
        *pages.drop("host", "path", "rule", "verdict").columns, "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict")
    )
