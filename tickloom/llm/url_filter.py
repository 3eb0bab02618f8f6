"""URL filtering against rules on host suffixes and path prefixes.

Every URL is expanded into expressions: each suffix of its host at a dot, with
each prefix of its path whose length some rule's path has.  Expressions meet
the rules by a 4-byte prefix of their SHA-256; full digests are then compared,
and the longest rule that is left decides.  Work is done once for each distinct
pair of host and path, and only pairs that meet a rule are shuffled again.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .hot import hot_limit
from .text import ascii_lower

DIGEST_PREFIX = 8  # hex digits
#: Rules are broadcast if their hosts and paths, and so many bytes for each, have no more bytes than these; else shuffled.
BROADCAST_BYTES, ROW_BYTES = 32 << 20, 200
SALTS = 16


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str


def with_host_and_path(urls: DataFrame, url: Column) -> DataFrame:
    """urls with host and path; both empty for a null or one without ``://``."""
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return urls.withColumns({"host": ascii_lower(F.coalesce(host, F.lit(""))), "path": F.coalesce(path, F.lit(""))})


def rule_table(rules: DataFrame) -> DataFrame:
    """rule, verdict, lengths and digest of each rule of host, path and verdict; of one rule with two verdicts block holds."""
    once = rules.groupBy("host", "path").agg(F.max(F.col("verdict") == "block").alias("blocks"), F.min("verdict").alias("verdict"))
    digest = F.sha2(F.concat("host", F.lit("\0"), "path").cast("binary"), 256)
    rows = once.select(
        F.concat("host", "path").alias("rule"), F.when(F.col("blocks"), "block").otherwise(F.col("verdict")).alias("verdict"),
        (F.length("host") + F.length("path")).alias("length"), F.length("host").alias("host_length"), digest.alias("digest"),
    )
    return rows.withColumn("short", F.substring("digest", 1, DIGEST_PREFIX))


def filter_rows(urls: DataFrame, rules: list[Rule] | DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """row (a struct of urls' columns), host, path, rule (null if none fits) and verdict.

    rules: a list, or a table of host, path and verdict.  A rule fits its host
    and all subdomains if the path starts with the rule's.  The longest wins; of
    equal length the one with the longer host.  Where none fits the verdict is
    ``default``.  Null and malformed URLs have empty host and path and fit no
    rule; they meet nothing on the way.  Rows that repeat are judged alike;
    URLs of any length are taken whole; an empty table gives an empty result.
    """
    spark = urls.sparkSession
    if not isinstance(rules, DataFrame):
        rules = spark.createDataFrame([tuple(r) for r in rules], "host string, path string, verdict string")
    parsed = with_host_and_path(urls.select(F.struct(*[F.col(f"`{c}`") for c in urls.columns]).alias("row")), F.col("row")[url])
    none = F.lit(None).cast("string")
    sizes = rules.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("host") + F.octet_length("path")), F.lit(0)), F.array_sort(F.collect_set(F.length("path")))).first()
    if not sizes[0]:
        return parsed.select("row", "host", "path", none.alias("rule"), F.lit(default).alias("verdict"))
    table = rule_table(rules)
    labels = F.split("host", r"\.")
    hosts = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    prefixes = F.array_distinct(F.transform(F.array(*[F.lit(n) for n in sizes[2]]), lambda n: F.substring(F.col("path"), F.lit(1), n)))
    # Each pair of host and path once, with how many rows have it.
    known = parsed.where("host <> ''")
    pairs = known.groupBy("host", "path").agg(F.count(F.lit(1)).alias("uses"))
    expressions = (
        pairs.withColumn("h", F.explode(hosts)).withColumn("p", F.explode(prefixes))
        .withColumn("full", F.sha2(F.concat("h", F.lit("\0"), "p").cast("binary"), 256))
        .select("host", "path", "uses", "full", F.substring("full", 1, DIGEST_PREFIX).alias("short"))
    )
    if sizes[1] + ROW_BYTES * sizes[0] <= BROADCAST_BYTES:
        met = expressions.join(F.broadcast(table), "short")
    else:  # short suffixes such as com/ are many hosts': each rule is in SALTS places
        salted = table.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        met = expressions.withColumn("salt", F.pmod(F.xxhash64("host", "path"), F.lit(SALTS)).cast("int")).join(salted, ["short", "salt"])
    met = met.where("full = digest")
    best = met.groupBy("host", "path").agg(F.max("uses").alias("uses"), F.max(F.struct("length", "host_length", "rule", "verdict")).alias("best"))
    best = best.select("host", "path", "uses", "best.rule", "best.verdict")
    # A URL of very many rows is one of few: those are broadcast, and the others are no task's burden.
    limit = hot_limit(known.count())
    hot = F.broadcast(best.where(F.col("uses") > limit).select("host", "path", F.col("rule").alias("hot_rule"), F.col("verdict").alias("hot_verdict")))
    often = F.broadcast(pairs.where(F.col("uses") > limit).select("host", "path", F.lit(True).alias("often")))
    split = known.join(often, ["host", "path"], "left").join(hot, ["host", "path"], "left")
    rare = split.where("often is null").select("row", "host", "path").join(best.where(F.col("uses") <= limit).drop("uses"), ["host", "path"], "left")
    many = split.where("often").select("row", "host", "path", F.col("hot_rule").alias("rule"), F.col("hot_verdict").alias("verdict"))
    empty = parsed.where("host = ''").select("row", "host", "path", none.alias("rule"), none.alias("verdict"))
    return rare.unionByName(many).unionByName(empty).withColumn("verdict", F.coalesce("verdict", F.lit(default)))


def filter_urls(urls: DataFrame, rules: list[Rule] | DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """``filter_rows`` with urls' columns beside the judgement, but for those that are named, in any case, like one of its own."""
    carry = [c for c in urls.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    return filter_rows(urls, rules, url, default).select(*[F.col("row")[c].alias(c) for c in carry], "host", "path", "rule", "verdict")
