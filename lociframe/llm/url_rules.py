"""URL filters by host-suffix and path-prefix expressions.

Each URL becomes the expressions under which a rule could be listed: every suffix of its host at a
dot, with every prefix of its path whose length some rule has. Expressions and rules meet in an
equi-join on the first hex digits of their SHA-256; the full digest then confirms the match, and the
longest rule decides. Work per URL is labels x path lengths; the rule list is never broadcast by hint
and may be larger than memory. A hot expression such as ``com/`` lies on the URL side of an inner join
whose other side is unique, which adaptive execution splits.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Hex digits of the digest that the join compares; 8 digits are 32 bits.
PREFIX_DIGITS = 8


def host_of(url: Column) -> Column:
    """Text between the first ``://`` and the next ``/``, ``?``, ``#``, with A-Z lower-cased; else empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """Text from the host's end up to ``?`` or ``#``; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_suffixes(host: Column) -> Column:
    """Every suffix of the host that starts at a label: ``a.b.c`` gives ``a.b.c``, ``b.c``, ``c``."""
    labels = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow", key: str = "page_id", prefix_digits: int = PREFIX_DIGITS) -> DataFrame:
    """Host, path, deciding rule and verdict of each URL.

    pages: (key, url); rules: (action, host, path). A rule fits its host and all subdomains when the
    URL's path starts with the rule's; the longest host + path wins, then ``block`` over ``allow``.
    ``default`` is the verdict where no rule fits. A null URL or one without ``://`` has an empty host
    and path and gets the default; null keys and repeated rows are kept, one result row per input row.
    An empty rule list leaves every URL with the default. Extra columns are ignored.
    """
    urls = pages.select(F.col(key).alias("key"), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    listed = rules.select("action", F.concat("host", "path").alias("rule"), F.coalesce(F.length("path"), F.lit(0)).alias("path_length")).filter("rule is not null")
    # Distinct path lengths of the rules are few whatever the number of rules: URLs are some kB at most.
    lengths = sorted(r[0] for r in listed.select("path_length").distinct().collect())
    # Equal hosts and paths are judged once.
    targets = urls.filter(F.col("host") != "").select("host", "path").distinct()
    prefixes = F.filter(F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in lengths] or [F.lit(None).cast("string")]), lambda p: p.isNotNull())
    expressions = (
        targets.select("host", "path", F.explode(host_suffixes(F.col("host"))).alias("suffix"), prefixes.alias("prefixes"))
        .select("host", "path", F.explode("prefixes").alias("prefix"), "suffix")
        .select("host", "path", F.sha2(F.concat("suffix", "prefix"), 256).alias("digest"))
        .withColumn("short", F.substring("digest", 1, prefix_digits))
    )
    digests = (
        listed.groupBy("rule").agg(F.max("action").alias("action"))
        .withColumn("rule_digest", F.sha2("rule", 256)).withColumn("short", F.substring("rule_digest", 1, prefix_digits))
    )
    found = (
        expressions.join(digests, "short").filter(F.col("digest") == F.col("rule_digest"))
        .groupBy("host", "path").agg(F.max(F.struct(F.length("rule").alias("n"), "rule", "action")).alias("best"))
    )
    return urls.join(found, ["host", "path"], "left").select(
        F.col("key").alias(key), "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.action", F.lit(default)).alias("verdict"))
