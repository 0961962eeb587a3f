"""URL filters: host-suffix and path-prefix expressions, joined on short hash prefixes.

Each distinct URL is expanded into (host suffix, path prefix) expressions. Expressions meet the rules on the first
32 bits of their SHA-256; the full digest then confirms a hit and the longest rule wins.

Defined results: a null URL, or one without ``://``, has an empty host and path and no rule. Repeated pages each keep
their row. Of equally long rules the one with the longer host wins, then ``block``. An empty rule table or page table
gives no rule, or no row. Other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import durable

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def expressions(host: Column, path: Column, max_labels: int, max_depth: int, lengths: list[int]) -> Column:
    """All (host, path) expressions a rule could state for this URL.

    Suffixes of at most ``max_labels`` labels; path prefixes that end in one of the first ``max_depth`` slashes, and
    those of the given ``lengths``. The three bounds come from the rules, so nothing that could match is left out.
    """
    labels = F.split(host, r"\.")
    n = F.size(labels)
    hosts = F.transform(
        F.sequence(F.lit(1), F.least(n, F.lit(max_labels))), lambda i: F.array_join(F.slice(labels, n - i + 1, i), ".")
    )
    parts = F.split(path, "/")
    depth = F.least(F.size(parts) - 1, F.lit(max_depth))
    paths = F.when(
        depth > 0,
        F.transform(F.sequence(F.lit(1), depth), lambda i: F.concat(F.array_join(F.slice(parts, 1, i), "/"), F.lit("/"))),
    ).otherwise(F.array().cast("array<string>"))
    for size in lengths:
        cut = F.when(F.length(path) >= size, F.array(F.substring(path, 1, size)))
        paths = F.concat(paths, F.coalesce(cut, F.array().cast("array<string>")))
    paths = F.array_distinct(paths)
    return F.flatten(
        F.transform(hosts, lambda h: F.transform(paths, lambda p: F.struct(h.alias("host"), p.alias("path"))))
    )


def filter_urls(pages: DataFrame, rules: DataFrame, default: str = "allow", url: str = "url") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict``; ``rules`` has ``host``, ``path``, ``verdict``.

    A rule fits its host and all subdomains if the path starts with the rule's. The rules are joined, not collected:
    a small table is broadcast by Spark on its known size, a large one meets the expressions in a hash join.
    """
    rules = (
        rules.select("host", "path", "verdict")
        .dropna()
        .groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict"))
        .withColumn("digest", _digest(F.col("host"), F.col("path")))
    )
    odd = ~F.col("path").endswith("/")
    bounds = rules.agg(
        F.max(F.size(F.split("host", r"\."))).alias("labels"),
        F.max(F.when(~odd, F.size(F.split("path", "/")) - 1)).alias("depth"),
        F.collect_set(F.when(odd, F.length("path"))).alias("lengths"),  # distinct lengths: at most the longest URL
    ).first()
    urls = pages.select(F.col(url).alias("url")).distinct()
    parts = urls.select("url", host_of(F.col("url")).alias("h"), path_of(F.col("url")).alias("p"))
    terms = parts.select(
        "url",
        F.explode(
            expressions(F.col("h"), F.col("p"), bounds["labels"] or 1, bounds["depth"] or 0, sorted(bounds["lengths"]))
        ).alias("x"),
    ).select("url", _digest(F.col("x.host"), F.col("x.path")).alias("url_digest"))
    keyed = rules.withColumn("key", F.substring("digest", 1, 8))
    hits = (
        terms.withColumn("key", F.substring("url_digest", 1, 8))
        .join(keyed, "key")
        .filter(F.col("url_digest") == F.col("digest"))
    )
    best = hits.groupBy("url").agg(
        F.max(
            F.struct(
                (F.length("host") + F.length("path")).alias("size"), F.length("host").alias("n"), "verdict", "host", "path"
            )
        ).alias("best")
    )
    # Written once, so that the join below has a plain exchange on either side and a hot URL can be split.
    best = durable(
        best.select("url", F.concat("best.host", "best.path").alias("rule"), F.col("best.verdict").alias("verdict")),
        "url-rules",
    )
    kept = pages.drop("host", "path", "rule", "verdict")
    out = kept.join(best.withColumnRenamed("url", "_rule_url").hint("merge"), kept[url] == F.col("_rule_url"), "left")
    return out.select(
        *kept.columns,
        host_of(F.col(url)).alias("host"),
        path_of(F.col(url)).alias("path"),
        "rule",
        F.coalesce("verdict", F.lit(default)).alias("verdict"),
    )
