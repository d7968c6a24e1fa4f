"""URL filters: host-suffix and path-prefix expressions looked up by short hash prefixes, confirmed by full digests.

Cases: a null url, or one without ``://``, has an empty host and path and fits no rule unless the rule's host is empty;
equal urls are looked up once and every row of theirs gets the answer; of rules of one length the blocking one wins,
then the smaller rule text; no rules or no pages give the default verdict or no rows. Extra input columns pass through;
an input column that has the name of an output column is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orthoweave.llm.common import OWN, ascii_lower

#: Rules up to this number are sent to every executor; more are joined by shuffle.
BROADCAST_RULES = 200_000
#: Hexadecimal digits of the short prefix.
SHORT = 8


def url_host(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"://([^/?#]*)", 1))


def url_path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"://[^/?#]*([^?#]*)", 1)


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def url_filter(pages: DataFrame, rules: DataFrame, *, url: str = "url", default: str = "allow") -> DataFrame:
    """Adds host, path, rule and verdict to each row.

    rules: columns verdict, host, path. Every suffix of a url's host that has as many labels as some rule's host, with
    every prefix of its path as long as some rule's path, is an expression. The lengths come from the rules, so no
    expression that could match is left out and none is built in vain.
    """
    rules = rules.select(F.lower("verdict").alias("verdict"), ascii_lower(F.col("host")).alias("host"), F.coalesce("path", F.lit("")).alias("path")).filter(F.col("host").isNotNull()).distinct()
    shape = rules.agg(F.count("*"), F.array_sort(F.collect_set(F.size(F.split("host", "\\.")))), F.array_sort(F.collect_set(F.length("path")))).first()
    rules = rules.select(
        (F.length("host") + F.length("path")).alias("size"),
        (F.col("verdict") == "block").alias("blocks"),
        F.concat("host", "path").alias("rule"),
        "verdict",
        _digest(F.col("host"), F.col("path")).alias("full"),
    ).withColumn("short", F.substring("full", 1, SHORT))
    if shape[0] <= BROADCAST_RULES:
        rules = F.broadcast(rules)

    labels = F.split("host", "\\.")
    suffixes = F.filter(
        F.transform(F.array(*[F.lit(n) for n in shape[1]]).cast("array<int>"), lambda n: F.when(F.size(labels) >= n, F.array_join(F.slice(labels, F.size(labels) - n + 1, n), "."))),
        lambda x: x.isNotNull(),
    )
    prefixes = F.filter(
        F.transform(F.array(*[F.lit(n) for n in shape[2]]).cast("array<int>"), lambda n: F.when(F.length("path") >= n, F.substring(F.col("path"), F.lit(1), n))),
        lambda x: x.isNotNull(),
    )
    urls = pages.select(F.col(url).alias("url")).filter(F.col("url").isNotNull()).distinct()
    urls = urls.select("url", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    asked = urls.select("url", "path", F.explode(suffixes).alias("h"), prefixes.alias("ps")).select("url", "h", F.explode("ps").alias("p")).select("url", _digest(F.col("h"), F.col("p")).alias("asked")).withColumn("short", F.substring("asked", 1, SHORT))
    fits = asked.join(rules, "short").filter(F.col("asked") == F.col("full"))
    won = fits.groupBy("url").agg(F.max(F.struct("size", "blocks", "rule", "verdict")).alias("won"))
    won = won.select(F.col("url").alias(OWN + "url"), F.col("won.rule").alias(OWN + "rule"), F.col("won.verdict").alias(OWN + "verdict"))
    kept = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict") or c == url]
    return pages.join(won, pages[url] == won[OWN + "url"], "left").select(
        *[pages[c] for c in kept],
        url_host(pages[url]).alias("host"),
        url_path(pages[url]).alias("path"),
        F.col(OWN + "rule").alias("rule"),
        F.coalesce(OWN + "verdict", F.lit(default)).alias("verdict"),
    )
