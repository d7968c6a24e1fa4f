"""Connected components of a table of links, by large-star and small-star rounds that stay distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orthoweave.llm.common import materialize


def _both(links: DataFrame) -> DataFrame:
    return links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _star(pairs: DataFrame, keep, step: str) -> DataFrame:
    """pairs (u, v): every v for which keep(u, v), and u, are linked to the smallest of u and its partners."""
    least = materialize(pairs.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")).select(F.col("a").alias("of"), "m"), f"{step}-least")
    told = pairs.join(least, pairs["a"] == least["of"]).filter(keep)
    got = told.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select(F.col("of").alias("a"), F.col("m").alias("b")))
    return materialize(got.filter(F.col("a") != F.col("b")).distinct(), step)


def components(links: DataFrame) -> DataFrame:
    """node, component (its smallest node) for each node of the links (columns a and b, long). Without links: no rows."""
    edges = materialize(links.select("a", "b").filter(F.col("a") != F.col("b")).distinct(), "edges")
    before = None
    while True:
        edges = _star(materialize(_both(edges).distinct(), "both"), F.col("b") > F.col("a"), "large")
        smaller = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        edges = _star(materialize(smaller, "smaller"), F.lit(True), "small")
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
