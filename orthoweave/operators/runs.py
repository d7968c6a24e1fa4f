"""Operators on run histories and QA reports: best versions, deltas, status tables, rollups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def best_version(rows: DataFrame, *, by: str, version: str, field: str, lower: bool = True) -> DataFrame:
    """by and the version of the best value, the first of equals; unknown values don't take part."""
    pick = F.min_by(version, F.struct(field, version)) if lower else F.min_by(version, F.struct((-F.col(field)).alias("v"), F.col(version)))
    return rows.filter(F.col(field).isNotNull()).groupBy(by).agg(pick.alias("best"))


def deltas(rows: DataFrame, *, by: str, version: str, field: str) -> DataFrame:
    """rows with delta to the version before and to the group's first."""
    order = W.partitionBy(by).orderBy(version)
    return rows.withColumn("delta", F.col(field) - F.lag(field).over(order)).withColumn("delta_first", F.col(field) - F.first(field).over(order.rowsBetween(W.unboundedPreceding, 0)))


def latest(rows: DataFrame, *, by: list[str], seq: str, value: list[str]) -> DataFrame:
    """The last value of each key."""
    return rows.groupBy(*by).agg(*[F.max_by(v, seq).alias(v) for v in value])


def status_rollup(rows: DataFrame, *, stage: str, status: str) -> DataFrame:
    """stage, status, n: counts for each, for each stage and for all; 'all' stands for what is summed over."""
    got = rows.rollup(stage, status).agg(F.count("*").alias("n"), F.grouping(stage).alias("gs"), F.grouping(status).alias("gt"))
    return got.select(F.when(F.col("gs") == 1, "all").otherwise(F.col(stage)).alias("stage"), F.when(F.col("gt") == 1, "all").otherwise(F.col(status).cast("string")).alias("status"), "n")


def section_rollup(rows: DataFrame, *, path: str, value: str) -> DataFrame:
    """section, total, n: each dotted path's value added to itself and to every section that it is in."""
    parts = F.split(path, r"\.")
    up = rows.select(F.explode(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "."))).alias("section"), F.col(value).alias("v"))
    return up.groupBy("section").agg(F.sum("v").alias("total"), F.count("*").alias("n"))


def output_accepted(reports: DataFrame, *, by: str, selected: str) -> DataFrame:
    """by, accepted: the selected candidate's flag, else whether any is accepted."""
    mine = F.max(F.when(F.col("candidate") == F.col(selected), F.col("accepted")))
    return reports.groupBy(by).agg(F.coalesce(mine, F.bool_or("accepted")).alias("accepted"))


def mosaic_groups(scenes: DataFrame, qa: DataFrame, *, by: list[str]) -> DataFrame:
    """by, members, n: scenes with an accepted report, by group."""
    ok = qa.groupBy("entity_id").agg(F.bool_or("accepted").alias("ok")).filter("ok")
    return scenes.join(ok, "entity_id", "left_semi").groupBy(*by).agg(F.array_sort(F.collect_list("entity_id")).alias("members"), F.count("*").alias("n"))


def retained(runs: DataFrame, *, by: str, version: str, score: str, last: int = 3) -> DataFrame:
    """Runs to keep: the last few of each scene, and its best."""
    newest = F.row_number().over(W.partitionBy(by).orderBy(F.desc(version)))
    best = F.row_number().over(W.partitionBy(by).orderBy(F.col(score).asc_nulls_last(), version))
    return runs.withColumn("newest", newest).withColumn("rank", best).filter((F.col("newest") <= last) | (F.col("rank") == 1)).drop("newest", "rank")


def preferred(**sources: Column) -> Column:
    """source and path of the first that is there, in the order given."""
    return F.coalesce(*[F.when(v.isNotNull(), F.struct(F.lit(k).alias("source"), v.alias("path"))) for k, v in sources.items()])


def interleaved(rows: DataFrame, *, bucket: str, order: str) -> DataFrame:
    """rows with turn: round after round one of each bucket, buckets by the place of their first row."""
    inner = W.partitionBy(bucket).orderBy(order)
    got = rows.withColumn("round", F.row_number().over(inner)).withColumn("first", F.min(order).over(W.partitionBy(bucket)))
    return got.withColumn("turn", F.struct("round", "first"))


def sampling_weights(rows: DataFrame, *, source: str) -> DataFrame:
    """rows with weight: the inverse of its source's size, of mean 1."""
    n = rows.groupBy(source).agg(F.count("*").alias("n"))
    total = n.agg(F.sum("n").alias("all"), F.count("*").alias("k"))
    weights = n.crossJoin(F.broadcast(total)).select(F.col(source).alias("s"), (F.col("all") / F.col("k") / F.col("n")).alias("weight"))
    return rows.join(weights, rows[source].eqNullSafe(weights["s"])).drop("s")


def layer_pairs(layers: DataFrame) -> DataFrame:
    """older, newer: each older layer with each modern one, and two older ones of different layers, by year then name."""
    a = layers.select(F.col("slug").alias("a"), F.col("year").alias("ya"), F.col("kind").alias("ka"))
    b = layers.select(F.col("slug").alias("b"), F.col("year").alias("yb"), F.col("kind").alias("kb"))
    first = (F.col("ya") < F.col("yb")) | ((F.col("ya") == F.col("yb")) & (F.col("a") < F.col("b")))
    both = (F.col("ka") == "kh") & (F.col("kb") == "kh") & first
    # The catalogue of layers is a short fixed list.
    return a.join(F.broadcast(b), ((F.col("ka") == "kh") & (F.col("kb") == "modern")) | both).select(F.col("a").alias("older"), F.col("b").alias("newer"))
