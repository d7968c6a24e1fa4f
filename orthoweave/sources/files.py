"""Listings of image folders, run histories and anchors; sinks for reports, status and stage tables."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Version of a stage table's layout; a newer one can't be read.
STAGE_VERSION = 1


def listing(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """path, name, modified, bytes: files below a folder; their content isn't read."""
    rows = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(folder)
    return rows.select("path", F.regexp_extract("path", r"([^/]*)$", 1).alias("name"), F.col("modificationTime").alias("modified"), F.col("length").alias("bytes"))


def frames(spark: SparkSession, folder: str) -> DataFrame:
    """entity_id and its frames' paths in order of their letters, from files called <entity>_<letter>.tif."""
    form = r"^(.+)_([a-z])\.tif$"
    rows = listing(spark, folder, "*.tif").filter(F.col("name").rlike(form))
    one = F.struct(F.regexp_extract("name", form, 2).alias("letter"), "path")
    return rows.groupBy(F.regexp_extract("name", form, 1).alias("entity_id")).agg(F.transform(F.array_sort(F.collect_list(one)), lambda x: x["path"]).alias("frames"))


def gzipped(spark: SparkSession, folder: str) -> DataFrame:
    """path, gzip: whether a file begins with the marks of gzip."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return rows.select("path", (F.substring("content", 1, 2) == F.lit(b"\x1f\x8b")).alias("gzip"))


def anchors(spark: SparkSession, path: str) -> DataFrame:
    """name, lon, lat, feature_type, confidence, patch_size_m from an anchor file, its own form or GeoJSON."""
    own = "struct<name string, lon double, lat double, feature_type string, confidence double, patch_size_m double>"
    feature = "struct<properties struct<name string, feature_type string, confidence double, patch_size_m double>, geometry struct<coordinates array<double>>>"
    text = spark.read.text(path, wholetext=True)
    doc = text.select(F.from_json("value", f"struct<gcps array<{own}>, features array<{feature}>>").alias("d"))
    of = F.transform("d.features", lambda f: F.struct(f["properties"]["name"].alias("name"), f["geometry"]["coordinates"][0].alias("lon"), f["geometry"]["coordinates"][1].alias("lat"), f["properties"]["feature_type"].alias("feature_type"), f["properties"]["confidence"].alias("confidence"), f["properties"]["patch_size_m"].alias("patch_size_m")))
    return doc.select(F.inline(F.coalesce("d.gcps", of)))


def run_reports(spark: SparkSession, folder: str) -> DataFrame:
    """version, candidate, accepted, total_score, confidence of all run_v<n>/qa.json files."""
    report = "struct<candidate string, accepted boolean, total_score double, confidence double>"
    rows = spark.read.text(f"{folder}/run_v*/qa.json", wholetext=True).select("value", F.col("_metadata.file_path").alias("path"))
    got = rows.select(F.regexp_extract("path", r"run_v(\d+)", 1).cast("int").alias("version"), F.from_json("value", f"struct<selected_candidate string, reports array<{report}>>").alias("q"))
    return got.select("version", F.col("q.selected_candidate").alias("selected"), F.inline("q.reports"))


def write_reports(reports: DataFrame, path: str, *, by: str) -> None:
    """A JSON document a group: its reports, each with its keys in order."""
    fields = sorted(c for c in reports.columns if c != by)
    reports.groupBy(by).agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("reports")).write.mode("overwrite").json(path)


def save_stage(df: DataFrame, folder: str, stage: str) -> None:
    """A stage's rows and the version of their layout, so that a later run can go on from them."""
    df.write.mode("overwrite").parquet(f"{folder}/{stage}/rows")
    spark = df.sparkSession
    spark.createDataFrame([(json.dumps({"version": STAGE_VERSION, "columns": df.columns}),)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/{stage}/layout")


def load_stage(spark: SparkSession, folder: str, stage: str) -> DataFrame:
    layout = json.loads(spark.read.text(f"{folder}/{stage}/layout").first()[0])
    if layout["version"] > STAGE_VERSION:
        raise ValueError(f"{stage} was written by a newer version ({layout['version']})")
    return spark.read.parquet(f"{folder}/{stage}/rows").select(*layout["columns"])


def append_status(df: DataFrame, path: str) -> None:
    """Status rows are only ever added; readers take the last of each key."""
    df.write.mode("append").parquet(path)
