"""Test tables in the roles of the engine's records: match pairs, scenes, telemetry and tile pixels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def match_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, scene, is_anchor, ref_x, ref_y, off_x, off_y (metres), confidence, prec."""
    part, supp = F.col("l_partkey"), F.col("l_suppkey")
    return table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")], F.col("l_quantity").cast("int").cast("string")).alias("id"),
        F.concat("l_returnflag", "l_linestatus").alias("scene"),
        (part % 50 == 0).alias("is_anchor"),
        (part * 10).cast("double").alias("ref_x"),
        (supp * 200).cast("double").alias("ref_y"),
        (part * 10 + F.col("l_quantity")).alias("off_x"),
        (supp * 200 - F.col("l_tax") * 100).alias("off_y"),
        (F.col("l_discount") * 10).alias("confidence"),
        (1.0 + F.col("l_tax")).alias("prec"),
    )


PAIRS = """pairs AS (SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS INT)) AS id,
 concat(l_returnflag, l_linestatus) AS scene, (l_partkey % 50) = 0 AS is_anchor, CAST(l_partkey*10 AS DOUBLE) AS ref_x,
 CAST(l_suppkey*200 AS DOUBLE) AS ref_y, l_partkey*10 + l_quantity AS off_x, l_suppkey*200 - l_tax*100 AS off_y,
 l_discount*10 AS confidence, 1.0 + l_tax AS prec FROM lineitem)"""


def scenes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """entity_id, mission, acq_date, frame, designation, available and the footprint's west, south, east, north."""
    orders, customer, nation = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    key = F.col("o_orderkey")
    rows = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    west, south = 50.0 + (key % 97) * 0.02, 25.0 + (key % 89) * 0.02
    return rows.select(
        key.alias("entity_id"),
        F.col("n_nationkey").alias("mission"),
        F.col("o_orderdate").cast("date").alias("acq_date"),
        (key % 1000).alias("frame"),
        F.when(F.col("o_orderstatus") == "F", "A").otherwise("F").alias("designation"),
        (F.col("o_orderpriority") != "5-LOW").alias("available"),
        west.alias("west"),
        south.alias("south"),
        (50.3 + (key % 97) * 0.02 + (key % 7) * 0.1).alias("east"),
        (25.3 + (key % 89) * 0.02 + (key % 5) * 0.1).alias("north"),
    )


SCENES = """scenes AS (SELECT o_orderkey AS entity_id, n_nationkey AS mission, CAST(o_orderdate AS DATE) AS acq_date, o_orderkey % 1000 AS frame,
 CASE WHEN o_orderstatus = 'F' THEN 'A' ELSE 'F' END AS designation, o_orderpriority <> '5-LOW' AS available,
 50.0::DOUBLE + (o_orderkey % 97)*0.02::DOUBLE AS west, 25.0::DOUBLE + (o_orderkey % 89)*0.02::DOUBLE AS south,
 50.3::DOUBLE + (o_orderkey % 97)*0.02::DOUBLE + (o_orderkey % 7)*0.1::DOUBLE AS east,
 25.3::DOUBLE + (o_orderkey % 89)*0.02::DOUBLE + (o_orderkey % 5)*0.1::DOUBLE AS north
 FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """seq, ts, scene, stage, residual_m, accepted."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("seq"), F.col("ts").cast("timestamp").alias("ts"), F.col("user_id").alias("scene"), F.col("event_type").alias("stage"), F.col("value").alias("residual_m"), (F.col("event_type") != "error").alias("accepted"), "props"
    )


TELEMETRY = """telemetry AS (SELECT event_id AS seq, ts, user_id AS scene, event_type AS stage, value AS residual_m, event_type <> 'error' AS accepted, props FROM events)"""


def pixels(spark: SparkSession, sf_dir: str, width: int = 8) -> DataFrame:
    """tile, strip, r, c, px: a row for each pixel of a tile."""
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("tile"), F.col("label").alias("strip"), F.posexplode("embedding").alias("pos", "v"))
    return rows.select("tile", "strip", F.floor(F.col("pos") / width).cast("int").alias("r"), (F.col("pos") % width).alias("c"), F.col("v").cast("double").alias("px"))


PIXELS = """pixels AS (SELECT tile, strip, CAST(pos // 8 AS INT) AS r, CAST(pos % 8 AS INT) AS c, CAST(v AS DOUBLE) AS px FROM
 (SELECT vec_id AS tile, label AS strip, unnest(embedding) AS v, generate_subscripts(embedding, 1) - 1 AS pos FROM embeddings))"""
