"""Queries along strips."""

from __future__ import annotations

from pyspark.sql import functions as F

from orthoweave.operators import strips
from orthoweave.plans.registry import query
from orthoweave.sources.roles import SCENES, scenes, table

_F = f"WITH {SCENES}, f AS (SELECT mission, designation, frame, min(entity_id) AS entity_id, max(available) AS done, min(west) AS west, min(south) AS south, max(east) AS east, max(north) AS north, avg(west) AS cx, avg(south) AS cy FROM scenes GROUP BY ALL)"
BY = ["mission", "designation"]


def _frames(spark, sf_dir):
    """One row a mission, camera and frame."""
    rows = scenes(spark, sf_dir).groupBy(*BY, "frame")
    return rows.agg(F.min("entity_id").alias("entity_id"), F.max("available").alias("done"), F.min("west").alias("west"), F.min("south").alias("south"), F.max("east").alias("east"), F.max("north").alias("north"), F.avg("west").alias("cx"), F.avg("south").alias("cy"))


@query(
    "J10",
    _F + ", b AS (SELECT *, max(CASE WHEN done THEN frame END) OVER (PARTITION BY mission, designation ORDER BY frame ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS lo, min(CASE WHEN done THEN frame END) OVER (PARTITION BY mission, designation ORDER BY frame ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS hi FROM f) SELECT entity_id, CASE WHEN hi IS NOT NULL THEN lo END AS lower, CASE WHEN lo IS NOT NULL THEN hi END AS upper, CASE WHEN lo IS NOT NULL AND hi IS NOT NULL THEN round((frame - lo)::DOUBLE / greatest(1, hi - lo), 9) END AS alpha FROM b",
)
def bracketing_neighbours(spark, sf_dir):
    got = strips.bracketing(_frames(spark, sf_dir), by=BY, done="done")
    return got.select("entity_id", "lower", "upper", F.round("alpha", 9).alias("alpha"))


@query(
    "J11",
    _F + """, p AS (SELECT a.mission, a.designation, a.frame, b.frame AS bf, b.cx, b.cy, row_number() OVER (PARTITION BY a.mission, a.designation, a.frame ORDER BY abs(a.frame - b.frame), b.frame) AS k FROM f a JOIN f b ON a.mission = b.mission AND a.designation = b.designation AND a.frame <> b.frame AND b.done),
x AS (SELECT mission, designation, frame, max(bf) FILTER (k = 1) AS f1, max(bf) FILTER (k = 2) AS f2, max(cx) FILTER (k = 1) AS x1, max(cx) FILTER (k = 2) AS x2, max(cy) FILTER (k = 1) AS y1, max(cy) FILTER (k = 2) AS y2 FROM p WHERE k <= 2 GROUP BY ALL)
SELECT entity_id, round(CASE WHEN f2 IS NULL THEN x1 ELSE x1 + (x2 - x1) / (f2 - f1) * (f.frame - f1) END, 6) AS x, round(CASE WHEN f2 IS NULL THEN y1 ELSE y1 + (y2 - y1) / (f2 - f1) * (f.frame - f1) END, 6) AS y FROM f LEFT JOIN x USING (mission, designation, frame)""",
)
def centre_extrapolation(spark, sf_dir):
    got = strips.extrapolated_centre(_frames(spark, sf_dir), by=BY, done="done")
    return got.select("entity_id", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


_W = "OVER (PARTITION BY mission, designation ORDER BY frame, entity_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"


@query("W1", _F + f" SELECT entity_id, least(50.4, min(CASE WHEN done THEN west - 0.18 END) {_W}) AS grown_west, least(25.4, min(CASE WHEN done THEN south - 0.18 END) {_W}) AS grown_south, greatest(51.2, max(CASE WHEN done THEN east + 0.18 END) {_W}) AS grown_east, greatest(26.2, max(CASE WHEN done THEN north + 0.18 END) {_W}) AS grown_north FROM f")
def grown_reference_window(spark, sf_dir):
    jobs = _frames(spark, sf_dir)
    for name, v in (("west", 50.4), ("south", 25.4), ("east", 51.2), ("north", 26.2)):
        jobs = jobs.withColumn("win_" + name, F.lit(v))
    return strips.grown_window(jobs, by=BY, done="done").select("entity_id", "grown_west", "grown_south", "grown_east", "grown_north")


@query("W2", _F + f" SELECT entity_id, array_to_string(list_reverse(coalesce(list(entity_id) FILTER (WHERE done) {_W}, []))[1:2], ',') AS refs FROM f")
def secondary_references(spark, sf_dir):
    return strips.secondary_references(_frames(spark, sf_dir), by=BY, done="done").select("entity_id", F.array_join(F.col("refs").cast("array<string>"), ",").alias("refs"))


_M = "m AS (SELECT l_orderkey AS strip, l_linenumber AS i, l_linenumber % 7 + 1 AS j, max(CAST(l_quantity AS BIGINT)) AS overlap FROM lineitem GROUP BY ALL), r AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY strip, i ORDER BY overlap DESC, j) AS k FROM m) WHERE k = 1)"


def _matches(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("strip"), F.col("l_linenumber").alias("i"), (F.col("l_linenumber") % 7 + 1).alias("j"), F.col("l_quantity").cast("long").alias("overlap"))
    return rows.groupBy("strip", "i", "j").agg(F.max("overlap").alias("overlap"))


@query("O7", f"WITH {_M} SELECT strip, i, j, overlap FROM (SELECT *, row_number() OVER (PARTITION BY strip, j ORDER BY overlap DESC, i) AS c FROM r) WHERE c = 1")
def right_neighbour_graph(spark, sf_dir):
    return strips.right_neighbours(_matches(spark, sf_dir), by="strip")


@query(
    "O8 O9",
    f"""WITH RECURSIVE {_M}, a AS (SELECT strip, i FROM m UNION SELECT strip, j FROM m), k AS (SELECT strip, arg_min(i, (-overlap, i)) AS i FROM r GROUP BY strip),
f AS (SELECT strip, min(i) AS i FROM a WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.strip = a.strip AND r.j = a.i) GROUP BY strip),
c AS (SELECT strip, coalesce(f.i, k.i) AS i, CAST(0 AS BIGINT) AS overlap, 0 AS seq, [coalesce(f.i, k.i)] AS path FROM f FULL JOIN k USING (strip)
 UNION ALL SELECT c.strip, r.j, r.overlap, c.seq + 1, list_append(c.path, r.j) FROM c JOIN r ON r.strip = c.strip AND r.i = c.i WHERE NOT list_contains(c.path, r.j))
SELECT strip, i, overlap, seq FROM c UNION ALL
SELECT a.strip, a.i, CAST(0 AS BIGINT), CAST((SELECT count(*) FROM c WHERE c.strip = a.strip) + row_number() OVER (PARTITION BY a.strip ORDER BY a.i) - 1 AS INTEGER) FROM a WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.strip = a.strip AND c.i = a.i)""",
)
def frame_chain(spark, sf_dir):
    """Every frame that a match names, along the chain from the leftmost, then disconnected ones; cycles are cut."""
    matches = _matches(spark, sf_dir)
    frames = matches.select("strip", "i").unionByName(matches.select("strip", F.col("j").alias("i")))
    return strips.frame_order(frames, strips.right_neighbours(matches, by="strip"), by="strip")


@query("B123", "WITH l AS (SELECT l_orderkey AS strip, l_linenumber AS seq, max(CAST(l_quantity AS BIGINT)) AS q FROM lineitem GROUP BY ALL) SELECT strip, seq, CAST(coalesce(sum(1000 + q - q * 3) OVER (PARTITION BY strip ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS x FROM l")
def canvas_offsets(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("strip"), F.col("l_linenumber").alias("seq")).agg(F.max(F.col("l_quantity").cast("long")).alias("q"))
    return strips.offsets(rows.select("strip", "seq", (F.col("q") + 1000).alias("width"), (F.col("q") * 3).alias("overlap")), by="strip").select("strip", "seq", "x")


@query("A25", "WITH l AS (SELECT l_orderkey AS strip, l_linenumber AS seq, max(CASE WHEN l_returnflag <> 'R' THEN l_quantity - 25.0 END) AS dx FROM lineitem GROUP BY ALL), r AS (SELECT *, sum(coalesce(dx, 0)) OVER (PARTITION BY strip ORDER BY seq) AS run, count(*) OVER (PARTITION BY strip) AS n, row_number() OVER (PARTITION BY strip ORDER BY seq) - 1 AS k FROM l) SELECT strip, seq, run - max(run) FILTER (WHERE k = n // 2) OVER (PARTITION BY strip) AS total FROM r")
def chained_corrections(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("strip"), F.col("l_linenumber").alias("seq")).agg(F.max(F.when(F.col("l_returnflag") != "R", F.col("l_quantity") - 25.0)).alias("dx"))
    return strips.chained_shifts(rows, by="strip").select("strip", "seq", "total")


@query("W10", "WITH e AS (SELECT user_id, event_id, CASE WHEN event_id - lag(event_id) OVER (PARTITION BY user_id ORDER BY event_id) > 200 THEN 1 ELSE 0 END AS nw FROM events), i AS (SELECT *, sum(nw) OVER (PARTITION BY user_id ORDER BY event_id) AS island FROM e) SELECT user_id, CAST(island AS BIGINT) AS island, count(*) AS n, median(event_id) AS median FROM i GROUP BY ALL")
def seam_clusters(spark, sf_dir):
    return strips.islands(table(spark, sf_dir, "events").select("user_id", "event_id"), by="user_id", at="event_id", gap=200)


@query("O10 B121", "WITH f AS (SELECT p_partkey AS k, p_size AS ab, p_partkey % 50 AS ba, p_size % 7 AS oab, p_partkey % 9 AS oba FROM part) SELECT k, CASE WHEN ba > ab * 1.2 AND ba >= 10 THEN true WHEN ab >= ba * 1.2 AND ab >= 10 THEN false ELSE oba > oab AND oba > 0 END AS swap FROM f")
def two_frame_order(spark, sf_dir):
    k, s = F.col("p_partkey"), F.col("p_size")
    return table(spark, sf_dir, "part").select(k.alias("k"), strips.two_frame_order(s, k % 50, s % 7, k % 9).alias("swap"))


@query("B122", f"WITH {_M}, w AS (SELECT strip, coalesce(sum(overlap) FILTER (j - i = 1), 0)::BIGINT AS forward, coalesce(sum(overlap) FILTER (j - i = -1), 0)::BIGINT AS backward FROM (SELECT l_orderkey AS strip, l_linenumber AS i, l_suppkey % 7 + 1 AS j, max(CAST(l_quantity AS BIGINT)) AS overlap FROM lineitem GROUP BY ALL) GROUP BY strip) SELECT *, backward > forward * 1.05 AS reverse FROM w")
def reversed_strips(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("strip"), F.col("l_linenumber").alias("i"), (F.col("l_suppkey") % 7 + 1).alias("j")).agg(F.max(F.col("l_quantity").cast("long")).alias("overlap"))
    return strips.reversed_strips(rows, by="strip")


@query("J9", _F + " SELECT entity_id, count(*) FILTER (done) OVER (PARTITION BY mission, designation) - CAST(done AS BIGINT) AS siblings FROM f")
def validated_siblings(spark, sf_dir):
    return strips.validated_siblings(_frames(spark, sf_dir), by=BY, done="done")
