"""Queries on frames: georeferences, angles, marks, duplicates."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from orthoweave.functions.geo import in_quad
from orthoweave.operators import frames
from orthoweave.plans.registry import query
from orthoweave.sources.roles import PAIRS, SCENES, TELEMETRY, match_pairs, scenes, table, telemetry

_S = f"WITH {SCENES}"


@query("F13 F14 B92", _S + ", t AS (SELECT entity_id, west, east, (entity_id % 11) / 10.0::DOUBLE AS t FROM scenes) SELECT entity_id, west + t * (east - west) AS plain, west + (t + 0.04::DOUBLE * pow(t * 2 - 1, 2) * CASE WHEN t > 0.5 THEN 1 ELSE -1 END) * (east - west) AS scan FROM t")
def panoramic_corners(spark, sf_dir):
    t, w, e = (F.col("entity_id") % 11) / 10.0, F.col("west"), F.col("east")
    return scenes(spark, sf_dir).select("entity_id", frames.interpolated(w, e, t, False).alias("plain"), frames.interpolated(w, e, t, True).alias("scan"))


@query("F24", _S + " SELECT entity_id, round(sqrt((pow(cos(radians(south)), 2) * pow(6378137.0::DOUBLE, 4) + pow(sin(radians(south)), 2) * pow(6356752.314245::DOUBLE, 4)) / (pow(cos(radians(south)), 2) * pow(6378137.0::DOUBLE, 2) + pow(sin(radians(south)), 2) * pow(6356752.314245::DOUBLE, 2))), 4) AS radius FROM scenes")
def meridional_radius(spark, sf_dir):
    return scenes(spark, sf_dir).select("entity_id", F.round(frames.meridional_radius(F.radians("south")), 4).alias("radius"))


_L = "l AS (SELECT l_orderkey AS g, l_partkey % 361 - 180 AS raw, l_quantity AS length, l_linenumber AS k FROM lineitem), a AS (SELECT *, 90.0::DOUBLE - ((90 - raw) % 180 + 180) % 180 AS angle FROM l)"


def _lines(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("g"), (F.col("l_partkey") % 361 - 180).alias("raw"), F.col("l_quantity").alias("length"), F.col("l_linenumber").alias("k"))
    return rows.withColumn("angle", frames.half_turn(F.col("raw")))


@query("F37", f"WITH {_L} SELECT raw, angle, count(*) AS n FROM a GROUP BY ALL")
def half_turn_angles(spark, sf_dir):
    return _lines(spark, sf_dir).groupBy("raw", "angle").agg(F.count("*").alias("n"))


@query(
    "F38",
    f"""WITH {_L}, m AS (SELECT g, count(*) AS n, sum(length * cos(radians(angle) * 2)) / sum(length) AS mx, sum(length * sin(radians(angle) * 2)) / sum(length) AS my FROM a GROUP BY g),
d AS (SELECT *, degrees(atan2(my, mx)) * 0.5 AS main FROM m), o AS (SELECT a.*, n, mx, my, (angle - main + 90) - 180 * floor((angle - main + 90) / 180) - 90 AS off FROM a JOIN d USING (g)),
s AS (SELECT g, median(off) AS mid FROM o GROUP BY g), t AS (SELECT g, any_value(mid) AS mid, median(abs(off - mid)) AS mad FROM o JOIN s USING (g) GROUP BY g)
SELECT g, count(*) AS kept FROM o JOIN t USING (g) WHERE NOT (mx * mx + my * my >= 1e-6 AND n >= 4) OR abs(off - mid) <= greatest(mad * 1.4826, 1.0) * 1.5 + 1e-9 GROUP BY g""",
)
def dominant_angles(spark, sf_dir):
    return frames.dominant_angle(_lines(spark, sf_dir), by="g", k=1.5).groupBy("g").agg(F.count("*").alias("kept"))


@query("B43 B93 B10 B36 B139", _S + " SELECT entity_id, (east - west) / 4000 AS step_x, -(north - south) / 3000 AS step_y, 50.8 - (east - west) / 4000 * 4000 / 2 AS moved_x, round((50.8 - (east - west) / 4000 * 4000 / 2 - west) * 111000, 3) + 0.0 AS dx_m FROM scenes")
def rough_georeference(spark, sf_dir):
    w, s, e, n = (F.col(c) for c in ("west", "south", "east", "north"))
    g = frames.geotransform(w, s, e, n, F.lit(4000), F.lit(3000))
    moved = frames.moved_to(g["origin_x"], g["step_x"], F.lit(4000), F.lit(50.8))
    return scenes(spark, sf_dir).select("entity_id", g["step_x"].alias("step_x"), g["step_y"].alias("step_y"), moved.alias("moved_x"), (F.round((moved - w) * 111000.0, 3) + 0.0).alias("dx_m"))


@query("B108 O11", "WITH o AS (SELECT p_partkey AS k, p_size * 10 AS w, p_partkey % 37 * 10 AS h, (p_size % 7) / 2.0::DOUBLE AS g, p_size % 5 = 0 AS rev, CASE WHEN p_size % 3 = 0 THEN 180 END AS seen, CASE WHEN p_size % 3 = 0 THEN p_size % 20 END AS conf FROM part), a AS (SELECT *, CASE WHEN h > 0 THEN w::DOUBLE / h ELSE 1 END AS asp FROM o) SELECT k, CASE WHEN conf >= 10 THEN seen WHEN asp < 1 THEN 90 WHEN (asp / nullif(g, 0) > 2 OR asp / nullif(g, 0) < 0.5) AND asp > 1 AND g < 1 THEN 270 WHEN rev THEN 180 ELSE 0 END AS turn FROM a")
def scan_orientation(spark, sf_dir):
    s = F.col("p_size")
    turn = frames.orientation(s * 10, F.col("p_partkey") % 37 * 10, (s % 7) / 2.0, s % 5 == 0, F.when(s % 3 == 0, 180), F.when(s % 3 == 0, s % 20))
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), turn.alias("turn"))


@query("B8", "SELECT DISTINCT p_size, CAST(floor(greatest(56, round_even(p_size * 40 * CASE WHEN p_size * 40 > 800 THEN 800.0::DOUBLE / (p_size * 40) ELSE 1 END, 0)) / 14) * 14 AS INT) AS side FROM part")
def matcher_tile_size(spark, sf_dir):
    side = F.col("p_size") * 40
    return table(spark, sf_dir, "part").select("p_size", frames.matcher_side(side, side).alias("side")).distinct()


@query("B113", "SELECT CAST(r AS INT) AS row, CAST(c AS INT) AS col, c * 10.0::DOUBLE AS x_mm, r * 10.0::DOUBLE AS y_mm FROM range(23) a(r), range(47) b(c)")
def calibration_marks(spark, sf_dir):
    return frames.marks(spark)


@query(
    "J13",
    "WITH d AS (SELECT p_partkey AS id, (p_partkey % 47) * 10 + (p_size % 9) - 4.0::DOUBLE AS x, (p_partkey % 23) * 10 + (p_size % 7) - 3.0::DOUBLE AS y FROM part), g AS (SELECT *, CAST(round_even(x / 10, 0) AS INT) AS col, CAST(round_even(y / 10, 0) AS INT) AS row FROM d), e AS (SELECT *, sqrt(pow(x - col * 10, 2) + pow(y - row * 10, 2)) AS dist FROM g) SELECT row, col, arg_min(id, (dist, id)) AS id, min(dist) AS dist FROM e WHERE dist < 3 AND row BETWEEN 0 AND 22 AND col BETWEEN 0 AND 46 GROUP BY row, col",
)
def marks_nearest_detection(spark, sf_dir):
    k, s = F.col("p_partkey"), F.col("p_size")
    found = table(spark, sf_dir, "part").select(k.alias("id"), ((k % 47) * 10 + (s % 9) - 4.0).alias("x"), ((k % 23) * 10 + (s % 7) - 3.0).alias("y"))
    return frames.nearest_marks(found, spacing=10.0)


@query("J14", f"WITH {PAIRS}, p AS (SELECT scene, id, off_x AS x, ref_y AS y FROM pairs) SELECT scene, id FROM p WHERE NOT EXISTS (SELECT 1 FROM p q WHERE q.scene = p.scene AND q.id < p.id AND q.y BETWEEN p.y - 30 AND p.y + 30 AND pow(p.x - q.x, 2) + pow(p.y - q.y, 2) < 900)")
def near_duplicate_points(spark, sf_dir):
    pts = match_pairs(spark, sf_dir).select("scene", "id", F.col("off_x").alias("x"), F.col("ref_y").alias("y"))
    return frames.drop_near(pts, by="scene", radius=30.0).select("scene", "id")


@query("B164", _S + " SELECT entity_id, west * 2 + south * 3 AS a, west * 4 + south * 5 + 7 AS tx FROM scenes")
def composed_affine(spark, sf_dir):
    lit = [F.lit(v) for v in (2.0, 0.0, 4.0, 3.0, 1.0, 5.0)]
    got = frames.composed([F.col("west"), F.col("south"), F.lit(7.0), F.lit(0.0), F.lit(1.0), F.lit(0.0)], lit)
    return scenes(spark, sf_dir).select("entity_id", got[0].alias("a"), got[2].alias("tx"))


@query("F49", _S + " SELECT entity_id, (west + east) / 2 + (south + north) / 2 < 77.503 AND west >= 50 AND south >= 25 AS inside FROM scenes")
def point_in_ring(spark, sf_dir):
    """Whether a footprint's middle is in the triangle below the diagonal."""
    x, y = (F.col("west") + F.col("east")) / 2, (F.col("south") + F.col("north")) / 2
    ring = [(F.lit(a), F.lit(b)) for a, b in ((50.0, 25.0), (52.503, 25.0), (50.0, 27.503))]
    return scenes(spark, sf_dir).select("entity_id", in_quad(x, y, ring).alias("inside"))


@query("F51", "SELECT vec_id AS tile, round(embedding[1]::DOUBLE * 0.299 + embedding[2]::DOUBLE * 0.587 + embedding[3]::DOUBLE * 0.114, 9) AS pan FROM embeddings")
def luminance(spark, sf_dir):
    e = [F.get("embedding", F.lit(i)).cast("double") for i in range(3)]
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("tile"), F.round(frames.luminance(*e), 9).alias("pan"))


@query("O17", f"WITH {TELEMETRY}, r AS (SELECT scene, seq, row_number() OVER (PARTITION BY scene ORDER BY seq) - 1 AS k, count(*) OVER (PARTITION BY scene) AS n FROM telemetry), a AS (SELECT DISTINCT scene, floor(i * ((n - 1) / 4.0::DOUBLE)) AS k FROM (SELECT DISTINCT scene, n FROM r), range(5) t(i)) SELECT r.scene, r.seq FROM r LEFT JOIN a ON r.scene = a.scene AND r.k = a.k WHERE n <= 5 OR a.k IS NOT NULL")
def thinned_points(spark, sf_dir):
    return frames.thinned(telemetry(spark, sf_dir), by="scene", order=["seq"], most=5).select("scene", "seq")


@query("R28", "WITH m AS (SELECT p_brand, median(p_retailprice) AS target FROM part GROUP BY ALL) SELECT p_partkey, target FROM part JOIN m USING (p_brand) WHERE abs(p_retailprice - target) > target * 0.005")
def resample_to_common_grid(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_retailprice")
    return frames.off_grid(rows, by="p_brand", size="p_retailprice").select("p_partkey", "target")


@query("P32", "SELECT p_partkey, ((p_size % 2 = 0 AND p_size / 100.0 < 0.30) OR p_size / 100.0 < 0.20) AND p_size % 3 <> 0 AND p_size % 5 <> 0 AS again FROM part")
def second_pass(spark, sf_dir):
    s = F.col("p_size")
    return table(spark, sf_dir, "part").select("p_partkey", frames.second_pass(s % 2 == 0, s / 100.0, s % 3 != 0, s % 5 != 0).alias("again"))


@query("K11", f"WITH {TELEMETRY} SELECT scene, CASE WHEN bool_or(stage = 'error') THEN 'incoherent' ELSE arg_max(stage, seq) END AS status FROM telemetry GROUP BY scene")
def mosaic_status(spark, sf_dir):
    rows = telemetry(spark, sf_dir).select("scene", "seq", F.when(F.col("stage") == "error", "incoherent").otherwise(F.col("stage")).alias("status"))
    return frames.sticky_status(rows, by="scene", seq="seq", status="status")


@query("B118 G22", "SELECT vec_id AS tile, round(least(255.0, greatest(0.0, abs(embedding[1])::DOUBLE * 200 / (1 + 0.2 * 0.5 - 0.1 * 0.25))), 6) AS px, round(1 / pow(cos(0.5), 2), 9) AS stretch FROM embeddings")
def vignette_correction(spark, sf_dir):
    px = F.abs(F.get("embedding", F.lit(0)).cast("double")) * 200
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("tile"), F.round(frames.vignette(px, F.lit(0.5), 0.2, -0.1), 6).alias("px"), F.lit(round(1 / math.cos(0.5) ** 2, 9)).alias("stretch"))


@query(
    "A32",
    """WITH v AS (SELECT p_brand AS g, CAST(p_size % 10 AS INT) AS r, CAST(p_partkey % 10 AS INT) AS c, CASE WHEN avg(p_size) % 4 < 3 THEN max(p_retailprice) END AS s FROM part GROUP BY ALL),
m AS (SELECT g, median(s) AS m FROM v GROUP BY g), d AS (SELECT g, any_value(m) AS m, median(abs(s - m)) AS mad FROM v JOIN m USING (g) GROUP BY g),
k AS (SELECT v.*, m, CASE WHEN s IS NOT NULL AND (mad < 1e-6 OR 0.6745 * abs(s - m) / mad < 1.5) THEN s END AS kept FROM v JOIN d USING (g)),
n AS (SELECT a.g, a.r, a.c, avg(b.kept) AS near FROM k a JOIN k b ON a.g = b.g AND abs(a.r - b.r) <= 1 AND abs(a.c - b.c) <= 1 AND (a.r <> b.r OR a.c <> b.c) GROUP BY ALL)
SELECT k.g, k.r, k.c, round(coalesce(kept, near, m), 6) AS filled, CASE WHEN kept IS NOT NULL THEN 'own' WHEN near IS NOT NULL THEN 'neighbours' ELSE 'group' END AS source FROM k LEFT JOIN n USING (g, r, c)""",
)
def local_scale_grid(spark, sf_dir):
    rows = table(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("g"), (F.col("p_size") % 10).cast("int").alias("r"), (F.col("p_partkey") % 10).cast("int").alias("c"))
    cells = rows.agg(F.when(F.avg("p_size") % 4 < 3, F.max("p_retailprice")).alias("s"))
    got = frames.scale_grid(cells, by="g", value="s", most_z=1.5)
    return got.select("g", "r", "c", F.round("filled", 6).alias("filled"), "source")


@query("B3", "SELECT p_partkey, 0.5::DOUBLE * p_size + 0.1::DOUBLE * (p_partkey % 100) + 50 AS x, -0.2::DOUBLE * p_size - 0.5::DOUBLE * (p_partkey % 100) + 26 AS y FROM part")
def pixel_to_world(spark, sf_dir):
    x, y = frames.to_world(F.col("p_size"), F.col("p_partkey") % 100, [F.lit(v) for v in (0.5, 0.1, 50.0, -0.2, -0.5, 26.0)])
    return table(spark, sf_dir, "part").select("p_partkey", x.alias("x"), y.alias("y"))


@query("W11", f"WITH {TELEMETRY} SELECT seq, CASE WHEN scene % 2 = 0 THEN '' ELSE '  ' END || CASE WHEN scene % 2 = 0 THEN 'run' ELSE stage END || printf(' %.1f', seq / 10.0) AS line FROM telemetry")
def profile_waterfall(spark, sf_dir):
    path = F.when(F.col("scene") % 2 == 0, F.lit("run")).otherwise(F.concat(F.lit("run."), F.col("stage")))
    rows = telemetry(spark, sf_dir).select("seq", path.alias("path"), (F.col("seq") / 10.0).alias("v"))
    return frames.waterfall(rows, path="path", seq="seq", value="v")


@query("P30", "SELECT c_custkey AS k, c_custkey % 3 = 0 OR (c_custkey % 3 = 2 AND c_custkey % 2 = 0) AS aft FROM customer")
def aft_camera(spark, sf_dir):
    k = F.col("c_custkey")
    entity = F.when(k % 3 == 0, "DS1104-1057DA024").when(k % 3 == 1, "DS1104-1057DF024").otherwise("D3C1213-200346A003")
    return table(spark, sf_dir, "customer").select(k.alias("k"), frames.is_aft(entity, F.when(k % 2 == 0, "KH-9 Aft")).alias("aft"))


@query("B77 B79", "SELECT p_partkey, p_size * 1.0::DOUBLE AS ref_x, 0.7::DOUBLE AS confidence, CASE WHEN p_size % 2 = 0 THEN 2.5 ELSE 1.0 END::DOUBLE AS prec FROM part WHERE p_size % 5 <> 0")
def pairs_from_arrays(spark, sf_dir):
    s = F.col("p_size")
    values = F.array(*[s * 1.0] * 5)
    values = F.when(s % 5 == 0, F.slice(values, 1, 4)).when(s % 2 == 0, F.concat(values, F.array(F.lit(2.5)))).otherwise(values)
    rows = table(spark, sf_dir, "part").select("p_partkey", frames.pair_from_array(values, F.col("p_brand")).alias("p")).filter("p is not null")
    return rows.select("p_partkey", frames.with_confidence(F.col("p"), F.lit(0.7)).alias("p")).select("p_partkey", "p.ref_x", "p.confidence", "p.prec")


@query("P14", "WITH l AS (SELECT p_partkey AS k, 1950 + p_size AS year, CASE p_partkey % 6 WHEN 0 THEN 'a-ds1104-x' WHEN 1 THEN 'DS1022-y' WHEN 2 THEN 'dzb4036' WHEN 3 THEN 'D3C1213' WHEN 4 THEN 'z-kh9-z' ELSE 'city' END AS slug FROM part) SELECT k, CASE WHEN year >= 1984 THEN 'modern' WHEN slug LIKE '%1104%' THEN 'kh-4b' WHEN slug LIKE '%1022%' THEN 'kh-4a' WHEN slug LIKE 'dzb40%' THEN 'kh-7' WHEN slug LIKE 'D3C%' THEN 'kh-9-pc' WHEN slug LIKE '%kh9%' THEN 'kh-9-mc' ELSE 'unknown' END AS mission FROM l")
def layer_missions(spark, sf_dir):
    from orthoweave.functions.entities import layer_mission

    k = F.col("p_partkey")
    slug = F.when(k % 6 == 0, "a-ds1104-x").when(k % 6 == 1, "DS1022-y").when(k % 6 == 2, "dzb4036").when(k % 6 == 3, "D3C1213").when(k % 6 == 4, "z-kh9-z").otherwise("city")
    return table(spark, sf_dir, "part").select(k.alias("k"), layer_mission(slug, F.col("p_size") + 1950).alias("mission"))


@query("G18", "WITH p AS (SELECT p_brand AS g, p_partkey AS id, (p_partkey % 101) / 101.0::DOUBLE AS x, (p_partkey % 97) / 97.0::DOUBLE AS y, p_size % 3 = 0 AS v, 1.0 + p_size / 100.0::DOUBLE AS prec FROM part), n AS (SELECT a.id, min(sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2))) AS d FROM p a JOIN p b ON a.g = b.g AND a.v AND NOT b.v GROUP BY a.id) SELECT p.id, round(CASE WHEN v THEN least(1, greatest(0, (coalesce(d, 1) - 0.1::DOUBLE) / 0.2::DOUBLE)) * 0.35::DOUBLE + 0.05::DOUBLE ELSE prec END, 9) AS weight FROM p LEFT JOIN n USING (id)")
def point_weights(spark, sf_dir):
    k, s = F.col("p_partkey"), F.col("p_size")
    pts = table(spark, sf_dir, "part").select(F.col("p_brand").alias("g"), k.alias("id"), ((k % 101) / 101.0).alias("x"), ((k % 97) / 97.0).alias("y"), (s % 3 == 0).alias("virtual"), (s / 100.0 + 1.0).alias("prec"))
    return frames.point_weights(pts, by="g").select("id", F.round("weight", 9).alias("weight"))


@query("S32", "WITH b AS (SELECT p_partkey AS id, p_partkey % 40 AS x0, p_partkey % 40 + p_size AS x1, p_partkey % 30 AS y0, p_partkey % 30 + p_size % 9 AS y1 FROM part), t AS (SELECT DISTINCT c_custkey % 91 AS x, c_custkey % 37 AS y FROM customer), a AS (SELECT id, unnest([x0, x1]) AS x, [y0, y1] AS ys FROM b), q AS (SELECT id, x, unnest(ys) AS y FROM a) SELECT id, count(t.x) = count(*) AS covered FROM q LEFT JOIN t ON q.x = t.x AND q.y = t.y GROUP BY id")
def tile_coverage(spark, sf_dir):
    k, s = F.col("p_partkey"), F.col("p_size")
    boxes = table(spark, sf_dir, "part").select(k.alias("id"), (k % 40).alias("x_min"), (k % 40 + s).alias("x_max"), (k % 30).alias("y_min"), (k % 30 + s % 9).alias("y_max"))
    there = table(spark, sf_dir, "customer").select((F.col("c_custkey") % 91).alias("x"), (F.col("c_custkey") % 37).alias("y"))
    return frames.covered_by_tiles(boxes, there)


@query("F46", "SELECT p_brand AS g, greatest(0.0, min(p_size * 1000 - 5000))::DOUBLE AS west, greatest(0.0, min(p_size * 500 - 5000))::DOUBLE AS south, least(60000.0, max(p_size * 1000 + 2000 + 5000))::DOUBLE AS east, least(20000.0, max(p_size * 500 + 3000 + 5000))::DOUBLE AS north FROM part GROUP BY p_brand")
def search_bounds(spark, sf_dir):
    s = F.col("p_size")
    rows = table(spark, sf_dir, "part").select(F.col("p_brand").alias("g"), (s * 1000.0).alias("west"), (s * 500.0).alias("south"), (s * 1000.0 + 2000).alias("east"), (s * 500.0 + 3000).alias("north"))
    return frames.search_bounds(rows, (0.0, 0.0, 60000.0, 20000.0), by="g")
