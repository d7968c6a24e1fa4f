"""Queries on scene catalogues, geographic functions and names."""

from __future__ import annotations

from pyspark.sql import functions as F

from orthoweave.functions import entities, geo
from orthoweave.operators import iterative, scenes
from orthoweave.plans.registry import query
from orthoweave.sources.roles import SCENES, table
from orthoweave.sources.roles import scenes as scene_table

BOX = (50.4, 25.4, 51.2, 26.2)
_S = f"WITH {SCENES}"
_IDS = """ids AS (SELECT c_custkey AS k, CASE c_custkey % 5 WHEN 0 THEN 'DS' || (1001 + c_custkey % 199) || '-' || (1000 + c_custkey % 9) || 'DA' || lpad(CAST(c_custkey % 1000 AS VARCHAR), 3, '0')
 WHEN 1 THEN 'D3C' || (1201 + c_custkey % 30) || '-200346A' || lpad(CAST(c_custkey % 1000 AS VARCHAR), 3, '0') WHEN 2 THEN 'DZB00' || (4001 + c_custkey % 120) || '00H' || lpad(CAST(c_custkey % 1000 AS VARCHAR), 3, '0')
 WHEN 3 THEN 'DZB' || (1201 + c_custkey % 25) || '-500123L001001' ELSE 'X' || c_custkey END AS eid, CASE c_custkey % 4 WHEN 0 THEN 'Aft' WHEN 1 THEN ' Forward ' WHEN 2 THEN 'vertical' ELSE '' END AS kind FROM customer)"""


def _ids(spark, sf_dir):
    """Scene ids of every form, made from customers' keys."""
    k = F.col("c_custkey")
    frame = F.lpad((k % 1000).cast("string"), 3, "0")
    eid = (
        F.when(k % 5 == 0, F.concat(F.lit("DS"), 1001 + k % 199, F.lit("-"), 1000 + k % 9, F.lit("DA"), frame))
        .when(k % 5 == 1, F.concat(F.lit("D3C"), 1201 + k % 30, F.lit("-200346A"), frame))
        .when(k % 5 == 2, F.concat(F.lit("DZB00"), 4001 + k % 120, F.lit("00H"), frame))
        .when(k % 5 == 3, F.concat(F.lit("DZB"), 1201 + k % 25, F.lit("-500123L001001")))
        .otherwise(F.concat(F.lit("X"), k))
    )
    kind = F.when(k % 4 == 0, "Aft").when(k % 4 == 1, " Forward ").when(k % 4 == 2, "vertical").otherwise("")
    return table(spark, sf_dir, "customer").select(k.alias("k"), eid.alias("eid"), kind.alias("kind"))


@query("P1", _S + " SELECT entity_id, designation FROM scenes WHERE available AND designation IN ('A')")
def scene_filter(spark, sf_dir):
    return scenes.filter_scenes(scene_table(spark, sf_dir), designations=["A"]).select("entity_id", "designation")


@query("A1 A2 A3", _S + " SELECT mission, acq_date, designation, count(*) AS n, string_agg(CAST(frame AS VARCHAR), ',' ORDER BY frame, entity_id) AS frames, arg_min(entity_id, (frame, entity_id)) AS first_scene, min(west) AS west, min(south) AS south, max(east) AS east, max(north) AS north FROM scenes GROUP BY ALL")
def strip_groups(spark, sf_dir):
    got = scenes.strips(scene_table(spark, sf_dir))
    return got.withColumn("frames", F.array_join(F.col("frames").cast("array<string>"), ","))


@query("A2 B138", _S + " SELECT entity_id, min(lon) AS west, min(lat) AS south, max(lon) AS east, max(lat) AS north FROM (SELECT entity_id, unnest([west, east, east, west]) AS lon, unnest([north, north, south, south]) AS lat FROM scenes) GROUP BY entity_id")
def corner_box(spark, sf_dir):
    return scenes.corners(scene_table(spark, sf_dir)).groupBy("entity_id").agg(F.min("lon").alias("west"), F.min("lat").alias("south"), F.max("lon").alias("east"), F.max("lat").alias("north"))


@query("A4", _S + ", p AS (SELECT entity_id, mission, west, south, east, north, CASE WHEN frame % 10 < 9 THEN 32639 ELSE 4326 END AS crs FROM scenes) SELECT mission, CASE WHEN count(DISTINCT crs) = 1 THEN min(west) END AS west, CASE WHEN count(DISTINCT crs) = 1 THEN max(east) END AS east, count(DISTINCT crs) AS n_crs FROM p GROUP BY mission")
def prior_bounds_union(spark, sf_dir):
    rows = scene_table(spark, sf_dir).withColumn("crs", F.when(F.col("frame") % 10 < 9, 32639).otherwise(4326))
    one = F.count_distinct("crs") == 1
    return rows.groupBy("mission").agg(F.when(one, F.min("west")).alias("west"), F.when(one, F.max("east")).alias("east"), F.count_distinct("crs").alias("n_crs"))


@query("J1 J3", _S + ", a AS (SELECT * FROM scenes WHERE designation = 'A'), b AS (SELECT * FROM scenes WHERE designation = 'F'), o AS (SELECT a.entity_id AS left_id, b.entity_id AS right_id, (least(a.east, b.east) - greatest(a.west, b.west)) * (least(a.north, b.north) - greatest(a.south, b.south)) / ((b.east - b.west) * (b.north - b.south)) AS fraction FROM a JOIN b ON a.west < b.east AND b.west < a.east AND a.south < b.north AND b.south < a.north) SELECT right_id, count(*) AS n, max(fraction) AS best, min(left_id) FILTER (WHERE round(fraction, 9) >= 1) AS first_whole FROM o GROUP BY right_id")
def footprint_overlap(spark, sf_dir):
    """Every reference scene (designation A) against every offset scene (F), over the whole table; summed up per offset scene,
    as the overlapping pairs grow with the square of the scenes; the operator sums them up before they meet."""
    rows = scene_table(spark, sf_dir)
    return scenes.overlap_summary(rows.filter("designation = 'A'"), rows.filter("designation = 'F'"))


_GRID = """g AS (SELECT i AS cell, 50.4::DOUBLE + (i % 50) * ((51.2::DOUBLE - 50.4::DOUBLE) / 50) + (51.2::DOUBLE - 50.4::DOUBLE) / 100 AS x, 25.4::DOUBLE + (i // 50) * ((26.2::DOUBLE - 25.4::DOUBLE) / 50) + (26.2::DOUBLE - 25.4::DOUBLE) / 100 AS y FROM range(2500) t(i)),
near AS (SELECT * FROM scenes WHERE east > 50.4 AND west < 51.2 AND north > 25.4 AND south < 26.2),
cov AS (SELECT mission, designation, count(DISTINCT cell) / 2500.0::DOUBLE AS coverage FROM near LEFT JOIN g ON x < east AND x >= west AND y < north AND y >= south GROUP BY ALL),
groups AS (SELECT mission, designation, n_scenes, coverage FROM cov JOIN (SELECT mission, designation, count(*) AS n_scenes FROM near GROUP BY ALL) USING (mission, designation))"""


@query("A5 F48", _S + ", " + _GRID + " SELECT * FROM groups")
def group_coverage(spark, sf_dir):
    return scenes.coverage(scene_table(spark, sf_dir), BOX, by=["mission", "designation"])


@query("A6")
def mission_coverage_selection(spark, sf_dir):
    rows = scenes.filter_scenes(scene_table(spark, sf_dir))
    return iterative.best_coverage(rows, BOX, by=["mission", "designation"]).select("mission", "designation", "entity_id", "frame", "gain", "coverage")


@query("W6", "WITH t AS (SELECT p_partkey AS entity_id, p_brand AS tile, CASE WHEN p_size % 5 <> 0 THEN p_size * 1.5 END AS cloud FROM part) SELECT tile, arg_min(entity_id, (coalesce(cloud, 99.0), entity_id)) AS entity_id FROM t GROUP BY tile")
def best_per_tile(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("entity_id"), F.col("p_brand").alias("tile"), F.when(F.col("p_size") % 5 != 0, F.col("p_size") * 1.5).alias("cloud"))
    return scenes.best_per_tile(rows, tile="tile", score="cloud").select("tile", "entity_id")


@query("K13 S27", _S + ", o AS (SELECT entity_id, west, south, east, north, greatest(0, least(east, 51.2) - greatest(west, 50.4)) * greatest(0, least(north, 26.2) - greatest(south, 25.4)) / ((east - west) * (north - south)) AS overlap FROM scenes WHERE available) SELECT entity_id, round(overlap, 9) AS overlap FROM o WHERE overlap >= 0.01")
def alignment_manifest(spark, sf_dir):
    rows = scene_table(spark, sf_dir)
    got = scenes.manifest(rows, BOX, done=rows.filter(~F.col("available")))
    return got.select("entity_id", F.round("overlap", 9).alias("overlap"))


@query("F1", _S + " SELECT entity_id, round(2 * 6371.0088 * asin(least(1, sqrt(pow(sin((radians(26.0) - radians(south)) / 2), 2) + cos(radians(south)) * cos(radians(26.0)) * pow(sin(radians(50.5 - west) / 2), 2)))), 6) AS km FROM scenes")
def great_circle(spark, sf_dir):
    return scene_table(spark, sf_dir).select("entity_id", F.round(geo.great_circle_km(F.col("south"), F.col("west"), F.lit(26.0), F.lit(50.5)), 6).alias("km"))


@query("F2 F6", _S + " SELECT entity_id, CAST(trunc((west + 180.0) / 360.0 * 16384.0) AS BIGINT) AS x_min, CAST(trunc((1 - ln(tan(radians(north)) + 1 / cos(radians(north))) / pi()) / 2 * 16384.0) AS BIGINT) AS y_min, CAST(trunc((east + 180.0) / 360.0 * 16384.0) AS BIGINT) AS x_max, CAST(trunc((1 - ln(tan(radians(south)) + 1 / cos(radians(south))) / pi()) / 2 * 16384.0) AS BIGINT) AS y_max FROM scenes")
def covering_tiles(spark, sf_dir):
    c = F.col
    return scene_table(spark, sf_dir).select("entity_id", geo.tile_x(c("west"), 14).alias("x_min"), geo.tile_y(c("north"), 14).alias("y_min"), geo.tile_x(c("east"), 14).alias("x_max"), geo.tile_y(c("south"), 14).alias("y_max"))


@query("F3 F5", "SELECT DISTINCT x, y, round(x / 4096.0 * 360 - 180, 6) AS lon, round(degrees(atan(sinh(pi() * (1 - 2 * y / 4096.0)))), 6) AS lat, round(-pi()*6378137 + x * (2*pi()*6378137 / 4096), 3) AS min_x, round(pi()*6378137 - y * (2*pi()*6378137 / 4096), 3) AS max_y FROM (SELECT c_custkey % 4096 AS x, (c_custkey * 7) % 4096 AS y FROM customer)")
def tile_corners(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select((F.col("c_custkey") % 4096).alias("x"), (F.col("c_custkey") * 7 % 4096).alias("y")).distinct()
    box = geo.tile_bounds(F.col("x"), F.col("y"), 12)
    return rows.select("x", "y", F.round(geo.tile_lon(F.col("x"), 12), 6).alias("lon"), F.round(geo.tile_lat(F.col("y"), 12), 6).alias("lat"), F.round(box["min_x"], 3).alias("min_x"), F.round(box["max_y"], 3).alias("max_y"))


@query("F4 F7", _S + " SELECT entity_id, round(6378137 * radians(west), 3) AS x, round(6378137 * ln(tan(pi() / 4 + radians(south) / 2)), 3) AS y FROM scenes")
def web_mercator(spark, sf_dir):
    return scene_table(spark, sf_dir).select("entity_id", F.round(geo.mercator_x(F.col("west")), 3).alias("x"), F.round(geo.mercator_y(F.col("south")), 3).alias("y"))


@query("F8 F9 P16 P17", _S + " SELECT entity_id, CAST(trunc(((west + east) / 2 + 180) / 6) + 1 + CASE WHEN (south + north) / 2 >= 0 THEN 32600 ELSE 32700 END AS INT) AS epsg, round(((east - west) * 111320 * cos(radians((south + north) / 2)) / 4000 + (north - south) * 110540 / 3000) / 2, 6) AS native_m FROM scenes")
def metric_frame(spark, sf_dir):
    w, s, e, n = (F.col(c) for c in scenes.BOX)
    return scene_table(spark, sf_dir).select("entity_id", geo.utm_epsg((w + e) / 2, (s + n) / 2).alias("epsg"), F.round(geo.native_resolution_m(w, s, e, n, F.lit(4000), F.lit(3000)), 6).alias("native_m"))


@query("F44 F45 F47", _S + " SELECT entity_id, greatest(west - 0.1, 50.4) AS w, greatest(south - 0.1, 25.4) AS s, least(east + 0.1, 51.2) AS e, least(north + 0.1, 26.2) AS n, greatest(40.0, (east - west) * 111320 / 4096) AS res FROM scenes")
def clamped_search_window(spark, sf_dir):
    c = F.col
    return scene_table(spark, sf_dir).select("entity_id", F.greatest(c("west") - 0.1, F.lit(50.4)).alias("w"), F.greatest(c("south") - 0.1, F.lit(25.4)).alias("s"), F.least(c("east") + 0.1, F.lit(51.2)).alias("e"), F.least(c("north") + 0.1, F.lit(26.2)).alias("n"), F.greatest(F.lit(40.0), (c("east") - c("west")) * 111320 / 4096).alias("res"))


@query("F12 B106 B107 F15", _S + " SELECT entity_id, south AS nw_lat_180, east AS nw_lon_180, west + (east - west) * 0.25 AS left_lon, west + (east - west) * 0.75 AS right_lon FROM scenes")
def corner_subset(spark, sf_dir):
    """Corners turned by half a turn, and the longitudes between which the middle two of four frames lie."""
    w, e = F.col("west"), F.col("east")
    return scene_table(spark, sf_dir).select("entity_id", F.col("south").alias("nw_lat_180"), e.alias("nw_lon_180"), (w + (e - w) * 0.25).alias("left_lon"), (w + (e - w) * 0.75).alias("right_lon"))


@query("F11", _S + " SELECT entity_id, CASE WHEN north - south > 0 THEN round((east - west) * cos(radians((north + south) / 2)) / (north - south), 9) ELSE 999.0 END AS aspect FROM scenes")
def geographic_aspect(spark, sf_dir):
    w, s, e, n = (F.col(c) for c in scenes.BOX)
    return scene_table(spark, sf_dir).select("entity_id", F.when(n - s > 0, F.round((e - w) * F.cos(F.radians((n + s) / 2)) / (n - s), 9)).otherwise(999.0).alias("aspect"))


@query("P2 P3 P8", f"WITH {_IDS} SELECT k, CASE WHEN eid LIKE 'DS1%' THEN 'KH-4' WHEN eid LIKE 'DZB%' THEN 'KH-7' WHEN eid LIKE 'D3C%' THEN 'KH-9' END AS camera, CASE WHEN eid LIKE 'D3C%' THEN 'A' WHEN eid LIKE 'DS1%' THEN 'A' WHEN eid LIKE 'DZB%' THEN 'H' WHEN kind <> '' THEN upper(left(kind, 1)) ELSE 'X' END AS designation FROM ids")
def camera_of_scene(spark, sf_dir):
    return _ids(spark, sf_dir).select("k", entities.camera(F.col("eid")).alias("camera"), entities.designation(F.col("eid"), F.col("kind")).alias("designation"))


@query("P4 P5", f"WITH {_IDS}, m AS (SELECT k, eid, CASE WHEN eid LIKE 'D3C%' THEN substr(eid, 4, 4) WHEN eid LIKE 'DS%' THEN substr(eid, 3, 4) WHEN eid LIKE 'DZB00%' THEN substr(eid, 6, 4) WHEN eid LIKE 'DZB%' THEN substr(eid, 4, 4) END AS mid FROM ids), s AS (SELECT *, CASE WHEN eid LIKE 'D3C%' THEN 'KH-9' WHEN eid LIKE 'DZB%' AND mid BETWEEN '1201' AND '1220' THEN 'KH-9' WHEN eid LIKE 'DZB%' AND mid BETWEEN '4001' AND '4099' THEN 'KH-7' WHEN eid LIKE 'DS%' AND mid BETWEEN '1001' AND '1099' THEN 'KH-4A' WHEN eid LIKE 'DS%' AND mid BETWEEN '1101' AND '1199' THEN 'KH-4B' END AS system FROM m) SELECT k, system, CASE WHEN system IS NOT NULL THEN mid END AS mission_id FROM s")
def mission_of_scene(spark, sf_dir):
    return _ids(spark, sf_dir).select("k", entities.mission(F.col("eid")).alias("m")).select("k", "m.system", "m.mission_id")


@query("P6 P7", f"WITH {_IDS} SELECT k, CASE WHEN regexp_matches(eid, 'DZB004[0-9]+H') THEN 'kh7' WHEN regexp_matches(eid, 'D3C[0-9]{{4}}') THEN 'kh9' WHEN regexp_matches(eid, 'DZB[0-9]+') THEN 'kh9' WHEN eid LIKE 'DS10%' THEN 'kh4a' WHEN eid LIKE 'DS%' THEN 'kh4b' END AS profile FROM ids")
def profile_of_file(spark, sf_dir):
    return _ids(spark, sf_dir).select("k", entities.profile(F.concat(F.lit("in/"), "eid", F.lit("_x.tif"))).alias("profile"))


@query("P9", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders")
def acquisition_dates(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("t"))
    text = F.when(F.col("o_orderkey") % 3 == 0, F.date_format("t", "yyyy/MM/dd")).when(F.col("o_orderkey") % 3 == 1, F.date_format("t", "yyyy-MM-dd")).otherwise(F.date_format("t", "MM/dd/yyyy"))
    return rows.select("o_orderkey", entities.acquisition_date(F.concat(F.lit(" "), text)).alias("d"))


@query("P10 P11 P12", f"WITH {_IDS}, r AS (SELECT k, eid, regexp_extract(eid, '(DS[0-9]+-[0-9]+|D3C[0-9]+-[0-9]+|DZB[0-9]+)([A-Z]+)([0-9]+)$', 2) AS strip, regexp_extract(eid, '([0-9]+)$', 1) AS idx FROM ids) SELECT k, eid AS entity, nullif(strip, '') AS strip, CASE WHEN strip <> '' THEN CAST(idx AS INT) END AS index, CASE WHEN regexp_matches(eid, '[0-9]{{3}}$') THEN CAST(right(eid, 3) AS INT) END AS frame FROM r")
def strip_of_file(spark, sf_dir):
    path = F.concat(F.lit("cache/"), "eid", F.lit("_stitched_ortho.tif"))
    rows = _ids(spark, sf_dir).select("k", entities.entity_id(F.concat(F.lit("a/b/"), "eid", F.lit("_ortho.coarse.tif"))).alias("entity"), entities.strip_index(path).alias("s"), entities.frame_key(F.col("eid")).alias("f"))
    return rows.select("k", "entity", "s.strip", "s.index", "f.frame")


@query("P13 F30", "WITH r AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 7 = 0 THEN 12.5 END AS explicit, year(o_orderdate) AS y, CASE o_orderkey % 4 WHEN 0 THEN 1968 WHEN 1 THEN 2023 WHEN 2 THEN 2022 END AS ry FROM orders), g AS (SELECT k, coalesce(explicit, abs(y - ry)::DOUBLE) AS gap FROM r) SELECT k, gap, CASE WHEN gap IS NULL THEN 1.0 ELSE round(greatest(0.3, 1 - 0.06 * greatest(0.0, gap - 5)), 9) END AS factor FROM g")
def era_gap(spark, sf_dir):
    from orthoweave.operators.quality import era_factor

    k = F.col("o_orderkey")
    file = F.when(k % 4 == 0, "ref/kh4_1968_x.tif").when(k % 4 == 1, "ref/Sentinel2_x.tif").when(k % 4 == 2, "NAIP-mosaic.tif").otherwise("unknown.tif")
    rows = table(spark, sf_dir, "orders").select(k.alias("k"), entities.era_gap(F.when(k % 7 == 0, 12.5), F.date_format("o_orderdate", "yyyy/MM/dd"), file).alias("gap"))
    return rows.select("k", "gap", F.round(era_factor(F.col("gap")), 9).alias("factor"))


@query("P20", "SELECT p_partkey, CASE WHEN p_brand IN ('Brand#11') THEN 'coastal_obia' ELSE 'heuristic' END AS mode FROM part")
def anchor_mask_mode(spark, sf_dir):
    kind = F.when(F.col("p_brand") == "Brand#11", "island_center").otherwise("road")
    return table(spark, sf_dir, "part").select("p_partkey", entities.mask_mode(kind).alias("mode"))


@query("S33 F43", _S + ", t AS (SELECT DISTINCT floor(west) AS lon, floor(south) AS lat FROM scenes) SELECT 'Copernicus_DSM_COG_10_N' || lpad(CAST(CAST(lat AS INT) AS VARCHAR), 2, '0') || '_00_E' || lpad(CAST(CAST(lon AS INT) AS VARCHAR), 3, '0') || '_00_DEM' AS tile FROM t")
def dem_tiles(spark, sf_dir):
    rows = scene_table(spark, sf_dir).select(F.floor("west").alias("lon"), F.floor("south").alias("lat")).distinct()
    return rows.select(entities.dem_tile(F.col("lat"), F.col("lon")).alias("tile"))


@query("P31", _S + " SELECT entity_id, west >= 50.4 AND south >= 25.4 AND east <= 51.2 AND north <= 26.2 AS covered FROM scenes")
def reference_covers(spark, sf_dir):
    w, s, e, n = BOX
    return scene_table(spark, sf_dir).select("entity_id", ((F.col("west") >= w) & (F.col("south") >= s) & (F.col("east") <= e) & (F.col("north") <= n)).alias("covered"))


@query("P33 B53", _S + ", o AS (SELECT entity_id, (east - west) * 111320 * 1.0 AS w, (north - south) * 110540 * 1.0 AS h FROM scenes) SELECT entity_id, CASE WHEN w * h * 4 * 28 <= 2e9 THEN 0.5 ELSE round_even(greatest(sqrt(w * h * 28 / 2e9), 1.0) * 2 + 0.49, 0) / 2 END AS res FROM o")
def safe_resolution(spark, sf_dir):
    """Coarsens a resolution of 0.5 m until an image's matching footprint fits a cap of 2 GB."""
    w, h = (F.col("east") - F.col("west")) * 111320 * 1.0, (F.col("north") - F.col("south")) * 110540 * 1.0
    return scene_table(spark, sf_dir).select("entity_id", F.when(w * h * 4 * 28 <= 2e9, 0.5).otherwise(F.bround(F.greatest(F.sqrt(w * h * 28 / 2e9), F.lit(1.0)) * 2 + 0.49) / 2).alias("res"))
