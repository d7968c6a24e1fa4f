"""Queries on tiles of 8 by 8 pixels."""

from __future__ import annotations

from pyspark.sql import functions as F

from orthoweave.operators import imaging, iterative, kernels, quality, tiles
from orthoweave.plans.registry import query
from orthoweave.sources.roles import PIXELS, pixels, table

_P = f"WITH {PIXELS}"


@query("R1", _P + " SELECT a.tile, a.r, a.c, coalesce(b.px, 0.0) AS px FROM pixels a LEFT JOIN pixels b ON a.tile = b.tile AND a.r = b.r + 1 AND a.c = b.c - 2")
def tile_shift(spark, sf_dir):
    return tiles.shift(pixels(spark, sf_dir), 1, -2, 8)


@query("R2", _P + ", e AS (SELECT tile, min(px) FILTER (px > 0) AS lo, max(px) FILTER (px > 0) AS hi FROM pixels GROUP BY tile) SELECT tile, r, c, CASE WHEN px > 0 AND hi > lo THEN CAST(floor((px - lo) / (hi - lo) * 255) AS INT) ELSE 0 END AS u8 FROM pixels JOIN e USING (tile)")
def byte_range(spark, sf_dir):
    return tiles.byte_range(pixels(spark, sf_dir))


@query("R3", _P + ", e AS (SELECT tile, quantile_cont(px, 0.01) FILTER (px > 0) AS lo, quantile_cont(px, 0.99) FILTER (px > 0) AS hi FROM pixels GROUP BY tile) SELECT tile, r, c, CASE WHEN hi > lo THEN CAST(floor(least(255, greatest(0, (px - lo) / (hi - lo) * 255)) + 1e-9) AS INT) ELSE 0 END AS u8 FROM pixels JOIN e USING (tile)")
def byte_percentiles(spark, sf_dir):
    return tiles.byte_percentiles(pixels(spark, sf_dir))


@query("R4", _P + ", e AS (SELECT strip, quantile_cont(px, 0.01) FILTER (px > 0) AS lo, quantile_cont(px, 0.99) FILTER (px > 0) AS hi FROM pixels GROUP BY strip) SELECT tile, r, c, CASE WHEN hi > lo THEN CAST(floor(least(255, greatest(0, (px - lo) / (hi - lo) * 255)) + 1e-9) AS INT) ELSE 0 END AS u8 FROM pixels JOIN e USING (strip)")
def byte_percentiles_joint(spark, sf_dir):
    return tiles.byte_percentiles(pixels(spark, sf_dir), by="strip")


@query("R5", _P + ", s AS (SELECT tile, avg(px) FILTER (px > 0) AS sm, greatest(stddev_pop(px) FILTER (px > 0), 1e-6) AS ss FROM pixels GROUP BY tile), g AS (SELECT strip, avg(px) FILTER (px > 0) AS rm, greatest(stddev_pop(px) FILTER (px > 0), 1e-6) AS rs FROM pixels GROUP BY strip) SELECT tile, r, c, round(CASE WHEN px > 0 AND rm IS NOT NULL THEN (px - sm) / ss * rs + rm ELSE px END, 6) AS px FROM pixels JOIN s USING (tile) JOIN g USING (strip)")
def wallis_match(spark, sf_dir):
    px = pixels(spark, sf_dir)
    return tiles.match_statistics(px, px, by="strip").withColumn("px", F.round("px", 6))


@query("P18 P23", _P + ", s AS (SELECT tile, count(*) AS n, count(*) FILTER (px > 0) AS k, avg(px) FILTER (px > 0) AS m, stddev_pop(px) FILTER (px > 0) AS s, max(px) FILTER (px > 0) AS hi, min(px) FILTER (px > 0) AS lo FROM pixels GROUP BY tile) SELECT tile, k < n * 0.3 OR (m / hi > 0.5 AND coalesce(s / nullif(hi - lo, 0), 0) < 0.3) AS cloudy FROM s")
def cloudy_tiles(spark, sf_dir):
    return tiles.cloudy(pixels(spark, sf_dir), bright=0.5, texture=0.3)


@query("R10", _P + ", j AS (SELECT a.tile, b.tile AS other, a.px AS x, b.px AS y FROM pixels a JOIN pixels b ON a.strip = b.strip AND a.r = b.r AND a.c = b.c AND a.tile < b.tile WHERE a.px <> 0 AND b.px <> 0) SELECT tile, other, round(CASE WHEN count(*) < 16 THEN -1.0 ELSE corr(x, y) END, 6) AS zncc FROM j GROUP BY ALL")
def tile_correlation(spark, sf_dir):
    """Every two tiles of one strip, each pair once. The pairs grow with the square of a strip's tiles."""
    return tiles.correlated_within(pixels(spark, sf_dir), by="strip").select("tile", "other", F.round("zncc", 6).alias("zncc"))


_MIRROR = "CASE WHEN {0} < 0 THEN -({0}) WHEN {0} > 7 THEN 14 - ({0}) ELSE {0} END"


@query(
    "R9",
    _P + ", o AS (SELECT * FROM (VALUES (1,-2,-2),(2,-2,0),(4,-2,2),(8,0,-2),(16,0,2),(32,2,-2),(64,2,0),(128,2,2)) v(b, dr, dc)) SELECT a.tile, a.r, a.c, CAST(sum(CASE WHEN n.px > a.px THEN b ELSE 0 END) AS INT) AS code FROM pixels a, o JOIN pixels n ON n.tile = a.tile AND n.r = " + _MIRROR.format("a.r + dr") + " AND n.c = " + _MIRROR.format("a.c + dc") + " GROUP BY ALL",
)
def census_transform(spark, sf_dir):
    return tiles.census(pixels(spark, sf_dir))


@query(
    "R7",
    _P + ", o AS (SELECT i AS dr, j AS dc, j * CASE WHEN i = 0 THEN 2 ELSE 1 END AS kx, i * CASE WHEN j = 0 THEN 2 ELSE 1 END AS ky FROM (VALUES (-1), (0), (1)) a(i), (VALUES (-1), (0), (1)) b(j)) SELECT a.tile, a.r, a.c, round(sqrt(pow(sum(n.px * kx), 2) + pow(sum(n.px * ky), 2)), 6) AS magnitude FROM pixels a, o JOIN pixels n ON n.tile = a.tile AND n.r = " + _MIRROR.format("a.r + dr") + " AND n.c = " + _MIRROR.format("a.c + dc") + " GROUP BY a.tile, a.r, a.c",
)
def sobel_gradient(spark, sf_dir):
    return tiles.sobel(pixels(spark, sf_dir)).withColumn("magnitude", F.round("magnitude", 6))


@query("R19", _P + " SELECT tile, r, c, round(least(1.5, greatest(0, CASE WHEN px > 0.1 THEN 1.25 ELSE 0 END + CASE WHEN abs(px) < 0.02 THEN 0.75 ELSE 0 END + CASE WHEN px < -0.1 THEN 0.35 ELSE 0 END - CASE WHEN px < -0.2 THEN 0.8 ELSE 0 END)), 6)::DOUBLE AS weight FROM pixels")
def class_weights(spark, sf_dir):
    px = F.col("px")
    w = tiles.class_weight(stable=px > 0.1, shoreline=F.abs(px) < 0.02, dark_farmland=px < -0.1, shallow_water=px < -0.2)
    return pixels(spark, sf_dir).select("tile", "r", "c", F.round(w, 6).alias("weight"))


@query("R40", _P + ", f AS (SELECT a.tile, a.r, a.c, a.px * 100 AS x, b.px * 100 AS y FROM pixels a JOIN pixels b ON a.tile = b.tile AND a.r = b.c AND a.c = b.r) SELECT tile, r, c, round(x * CASE WHEN sqrt(x*x+y*y) > 10 THEN 10 / (sqrt(x*x+y*y) + 1e-8) ELSE 1 END, 6) AS x, round(least(10.0, sqrt(x*x+y*y)), 6) AS magnitude FROM f")
def clamped_flow(spark, sf_dir):
    px = pixels(spark, sf_dir)
    flow = px.select("tile", "r", "c", (F.col("px") * 100).alias("x")).join(px.select("tile", F.col("c").alias("r"), F.col("r").alias("c"), (F.col("px") * 100).alias("y")), ["tile", "r", "c"])
    got = tiles.clamp_flow(F.col("x"), F.col("y"), 10.0)
    return flow.select("tile", "r", "c", F.round(got["x"], 6).alias("x"), F.round(got["magnitude"], 6).alias("magnitude"))


@query("R42", _P + ", f AS (SELECT tile, r, c, c + px * 4 AS x, r - px * 4 AS y FROM pixels), d AS (SELECT tile, lead(x) OVER rw - lag(x) OVER rw AS xc, lead(y) OVER rw - lag(y) OVER rw AS yc, lead(x) OVER cw - lag(x) OVER cw AS xr, lead(y) OVER cw - lag(y) OVER cw AS yr FROM f WINDOW rw AS (PARTITION BY tile, r ORDER BY c), cw AS (PARTITION BY tile, c ORDER BY r)) SELECT tile, avg(CASE WHEN xc*yr - yc*xr <= 0 THEN 1.0::DOUBLE ELSE 0 END) AS folded FROM d WHERE xc*yr - yc*xr IS NOT NULL GROUP BY tile")
def fold_fraction(spark, sf_dir):
    flow = pixels(spark, sf_dir).select("tile", "r", "c", (F.col("c") + F.col("px") * 4).alias("x"), (F.col("r") - F.col("px") * 4).alias("y"))
    return tiles.folds(flow)


@query("A23", _P + " SELECT strip, r, c, CAST(floor(least(255, greatest(0, sum(abs(px) * 300 * (1 + tile % 3)) / sum(1 + tile % 3))) + 1e-9) AS INT) AS value FROM pixels GROUP BY ALL")
def alpha_composite(spark, sf_dir):
    rows = pixels(spark, sf_dir).select("strip", "r", "c", (F.abs("px") * 300).alias("px"), (1 + F.col("tile") % 3).alias("alpha"))
    return tiles.composite(rows, by=["strip", "r", "c"])


_CELLS = _P + """, k AS (SELECT CAST(i // 3 AS INT) AS r, CAST(i % 3 AS INT) AS c FROM range(6) t(i)), m AS (SELECT tile, k.r, k.c, median(px) AS med, count(*) AS n FROM pixels p JOIN k ON p.r >= round_even(k.r * 8 / 2.0, 0) AND p.r < round_even((k.r + 1) * 8 / 2.0, 0) AND p.c >= round_even(k.c * 8 / 3.0, 0) AND p.c < round_even((k.c + 1) * 8 / 3.0, 0) WHERE px > 0 GROUP BY ALL),
cells AS (SELECT t.tile, k.r, k.c, CASE WHEN n >= 4 THEN med END AS shoreline_med, coalesce(n, 0) AS edge_px, coalesce(n, 0) >= 4 AS valid FROM (SELECT DISTINCT tile FROM pixels WHERE px > 0) t, k LEFT JOIN m ON m.tile = t.tile AND m.r = k.r AND m.c = k.c)"""


@query("A12", _CELLS + " SELECT tile, r, c, round(shoreline_med, 9) AS shoreline_med, edge_px, valid FROM cells")
def grid_cells(spark, sf_dir):
    got = tiles.grid_cells(pixels(spark, sf_dir).filter("px > 0"), rows=2, columns=3, size=8, least=4)
    return got.withColumn("shoreline_med", F.round("shoreline_med", 9))


@query("A13", _CELLS + " SELECT tile, round(median(shoreline_med) FILTER (c = 0), 9) AS west, round(median(shoreline_med) FILTER (c = 1), 9) AS center, round(median(shoreline_med) FILTER (c = 2), 9) AS east, round(median(shoreline_med) FILTER (r = 0) - median(shoreline_med) FILTER (r = 1), 9) AS north_shift FROM cells GROUP BY tile")
def grid_summary(spark, sf_dir):
    cells = tiles.grid_cells(pixels(spark, sf_dir).filter("px > 0"), rows=2, columns=3, size=8, least=4)
    got = quality.grid_summary(cells, by="tile", columns=3, rows=2)
    return got.select("tile", *[F.round(c, 9).alias(c) for c in got.columns[1:]])


@query("A16 U5", _P + ", m AS (SELECT a.tile, a.px > 0 AS a, b.px > 0 AS b FROM pixels a JOIN pixels b ON b.tile = a.tile + 1 AND a.r = b.r AND a.c = b.c) SELECT tile, count(*) FILTER (a OR b) AS union_px, coalesce(count(*) FILTER (a AND b)::DOUBLE / nullif(count(*) FILTER (a OR b), 0), 0) AS iou, count(*) FILTER (a <> b) AS changed_px FROM m GROUP BY tile")
def mask_agreement(spark, sf_dir):
    px = pixels(spark, sf_dir)
    both = px.select("tile", "r", "c", (F.col("px") > 0).alias("a")).join(px.select((F.col("tile") - 1).alias("tile"), "r", "c", (F.col("px") > 0).alias("b")), ["tile", "r", "c"])
    return tiles.mask_agreement(both)


@query("B45", _P + " SELECT tile, CAST(r // 2 AS INT) AS r, CAST(c // 2 AS INT) AS c, round(avg(px), 9) AS px FROM pixels GROUP BY ALL")
def overview_level(spark, sf_dir):
    return tiles.overview(pixels(spark, sf_dir)).withColumn("px", F.round("px", 9))


@query("R30", _P + " SELECT tile, greatest(0, min(r) - 1) AS r0, least(7, max(r) + 1) AS r1, greatest(0, min(c) - 1) AS c0, least(7, max(c) + 1) AS c1 FROM pixels WHERE px > 0.2 GROUP BY tile")
def content_box(spark, sf_dir):
    return tiles.content_box(pixels(spark, sf_dir), threshold=0.2)


@query("B120", _P + " SELECT tile, CAST(7 - r AS INT) AS r, CAST(7 - c AS INT) AS c, px FROM pixels")
def turned_half(spark, sf_dir):
    return pixels(spark, sf_dir).select("tile", (7 - F.col("r")).cast("int").alias("r"), (7 - F.col("c")).cast("int").alias("c"), "px")


@query("F36", _P + ", a AS (SELECT tile, avg(sin(px * 2 * pi() / 0.05)) AS s, avg(cos(px * 2 * pi() / 0.05)) AS k FROM pixels GROUP BY tile) SELECT tile, round(atan2(s, k) * 0.05 / (2 * pi()) + CASE WHEN atan2(s, k) < 0 THEN 0.05 ELSE 0 END, 6) AS phase FROM a")
def circular_mean(spark, sf_dir):
    return tiles.circular_mean(pixels(spark, sf_dir), "px", 0.05, by="tile").withColumn("phase", F.round("phase", 6))


@query("B166 A31 B165", "WITH e AS (SELECT a.label, list_cosine_similarity(a.embedding, b.embedding)::DOUBLE AS cs FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1 AND a.label = b.label) SELECT label, count(*) AS n, CASE WHEN median(cs) >= 0.8 THEN 'STOP' WHEN median(cs) >= 0.5 THEN 'PROCEED_r8' ELSE 'PROCEED_r16' END AS band FROM e GROUP BY label")
def feature_gap(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    nxt = e.select((F.col("vec_id") - 1).alias("vec_id"), "label", F.col("embedding").alias("other"))
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda a, b: a.cast("double") * b.cast("double")), F.lit(0.0), lambda s, v: s + v)
    x, y = F.col("embedding"), F.col("other")
    cos = e.join(nxt, ["vec_id", "label"]).select("label", (dot(x, y) / F.sqrt(dot(x, x) * dot(y, y))).alias("cs"))
    return cos.groupBy("label").agg(F.count("*").alias("n"), quality.decision_band(F.percentile("cs", F.lit(0.5))).alias("band"))


@query("R6 R17 B74 B75 B83")
def tile_measures(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("tile"), kernels.tile_measures(F.col("embedding")).alias("m")).select("tile", "m.*")


def _next(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("tile"), F.col("embedding").alias("a")).join(e.select((F.col("vec_id") - 1).alias("tile"), F.col("embedding").alias("b")), "tile")


@query("R11 R20")
def tile_phase_shift(spark, sf_dir):
    return kernels.shifts(_next(spark, sf_dir), "a", "b").select("tile", "dx", "dy", "response", "changed")


@query("R24")
def pyramid_blend(spark, sf_dir):
    return kernels.blended(_next(spark, sf_dir), "a", "b").select("tile", "px")


@query("R8")
def bilinear_warp(spark, sf_dir):
    tiles_ = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("tile"), "embedding")
    return kernels.warped(tiles_, "embedding", (0.98, -0.05, 0.3, 0.05, 0.98, -0.2)).select("tile", "px")


@query("O15")
def minimum_seam(spark, sf_dir):
    costs = pixels(spark, sf_dir).select("tile", "r", "c", F.abs("px").alias("cost"))
    return iterative.cheapest_seam(costs, by="tile")


@query("O3")
def correlation_peaks(spark, sf_dir):
    rows = pixels(spark, sf_dir).select("tile", F.col("c").cast("double").alias("x"), F.col("r").cast("double").alias("y"), "px")
    return iterative.peaks(rows, by="tile", value="px", radius=2.5)


@query("A17 A29 R16 R44 B1 B152 B154")
def pair_diagnostics(spark, sf_dir):
    return imaging.pair_diagnostics(_next(spark, sf_dir), "a", "b").select("tile", "boundary_m", "land_dx", "land_dy", "land_ncc", "mask_corr", "median_m")


@query("R27 R37 B11")
def restored_tiles(spark, sf_dir):
    tiles_ = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("tile"), "embedding")
    return imaging.restored(tiles_, "embedding").select("tile", "px", "k1", "k2", "line")
