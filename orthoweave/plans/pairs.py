"""Queries on match pairs."""

from __future__ import annotations

from pyspark.sql import functions as F

from orthoweave.operators import iterative, pairs, quality
from orthoweave.plans.registry import query
from orthoweave.sources.roles import PAIRS, match_pairs, table

_D = f"WITH {PAIRS}, d AS (SELECT *, off_x - ref_x AS dx, off_y - ref_y AS dy FROM pairs)"
_MAD = (
    _D
    + """, m AS (SELECT scene, count(*) AS n, median(dx) AS mx, median(dy) AS my FROM d GROUP BY scene),
s AS (SELECT scene, median(abs(dx - mx)) * 1.4826 AS sx, median(abs(dy - my)) * 1.4826 AS sy FROM d JOIN m USING (scene) GROUP BY scene),
k AS (SELECT d.*, n, is_anchor OR (abs(dx - mx) < 2.5 * greatest(sx, 20.0) AND abs(dy - my) < 2.5 * greatest(sy, 20.0)) AS near FROM d JOIN m USING (scene) JOIN s USING (scene)),
kept AS (SELECT * FROM (SELECT *, count(*) FILTER (WHERE near) OVER (PARTITION BY scene) AS lft FROM k) WHERE near OR n <= 4 OR lft < 4)"""
)
_FIT = """, w AS (SELECT scene, count(*) AS n, sum(prec * off_x) / sum(prec) AS mu, sum(prec * off_y) / sum(prec) AS mv, sum(prec * ref_x) / sum(prec) AS mx0, sum(prec * ref_y) / sum(prec) AS my0 FROM {t} GROUP BY scene),
q AS (SELECT scene, any_value(w.n) AS n, any_value(mu) AS mu, any_value(mv) AS mv, any_value(mx0) AS mx0, any_value(my0) AS my0, sum(prec*(off_x-mu)*(off_x-mu)) AS uu, sum(prec*(off_x-mu)*(off_y-mv)) AS uv, sum(prec*(off_y-mv)*(off_y-mv)) AS vv,
 sum(prec*(off_x-mu)*(ref_x-mx0)) AS ux, sum(prec*(off_y-mv)*(ref_x-mx0)) AS vx, sum(prec*(off_x-mu)*(ref_y-my0)) AS uy, sum(prec*(off_y-mv)*(ref_y-my0)) AS vy FROM {t} JOIN w USING (scene) GROUP BY scene),
f AS (SELECT scene, n, (ux*vv - vx*uv)/(uu*vv - uv*uv) AS a, (vx*uu - ux*uv)/(uu*vv - uv*uv) AS b, (uy*vv - vy*uv)/(uu*vv - uv*uv) AS c, (vy*uu - uy*uv)/(uu*vv - uv*uv) AS d, mu, mv, mx0, my0 FROM q),
fit AS (SELECT scene, n, a, b, mx0 - a*mu - b*mv AS tx, c, d, my0 - c*mu - d*mv AS ty FROM f)"""
_STATS = """count(*) AS "count", round(avg(r), 6) AS mean_m, round(quantile_cont(r, 0.5), 6) AS median_m, round(quantile_cont(r, 0.9), 6) AS p90_m, round(max(r), 6) AS max_m"""
_RES = "SELECT p.*, sqrt(pow(a*off_x + b*off_y + tx - ref_x, 2) + pow(c*off_x + d*off_y + ty - ref_y, 2)) AS r FROM {t} p JOIN fit USING (scene)"


def _rounded(df, *names, digits: int = 6):
    return df.select(*[F.round(c, digits).alias(c) if c in names else F.col(c) for c in df.columns])


@query(
    "G5 A8 A9 A10 F33 U1",
    _MAD + _FIT.format(t="kept") + f", r AS ({_RES.format(t='kept')}), s2 AS (SELECT scene, {_STATS} FROM r GROUP BY scene) SELECT *, CASE WHEN median_m <= 30 THEN 'A' WHEN median_m <= 60 THEN 'B' WHEN median_m <= 90 THEN 'C' ELSE 'D' END AS grade FROM s2",
)
def scene_affine_fit(spark, sf_dir):
    kept = pairs.reject_mad(match_pairs(spark, sf_dir))
    rows = pairs.residuals(kept, pairs.fit_affine(kept, F.col("prec")))
    stats = _rounded(pairs.residual_stats(rows), "mean_m", "median_m", "p90_m", "max_m")
    return stats.withColumn("grade", quality.grade(F.lit(None).cast("double"), F.col("median_m"), F.lit(None).cast("double")))


@query("G5", _MAD + " SELECT id, scene FROM kept")
def mad_rejection(spark, sf_dir):
    return pairs.reject_mad(match_pairs(spark, sf_dir)).select("id", "scene")


@query("A8 B29", f"WITH {PAIRS}" + _FIT.format(t="pairs") + " SELECT scene, n, round(a, 6) AS a, round(b, 6) AS b, round(tx, 3) AS tx, round(c, 6) AS c, round(d, 6) AS d, round(ty, 3) AS ty, 'ok' AS status FROM fit")
def weighted_affine(spark, sf_dir):
    got = pairs.fit_affine(match_pairs(spark, sf_dir), F.col("prec"))
    return _rounded(_rounded(got, "a", "b", "c", "d"), "tx", "ty", digits=3)


@query("A9 A10", f"WITH {PAIRS}" + _FIT.format(t="pairs") + f", r AS ({_RES.format(t='pairs')}) SELECT scene, {_STATS} FROM r GROUP BY scene")
def affine_residual_stats(spark, sf_dir):
    rows = match_pairs(spark, sf_dir)
    return _rounded(pairs.residual_stats(pairs.residuals(rows, pairs.fit_affine(rows, F.col("prec")))), "mean_m", "median_m", "p90_m", "max_m")


@query(
    "G6",
    _D
    + """, t AS (SELECT * FROM d WHERE is_anchor), m AS (SELECT scene, count(*) AS n, median(dx) AS mx, median(dy) AS my FROM t GROUP BY scene),
e AS (SELECT t.*, n, sqrt(pow(dx - mx, 2) + pow(dy - my, 2)) AS dist FROM t JOIN m USING (scene)), f AS (SELECT scene, median(dist) AS md FROM e GROUP BY scene),
g AS (SELECT scene, median(abs(dist - md)) * 1.4826 AS mad FROM e JOIN f USING (scene) GROUP BY scene),
h AS (SELECT e.*, dist <= greatest(180.0, least(5.0, greatest(3.5, 3.5 + (confidence - 0.4) / 0.3 * 1.5)) * mad) AS near FROM e JOIN g USING (scene)),
i AS (SELECT *, count(*) FILTER (WHERE near) OVER (PARTITION BY scene) AS lft FROM h) SELECT id, scene FROM i WHERE near OR n < 6 OR lft < 4""",
)
def anchor_outliers(spark, sf_dir):
    return pairs.anchor_displacement_outliers(match_pairs(spark, sf_dir).filter("is_anchor")).select("id", "scene")


@query("P15", f"WITH {PAIRS} SELECT id, scene, confidence FROM (SELECT *, count(*) FILTER (WHERE NOT is_anchor) OVER (PARTITION BY scene) AS n FROM pairs) WHERE is_anchor OR n < 10 OR confidence >= 0.25")
def confidence_floor(spark, sf_dir):
    return pairs.confidence_floor(match_pairs(spark, sf_dir)).select("id", "scene", "confidence")


@query(
    "P22",
    f"""WITH {PAIRS}, b AS (SELECT scene, count(*) AS n, min(ref_x) AS x0, max(ref_x) AS x1, min(ref_y) AS y0, max(ref_y) AS y1 FROM pairs GROUP BY scene),
g AS (SELECT DISTINCT scene, least(2, floor((ref_x - x0) / (x1 - x0) * 3)) AS gx, least(2, floor((ref_y - y0) / (y1 - y0) * 3)) AS gy FROM pairs JOIN b USING (scene)),
c AS (SELECT scene, count(*) AS n_cells FROM g GROUP BY scene)
SELECT scene, n, n_cells, n >= 25 AND x1 - x0 >= 100 AND y1 - y0 >= 100 AND n_cells >= 4 AS sufficient FROM b JOIN c USING (scene)""",
)
def pairs_sufficient(spark, sf_dir):
    return pairs.sufficient(match_pairs(spark, sf_dir))


@query(
    "W4",
    f"""WITH {PAIRS}, r AS (SELECT *, floor(ref_x/2000) AS cx, floor(ref_y/2000) AS cy, row_number() OVER (PARTITION BY scene, floor(ref_x/2000), floor(ref_y/2000), floor(ref_x/500), floor(ref_y/500) ORDER BY confidence DESC, id) AS rk, count(*) OVER (PARTITION BY scene) AS n FROM pairs),
s AS (SELECT *, rk <= 7 AS taken, count(*) FILTER (WHERE rk <= 7) OVER (PARTITION BY scene, cx, cy) AS have FROM r),
t AS (SELECT *, row_number() OVER (PARTITION BY scene, cx, cy ORDER BY taken, confidence DESC, id) AS nx FROM s)
SELECT id, scene FROM t WHERE taken OR nx <= 7 - have OR n <= 100""",
)
def cell_quota(spark, sf_dir):
    return pairs.quota(match_pairs(spark, sf_dir)).select("id", "scene")


@query("N4", f"WITH {PAIRS} SELECT id, scene FROM (SELECT *, row_number() OVER (PARTITION BY scene, floor(ref_x/25), floor(ref_y/25) ORDER BY confidence DESC, id) AS k FROM pairs) WHERE k = 1")
def best_match_per_bin(spark, sf_dir):
    return pairs.best_per_cell(match_pairs(spark, sf_dir), cell_m=25.0).select("id", "scene")


@query("N11", f"WITH {PAIRS} SELECT id, scene FROM (SELECT *, row_number() OVER (PARTITION BY scene, floor(ref_x/2500), floor(ref_y/2500) ORDER BY confidence DESC, id) AS k FROM pairs WHERE is_anchor) WHERE k <= 6")
def anchor_top_six(spark, sf_dir):
    return pairs.best_per_cell(match_pairs(spark, sf_dir).filter("is_anchor"), cell_m=2500.0, keep=6).select("id", "scene")


@query("J5 G10")
def local_consistency(spark, sf_dir):
    """All neighbours within 5000 m, a tolerance of 50 m: the radius and limit of production. Too many for SQL."""
    rows = match_pairs(spark, sf_dir).select("id", "scene", "ref_x", "ref_y", "off_x", "off_y", "confidence", "is_anchor")
    return pairs.locally_consistent_within(rows, ~F.col("is_anchor")).select("id", "scene")


@query("A18", f"WITH {PAIRS}, v AS (SELECT scene, confidence AS v, sum(prec) AS w FROM pairs GROUP BY ALL), c AS (SELECT *, sum(w) OVER (PARTITION BY scene ORDER BY v) AS r, sum(w) OVER (PARTITION BY scene) AS t FROM v) SELECT scene, min(v) AS weighted_median FROM c WHERE r >= t / 2 GROUP BY scene")
def weighted_median(spark, sf_dir):
    return pairs.weighted_median(match_pairs(spark, sf_dir), "confidence", "prec", by="scene")


@query("A19", _D + ", m AS (SELECT scene, count(*) AS n, median(dx) AS dx0, median(dy) AS dy0 FROM d GROUP BY scene), e AS (SELECT scene, any_value(n) AS n, any_value(dx0) AS dx, any_value(dy0) AS dy, median(abs(dx - dx0)) + median(abs(dy - dy0)) AS mad FROM d JOIN m USING (scene) GROUP BY scene) SELECT scene, n, round(dx, 6) AS dx, round(dy, 6) AS dy, round(1 / (1 + 1.4826 * mad / sqrt(n)), 9) AS agreement FROM e")
def translation_estimate(spark, sf_dir):
    return _rounded(_rounded(pairs.translation(match_pairs(spark, sf_dir)), "dx", "dy"), "agreement", digits=9)


@query("G26", f"WITH {PAIRS}, m AS (SELECT scene, median(prec) AS mid FROM pairs GROUP BY scene) SELECT id, round(least(3.0, greatest(0.2, prec / mid)), 9) AS weight, count(*) AS rows FROM pairs JOIN m USING (scene) GROUP BY ALL")
def precision_weights(spark, sf_dir):
    return _rounded(pairs.precision_weights(match_pairs(spark, sf_dir)), "weight", digits=9).groupBy("id", "weight").agg(F.count("*").alias("rows"))


@query("A24", f"WITH {PAIRS}, b AS (SELECT min(ref_x) AS x0, max(ref_x) AS x1, min(ref_y) AS y0, max(ref_y) AS y1 FROM pairs), g AS (SELECT scene, least(4, floor((ref_x-x0)/(x1-x0)*5)) AS gx, least(4, floor((ref_y-y0)/(y1-y0)*5)) AS gy FROM pairs, b) SELECT scene, count(*) AS n, count(DISTINCT gx*5+gy) / 25.0::DOUBLE AS coverage FROM g GROUP BY scene")
def gcp_coverage(spark, sf_dir):
    return pairs.coverage(match_pairs(spark, sf_dir))


@query("O16", f"WITH {PAIRS}, r AS (SELECT id, scene, is_anchor, count(*) FILTER (WHERE NOT is_anchor) OVER (PARTITION BY scene) AS n, row_number() OVER (PARTITION BY scene, is_anchor ORDER BY md5(id), id) AS k FROM pairs) SELECT id, scene, NOT is_anchor AND n >= 12 AND k <= least(greatest(4, round_even(n * 0.2, 0)), greatest(0, n - 6)) AS holdout FROM r")
def holdout_split(spark, sf_dir):
    return pairs.holdout(match_pairs(spark, sf_dir)).select("id", "scene", "holdout")


@query("G15 G17", "WITH f AS (SELECT p_partkey AS scene, p_size * 100 AS width, p_size * 70 + 30 AS height FROM part), e AS (SELECT scene, width, height, edge, greatest(2, CASE WHEN edge IN ('top', 'bottom') THEN width ELSE height END // 500 + 1) AS n FROM f, (VALUES ('top'), ('bottom'), ('left'), ('right')) v(edge)), s AS (SELECT *, unnest(range(n)) AS step FROM e) SELECT scene, edge, CAST(step AS INT) AS step, CASE edge WHEN 'left' THEN 0.0::DOUBLE WHEN 'right' THEN width::DOUBLE ELSE step::DOUBLE / (n - 1) * width END AS col, CASE edge WHEN 'top' THEN 0.0::DOUBLE WHEN 'bottom' THEN height::DOUBLE ELSE step::DOUBLE / (n - 1) * height END AS row FROM s")
def boundary_points(spark, sf_dir):
    frames = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("scene"), (F.col("p_size") * 100).alias("width"), (F.col("p_size") * 70 + 30).alias("height"))
    return pairs.frame_points(frames)


@query("G16 U2", f"WITH {PAIRS}" + _FIT.format(t="pairs") + ", pt AS (SELECT * FROM (VALUES ('sw', 0.0, 0.0), ('ne', 20000.0, 20000.0), ('mid', 10000.0, 5000.0)) v(name, gx, gy)) SELECT scene, name, round((d*(gx-tx) - b*(gy-ty)) / (a*d - b*c), 3) AS off_x, round((a*(gy-ty) - c*(gx-tx)) / (a*d - b*c), 3) AS off_y FROM fit, pt")
def boundary_inverse(spark, sf_dir):
    fits = pairs.fit_affine(match_pairs(spark, sf_dir), F.col("prec"))
    points = spark.createDataFrame([("sw", 0.0, 0.0), ("ne", 20000.0, 20000.0), ("mid", 10000.0, 5000.0)], "name string, gx double, gy double")
    asked = fits.select("scene").crossJoin(F.broadcast(points))
    return _rounded(pairs.inverse_affine(fits, asked).select("scene", "name", "off_x", "off_y"), "off_x", "off_y", digits=3)


@query(
    "G8",
    _D
    + """, s AS (SELECT scene, median(dx) AS dx, median(dy) AS dy, greatest(stddev_pop(dx), stddev_pop(dy)) AS std, median(confidence) AS conf FROM d WHERE is_anchor GROUP BY scene),
p AS (SELECT scene, avg(dx) AS px, avg(dy) AS py FROM d WHERE NOT is_anchor GROUP BY scene)
SELECT scene, round(dx, 6) AS dx, round(dy, 6) AS dy, CASE WHEN sqrt(dx*dx+dy*dy) < 20 OR sqrt(dx*dx+dy*dy) > 1500 THEN 'shift out of range' WHEN std > 150 THEN 'anchors disagree' WHEN conf < 0.35 THEN 'low confidence' WHEN px IS NULL THEN 'no presearch'
 WHEN abs(dx-px) > 75 OR abs(dy-py) > 75 OR sqrt(pow(dx-px,2)+pow(dy-py,2)) > 100 THEN 'presearch disagrees' END AS reason FROM s LEFT JOIN p USING (scene)""",
)
def anchor_corroboration(spark, sf_dir):
    rows = match_pairs(spark, sf_dir)
    found = pairs.displaced(rows.filter(~F.col("is_anchor"))).groupBy("scene").agg(F.avg("dx").alias("pre_x"), F.avg("dy").alias("pre_y"))
    return _rounded(pairs.corroborated(rows.filter("is_anchor"), found), "dx", "dy")


@query("J16", f"WITH {PAIRS} SELECT scene, count(*) AS n FROM pairs p WHERE is_anchor AND NOT EXISTS (SELECT 1 FROM pairs q WHERE q.id = p.id AND q.confidence < 0.3) GROUP BY scene")
def rejected_anchor_anti_join(spark, sf_dir):
    rows = match_pairs(spark, sf_dir)
    weak = rows.filter("confidence < 0.3").select("id")
    return rows.filter("is_anchor").join(weak, "id", "left_anti").groupBy("scene").agg(F.count("*").alias("n"))


@query("J17")
def chamfer_distance(spark, sf_dir):
    return pairs.chamfer(match_pairs(spark, sf_dir))


@query("O6")
def spatial_dedup(spark, sf_dir):
    return iterative.spatial_dedup(match_pairs(spark, sf_dir).select("id", "scene", "confidence", "ref_x", "ref_y")).select("id", "scene")


@query("G4")
def iterative_outlier_removal(spark, sf_dir):
    return iterative.outlier_removal(match_pairs(spark, sf_dir)).select("id", "scene", "residual")


@query("G1 G3")
def ransac_affine(spark, sf_dir):
    return iterative.ransac_affine(match_pairs(spark, sf_dir))


@query("A21")
def cross_validation(spark, sf_dir):
    return iterative.cross_validate(match_pairs(spark, sf_dir))


@query("O5")
def gcp_selection(spark, sf_dir):
    return iterative.select_gcps(match_pairs(spark, sf_dir)).select("id", "scene")


@query("G12 G13 B15 B16")
def triangle_area_ratio(spark, sf_dir):
    rows = match_pairs(spark, sf_dir).select("id", "scene", "ref_x", "ref_y", "off_x", "off_y", "confidence")
    return iterative.triangle_filter(rows, keep=["id", "scene"])


@query("G7")
def reference_offset_correction(spark, sf_dir):
    """Anchors are given a shift of their own, which the automatic pairs must follow."""
    rows = match_pairs(spark, sf_dir)
    rows = rows.withColumn("ref_x", F.col("ref_x") + F.when(F.col("is_anchor"), 120.0).otherwise(0.0))
    got = pairs.correct_reference_offset(rows)
    return got.groupBy("scene", "corrected").agg(F.count("*").alias("n"), F.round(F.avg("ref_x"), 3).alias("mean_x"))


_PLAIN = _FIT.replace("prec", "1.0::DOUBLE")


@query("G24", f"WITH {PAIRS}, auto AS (SELECT * FROM pairs WHERE NOT is_anchor)" + _PLAIN.format(t="auto") + f", r AS ({_RES.format(t='auto')}), m AS (SELECT scene, avg(r) AS m FROM r GROUP BY scene) SELECT scene, count(*) AS n FROM pairs LEFT JOIN m USING (scene) WHERE is_anchor OR m < 10 GROUP BY scene")
def neural_quality_gate(spark, sf_dir):
    return pairs.quality_gate(match_pairs(spark, sf_dir), most_m=10.0).groupBy("scene").agg(F.count("*").alias("n"))


@query("G9", f"WITH {PAIRS}, anc AS (SELECT * FROM pairs WHERE is_anchor)" + _PLAIN.format(t="anc") + " SELECT scene, n, round(a, 6) AS a, round(ty, 3) AS ty FROM fit")
def initial_affine(spark, sf_dir):
    """Every scene of these pairs has four anchors or more."""
    return pairs.initial_affine(match_pairs(spark, sf_dir)).select("scene", "n", F.round("a", 6).alias("a"), F.round("ty", 3).alias("ty"))


@query("G27", f"WITH {PAIRS}, one AS (SELECT scene || '-' || ref_y AS scene, ref_x, ref_y, off_x, off_y FROM pairs WHERE is_anchor AND confidence > 0.95) SELECT scene, count(*) AS n, round(-median(off_x - ref_x), 6) + 0.0 AS tx, round(-median(off_y - ref_y), 6) + 0.0 AS ty FROM one GROUP BY scene HAVING count(*) < 3")
def translation_where_degenerate(spark, sf_dir):
    """Groups of one or two points have no affine. Places are whole metres, written out as SQL does: as a double, Spark
    writes ten million and more as 1.0E7."""
    rows = match_pairs(spark, sf_dir).filter("is_anchor and confidence > 0.95").withColumn("scene", F.concat("scene", F.lit("-"), F.col("ref_y").cast("long").cast("string"), F.lit(".0")))
    got = pairs.fit_or_shift(rows).filter("kind = 'translation' and n < 3")
    return got.select("scene", "n", (F.round("tx", 6) + 0.0).alias("tx"), (F.round("ty", 6) + 0.0).alias("ty"))
