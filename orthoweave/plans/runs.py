"""Queries on run histories, QA reports, layers and scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from orthoweave.operators import quality, runs
from orthoweave.plans.registry import query
from orthoweave.sources.roles import SCENES, TELEMETRY, scenes, table, telemetry

_T = f"WITH {TELEMETRY}"


@query("W7", _T + " SELECT scene, arg_min(seq, (residual_m, seq)) AS best FROM telemetry WHERE accepted AND residual_m IS NOT NULL GROUP BY scene")
def best_version(spark, sf_dir):
    return runs.best_version(telemetry(spark, sf_dir).filter("accepted"), by="scene", version="seq", field="residual_m")


@query("W8", _T + " SELECT seq, round(residual_m - lag(residual_m) OVER (PARTITION BY scene ORDER BY seq), 9) AS delta, round(residual_m - first_value(residual_m) OVER (PARTITION BY scene ORDER BY seq), 9) AS delta_first FROM telemetry")
def version_deltas(spark, sf_dir):
    got = runs.deltas(telemetry(spark, sf_dir), by="scene", version="seq", field="residual_m")
    return got.select("seq", F.round("delta", 9).alias("delta"), F.round("delta_first", 9).alias("delta_first"))


@query("W14", _T + " SELECT scene, max(seq) + 1 AS next FROM telemetry GROUP BY scene")
def next_version(spark, sf_dir):
    return telemetry(spark, sf_dir).groupBy("scene").agg((F.max("seq") + 1).alias("next"))


@query("W15", _T + ", k AS (SELECT scene, seq, row_number() OVER (PARTITION BY scene ORDER BY seq DESC) AS n, row_number() OVER (PARTITION BY scene ORDER BY residual_m NULLS LAST, seq) AS b FROM telemetry) SELECT scene, seq FROM k WHERE n <= 3 OR b = 1")
def run_retention(spark, sf_dir):
    return runs.retained(telemetry(spark, sf_dir), by="scene", version="seq", score="residual_m").select("scene", "seq")


@query("K4 B156", _T + " SELECT scene, stage, arg_max(accepted, seq) AS accepted, arg_max(residual_m, seq) AS residual_m FROM telemetry GROUP BY ALL")
def latest_status(spark, sf_dir):
    return runs.latest(telemetry(spark, sf_dir), by=["scene", "stage"], seq="seq", value=["accepted", "residual_m"])


@query("A28 A27", _T + " SELECT coalesce(stage, 'all') AS stage, coalesce(CAST(accepted AS VARCHAR), 'all') AS status, count(*) AS n FROM telemetry GROUP BY ROLLUP (stage, accepted)")
def status_rollup(spark, sf_dir):
    return runs.status_rollup(telemetry(spark, sf_dir), stage="stage", status="accepted")


@query("K12", _T + ", p AS (SELECT 'run' AS section, residual_m AS v FROM telemetry UNION ALL SELECT 'run.' || stage, residual_m FROM telemetry UNION ALL SELECT 'run.' || stage || '.s' || scene % 10, residual_m FROM telemetry) SELECT section, round(sum(v), 4) AS total, count(*) AS n FROM p GROUP BY section")
def section_rollup(spark, sf_dir):
    rows = telemetry(spark, sf_dir).select(F.concat_ws(".", F.lit("run"), "stage", F.concat(F.lit("s"), F.col("scene") % 10)).alias("path"), "residual_m")
    return runs.section_rollup(rows, path="path", value="residual_m").withColumn("total", F.round("total", 4))


_REPORTS = "rep AS (SELECT l_orderkey AS job, 'c' || l_linenumber AS candidate, bool_or(l_returnflag <> 'R') AS accepted, max(l_extendedprice / 100) AS total_score, max(l_discount * 10) AS confidence FROM lineitem GROUP BY ALL)"


def _reports(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("job"), F.concat(F.lit("c"), "l_linenumber").alias("candidate")).agg(F.bool_or(F.col("l_returnflag") != "R").alias("accepted"), F.max(F.col("l_extendedprice") / 100).alias("total_score"), F.max(F.col("l_discount") * 10).alias("confidence"))


@query("O1 O2 O13", f"WITH {_REPORTS} SELECT job, candidate, accepted, total_score, confidence FROM (SELECT *, row_number() OVER (PARTITION BY job ORDER BY accepted DESC, total_score, confidence DESC, candidate) AS k FROM rep) WHERE k = 1")
def ranked_candidates(spark, sf_dir):
    return quality.best_candidate(_reports(spark, sf_dir), by="job")


@query("P25 P26", f"WITH {_REPORTS}, a AS (SELECT job, coalesce(bool_or(accepted) FILTER (candidate = 'c1'), bool_or(accepted)) AS accepted, max(confidence) AS confidence FROM rep GROUP BY job) SELECT job, accepted, NOT accepted OR confidence < 0.35 AS abstains FROM a")
def output_accepted(spark, sf_dir):
    rows = _reports(spark, sf_dir).withColumn("selected", F.lit("c1"))
    conf = rows.groupBy("job").agg(F.max("confidence").alias("confidence"))
    got = runs.output_accepted(rows, by="job", selected="selected").join(conf, "job")
    return got.select("job", "accepted", quality.abstains(F.col("accepted"), F.col("confidence")).alias("abstains"))


@query("A7", f"WITH {SCENES}, q AS (SELECT l_orderkey AS entity_id, bool_or(l_returnflag = 'R') AS ok FROM lineitem GROUP BY ALL) SELECT mission, designation, string_agg(CAST(entity_id AS VARCHAR), ',' ORDER BY entity_id) AS members, count(*) AS n FROM scenes JOIN q USING (entity_id) WHERE ok GROUP BY ALL")
def mosaic_groups(spark, sf_dir):
    qa = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("entity_id"), (F.col("l_returnflag") == "R").alias("accepted"))
    got = runs.mosaic_groups(scenes(spark, sf_dir), qa, by=["mission", "designation"])
    return got.withColumn("members", F.array_join(F.col("members").cast("array<string>"), ","))


@query("O14", "SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN 'ortho' WHEN p_size % 3 = 0 THEN 'georef' ELSE 'stitched' END AS source, 'f' || p_size AS path FROM part")
def preferred_input(spark, sf_dir):
    s, path = F.col("p_size"), F.concat(F.lit("f"), "p_size")
    got = runs.preferred(ortho=F.when(s % 2 == 0, path), georef=F.when(s % 3 == 0, path), stitched=path)
    return table(spark, sf_dir, "part").select("p_partkey", got.alias("g")).select("p_partkey", "g.source", "g.path")


@query("W12", "WITH t AS (SELECT p_partkey, p_brand, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS rnd, min(p_partkey) OVER (PARTITION BY p_brand) AS f FROM part) SELECT p_partkey, rnd AS round, f AS first FROM t")
def interleaved_tiles(spark, sf_dir):
    got = runs.interleaved(table(spark, sf_dir, "part").select("p_partkey", "p_brand"), bucket="p_brand", order="p_partkey")
    return got.select("p_partkey", F.col("round").cast("long").alias("round"), "first")


@query("B163", "WITH n AS (SELECT p_brand, count(*) AS n FROM part GROUP BY ALL), t AS (SELECT sum(n) AS a, count(*) AS k FROM n) SELECT p_partkey, round(a::DOUBLE / k / n, 9) AS weight FROM part JOIN n USING (p_brand), t")
def sampling_weights(spark, sf_dir):
    got = runs.sampling_weights(table(spark, sf_dir, "part").select("p_partkey", "p_brand"), source="p_brand")
    return got.select("p_partkey", F.round("weight", 9).alias("weight"))


@query("J15 B162", "WITH l AS (SELECT n_name AS slug, 1960 + n_nationkey % 12 AS year, CASE WHEN n_nationkey % 5 = 0 THEN 'modern' ELSE 'kh' END AS kind FROM nation) SELECT a.slug AS older, b.slug AS newer FROM l a JOIN l b ON (a.kind = 'kh' AND b.kind = 'modern') OR (a.kind = 'kh' AND b.kind = 'kh' AND (a.year < b.year OR (a.year = b.year AND a.slug < b.slug)))")
def layer_pairs(spark, sf_dir):
    k = F.col("n_nationkey")
    rows = table(spark, sf_dir, "nation").select(F.col("n_name").alias("slug"), (k % 12 + 1960).alias("year"), F.when(k % 5 == 0, "modern").otherwise("kh").alias("kind"))
    return runs.layer_pairs(rows)


_QA = """q AS (SELECT p_partkey AS k, CASE WHEN p_size % 6 <> 0 THEN p_size * 3.0::DOUBLE END AS img, CASE WHEN p_size % 7 <> 0 THEN p_size * 1.5::DOUBLE END AS hm, CASE WHEN p_size % 7 <> 0 THEN p_size * 2.5::DOUBLE END AS hp, CASE WHEN p_size % 5 <> 0 THEN p_size * 2.0::DOUBLE END AS cv, (p_partkey % 40) / 100.0::DOUBLE AS cov FROM part)"""


def _qa(spark, sf_dir):
    s = F.col("p_size")
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("k"), F.when(s % 6 != 0, s * 3.0).alias("img"), F.when(s % 7 != 0, s * 1.5).alias("hm"), F.when(s % 7 != 0, s * 2.5).alias("hp"), F.when(s % 5 != 0, s * 2.0).alias("cv"), ((F.col("p_partkey") % 40) / 100.0).alias("cov")
    )


@query(
    "F31 F32 F33 F34 F35 B64",
    f"""WITH {_QA}, c AS (SELECT *, [x FOR x IN [CASE WHEN img IS NOT NULL THEN least(1, greatest(0, 1 - img / 200)) END, CASE WHEN hm IS NOT NULL THEN least(1, greatest(0, 1 - hm / 120)) END, CASE WHEN hp IS NOT NULL THEN least(1, greatest(0, 1 - hp / 180)) END, CASE WHEN cv IS NOT NULL THEN least(1, greatest(0, 1 - cv / 120)) END, least(1, greatest(0, cov / 0.35::DOUBLE))] IF x IS NOT NULL] AS parts FROM q)
SELECT k, round(coalesce(img, 0) + coalesce(0.6::DOUBLE * hm, 0) + coalesce(0.25::DOUBLE * hp, 0) + coalesce(0.35::DOUBLE * cv, 0) + greatest(0, (0.12::DOUBLE - cov) * 400), 6) AS total, round(list_sum(parts) / len(parts), 9) AS confidence,
CASE WHEN hm IS NULL THEN 'D' WHEN (img IS NULL OR img <= 40) AND hm <= 30 AND (cv IS NULL OR cv <= 30) THEN 'A' WHEN (img IS NULL OR img <= 80) AND hm <= 60 AND (cv IS NULL OR cv <= 60) THEN 'B' WHEN (img IS NULL OR img <= 140) AND hm <= 90 AND (cv IS NULL OR cv <= 90) THEN 'C' ELSE 'D' END AS grade,
array_to_string([x FOR x IN [CASE WHEN img > 140 THEN 'image_alignment_score_high' END, CASE WHEN hm > 90 THEN 'holdout_residual_high' END, CASE WHEN cv > 90 THEN 'cross_validation_high' END, CASE WHEN img IS NOT NULL AND cov < 0.1::DOUBLE THEN 'gcp_coverage_low' END, CASE WHEN hm > cv * 1.5 OR hp > cv * 1.5 THEN 'post_warp_holdout_regression' END] IF x IS NOT NULL], ',') AS reasons FROM c""",
)
def candidate_report(spark, sf_dir):
    img, hm, hp, cv, cov = (F.col(c) for c in ("img", "hm", "hp", "cv", "cov"))
    why = quality.reasons(F.lit("grid"), img, hm, cv, cov, (hm, hp), (cv, cv))
    return _qa(spark, sf_dir).select(
        "k", F.round(quality.total_score(img, hm, hp, cv, cov), 6).alias("total"), F.round(quality.confidence(img, hm, hp, cv, cov), 9).alias("confidence"), quality.grade(img, hm, cv).alias("grade"), F.array_join(why, ",").alias("reasons")
    )


@query(
    "A26 B157",
    f"""WITH {_QA}, w AS (SELECT *, least(1.0, cov / 0.25::DOUBLE) AS sh, CASE WHEN cv IS NULL THEN 1.0 ELSE greatest(0.3, 1 - 0.06 * greatest(0.0, cv / 4 - 5)) END::DOUBLE AS era FROM q),
g AS (SELECT *, 0.55::DOUBLE * sh AS gw, CASE WHEN cov > 0 THEN 0.25 + 0.55::DOUBLE * (1 - sh) ELSE 0.8 END AS pw FROM w)
SELECT k, round((gw - gw * (1 - era)) * coalesce(img, 500) + (pw + gw * (1 - era)) * 50 + coalesce(least(18, hm * 18 / 50) * least(1, greatest(0, (k % 300 - 50) / 150.0::DOUBLE)), 0) + coalesce(least(12, hp * 12 / 50) * least(1, greatest(0, (k % 500 - 50) / 150.0::DOUBLE)), 0), 6) AS score FROM g""",
)
def image_score(spark, sf_dir):
    k = F.col("k")
    score = quality.image_score(F.col("img"), F.col("cov"), F.lit(50.0), quality.era_factor(F.col("cv") / 4), (F.col("hm"), k % 300), (F.col("hp"), k % 500))
    return _qa(spark, sf_dir).select("k", F.round(score, 6).alias("score"))


@query("O12 P27", "WITH m AS (SELECT p_partkey AS k, p_size % 13 - 1 AS a, p_size % 11 - 1 AS b, p_retailprice % 97 AS ma, p_size * 2.0::DOUBLE AS mb FROM part) SELECT k, CASE WHEN a <= 0 AND b <= 0 THEN NULL WHEN a <= 0 THEN 'second' WHEN b <= 0 THEN 'first' WHEN b > a * 1.05 THEN 'second' WHEN a > b * 1.05 THEN 'first' WHEN mb <= ma THEN 'second' ELSE 'first' END AS better, a >= 8 AND mb / 50 > 0.45 AND mb / 50 < 1.8 AS gate FROM m")
def better_affine(spark, sf_dir):
    s = F.col("p_size")
    a, b, ma, mb = s % 13 - 1, s % 11 - 1, F.col("p_retailprice") % 97, s * 2.0
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), quality.better_affine(a, ma, b, mb).alias("better"), quality.neural_gate(a, mb / 50).alias("gate"))


@query("P28", _T + ", p AS (SELECT scene, seq % 100 AS x, seq * 7 % 100 AS y FROM telemetry) SELECT scene, count(*) AS n, count(DISTINCT least(5, floor(x / 100.0::DOUBLE * 6))) AS bins, count(*) >= 8 AND max(x) - min(x) >= 45 AND max(y) - min(y) >= 18 AND count(DISTINCT least(5, floor(x / 100.0::DOUBLE * 6))) >= 4 AS observable FROM p GROUP BY scene")
def observability(spark, sf_dir):
    pts = telemetry(spark, sf_dir).select("scene", (F.col("seq") % 100).alias("x"), (F.col("seq") * 7 % 100).alias("y"))
    return quality.observable(pts, by="scene", width=F.lit(100), height=F.lit(100))


@query("B133 B134", "SELECT n_name AS slug FROM nation WHERE n_nationkey % 5 <> 0 AND n_name >= 'G'")
def layers_of_a_kind(spark, sf_dir):
    kind = F.when(F.col("n_nationkey") % 5 == 0, "modern").otherwise("kh")
    return table(spark, sf_dir, "nation").filter((kind == "kh") & (F.col("n_name") >= "G")).select(F.col("n_name").alias("slug"))
