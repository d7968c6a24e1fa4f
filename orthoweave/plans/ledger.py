"""Queries on files, missions, attempts and results."""

from __future__ import annotations

from pyspark.sql import functions as F

from orthoweave.operators import ledger
from orthoweave.plans.registry import query
from orthoweave.sources.roles import PAIRS, SCENES, match_pairs, table
from orthoweave.sources.roles import scenes as scene_table

_S = f"WITH {SCENES}"


@query(
    "S11",
    """WITH i AS (SELECT '/in/' || p_brand || '/p' || p_partkey || '.tif' AS path, '/in/' || p_brand AS own, 'p' || p_partkey AS stem, p_size, p_partkey FROM part),
n(k, s) AS (VALUES (0, '.priors.json'), (1, '.json'), (2, '.xml'), (3, '_metadata.xml')),
l AS (SELECT DISTINCT CASE WHEN p_partkey % 3 = 0 THEN '/priors' ELSE own END || '/' || stem || s AS file FROM i JOIN n ON p_size % 4 >= k),
a AS (SELECT path, k, '/priors/' || stem || s AS prior FROM i, n UNION ALL SELECT path, k + 4, own || '/' || stem || s FROM i, n)
SELECT path, prior, CAST(row_number() OVER (PARTITION BY path ORDER BY k) - 1 AS INTEGER) AS place FROM a JOIN l ON file = prior""",
)
def sidecar_paths(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    own, stem = F.concat(F.lit("/in/"), "p_brand"), F.concat(F.lit("p"), F.col("p_partkey"))
    images = part.select(F.concat(own, F.lit("/"), stem, F.lit(".tif")).alias("path"))
    names = F.slice(F.array(*[F.lit(s) for s in ledger.SIDECARS]), 1, F.col("p_size") % 4 + 1)
    listing = part.select(F.when(F.col("p_partkey") % 3 == 0, "/priors").otherwise(own).alias("d"), stem.alias("s"), F.explode(names).alias("n")).select(F.concat("d", F.lit("/"), "s", "n").alias("file"))
    return ledger.sidecars(images, listing, "/priors")


@query(
    "B98 B99 B135",
    _S
    + """, m AS (SELECT s_suppkey AS mission, CASE WHEN s_acctbal > 0 THEN s_acctbal END AS nominal_km, CASE WHEN s_suppkey % 2 = 0 THEN 150.0 + s_nationkey END AS p, 250.0 + s_nationkey AS a FROM supplier WHERE s_suppkey % 3 <> 0),
r AS (SELECT r_regionkey AS series, CASE WHEN r_regionkey <> 2 THEN 180.0 + r_regionkey END AS km FROM region)
SELECT entity_id, m.mission IS NOT NULL AS known, coalesce(m.nominal_km, (m.p + m.a) / 2, r.km) AS nominal_km FROM scenes LEFT JOIN m ON m.mission = scenes.mission LEFT JOIN r ON r.series = scenes.mission % 6""",
)
def mission_rows(spark, sf_dir):
    rows = scene_table(spark, sf_dir).select("entity_id", F.col("mission").cast("long").alias("mission"), (F.col("mission") % 6).alias("series"))
    s, one = F.col("s_suppkey"), F.col("s_nationkey")
    missions = table(spark, sf_dir, "supplier").filter(s % 3 != 0).select(s.alias("mission"), F.when(F.col("s_acctbal") > 0, F.col("s_acctbal")).alias("nominal_km"), F.when(s % 2 == 0, 150.0 + one).alias("perigee_km"), (250.0 + one).alias("apogee_km"))
    r = F.col("r_regionkey")
    series = table(spark, sf_dir, "region").select(r.alias("series"), F.when(r != 2, 180.0 + r).alias("nominal_km"), F.lit(None).cast("double").alias("perigee_km"), F.lit(None).cast("double").alias("apogee_km"))
    return ledger.mission_rows(rows, missions, series)


@query("F20", "SELECT s_suppkey AS mid, (150.0 + s_nationkey + 200.0 + s_suppkey % 90) / 2 AS mean_km, (50.0 + s_suppkey % 90 - s_nationkey) * 1000 / (2 * ((350.0 + s_nationkey + s_suppkey % 90) / 2 * 1000 + 6378137.0)) AS ecc, sqrt(3.986004418e14 / pow((350.0 + s_nationkey + s_suppkey % 90) / 2 * 1000 + 6378137.0, 3)) * 86400 / (2 * pi()) AS n_rev_per_day FROM supplier")
def satcat_orbits(spark, sf_dir):
    got = ledger.satcat_orbit(150.0 + F.col("s_nationkey"), 200.0 + F.col("s_suppkey") % 90)
    return table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("mid"), *[v.alias(k) for k, v in got.items()])


@query("P24", _S + ", p AS (SELECT n_nationkey AS mission, n_regionkey IN (1, 3) AS bad FROM nation) SELECT entity_id, coalesce(bad, false) AS unreliable FROM scenes LEFT JOIN p USING (mission)")
def unreliable_corners(spark, sf_dir):
    """Profiles whose corners can't be relied on are a flag of the profile; a scene without a profile has reliable ones."""
    flags = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("mission"), F.col("n_regionkey").isin(1, 3).alias("bad"))
    return scene_table(spark, sf_dir).join(flags, "mission", "left").select("entity_id", F.coalesce("bad", F.lit(False)).alias("unreliable"))


@query("K9 B5", """SELECT p_partkey AS k, left(sha256('{"brand":"' || p_brand || '","size":' || p_size || ',"steps":[' || p_size || ',' || p_partkey || ']}'), 16) AS hash FROM part""")
def parameter_hash(spark, sf_dir):
    values = F.struct(F.col("p_brand").alias("brand"), F.col("p_size").alias("size"), F.array(F.col("p_size").cast("long"), F.col("p_partkey")).alias("steps"))
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), ledger.parameter_hash(values).alias("hash"))


@query("K14", "SELECT p_partkey AS k, '/out/' || p_brand || '/georef/' || p_partkey || '.tif' AS georef, '/out/' || p_brand || '/meta/' || p_partkey || '.json' AS meta FROM part")
def layout_paths(spark, sf_dir):
    at = lambda kind, suffix: F.concat(F.concat_ws("/", F.lit("/out"), "p_brand", F.lit(kind), F.col("p_partkey").cast("string")), F.lit(suffix))
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), at("georef", ".tif").alias("georef"), at("meta", ".json").alias("meta"))


@query("B25 B142", "WITH c AS (SELECT p_brand || p_partkey AS of, md5(CAST(p_partkey - (p_partkey % 4 = 0)::INT AS VARCHAR)) AS d FROM part WHERE p_size > 10) SELECT p_brand || p_partkey AS path, md5(CAST(p_partkey AS VARCHAR)) AS digest, CASE WHEN c.of IS NULL THEN p_brand || p_partkey ELSE c.of || '.clean' END AS read FROM part LEFT JOIN c ON c.of = p_brand || p_partkey AND c.d = md5(CAST(p_partkey AS VARCHAR))")
def cleaned_sources(spark, sf_dir):
    """A cleaned copy is read only if it was made from the file as it is now."""
    part, k = table(spark, sf_dir, "part"), F.col("p_partkey")
    path, digest = F.concat("p_brand", k.cast("string")), lambda n: F.md5(n.cast("string").cast("binary"))
    held = part.filter("p_size > 10").select(path.alias("of"), digest(k - (k % 4 == 0).cast("int")).alias("of_digest"), F.concat(path, F.lit(".clean")).alias("copy"))
    return ledger.substituted(part.select(path.alias("path"), digest(k).alias("digest")), held)


@query("B144", "SELECT p_partkey AS k, CASE WHEN p_size % 5 = 0 THEN 'missing' WHEN p_size % 7 = 0 THEN 'changed: profile' WHEN p_partkey % 3 = 0 THEN 'changed: corners' END AS reason FROM part")
def cache_reuse(spark, sf_dir):
    k, s = F.col("p_partkey"), F.col("p_size")
    held = {"profile": F.when(s % 7 == 0, F.lit(None)).otherwise(F.col("p_brand")), "corners": F.when(k % 3 == 0, k + 1).otherwise(k)}
    return table(spark, sf_dir, "part").select(k.alias("k"), ledger.cache_verdict({"profile": F.col("p_brand"), "corners": k}, held, s % 5 != 0).alias("reason"))


_TRIES = "t AS (SELECT l_orderkey AS entity_id, l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-' || CAST(l_quantity AS INT) AS label, l_quantity AS score, l_returnflag = 'R' AS bad FROM lineitem)"


@query(
    "B38 B65 B66",
    f"WITH {_TRIES}, r AS (SELECT *, row_number() OVER (PARTITION BY entity_id, bad ORDER BY score, label) AS k FROM t), f AS (SELECT *, CASE WHEN bad THEN 'removed' WHEN k > 1 THEN 'deleted' WHEN score <= 20 THEN 'promoted' ELSE 'rejected' END AS fate FROM r) SELECT entity_id, label, CASE fate WHEN 'promoted' THEN label || '.tif' WHEN 'rejected' THEN label || '_rejected.tif' END AS output, fate = 'promoted' AS accepted, fate FROM f",
)
def attempt_outcomes(spark, sf_dir):
    label = F.concat_ws("-", F.col("l_linenumber").cast("string"), F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"), F.col("l_quantity").cast("int").cast("string"))
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("entity_id"), label.alias("label"), F.concat(label, F.lit(".tif")).alias("output"), F.col("l_quantity").alias("score"), F.lit(20.0).alias("limit"), F.when(F.col("l_returnflag") == "R", "failed").alias("error"))
    return ledger.attempts(rows)


@query("B140", "WITH h AS (SELECT p_partkey AS entity_id, CASE WHEN p_size % 2 = 0 THEN 'done' ELSE 'failed' END AS status FROM part WHERE p_partkey % 3 <> 0), t AS (SELECT p_partkey AS entity_id, 'done' AS status FROM part WHERE p_partkey % 5 <> 0) SELECT coalesce(h.entity_id, t.entity_id) AS entity_id, coalesce(t.status, h.status) AS status, t.status IS NOT NULL AND t.status IS DISTINCT FROM h.status AS written FROM h FULL JOIN t ON h.entity_id = t.entity_id")
def status_stamps(spark, sf_dir):
    part, k = table(spark, sf_dir, "part"), F.col("p_partkey")
    held = part.filter(k % 3 != 0).select(k.alias("entity_id"), F.when(F.col("p_size") % 2 == 0, "done").otherwise("failed").alias("status"))
    return ledger.stamped(held, part.filter(k % 5 != 0).select(k.alias("entity_id"), F.lit("done").alias("status")))


@query("B147", _S + " SELECT mission AS strip, entity_id, '/st/' || entity_id || '.tif' AS stitched, CAST(west AS VARCHAR) IS NOT NULL AS corners FROM scenes WHERE available AND designation = 'A'")
def strip_members(spark, sf_dir):
    rows = scene_table(spark, sf_dir)
    at = F.concat(F.lit("/st/"), F.col("entity_id").cast("string"), F.lit(".tif"))
    metadata = rows.select("entity_id", at.alias("stitched"), F.when(F.col("available"), F.col("west").isNotNull()).alias("corners"))
    return ledger.strip_members(rows.select(F.col("mission").alias("strip"), "entity_id"), metadata, rows.filter("designation = 'A'").select(at.alias("file")))


@query("F41", "SELECT p_partkey AS k, CASE WHEN p_size % 3 = 0 THEN p_brand END AS section, CASE WHEN p_size % 3 = 0 THEN 'a__b' ELSE p_brand END AS attr, p_size AS value FROM part")
def scoped_overrides(spark, sf_dir):
    name = F.when(F.col("p_size") % 3 == 0, F.concat("p_brand", F.lit("__a__b"))).otherwise(F.col("p_brand"))
    got = ledger.scoped(table(spark, sf_dir, "part").select(name.alias("name"), F.struct("p_partkey", "p_size").alias("value")))
    return got.select("value.p_partkey", "section", "attr", "value.p_size").toDF("k", "section", "attr", "value")


@query("B101 B102", _S + ", c AS (SELECT entity_id AS e, frame - 500.0 AS dx, frame % 300 - 100.0 AS dy FROM scenes WHERE available) SELECT entity_id AS path, west + CASE WHEN sqrt(dx * dx + dy * dy) <= 300 THEN dx ELSE 0 END AS x0, south + CASE WHEN sqrt(dx * dx + dy * dy) <= 300 THEN dy ELSE 0 END AS y0 FROM scenes LEFT JOIN c ON e = entity_id")
def moved_origins(spark, sf_dir):
    rows = scene_table(spark, sf_dir)
    shifts = rows.filter("available").select(F.col("entity_id").alias("path"), (F.col("frame") - 500.0).alias("dx"), (F.col("frame") % 300 - 100.0).alias("dy"))
    return ledger.moved_origins(rows.select(F.col("entity_id").alias("path"), F.col("west").alias("x0"), F.col("south").alias("y0")), shifts, bound=300.0)


_CELLS = f"WITH {PAIRS}, p AS (SELECT scene, CAST(CAST(floor(ref_y / 200) AS INT) % 12 AS INT) AS r, CAST(CAST(floor(ref_x / 10) AS INT) % 9 AS INT) AS c FROM pairs WHERE confidence > 0.9)"


def _cells(spark, sf_dir):
    k = lambda c, step, n: (F.floor(F.col(c) / step) % n).cast("int")
    return match_pairs(spark, sf_dir).filter("confidence > 0.9").select("scene", k("ref_y", 200, 12).alias("r"), k("ref_x", 10, 9).alias("c"))


@query("U3", _CELLS + ", g AS (SELECT scene, CAST(r AS INT) AS r, CAST(c AS INT) AS c FROM (SELECT DISTINCT scene FROM p), range(14) a(r), range(11) b(c)) SELECT scene, r, c FROM g EXCEPT SELECT scene, r, c FROM p")
def empty_cells(spark, sf_dir):
    return ledger.empty_cells(_cells(spark, sf_dir), 14, 11, by="scene")


@query("U4", _CELLS + ", l AS (SELECT DISTINCT scene, r, c FROM p WHERE (r + c) % 2 = 0 UNION SELECT scene, r, 50 FROM p), h AS (SELECT DISTINCT scene, r, c FROM p) SELECT scene, count(h.r) AS occupied, count(*) AS cells, count(h.r) / count(*) AS share FROM l LEFT JOIN h USING (scene, r, c) GROUP BY scene")
def land_coverage(spark, sf_dir):
    held = _cells(spark, sf_dir)
    land = held.filter("(r + c) % 2 = 0").unionByName(held.withColumn("c", F.lit(50)))
    return ledger.land_coverage(held, land, by="scene")


@query(
    "U7",
    """WITH p AS (SELECT user_id AS scene, CASE event_id % 3 WHEN 0 THEN 'heuristic' WHEN 1 THEN 'coastal_obia' ELSE 'water' END AS mode, (value - floor(value)) AS ncc FROM events),
a AS (SELECT DISTINCT user_id AS scene, CASE user_id % 3 WHEN 0 THEN 'heuristic' WHEN 1 THEN 'coastal_obia' ELSE 'water' END AS mode FROM events),
m AS (SELECT scene, mode, 0 AS place FROM a UNION ALL SELECT scene, CASE mode WHEN 'heuristic' THEN 'coastal_obia' ELSE 'heuristic' END, 1 FROM a WHERE mode <> 'water'),
f AS (SELECT scene, place, mode, count(*) AS n, max(ncc) AS best FROM p JOIN m USING (scene, mode) WHERE ncc >= 0.6 GROUP BY ALL)
SELECT scene, mode, n, best FROM f QUALIFY row_number() OVER (PARTITION BY scene ORDER BY place) = 1""",
)
def mode_ladder(spark, sf_dir):
    rows = table(spark, sf_dir, "events")
    mode = lambda k: F.when(F.col(k) % 3 == 0, "heuristic").when(F.col(k) % 3 == 1, "coastal_obia").otherwise("water")
    peaks = rows.select(F.col("user_id").alias("scene"), mode("event_id").alias("mode"), (F.col("value") - F.floor("value")).alias("ncc"))
    return ledger.mode_peaks(peaks, rows.select(F.col("user_id").alias("scene"), mode("user_id").alias("mode")).distinct(), 0.6)


_FR = "f AS (SELECT l_orderkey AS strip, l_linenumber AS i, CAST(min(l_partkey % 50) AS BIGINT) AS lo, CAST(min(l_partkey % 50) + max(CAST(l_quantity AS BIGINT)) AS BIGINT) AS hi FROM lineitem GROUP BY ALL)"


@query("J12", f"WITH {_FR} SELECT a.strip, a.i, b.i AS j, least(a.hi, b.hi) - greatest(a.lo, b.lo) AS overlap FROM f a JOIN f b ON a.strip = b.strip AND a.i <> b.i WHERE least(a.hi, b.hi) > greatest(a.lo, b.lo)")
def frame_pairs(spark, sf_dir):
    lo = F.min(F.col("l_partkey") % 50)
    frames = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("strip"), F.col("l_linenumber").alias("i")).agg(lo.alias("lo"), (lo + F.max(F.col("l_quantity").cast("long"))).alias("hi"))
    return ledger.frame_pairs(frames, by="strip")


@query("W5", f"WITH {PAIRS}, i AS (SELECT scene, id, confidence, CAST(floor(ref_x / 250) AS BIGINT) AS c, CAST(floor((ref_y - 200) / 400) AS BIGINT) AS r FROM pairs WHERE confidence >= 0.5) SELECT scene, r, c, id FROM i WHERE c BETWEEN 0 AND 39 AND r BETWEEN 0 AND 19 QUALIFY row_number() OVER (PARTITION BY scene, r, c ORDER BY confidence DESC, id) = 1")
def best_anchor_per_cell(spark, sf_dir):
    pts = match_pairs(spark, sf_dir).select("scene", "id", F.col("ref_x").alias("x"), F.col("ref_y").alias("y"), "confidence")
    return ledger.best_per_cell(pts, by="scene", left=0.0, bottom=200.0, right=10000.0, top=8200.0, rows=20, cols=40, least=0.5)


@query("W9", "WITH m AS (SELECT event_type || user_id AS metric, min(value) FILTER (event_id % 2 = 0) AS base, max(value) FILTER (event_id % 2 = 1) AS value FROM events GROUP BY ALL) SELECT metric, value, base, value - base AS delta, CASE WHEN base IS NULL THEN 'new' WHEN value - base > abs(base) * 0.05 THEN 'worse' WHEN value - base < -abs(base) * 0.05 THEN 'better' ELSE 'same' END AS verdict FROM m WHERE value IS NOT NULL")
def run_comparison(spark, sf_dir):
    rows = table(spark, sf_dir, "events").withColumn("metric", F.concat("event_type", F.col("user_id").cast("string")))
    base = rows.filter("event_id % 2 = 0").groupBy("metric").agg(F.min("value").alias("value"))
    return ledger.compared(rows.filter("event_id % 2 = 1").groupBy("metric").agg(F.max("value").alias("value")).filter("value is not null"), base)


@query("B161", "SELECT p_partkey AS id, 's' || p_size AS suite, t AS test, CASE WHEN t = 'b' AND p_size % 2 = 0 THEN 'failed' WHEN t = 'c' THEN 'skipped' ELSE 'passed' END AS status, CASE t WHEN 'a' THEN p_size / 4.0::DOUBLE ELSE 1.5::DOUBLE END AS seconds FROM part, (VALUES ('a'), ('b'), ('c')) v(t) WHERE p_partkey % 10 <> 3")
def junit_cases(spark, sf_dir):
    """Every tenth report is cut off, and gives no rows."""
    s = F.col("p_size")
    fail = F.when(s % 2 == 0, '<failure message="x">trace</failure>').otherwise("")
    xml = F.concat(F.lit('<testsuite name="s'), s.cast("string"), F.lit('"><testcase name="a" time="'), (s / 4.0).cast("string"), F.lit('"/><testcase name="b" time="1.5">'), fail, F.lit('</testcase><testcase name="c" time="1.5"><skipped message="y"/></testcase></testsuite>'))
    cut = F.when(F.col("p_partkey") % 10 == 3, F.substring(xml, 1, 40)).otherwise(xml)
    return ledger.junit_cases(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), cut.alias("xml")))


@query("J2 J4 B24 B34 B46", _S + ", o AS (SELECT entity_id, greatest(west, 50.4) AS w, greatest(south, 25.4) AS s, least(east, 51.2) AS e, least(north, 26.2) AS n FROM scenes) SELECT entity_id, CASE WHEN w < e AND s < n THEN (w + e) / 2 END AS lon, CASE WHEN w < e AND s < n THEN (s + n) / 2 END AS lat, CASE WHEN w < e AND s < n THEN CAST(32601 + floor(((w + e) / 2 + 180) / 6) AS INTEGER) END AS zone, CASE WHEN NOT (w < e AND s < n) THEN 'no overlap' END AS error FROM o")
def work_region(spark, sf_dir):
    """The overlap of each scene with the reference, its centre and zone; without overlap the error is a value of the row."""
    w, s, e, n = F.greatest("west", F.lit(50.4)), F.greatest("south", F.lit(25.4)), F.least("east", F.lit(51.2)), F.least("north", F.lit(26.2))
    meets = (w < e) & (s < n)
    zone = (32601 + F.floor(((w + e) / 2 + 180) / 6)).cast("int")
    return scene_table(spark, sf_dir).select("entity_id", F.when(meets, (w + e) / 2).alias("lon"), F.when(meets, (s + n) / 2).alias("lat"), F.when(meets, zone).alias("zone"), F.when(~meets, "no overlap").alias("error"))


@query("B67 B159", "WITH t AS (SELECT user_id AS scene, event_type AS stage, sum(value) AS wall, sum(CASE WHEN event_id % 3 = 0 THEN value * 2 ELSE value / 2 END) AS cpu, max(event_id) FILTER (event_type = 'error') AS bad FROM events GROUP BY ALL) SELECT scene, stage, CASE WHEN bad IS NOT NULL THEN 'incoherent' WHEN wall > 100 THEN 'slow' ELSE 'ok' END AS status, round(greatest(0, wall - cpu), 4) AS waits FROM t")
def section_waits(spark, sf_dir):
    """Wall time of sections less their CPU time, never below 0; an incoherent status wins over the others."""
    v = F.col("value")
    got = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("scene"), F.col("event_type").alias("stage")).agg(F.sum("value").alias("wall"), F.sum(F.when(F.col("event_id") % 3 == 0, v * 2).otherwise(v / 2)).alias("cpu"), F.max(F.when(F.col("event_type") == "error", F.col("event_id"))).alias("bad"))
    status = F.when(F.col("bad").isNotNull(), "incoherent").when(F.col("wall") > 100, "slow").otherwise("ok")
    return got.select("scene", "stage", status.alias("status"), F.round(F.greatest(F.lit(0.0), F.col("wall") - F.col("cpu")), 4).alias("waits"))


@query("B78", "SELECT l_orderkey AS k, l_linenumber AS line, l_partkey AS part, CASE WHEN l_linenumber % 3 > 0 THEN l_quantity END AS col, CASE WHEN l_linenumber % 3 > 0 THEN l_discount END AS gy FROM lineitem")
def legacy_records(spark, sf_dir):
    """Tuples of four values or more become records, shorter ones nulls."""
    four = F.array("l_quantity", "l_tax", "l_extendedprice", "l_discount")
    values = F.when(F.col("l_linenumber") % 3 > 0, four).otherwise(F.slice(four, 1, 3))
    at = lambda i: F.when(F.size(values) >= 4, F.get(values, F.lit(i)))
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("line"), F.col("l_partkey").alias("part"), at(0).alias("col"), at(3).alias("gy"))


@query("J20", _S + ", a AS (SELECT s_suppkey AS e, s_acctbal AS alt FROM supplier) SELECT e AS entity_id, scenes.entity_id IS NOT NULL AS known, mission, alt FROM a LEFT JOIN scenes ON scenes.entity_id = e")
def altitude_by_scene(spark, sf_dir):
    """Altitudes that name a scene by its id, with that scene; unknown ids stay."""
    rows = scene_table(spark, sf_dir).select("entity_id", "mission", F.lit(True).alias("is"))
    alts = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("entity_id"), F.col("s_acctbal").alias("alt"))
    return alts.join(rows, "entity_id", "left").select("entity_id", F.coalesce("is", F.lit(False)).alias("known"), "mission", "alt")
