"""Queries on orbits."""

from __future__ import annotations

from pyspark.sql import functions as F

from orthoweave.operators import orbits
from orthoweave.plans.registry import query
from orthoweave.sources.roles import SCENES, TELEMETRY, scenes, table, telemetry


def _lines(spark, sf_dir):
    """A text of two-line element sets a supplier, with name lines between: (file, seq, value)."""
    k = F.col("s_suppkey")
    one = F.rpad(F.concat(F.lit("1 00001U 65001A   "), F.lpad((60 + k % 25).cast("string"), 2, "0"), F.lpad(F.format_string("%.8f", 1.0 + k % 360 + (k % 8) / 8.0), 12, "0")), 69, " ")
    two = F.rpad(F.concat(F.lit("2 00001  65.0000 100.0000 "), F.lpad((k * 37 % 90000).cast("string"), 7, "0"), F.lit("  50.0000 310.0000 "), F.lpad(F.format_string("%.8f", 15.5 + (k % 100) / 100.0), 11, " ")), 69, " ")
    rows = table(spark, sf_dir, "supplier").select(k.alias("file"), F.posexplode(F.array(F.lit("SAT"), one, two, F.lit("1 torn"), F.lit(""))).alias("seq", "value"))
    return rows


_E = "e AS (SELECT s_suppkey AS file, 60 + s_suppkey % 25 AS yy, 1 + s_suppkey % 360 + (s_suppkey % 8) / 8.0::DOUBLE AS day, 15.5::DOUBLE + (s_suppkey % 100) / 100.0::DOUBLE AS n, (s_suppkey * 37 % 90000) / 1e7::DOUBLE AS ecc FROM supplier)"


@query("S17 F16 F19", f"WITH {_E} SELECT file, make_timestamp(1900 + yy, 1, 1, 0, 0, 0.0) + to_microseconds(CAST(round((day - 1) * 86400000000) AS BIGINT)) AS epoch, round(ecc, 7) AS ecc, round(n, 8) AS n FROM e")
def element_sets(spark, sf_dir):
    got = orbits.element_sets(_lines(spark, sf_dir))
    return got.select("file", orbits.epoch(F.col("line1")).alias("epoch"), F.round(orbits.eccentricity(F.col("line2")), 7).alias("ecc"), F.round(orbits.mean_motion(F.col("line2")), 8).alias("n"))


@query("F17 F18 F22", f"WITH {_E}, a AS (SELECT file, ecc, pow(3.986004418e14 / pow(n * 2 * pi() / 86400, 2), 1.0::DOUBLE/3) AS a FROM e) SELECT file, round(a * (1 - ecc) - 6378137, 3) AS perigee_m, round(a - 6378137, 3) AS mean_m, round(a * (1 + ecc) - 6378137, 3) AS apogee_m, CASE WHEN a - 6378137 BETWEEN 140000 AND 280000 THEN round(a - 6378137, 3) END AS usable_m FROM a")
def orbit_altitudes(spark, sf_dir):
    got = orbits.element_sets(_lines(spark, sf_dir))
    alt = orbits.altitudes(orbits.mean_motion(F.col("line2")), orbits.eccentricity(F.col("line2")))
    return got.select("file", *[F.round(v, 3).alias(k) for k, v in alt.items()], F.round(orbits.in_range(alt["mean_m"]), 3).alias("usable_m"))


@query(
    "J6 J7",
    f"""WITH {TELEMETRY}, q AS (SELECT seq, scene, ts FROM telemetry WHERE stage = 'error'), r AS (SELECT seq, scene, ts FROM telemetry WHERE stage <> 'error'),
j AS (SELECT q.seq, r.seq AS rs, row_number() OVER (PARTITION BY q.seq ORDER BY abs(epoch_us(r.ts) - epoch_us(q.ts)), r.seq) AS k FROM q JOIN r USING (scene))
SELECT q.seq, q.scene, rs AS right_seq FROM q LEFT JOIN j ON q.seq = j.seq AND k = 1""",
)
def nearest_record(spark, sf_dir):
    rows = telemetry(spark, sf_dir)
    errors, others = rows.filter("stage = 'error'").select("seq", "scene", "ts"), rows.filter("stage <> 'error'").select("seq", "scene", "ts")
    return orbits.nearest_in_time(errors, others, by=["scene"], left_ts="ts", right_ts="ts", tie="seq").select("seq", "scene", "right_seq")


@query("W3", f"WITH {TELEMETRY}, s AS (SELECT scene, min(ts) AS a, max(ts) AS b FROM telemetry GROUP BY scene), p AS (SELECT scene, a, b, label, part FROM s, (VALUES ('Q0_start', 0.0), ('Q1_25%', 0.25), ('Q2_50%', 0.5), ('Q3_75%', 0.75), ('Q4_end', 1.0)) v(label, part) WHERE b > a OR label = 'Q0_start') SELECT scene, CASE WHEN b > a THEN label ELSE 't=start' END AS label, make_timestamp(epoch_us(a) + CAST(round((epoch_us(b) - epoch_us(a)) * part::DOUBLE) AS BIGINT)) AS at FROM p")
def quarter_samples(spark, sf_dir):
    spans = telemetry(spark, sf_dir).groupBy("scene").agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
    return orbits.quarter_samples(spans, by="scene")


@query(
    "F10 F21 A33 B100",
    """WITH m AS (SELECT p_partkey AS k, CASE WHEN p_size % 3 = 0 THEN p_size * 8000.0::DOUBLE END AS tle_mean_m, CASE WHEN p_size % 4 = 0 THEN 150.0::DOUBLE END AS per, CASE WHEN p_size % 4 = 0 THEN 350.0::DOUBLE - p_size END AS apo, CASE WHEN p_size % 5 = 0 THEN 300.0::DOUBLE END AS nom, 180.0::DOUBLE + p_size % 3 AS ser FROM part),
g AS (SELECT k, CASE WHEN tle_mean_m BETWEEN 140000 AND 280000 THEN tle_mean_m END AS t, CASE WHEN (per + apo) / 2 * 1000 BETWEEN 140000 AND 280000 THEN (per + apo) / 2 * 1000 END AS c, coalesce(nom, ser) * 1000 AS n FROM m)
SELECT k, coalesce(t, c, n) AS altitude_m, CASE WHEN t IS NOT NULL THEN 'tle' WHEN c IS NOT NULL THEN 'catalog' ELSE 'nominal' END AS altitude_source, round(coalesce(t, c, n) * 7 * 1e-6 / (609.6 * 1e-3), 6) AS gsd_m FROM g""",
)
def altitude_ladder(spark, sf_dir):
    s = F.col("p_size")
    rows = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("k"), F.when(s % 3 == 0, s * 8000.0).alias("tle_mean_m"), F.when(s % 4 == 0, 150.0).alias("perigee_km"), F.when(s % 4 == 0, 350.0 - s).alias("apogee_km"), F.when(s % 5 == 0, 300.0).alias("nominal_km"), (s % 3 + 180.0).alias("series_nominal_km")
    )
    got = orbits.altitude_ladder(rows)
    return got.select("k", "altitude_m", "altitude_source", F.round(orbits.ground_sample_m(F.col("altitude_m"), F.lit(7.0), F.lit(609.6)), 6).alias("gsd_m"))


@query("B151", f"WITH {SCENES} SELECT mission % 5 AS series, count(*) AS n, min(acq_date) AS first, max(acq_date) AS last FROM scenes GROUP BY ALL")
def series_report(spark, sf_dir):
    return scenes(spark, sf_dir).groupBy((F.col("mission") % 5).alias("series")).agg(F.count("*").alias("n"), F.min("acq_date").alias("first"), F.max("acq_date").alias("last"))
