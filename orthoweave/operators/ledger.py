"""Bookkeeping of files, missions, attempts and results, as expressions and joins on tables of them.

A missing partner gives nulls, never an error; of equal candidates the first in the stated order counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Names of a sidecar after an image's stem, in the order of search.
SIDECARS = (".priors.json", ".json", ".xml", "_metadata.xml")
#: The Earth's gravitational parameter (m^3/s^2) and equatorial radius (m).
MU, EARTH = 3.986004418e14, 6378137.0
#: The mask mode that is tried after one without peaks.
FALLBACK = {"coastal_obia": "heuristic", "heuristic": "coastal_obia"}


def sidecars(images: DataFrame, listing: DataFrame, priors_dir: str | None = None) -> DataFrame:
    """path, prior, place: the files of listing (file) that go with each image (path), the priors' folder first.

    The join is by shuffle: Spark takes either side for smaller than its exploded names are, and would broadcast it.
    """
    folder = F.regexp_extract("path", r"^(.*)/[^/]*$", 1)
    stem = F.regexp_replace(F.regexp_extract("path", r"([^/]*)$", 1), r"\.[^.]*$", "")
    folders = [F.lit(priors_dir)] * (priors_dir is not None) + [F.when(folder == "", ".").otherwise(folder)]
    names = F.array(*[F.concat(d, F.lit("/"), stem, F.lit(s)) for d in folders for s in SIDECARS])
    asked = images.select("path", F.posexplode(F.array_distinct(names)).alias("k", "prior"))
    found = asked.join(listing.select(F.col("file").alias("prior")).distinct().hint("merge"), "prior")
    return found.select("path", "prior", (F.row_number().over(W.partitionBy("path").orderBy("k")) - 1).alias("place"))


def mission_rows(scenes: DataFrame, missions: DataFrame, series: DataFrame) -> DataFrame:
    """scenes (entity_id, mission, series) with known, nominal_km: of the mission, else of its series, else null.

    missions (mission, nominal_km, perigee_km, apogee_km), series (series, nominal_km, perigee_km, apogee_km).
    """
    km = F.coalesce("nominal_km", (F.col("perigee_km") + F.col("apogee_km")) / 2)
    m = missions.select("mission", F.lit(True).alias("known"), km.alias("of_mission"))
    s = series.select("series", km.alias("of_series"))
    got = scenes.join(m, "mission", "left").join(s, "series", "left")
    return got.select("entity_id", F.coalesce("known", F.lit(False)).alias("known"), F.coalesce("of_mission", "of_series").alias("nominal_km"))


def satcat_orbit(perigee_km: Column, apogee_km: Column) -> dict[str, Column]:
    """mean_km, ecc, n_rev_per_day of an orbit known by its two heights only."""
    axis = (perigee_km + apogee_km) / 2 * 1000 + EARTH
    return {"mean_km": (perigee_km + apogee_km) / 2, "ecc": (apogee_km - perigee_km) * 1000 / (2 * axis), "n_rev_per_day": F.sqrt(MU / F.pow(axis, 3)) * 86400 / (2 * F.pi())}


def parameter_hash(values: Column, digits: int = 16) -> Column:
    """Digest of parameters as JSON: a struct whose fields stand in order of their names."""
    return F.substring(F.sha2(F.to_json(values), 256), 1, digits)


def substituted(sources: DataFrame, cleaned: DataFrame) -> DataFrame:
    """sources (path, digest) with read: the cleaned copy (of, of_digest, copy) made from just that file, else the file."""
    right = cleaned.select(F.col("of").alias("path"), F.col("of_digest").alias("digest"), "copy").groupBy("path", "digest").agg(F.min("copy").alias("copy"))
    return sources.join(right, ["path", "digest"], "left").select("path", "digest", F.coalesce("copy", "path").alias("read"))


def cache_verdict(wanted: dict[str, Column], held: dict[str, Column], exists: Column) -> Column:
    """Why a cached result can't be reused: 'missing', 'changed: name' of the first key that differs; null: it can."""
    reason = F.when(~exists, "missing")
    for name, value in wanted.items():
        reason = reason.when(~value.eqNullSafe(held[name]), f"changed: {name}")
    return reason


def attempts(rows: DataFrame) -> DataFrame:
    """entity_id, label, output, accepted, fate of attempts (entity_id, label, output, score, error): an attempt with an
    error has no output and is removed; of the others the best score is promoted and the rest deleted; an entity whose best
    is not accepted (score above limit) is rejected under another name."""
    sound = F.col("error").isNull()
    rank = F.row_number().over(W.partitionBy("entity_id", sound).orderBy(F.col("score").asc_nulls_last(), "label"))
    best = sound & (F.col("rank") == 1)
    fate = F.when(~sound, "removed").when(~best, "deleted").when(F.col("score") <= F.col("limit"), "promoted").otherwise("rejected")
    rows = rows.withColumn("rank", rank).withColumn("fate", fate)
    output = F.when(F.col("fate") == "promoted", F.col("output")).when(F.col("fate") == "rejected", F.regexp_replace("output", r"(\.[^.]*)$", "_rejected$1"))
    return rows.select("entity_id", "label", output.alias("output"), (F.col("fate") == "promoted").alias("accepted"), "fate")


def stamped(held: DataFrame, told: DataFrame) -> DataFrame:
    """held (entity_id, status) after told (entity_id, status) is written into it; written: whether a row had to change."""
    new = told.select("entity_id", F.col("status").alias("new"))
    got = held.join(new, "entity_id", "full")
    return got.select("entity_id", F.coalesce("new", "status").alias("status"), (F.col("new").isNotNull() & ~F.col("new").eqNullSafe(F.col("status"))).alias("written"))


def strip_members(scenes: DataFrame, metadata: DataFrame, files: DataFrame) -> DataFrame:
    """scenes (strip, entity_id) with stitched, corners from metadata, where the stitched file is there and corners are known."""
    rows = scenes.join(metadata.filter("corners is not null"), "entity_id").join(files.select(F.col("file").alias("stitched")).distinct(), "stitched", "left_semi")
    return rows.select("strip", "entity_id", "stitched", "corners")


def scoped(overrides: DataFrame) -> DataFrame:
    """section, attr, value from overrides (name, value), names of the form section__attr; others have no section."""
    parts = F.split("name", "__", 2)
    two = F.size(parts) == 2
    return overrides.select("name", F.when(two, parts[0]).alias("section"), F.when(two, parts[1]).otherwise(F.col("name")).alias("attr"), "value")


def moved_origins(rasters: DataFrame, corrections: DataFrame, bound: float | None = None) -> DataFrame:
    """rasters (path, x0, y0) with the corrections (path, dx, dy) added; those beyond the bound, or missing, count as 0."""
    got = rasters.join(corrections, "path", "left")
    fits = F.lit(True) if bound is None else F.sqrt(F.col("dx") * F.col("dx") + F.col("dy") * F.col("dy")) <= bound
    add = lambda c: F.coalesce(F.when(fits, F.col(c)), F.lit(0.0))
    return got.select("path", (F.col("x0") + add("dx")).alias("x0"), (F.col("y0") + add("dy")).alias("y0"))


def empty_cells(points: DataFrame, rows: int, cols: int, *, by: str) -> DataFrame:
    """by, r, c: the cells of a rows x cols grid that no point (by, r, c) of a group is in."""
    grid = points.select(by).distinct().select(by, F.explode(F.sequence(F.lit(0), F.lit(rows - 1))).alias("r")).select(by, "r", F.explode(F.sequence(F.lit(0), F.lit(cols - 1))).alias("c"))
    return grid.join(points.select(by, "r", "c").distinct(), [by, "r", "c"], "left_anti")


def land_coverage(points: DataFrame, land: DataFrame, *, by: str) -> DataFrame:
    """by, occupied, cells, share: land cells that hold a point, and all of them."""
    held = points.select(by, "r", "c").distinct().withColumn("held", F.lit(1))
    got = land.select(by, "r", "c").distinct().join(held, [by, "r", "c"], "left").groupBy(by).agg(F.count("held").alias("occupied"), F.count("*").alias("cells"))
    return got.withColumn("share", F.col("occupied") / F.col("cells"))


def mode_peaks(peaks: DataFrame, asked: DataFrame, floor: float) -> DataFrame:
    """scene, mode, n, best of peaks (scene, mode, ncc): those of the mode asked for (scene, mode), or where it has none at
    the floor, those of its fallback; scenes without any abstain and are left out."""
    pair = F.create_map(*[F.lit(x) for kv in FALLBACK.items() for x in kv])
    modes = asked.select("scene", F.posexplode(F.filter(F.array("mode", F.try_element_at(pair, F.col("mode"))), lambda x: x.isNotNull())).alias("place", "mode"))
    found = peaks.filter(F.col("ncc") >= floor).join(modes, ["scene", "mode"]).groupBy("scene", "place", "mode").agg(F.count("*").alias("n"), F.max("ncc").alias("best"))
    return found.withColumn("k", F.row_number().over(W.partitionBy("scene").orderBy("place"))).filter("k = 1").select("scene", "mode", "n", "best")


def frame_pairs(frames: DataFrame, *, by: str) -> DataFrame:
    """by, i, j, overlap: ordered pairs of a strip's frames (by, i, lo, hi) that overlap."""
    other = frames.select(by, F.col("i").alias("j"), F.col("lo").alias("lo2"), F.col("hi").alias("hi2"))
    got = frames.join(other, by).filter("i <> j").withColumn("overlap", F.least("hi", "hi2") - F.greatest("lo", "lo2"))
    return got.filter("overlap > 0").select(by, "i", "j", "overlap")


def best_per_cell(points: DataFrame, *, by: str, left: float, bottom: float, right: float, top: float, rows: int, cols: int, least: float) -> DataFrame:
    """points (by, id, x, y, confidence) that are the most confident of their cell, from least on; cells are half-open, so a
    point on the upper or right edge is in none."""
    c, r = F.floor((F.col("x") - left) / ((right - left) / cols)), F.floor((F.col("y") - bottom) / ((top - bottom) / rows))
    inside = points.withColumn("c", c).withColumn("r", r).filter(F.col("c").between(0, cols - 1) & F.col("r").between(0, rows - 1) & (F.col("confidence") >= least))
    first = F.row_number().over(W.partitionBy(by, "r", "c").orderBy(F.desc("confidence"), "id"))
    return inside.withColumn("k", first).filter("k = 1").select(by, "r", "c", "id")


def compared(runs: DataFrame, baseline: DataFrame, slack: float = 0.05) -> DataFrame:
    """metric, value, base, delta, verdict: a run's metrics (metric, value; lower is better) against those of a baseline."""
    got = runs.join(baseline.select("metric", F.col("value").alias("base")), "metric", "left").withColumn("delta", F.col("value") - F.col("base"))
    verdict = F.when(F.col("base").isNull(), "new").when(F.col("delta") > F.abs("base") * slack, "worse").when(F.col("delta") < -F.abs("base") * slack, "better").otherwise("same")
    return got.select("metric", "value", "base", "delta", verdict.alias("verdict"))


def junit_cases(reports: DataFrame) -> DataFrame:
    """id, suite, test, status, seconds: the test cases of JUnit reports (id, xml); a report that can't be read has none."""
    schema = "_name string, testcase array<struct<_name: string, _time: double, failure: struct<_message: string>, error: struct<_message: string>, skipped: struct<_message: string>>>"
    got = reports.select("id", F.from_xml("xml", F.lit(schema), {"mode": "PERMISSIVE"}).alias("x")).select("id", F.col("x._name").alias("suite"), F.explode("x.testcase").alias("t"))
    status = F.when(F.col("t.failure").isNotNull(), "failed").when(F.col("t.error").isNotNull(), "error").when(F.col("t.skipped").isNotNull(), "skipped").otherwise("passed")
    return got.select("id", "suite", F.col("t._name").alias("test"), status.alias("status"), F.col("t._time").alias("seconds"))
