"""Small operators on frames: georeferences, corners, orientation, angles, marks, duplicates within a radius."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orthoweave.functions.numbers import MAD_SCALE, clip, median
from orthoweave.operators.nearest import nearest

# Axes of the ellipsoid in m; rows, columns and spacing in mm of the calibration marks.
WGS84_A, WGS84_B, MARK_ROWS, MARK_COLUMNS, MARK_MM = 6378137.0, 6356752.314245, 23, 47, 10.0


def panoramic(t: Column) -> Column:
    """Share by which a panoramic camera's scan moves a corner at t between 0 and 1, towards the nearer end."""
    return F.pow(t * 2 - 1, F.lit(2.0)) * 0.04 * F.when(t > 0.5, 1).otherwise(-1)


def interpolated(a: Column, b: Column, t: Column, scan: bool) -> Column:
    return a + (t + panoramic(t) if scan else t) * (b - a)


def meridional_radius(lat: Column) -> Column:
    c2, s2 = F.pow(F.cos(lat), F.lit(2.0)), F.pow(F.sin(lat), F.lit(2.0))
    a2, b2 = WGS84_A**2, WGS84_B**2
    return F.sqrt((c2 * (a2 * a2) + s2 * (b2 * b2)) / (c2 * a2 + s2 * b2))


def half_turn(angle: Column) -> Column:
    """The angle of a line, above -90 up to 90 degrees."""
    return F.lit(90.0) - F.pmod(F.lit(90.0) - angle, F.lit(180.0))


def dominant_angle(lines: DataFrame, *, by: str, k: float = 3.0, floor_deg: float = 1.0, least: int = 4) -> DataFrame:
    """lines (angle, length) near the mean direction of their group, weighted by length; a group of few is left whole.

    Directions are averaged at twice their angle, as a line has no sense; the limit is a robust deviation from the median.
    """
    w, twice = F.col("length").cast("double"), F.radians("angle") * 2
    mean = lines.groupBy(by).agg(F.count("*").alias("n"), (F.sum(w * F.cos(twice)) / F.sum(w)).alias("mx"), (F.sum(w * F.sin(twice)) / F.sum(w)).alias("my"))
    mean = mean.withColumn("main", half_turn(F.degrees(F.atan2("my", "mx")) * 0.5))
    rows = lines.join(mean, by).withColumn("off", F.pmod(F.col("angle") - F.col("main") + 90.0, F.lit(180.0)) - 90.0)
    rows = rows.join(rows.groupBy(by).agg(median(F.col("off")).alias("mid")), by)
    rows = rows.join(rows.groupBy(by).agg(median(F.abs(F.col("off") - F.col("mid"))).alias("mad")), by)
    clear = (F.col("mx") * F.col("mx") + F.col("my") * F.col("my") >= 1e-6) & (F.col("n") >= least)
    near = F.abs(F.col("off") - F.col("mid")) <= F.greatest(F.col("mad") * MAD_SCALE, F.lit(floor_deg)) * k
    return rows.filter(~clear | near).select(*lines.columns)


def geotransform(west: Column, south: Column, east: Column, north: Column, width: Column, height: Column) -> dict[str, Column]:
    return {"origin_x": west, "step_x": (east - west) / width, "origin_y": north, "step_y": -(north - south) / height}


def moved_to(origin: Column, step: Column, size: Column, centre: Column) -> Column:
    """The origin that puts a raster's middle at a centre; nothing but the origin changes."""
    return centre - step * size / 2


def orientation(width: Column, height: Column, geographic_aspect: Column, reversed_: Column, seen: Column, seen_confidence: Column) -> Column:
    """Degrees to turn a scan: by its shape and corners, unless a comparison with the reference is sure of another."""
    aspect = F.when(height > 0, width / height).otherwise(1.0)
    ratio = aspect / F.nullif(geographic_aspect, F.lit(0.0))
    shape = F.when(aspect < 1, 90).when(((ratio > 2) | (ratio < 0.5)) & (aspect > 1) & (geographic_aspect < 1), 270).when(reversed_, 180).otherwise(0)
    return F.when(seen_confidence >= 10, seen).otherwise(shape)


def matcher_side(side: Column, longest: Column, most: int = 800) -> Column:
    """Size that a matcher takes: at most so long, a multiple of 14, 56 at least."""
    scaled = F.greatest(F.lit(56), F.bround(side * F.when(longest > most, most / longest).otherwise(1.0)).cast("int"))
    return (F.floor(scaled / 14) * 14).cast("int")


def marks(spark) -> DataFrame:
    """row, col, x_mm, y_mm of the calibration marks; as many whatever the data."""
    return spark.range(MARK_ROWS * MARK_COLUMNS).select(F.floor(F.col("id") / MARK_COLUMNS).cast("int").alias("row"), (F.col("id") % MARK_COLUMNS).cast("int").alias("col")).select("row", "col", (F.col("col") * MARK_MM).alias("x_mm"), (F.col("row") * MARK_MM).alias("y_mm"))


def nearest_marks(found: DataFrame, *, spacing: float, share: float = 0.3) -> DataFrame:
    """row, col, id, dist: for each mark the detection (id, x, y in spacings of the grid) nearest to it within a share."""
    at = found.withColumn("col", F.bround(F.col("x") / spacing).cast("int")).withColumn("row", F.bround(F.col("y") / spacing).cast("int"))
    dist = F.sqrt(F.pow(F.col("x") - F.col("col") * spacing, 2) + F.pow(F.col("y") - F.col("row") * spacing, 2))
    at = at.withColumn("dist", dist).filter((F.col("dist") < spacing * share) & F.col("row").between(0, MARK_ROWS - 1) & F.col("col").between(0, MARK_COLUMNS - 1))
    return at.groupBy("row", "col").agg(F.min_by(F.struct("id", "dist"), F.struct("dist", "id")).alias("m")).select("row", "col", "m.*")


def drop_near(points: DataFrame, *, by: str, radius: float) -> DataFrame:
    """Points (id, x, y) that have no point of lower id within the radius; cells as wide as it make that an equi-join."""
    around = F.sequence(F.lit(-1), F.lit(1))
    cell = points.select(by, "id", "x", "y", F.floor(F.col("x") / radius).alias("gx"), F.floor(F.col("y") / radius).alias("gy"))
    lower = cell.select(by, F.col("id").alias("lid"), F.col("x").alias("lx"), F.col("y").alias("ly"), "gx", "gy").withColumn("sx", F.explode(around)).withColumn("sy", F.explode(around))
    lower = lower.withColumn("gx", F.col("gx") + F.col("sx")).withColumn("gy", F.col("gy") + F.col("sy"))
    met = cell.join(lower, [by, "gx", "gy"]).filter((F.col("lid") < F.col("id")) & (F.pow(F.col("x") - F.col("lx"), 2) + F.pow(F.col("y") - F.col("ly"), 2) < radius * radius))
    return points.join(met.select(by, "id").distinct(), [by, "id"], "left_anti")


def composed(outer: list[Column], inner: list[Column]) -> list[Column]:
    """a, b, tx, c, d, ty of one affine after another."""
    a, b, tx, c, d, ty = outer
    e, f, ux, g, h, uy = inner
    return [a * e + b * g, a * f + b * h, a * ux + b * uy + tx, c * e + d * g, c * f + d * h, c * ux + d * uy + ty]


def vignette(px: Column, r2: Column, k1: float, k2: float) -> Column:
    """A pixel without the fall of light towards the edge; r2: squared distance from the middle over that of a corner."""
    return clip(px / clip(r2 * k1 + r2 * r2 * k2 + 1.0, 0.5, 2.0), 0.0, 255.0)


def luminance(r: Column, g: Column, b: Column) -> Column:
    return r * 0.299 + g * 0.587 + b * 0.114


def thinned(rows: DataFrame, *, by: str, order: list[str], most: int) -> DataFrame:
    """As many rows of each group at most, evenly along its order, first and last among them."""
    key = W.partitionBy(by)
    ranked = rows.withColumn("k", F.row_number().over(key.orderBy(*order)) - 1).withColumn("n", F.count("*").over(key))
    step = (F.col("n") - 1) / float(max(1, most - 1))
    # Row k is asked for if the whole part of some multiple of the step is k.
    first = F.ceil((F.col("k") / step))
    asked = (F.floor(first * step) == F.col("k")) & (first <= most - 1)
    return ranked.filter((F.col("n") <= most) | asked).select(*rows.columns)


def off_grid(sizes: DataFrame, *, by: str, size: str, share: float = 0.005) -> DataFrame:
    """Rows whose pixel size is further from their group's median than a share of it, with the size to resample to."""
    mid = sizes.groupBy(by).agg(median(F.col(size)).alias("target"))
    return sizes.join(mid, by).filter(F.abs(F.col(size) - F.col("target")) > F.col("target") * share)


def second_pass(best: Column, coverage: Column, neural: Column, fine: Column) -> Column:
    weak = (best & (coverage < 0.30)) | (coverage < 0.20)
    return weak & neural & fine


def sticky_status(rows: DataFrame, *, by: str, seq: str, status: str) -> DataFrame:
    """The last status of each output, except that one once incoherent stays so."""
    once = F.bool_or(F.col(status) == "incoherent")
    return rows.groupBy(by).agg(F.when(once, "incoherent").otherwise(F.max_by(status, seq)).alias(status))


def scale_grid(cells: DataFrame, *, by: str, value: str, most_z: float = 3.0) -> DataFrame:
    """cells (r, c, value) with filled: values far from their group's median by robust z are dropped; a gap takes the mean
    of what is left of its eight neighbours, else the group's median, and ``source`` says which."""
    mid = cells.groupBy(by).agg(median(F.col(value)).alias("m"))
    rows = cells.join(mid, by)
    rows = rows.join(rows.groupBy(by).agg(median(F.abs(F.col(value) - F.col("m"))).alias("mad")), by)
    good = F.col(value).isNotNull() & ((F.col("mad") < 1e-6) | (F.abs(F.col(value) - F.col("m")) * 0.6745 / F.col("mad") < most_z))
    rows = rows.withColumn("kept", F.when(good, F.col(value)))
    around = F.sequence(F.lit(-1), F.lit(1))
    near = rows.filter("kept is not null").select(by, F.col("r").alias("nr"), F.col("c").alias("nc"), F.col("kept").alias("v"))
    near = near.withColumn("i", F.explode(around)).withColumn("j", F.explode(around)).filter("i <> 0 or j <> 0").select(by, (F.col("nr") + F.col("i")).alias("r"), (F.col("nc") + F.col("j")).alias("c"), "v")
    got = rows.join(near.groupBy(by, "r", "c").agg(F.avg("v").alias("near")), [by, "r", "c"], "left")
    source = F.when(F.col("kept").isNotNull(), "own").when(F.col("near").isNotNull(), "neighbours").otherwise("group")
    return got.select(*cells.columns, F.coalesce("kept", "near", "m").alias("filled"), source.alias("source"))


def to_world(col: Column, row: Column, transform: list[Column]) -> tuple[Column, Column]:
    """World coordinates of a pixel under a raster's six-number transform."""
    a, b, c, d, e, f = transform
    return a * col + b * row + c, d * col + e * row + f


def waterfall(sections: DataFrame, *, path: str, seq: str, value: str) -> DataFrame:
    """seq, line: sections in order, indented by their depth."""
    depth = F.size(F.split(F.col(path), r"\.")) - 1
    name = F.regexp_extract(path, r"([^.]*)$", 1)
    return sections.select(seq, F.concat(F.repeat(F.lit("  "), depth), name, F.format_string(" %.1f", F.col(value))).alias("line"))


def is_aft(entity: Column, camera: Column) -> Column:
    """Whether a frame is of the aft camera, by its id's letters, else by the camera's name."""
    side = F.regexp_extract(entity, r"-\d+D([AF])", 1)
    return F.when(side != "", side == "A").otherwise(F.lower(F.coalesce(camera, F.lit(""))).contains("aft"))


def pair_from_array(values: Column, name: Column) -> Column:
    """A match pair from its name and an array of five numbers, the precision sixth and else 1; null if there are fewer."""
    at = lambda i: F.get(values, F.lit(i))
    pair = F.struct(at(0).alias("ref_x"), at(1).alias("ref_y"), at(2).alias("off_x"), at(3).alias("off_y"), at(4).alias("confidence"), name.alias("name"), F.coalesce(at(5), F.lit(1.0)).alias("prec"))
    return F.when(F.size(values) >= 5, pair)


def with_confidence(pair: Column, confidence: Column) -> Column:
    return pair.withField("confidence", confidence)


def point_weights(points: DataFrame, *, by: str, within: float = 0.3) -> DataFrame:
    """points (x, y in shares of the frame, virtual, prec) with weight: precision of real points; of virtual ones .05 to
    .40, growing with the distance to the nearest real point between .1 and .3. Places are searched once, however many
    points they hold."""
    place = points.select(F.col(by).alias("scene"), "x", "y", "virtual").distinct()
    asked = place.filter("virtual").select("scene", F.struct("x", "y").alias("id"), "x", "y")
    real = place.filter(~F.col("virtual")).select("scene", F.col("x").alias("qx"), F.col("y").alias("qy"), F.lit(0).alias("q"))
    near = nearest(asked, real, k=1, cell=within / 2, within=within).select(F.col("scene").alias(by), "x", "y", "dist")
    ramp = clip((F.coalesce("dist", F.lit(1.0)) - 0.1) / 0.2, 0.0, 1.0) * 0.35 + 0.05
    return points.join(near, [by, "x", "y"], "left").select(*points.columns, F.when(F.col("virtual"), ramp).otherwise(F.col("prec")).alias("weight"))


def covered_by_tiles(boxes: DataFrame, tiles: DataFrame, *, samples: int = 4) -> DataFrame:
    """id, covered: whether every sampled tile (x, y) of a box's range (x_min to x_max, y_min to y_max) exists."""
    side = max(1, int(samples**0.5))
    line = lambda a, b: F.transform(F.sequence(F.lit(0), F.lit(side - 1)), lambda i: F.bround(F.col(a) + i * (F.col(b) - F.col(a)) / float(max(1, side - 1))).cast("long"))
    asked = boxes.select("id", F.explode(line("x_min", "x_max")).alias("x"), line("y_min", "y_max").alias("ys")).select("id", "x", F.explode("ys").alias("y"))
    there = tiles.select("x", "y", F.lit(1).alias("there")).distinct()
    return asked.join(there, ["x", "y"], "left").groupBy("id").agg((F.count("there") == F.count("*")).alias("covered"))


def search_bounds(priors: DataFrame, reference: tuple[float, float, float, float], *, by: str) -> DataFrame:
    """by and the box to search: all priors' boxes widened by half their size, 5 km at least, within the reference."""
    w, s, e, n = (F.lit(v) for v in reference)
    margin = F.greatest((F.col("east") - F.col("west")) * 0.5, (F.col("north") - F.col("south")) * 0.5, F.lit(5000.0))
    return priors.groupBy(by).agg(F.greatest(w, F.min(F.col("west") - margin)).alias("west"), F.greatest(s, F.min(F.col("south") - margin)).alias("south"), F.least(e, F.max(F.col("east") + margin)).alias("east"), F.least(n, F.max(F.col("north") + margin)).alias("north"))
