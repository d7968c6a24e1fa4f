"""Names of scenes and files as column expressions: camera, mission, strip, frame, profile, dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Prefix of an id, camera, programme, dataset.
CAMERAS = [("DS1", "KH-4", "CORONA", "corona2"), ("DZB", "KH-7", "GAMBIT", "declassii"), ("D3C", "KH-9", "HEXAGON", "declassiii")]
# Prefix, first and last mission, series.
SERIES = [("DZB", 1201, 1220, "KH-9"), ("DZB", 4001, 4099, "KH-7"), ("DS", 9000, 9099, "KH-4"), ("DS", 1001, 1099, "KH-4A"), ("DS", 1101, 1199, "KH-4B")]
# Endings that stages add to a scene's files.
SUFFIXES = r"(\.vrt|\.tiff?|_ortho\.extrapolated|_ortho\.coarse|_ortho|_aligned|_georef|_stitched|\.extrapolated)+$"
# File names of modern references without a year, and the year they stand for.
MODERN = [("esri", 2023), ("worldimagery", 2023), ("sentinel2", 2023), ("sentinel-2", 2023), ("s2_", 2023), ("naip", 2022)]


def _first(cases: list[tuple[Column, Column | str | int | None]]) -> Column:
    got = F.when(cases[0][0], cases[0][1])
    for cond, value in cases[1:]:
        got = got.when(cond, value)
    return got


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def camera(entity: Column) -> Column:
    return _first([(entity.startswith(p), name) for p, name, _, _ in CAMERAS])


def dataset(path: Column) -> Column:
    """By the file name's beginning, the longer name first: 'declassii' begins 'declassiii' too."""
    name = F.lower(base_name(path))
    return _first([(name.startswith(d), d) for *_, d in sorted(CAMERAS, key=lambda c: -len(c[3]))])


def designation(entity: Column, camera_type: Column) -> Column:
    """Aft, forward or other camera, from the id where it tells, else from the catalogue's column."""
    suffix = F.regexp_extract(entity, r"^[^-]*-([^-]*)$", 1)
    kind = F.lower(F.trim(F.coalesce(camera_type, F.lit(""))))
    letter, side = F.upper(F.regexp_extract(suffix, r"(\p{L})", 1)), F.regexp_extract(suffix, r"D([AF])", 1)
    return (
        F.when(entity.startswith("D3C") & (letter != ""), letter)
        .when(entity.startswith("DS1") & (side != ""), side)
        .when(entity.startswith("DS1") & kind.contains("aft"), "A")
        .when(entity.startswith("DS1") & kind.rlike("forward|fore"), "F")
        .when(entity.startswith("DZB"), "H")
        .when(F.coalesce(camera_type, F.lit("")) != "", F.upper(F.substring(camera_type, 1, 1)))
        .otherwise("X")
    )


def mission(entity: Column) -> Column:
    """system, mission_id, frame of an id, or null."""
    text = F.trim(entity)
    forms = [("D3C", r"^D3C(\d{4})"), ("DS", r"^DS(\d{4})"), ("DZB", r"^DZB00(\d{4})\d"), ("DZB", r"^DZB(\d{4})-")]
    got = None
    for prefix, form in forms:
        number = F.regexp_extract(text, form, 1)
        found = F.struct(series(F.lit(prefix), number).alias("system"), number.alias("mission_id"), F.regexp_replace(F.regexp_replace(text, form, ""), "^-+", "").alias("frame"))
        got = F.when(text.rlike(form), found) if got is None else got.when(text.rlike(form), found)
    return F.when(got["system"].isNotNull(), got)


def series(prefix: Column, number: Column) -> Column:
    n = F.try_to_number(number, F.lit("9999")).cast("int")
    return _first([(prefix == "D3C", "KH-9"), *[((prefix == p) & n.between(a, b), s) for p, a, b, s in SERIES]])


def profile(path: Column) -> Column:
    name = F.upper(base_name(path))
    older = F.regexp_extract(name, r"DS(\d{4})", 1)
    return _first([(name.rlike(r"DZB004\d+H"), "kh7"), (name.rlike(r"D3C\d{4}"), "kh9"), (name.rlike(r"DZB\d+"), "kh9"), ((older != "") & series(F.lit("DS"), older).isin("KH-4", "KH-4A"), "kh4a"), (older != "", "kh4b")])


def strip_index(path: Column) -> Column:
    """strip and index of a frame's file, after every suffix is taken off; null if its name is of another form."""
    form = r"(?i)(?:DS\d+-\d+|D3C\d+-\d+|DZB\d+)([A-Z]+)(\d+)$"
    name = F.regexp_replace(base_name(path), SUFFIXES, "")
    return F.when(name.rlike(form), F.struct(F.upper(F.regexp_extract(name, form, 1)).alias("strip"), F.regexp_extract(name, form, 2).cast("int").alias("index")))


def entity_id(path: Column) -> Column:
    name = F.regexp_replace(base_name(path), r"\.tif$", "")
    for ending in (r"_ortho\.coarse$", r"_ortho$", r"_georef$", r"_stitched$"):
        name = F.regexp_replace(name, ending, "")
    return name


def frame_key(entity: Column) -> Column:
    form = r"^(.*?)(\d{3})$"
    return F.when(entity.rlike(form), F.struct(F.regexp_extract(entity, form, 1).alias("prefix"), F.regexp_extract(entity, form, 2).cast("int").alias("frame")))


def acquisition_date(raw: Column) -> Column:
    text = F.trim(raw)
    return F.coalesce(*[F.try_to_date(text, f) for f in ("y/M/d", "y-M-d", "M/d/y")])


def reference_year(path: Column) -> Column:
    name = F.lower(base_name(path))
    year = F.regexp_extract(name, r"(?:^|[^\d])(19\d{2}|20\d{2})(?:\D|$)", 1)
    return _first([(year != "", year.try_cast("int")), *[(name.contains(h), y) for h, y in MODERN]])


def era_gap(explicit: Column, acquired: Column, reference: Column) -> Column:
    source = F.regexp_extract(F.coalesce(acquired, F.lit("")), r"(\d{4})", 1)
    return F.coalesce(explicit, F.abs(F.when(source != "", source.try_cast("int")) - reference_year(reference)).cast("double"))


def mask_mode(feature_type: Column) -> Column:
    return F.when(feature_type.isin("island_center", "reef_feature"), "coastal_obia").otherwise("heuristic")


def dem_tile(lat: Column, lon: Column) -> Column:
    """Name of the one-degree elevation tile whose south-west corner is at whole degrees."""
    side = lambda v, plus, minus: F.when(v >= 0, plus).otherwise(minus)
    return F.concat(F.lit("Copernicus_DSM_COG_10_"), side(lat, "N", "S"), F.lpad(F.abs(lat).cast("string"), 2, "0"), F.lit("_00_"), side(lon, "E", "W"), F.lpad(F.abs(lon).cast("string"), 3, "0"), F.lit("_00_DEM"))


def layer_mission(slug: Column, year: Column) -> Column:
    """Which mission a layer shows, from the ids in its name; 1984 and later are modern."""
    name = F.upper(slug)
    n = F.regexp_extract(name, r"DS(\d{4})", 1).try_cast("int")
    return _first([(year >= 1984, "modern"), (n.between(9024, 9069), "kh-4"), (n.between(1018, 1052), "kh-4a"), (n.between(1101, 1117), "kh-4b"), (name.rlike(r"DZB12\d{2}"), "kh-9-mc"), (name.rlike(r"DZB40\d{2}"), "kh-7"), (name.rlike(r"D3C\d{4}"), "kh-9-pc"), (name.contains("-KH9-"), "kh-9-mc"), (F.lit(True), "unknown")])
