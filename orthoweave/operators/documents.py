"""Sidecars and manifests: XML, JSON, logs, provenance; text columns in, typed columns out.

A document that can't be read gives nulls, not an error; a key that is there with value 0 counts as missing where the
sidecars' readers do so.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

PRIOR = "struct<west double, left double, south double, bottom double, east double, right double, north double, top double, crs string, name string>"
#: What a coarse sidecar's record must say at least.
SIDECAR_SCHEMA = 2


def bbox_xml(xml: Column) -> dict[str, Column]:
    at = lambda tag: F.xpath_double(xml, F.lit(f"//spdom/bounding/{tag}"))
    return {"west": at("westbc"), "south": at("southbc"), "east": at("eastbc"), "north": at("northbc")}


def portal_fields(xml: Column) -> Column:
    """map of the name/value fields of a portal's metadata document."""
    names, values = (F.xpath(xml, F.lit(f"//metadataField/{t}/text()")) for t in ("fieldName", "metadataValue"))
    return F.map_from_arrays(names, values)


def priors(text: Column) -> Column:
    """array of structs west, south, east, north, crs, name from a JSON list, an object with ``priors``, or one object."""
    t = F.trim(text)
    many = F.when(t.startswith("["), F.from_json(t, f"array<{PRIOR}>")).when(F.get_json_object(t, "$.priors").isNotNull(), F.from_json(t, f"struct<priors array<{PRIOR}>>")["priors"]).otherwise(F.array(F.from_json(t, PRIOR)))
    either = lambda p, a, b: F.coalesce(F.nullif(p[a], F.lit(0.0)), p[b])
    return F.transform(many, lambda p: F.struct(either(p, "west", "left").alias("west"), either(p, "south", "bottom").alias("south"), either(p, "east", "right").alias("east"), either(p, "north", "top").alias("north"), p["crs"].alias("crs"), p["name"].alias("name")))


def first_of_each(rows: DataFrame, *, key: list[str], order: list) -> DataFrame:
    """The first row of each key, by order."""
    return rows.withColumn("k", F.row_number().over(W.partitionBy(*key).orderBy(*order))).filter("k = 1").drop("k")


def manifest_jobs(manifests: DataFrame, text: str, *, fields: list[str]) -> DataFrame:
    """A row for each job of a JSON manifest: each field from the job, else from what its jobs share; all else in options."""
    job = "map<string,string>"
    parsed = F.from_json(F.col(text), f"struct<shared {job}, jobs array<{job}>>")
    rows = manifests.withColumn("m", parsed).select(*[c for c in manifests.columns if c != text], F.col("m.shared").alias("shared"), F.posexplode("m.jobs").alias("seq", "job"))
    shared = F.coalesce("shared", F.create_map().cast(job))
    given = F.array(*[F.lit(f) for f in fields])
    rest = lambda m: F.map_filter(m, lambda k, v: ~F.array_contains(given, k))
    options = F.map_from_entries(F.array_sort(F.map_entries(rest(F.col("job")))))
    return rows.select(*[c for c in manifests.columns if c != text], "seq", *[F.coalesce(F.col("job")[f], shared[f]).alias(f) for f in fields], options.alias("options"))


def merged(old: Column, new: Column) -> Column:
    """Of two maps the union; where both have a key the new value."""
    return F.map_concat(F.map_filter(old, lambda k, v: ~F.array_contains(F.map_keys(new), k)), new)


def cache_key(**parts: Column) -> Column:
    """Digest of named values as sorted JSON; doubles must have been rounded by the caller."""
    return F.sha2(F.to_json(F.struct(*[v.alias(k) for k, v in sorted(parts.items())])), 256)


def provenance_matches(left: dict[str, Column], right: dict[str, Column], schema: Column) -> Column:
    same = schema >= SIDECAR_SCHEMA
    for k, v in left.items():
        same = same & v.eqNullSafe(right[k])
    return F.coalesce(same, F.lit(False))


def stale(path_mtime: Column, *dependencies: Column) -> Column:
    """Missing, or older than something it was made from."""
    newest = F.greatest(*dependencies) if len(dependencies) > 1 else dependencies[0]
    return path_mtime.isNull() | F.coalesce(newest > path_mtime, F.lit(False))


def boundary_box(text: Column) -> Column:
    """west, south, east, north of four numbers parted by commas, or of a GeoJSON polygon's first ring."""
    parts = F.transform(F.split(text, ","), lambda p: F.trim(p).try_cast("double"))
    ring = F.from_json(F.get_json_object(text, "$.features[0].geometry.coordinates[0]"), "array<array<double>>")
    side = lambda f, i: f(F.transform(ring, lambda p: p[i]))
    plain = F.struct(*[F.get(parts, F.lit(i)).alias(n) for i, n in enumerate(("west", "south", "east", "north"))])
    return F.when(ring.isNotNull(), F.struct(side(F.array_min, 0).alias("west"), side(F.array_min, 1).alias("south"), side(F.array_max, 0).alias("east"), side(F.array_max, 1).alias("north"))).otherwise(plain)


def log_fields(lines: DataFrame, *, run: str, line: str, patterns: dict[str, str]) -> DataFrame:
    """run and the first number after each pattern, in the last line that has it; lines are in order of ``seq``."""
    got = {k: F.nullif(F.regexp_extract(line, p, 1), F.lit("")) for k, p in patterns.items()}
    return lines.groupBy(run).agg(*[F.max_by(v, F.when(v.isNotNull(), F.col("seq"))).cast("double").alias(k) for k, v in got.items()])


def path_list(text: Column) -> Column:
    """A list of paths from a JSON list, one path, or nothing."""
    t = F.trim(text)
    return F.when(t.isNull() | (t == ""), F.array().cast("array<string>")).when(t.startswith("["), F.from_json(t, "array<string>")).otherwise(F.array(t))


def deep_merge(base: dict, over: dict) -> dict:
    """Settings with another set over them, section by section."""
    out = dict(base)
    for k, v in over.items():
        out[k] = deep_merge(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else v
    return out


def profile(name: str, profiles: dict[str, dict], *, known: dict[str, set[str]] | None = None) -> dict:
    """A profile with all that it inherits; a cycle, or a section or key that isn't known, is an error."""
    seen, chain = [], name
    while chain:
        if chain in seen:
            raise ValueError(f"profiles inherit one another: {' -> '.join([*seen, chain])}")
        seen.append(chain)
        chain = profiles[chain].get("inherits")
    got: dict = {}
    for n in reversed(seen):
        got = deep_merge(got, {k: v for k, v in profiles[n].items() if k != "inherits"})
    for section, values in got.items():
        if known is not None and (section not in known or set(values) - known[section]):
            raise ValueError(f"unknown setting in {section}: {json.dumps(values)}")
    return got


def camera_fields(text: Column) -> Column:
    """map of the ``key = value`` lines of a camera's text file."""
    return F.map_from_arrays(F.regexp_extract_all(text, F.lit(r"(?m)^\s*(\w+)\s*=\s*(.*?)\s*$"), F.lit(1)), F.regexp_extract_all(text, F.lit(r"(?m)^\s*(\w+)\s*=\s*(.*?)\s*$"), F.lit(2)))


def camera_text(**fields: Column) -> Column:
    """A camera's text file of ``key = value`` lines."""
    return F.concat_ws("\n", F.lit("VERSION_4"), *[F.concat(F.lit(f"{k} = "), v.cast("string")) for k, v in fields.items()])


def asset_urls(item: Column, bands: list[str]) -> Column:
    """The bands' addresses of a catalogue item, or null if one is missing."""
    urls = F.array(*[F.get_json_object(item, f"$.assets.{b}.href") for b in bands])
    return F.when(~F.exists(urls, lambda u: u.isNull()), F.transform(urls, lambda u: F.concat(F.lit("/vsicurl/"), u)))
