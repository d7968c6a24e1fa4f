"""Scene catalogues as CSV files: columns found by their headers' spellings, bad rows left out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orthoweave.functions import entities

# What portals call each column.
HEADERS = {
    "entity_id": ["Entity ID"],
    "acquisition_date": ["Acquisition Date"],
    "mission": ["Mission"],
    "frame": ["Frame", "Frame Number"],
    "camera_type": ["Camera Type", "Camera"],
    "download_available": ["Download Available", "Down Load Available"],
    "center_lat": ["Center Latitude dec"],
    "center_lon": ["Center Longitude dec"],
    "nw_lat": ["NW Corner Lat dec", "NW Cormer Lat dec"],
    "nw_lon": ["NW Corner Long dec"],
    "ne_lat": ["NE Corner Lat dec"],
    "ne_lon": ["NE Corner Long dec"],
    "se_lat": ["SE Corner Lat dec"],
    "se_lon": ["SE Corner Long dec"],
    "sw_lat": ["SW Corner Lat dec"],
    "sw_lon": ["SW Corner Long dec"],
}
YES = ("1", "Y", "Yes", "true", "True")
CORNERS = [f"{c}_{a}" for c in ("nw", "ne", "se", "sw") for a in ("lat", "lon")]


def resolve(columns: list[str]) -> dict[str, str]:
    """Each field's column; an error names the field that has none."""
    got = {field: next((n for n in names if n in columns), None) for field, names in HEADERS.items()}
    if missing := [f for f, n in got.items() if n is None]:
        raise KeyError(f"no column for {', '.join(missing)} among {columns}")
    return got


def read_catalog(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Scenes of the files in the order given; rows without an id or with a corner that isn't a number are left out.

    A file's header decides its columns, so files are read one by one and put together by name.
    """
    frames = []
    for order, path in enumerate(paths):
        raw = spark.read.csv(path, header=True, encoding="ISO-8859-1", multiLine=True)
        col = resolve(raw.columns)
        text = lambda f: F.trim(F.coalesce(F.col(f"`{col[f]}`"), F.lit("")))  # noqa: B023, E731
        rows = raw.select(
            text("entity_id").alias("entity_id"),
            entities.acquisition_date(text("acquisition_date")).alias("acquisition_date"),
            text("mission").alias("mission"),
            text("frame").try_cast("int").alias("frame"),
            text("camera_type").alias("camera_type"),
            text("download_available").isin(*YES).alias("available"),
            *[text(c).try_cast("double").alias(c) for c in ("center_lat", "center_lon", *CORNERS)],
            F.lit(order).alias("source_order"),
            F.input_file_name().alias("source_csv"),
        )
        good = F.col("entity_id") != ""
        for c in CORNERS:
            good = good & F.col(c).isNotNull()
        frames.append(rows.filter(good))
    got = frames[0]
    for f in frames[1:]:
        got = got.unionByName(f)
    e, kind = F.col("entity_id"), F.col("camera_type")
    lon, lat = ([F.col(f"{c}_{a}") for c in ("nw", "ne", "se", "sw")] for a in ("lon", "lat"))
    return got.withColumns({"camera": entities.camera(e), "dataset": entities.dataset(F.col("source_csv")), "designation": entities.designation(e, kind), "west": F.least(*lon), "south": F.least(*lat), "east": F.greatest(*lon), "north": F.greatest(*lat)})
