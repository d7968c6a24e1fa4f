"""Operators on orbit element sets: parsing, altitudes, the record nearest in time."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Gravity parameter and radius of the earth, altitudes in m that a camera can have flown at.
MU, R_EARTH, LOWEST_M, HIGHEST_M = 3.986004418e14, 6378137.0, 140_000.0, 280_000.0


def epoch(line1: Column) -> Column:
    """Timestamp of a line's two-digit year, 57 and later in the last century, and fractional day."""
    year, day = F.substring(line1, 19, 2).try_cast("int"), F.substring(line1, 21, 12).try_cast("double")
    start = F.make_timestamp(year + F.when(year < 57, 2000).otherwise(1900), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    return F.when(F.length(line1) >= 32, F.timestamp_micros((F.unix_micros(start) + F.round((day - 1) * 86_400_000_000.0)).cast("long")))


def eccentricity(line2: Column) -> Column:
    return F.concat(F.lit("0."), F.trim(F.substring(line2, 27, 7))).try_cast("double")


def mean_motion(line2: Column) -> Column:
    got = F.trim(F.substring(line2, 53, 11)).try_cast("double")
    return F.when((F.length(line2) >= 63) & (got > 0), got)


def semi_major_axis(revs_per_day: Column) -> Column:
    return F.pow(MU / F.pow(revs_per_day * (2 * math.pi / 86400.0), F.lit(2.0)), F.lit(1 / 3))


def altitudes(revs_per_day: Column, ecc: Column) -> dict[str, Column]:
    a = semi_major_axis(revs_per_day)
    return {"perigee_m": a * (1 - ecc) - R_EARTH, "mean_m": a - R_EARTH, "apogee_m": a * (1 + ecc) - R_EARTH}


def in_range(altitude_m: Column) -> Column:
    """Out of range is unknown, not the nearest bound."""
    return F.when(altitude_m.between(LOWEST_M, HIGHEST_M), altitude_m)


def element_sets(lines: DataFrame) -> DataFrame:
    """file, seq, line1, line2 from text lines (file, seq, value): a line 1 with the line 2 next to it; others are skipped."""
    nxt = F.lead("value").over(W.partitionBy("file").orderBy("seq"))
    return lines.withColumn("line2", nxt).filter(F.col("value").startswith("1 ") & F.col("line2").startswith("2 ")).select("file", "seq", F.col("value").alias("line1"), "line2")


def nearest_in_time(left: DataFrame, right: DataFrame, *, by: list[str], left_ts: str, right_ts: str, tie: str) -> DataFrame:
    """left with the right row of its key nearest in time on either side; of two equally near, the lower ``tie``.

    Both sides are put in one order per key, so the neighbour before and after is a window's last value and nothing is
    joined: the plan is one shuffle whatever the number of records a key has.
    """
    kept = [c for c in right.columns if c not in by]
    record = F.struct(*kept)
    one = left.select(*by, F.col(left_ts).alias("at"), F.lit(1).alias("is_left"), F.struct(*left.columns).alias("l"), F.lit(None).cast(right.select(record.alias("r")).schema["r"].dataType).alias("r"))
    two = right.select(*by, F.col(right_ts).alias("at"), F.lit(0).alias("is_left"), F.lit(None).cast(left.select(F.struct(*left.columns).alias("l")).schema["l"].dataType).alias("l"), record.alias("r"))
    key = W.partitionBy(*by)
    # Among records of one time the lowest tie must be the last one seen from either side.
    both = one.unionByName(two).withColumn("tie", F.col(f"r.{tie}"))
    back = F.last("r", ignorenulls=True).over(key.orderBy("at", "is_left", F.desc("tie")).rowsBetween(W.unboundedPreceding, 0))
    ahead = F.last("r", ignorenulls=True).over(key.orderBy(F.desc("at"), "is_left", F.desc("tie")).rowsBetween(W.unboundedPreceding, 0))
    rows = both.withColumn("back", back).withColumn("ahead", ahead).filter("is_left = 1")
    gap = lambda r: F.abs(F.unix_micros(F.col(f"{r}.{right_ts}").cast("timestamp")) - F.unix_micros(F.col("at").cast("timestamp")))
    first = F.col("ahead").isNull() | (gap("back") < gap("ahead")) | ((gap("back") == gap("ahead")) & (F.col(f"back.{tie}") <= F.col(f"ahead.{tie}")))
    return rows.withColumn("best", F.when(F.col("back").isNotNull() & first, F.col("back")).otherwise(F.col("ahead"))).select("l.*", *[F.col(f"best.{c}").alias(f"right_{c}") for c in kept])


def quarter_samples(spans: DataFrame, *, by: str) -> DataFrame:
    """by, label, at: five times from first_ts to last_ts of each row; a span without length gives its start alone."""
    labels = [("Q0_start", 0.0), ("Q1_25%", 0.25), ("Q2_50%", 0.5), ("Q3_75%", 0.75), ("Q4_end", 1.0)]
    a, b = F.unix_micros("first_ts"), F.unix_micros("last_ts")
    sample = lambda label, part: F.struct(F.lit(label).alias("label"), F.timestamp_micros((a + F.round((b - a) * part)).cast("long")).alias("at"))
    return spans.select(by, F.inline(F.when(b > a, F.array(*[sample(*x) for x in labels])).otherwise(F.array(sample("t=start", 0.0)))))


def altitude_ladder(rows: DataFrame) -> DataFrame:
    """rows with altitude_m and altitude_source: from the nearest element set, else the mission's perigee and apogee, else
    the nominal altitude of mission or series; the first two only within range."""
    orbit = in_range(F.col("tle_mean_m"))
    catalogue = in_range((F.col("perigee_km") + F.col("apogee_km")) / 2 * 1000.0)
    nominal = F.coalesce("nominal_km", "series_nominal_km") * 1000.0
    source = F.when(orbit.isNotNull(), "tle").when(catalogue.isNotNull(), "catalog").when(nominal.isNotNull(), "nominal")
    return rows.withColumn("altitude_m", F.coalesce(orbit, catalogue, nominal)).withColumn("altitude_source", source)


def ground_sample_m(altitude_m: Column, pitch_um: Column, focal_mm: Column) -> Column:
    return altitude_m * pitch_um * 1e-6 / (focal_mm * 1e-3)
