"""Choices and corrections before dense matching: stacked candidates, scale of patches, flow bias, cuts, gains, energies.

Statistics of a group are aggregates joined back by the group's key. A missing prior or validation gives nulls, no error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Semi-axes of the WGS 84 ellipsoid in m.
AXES = (6378137.0, 6356752.314245)


def _median(x: Column) -> Column:
    return F.percentile(x, F.lit(0.5))


def stacked_choice(peaks: DataFrame, priors: DataFrame, single: DataFrame, *, radius_m: float, cross_m: float, along_m: float, floor: float = 0.3) -> DataFrame:
    """scene, outcome, k, dx, dy, n_matches, agreement: which coarse shift a scene takes, or why it takes none.

    peaks (scene, k, dx, dy, ncc, vdx, vdy, n_matches, agreement): candidates, the last four null where validation abstained;
    priors (scene, dx, dy): shifts of validated siblings; single (scene, dx, dy): a rejected direct estimate, one a scene.
    In this order: the best validated candidate; the median of three candidates or more that lie close together, and close
    to the median prior if there is one; the candidate nearest to the prior, which a direct estimate must confirm where the
    prior is a single one. Outcomes without a shift: no_prior, uncorroborated, cross, along, beyond.
    """
    score = F.col("agreement") * F.sqrt("n_matches")
    best = F.min(F.when(score.isNotNull(), F.struct((-score).alias("s"), "k", "vdx", "vdy", "n_matches", "agreement"))).alias("best")
    spread = lambda c: F.max(c) - F.min(c)
    stats = peaks.groupBy("scene").agg(best, F.count("*").alias("n"), spread("dx").alias("sx"), spread("dy").alias("sy"), _median(F.col("dx")).alias("mx"), _median(F.col("dy")).alias("my"), _median(F.col("ncc")).alias("mncc"))
    p = priors.groupBy("scene").agg(F.count("*").alias("np"), _median(F.col("dx")).alias("px"), _median(F.col("dy")).alias("py"))
    s = single.select("scene", F.col("dx").alias("s_dx"), F.col("dy").alias("s_dy"))
    known = stats.join(p, "scene", "left").join(s, "scene", "left")
    gap = lambda x, y: F.pow(F.col("dx") - F.col(x), 2) + F.pow(F.col("dy") - F.col(y), 2)
    near = peaks.select("scene", "k", "dx", "dy", "ncc").join(known.select("scene", "mx", "my", "px", "py"), "scene").groupBy("scene")
    near = near.agg(F.min(F.struct(gap("mx", "my").alias("d"), "k")).alias("mid"), F.min(F.when(F.col("px").isNotNull(), F.struct(gap("px", "py").alias("d"), "k", "dx", "dy", "ncc"))).alias("by"))
    got = known.join(near, "scene")

    apart = lambda a, b, most: F.abs(a - b) > most
    c = F.col
    off_prior = F.coalesce(apart(c("mx"), c("px"), cross_m) | apart(c("my"), c("py"), along_m), F.lit(False)) if cross_m > 0 or along_m > 0 else F.lit(False)
    close = (c("n") >= 3) & (c("sx") <= cross_m) & (c("sy") <= along_m) & ~off_prior
    no_prior = c("px").isNull() if cross_m > 0 or along_m > 0 else F.lit(True)
    unsure = (c("np") < 2) & (apart(c("px"), c("s_dx"), cross_m) | apart(c("py"), c("s_dy"), along_m))
    how = F.when(c("best").isNotNull(), "validated").when(close, "cluster").when(no_prior, "no_prior").when(F.coalesce(unsure, F.lit(False)), "uncorroborated")
    how = how.when(apart(c("by.dx"), c("px"), cross_m), "cross").when(apart(c("by.dy"), c("py"), along_m), "along").otherwise("prior")
    got = got.withColumn("outcome", how)
    pick = lambda a, b, d: F.when(c("outcome") == "validated", a).when(c("outcome") == "cluster", b).when(c("outcome") == "prior", d)
    none = F.lit(0).cast("long")
    got = got.select(
        "scene",
        "outcome",
        pick(c("best.k"), c("mid.k"), c("by.k")).alias("k"),
        pick(c("best.vdx"), c("mx"), c("by.dx")).alias("dx"),
        pick(c("best.vdy"), c("my"), c("by.dy")).alias("dy"),
        pick(c("best.n_matches").cast("long"), none, none).alias("n_matches"),
        pick(c("best.agreement"), F.greatest(F.lit(floor), c("mncc")), c("by.ncc")).alias("agreement"),
    )
    beyond = F.coalesce(F.hypot("dx", "dy") > 1.5 * radius_m, F.lit(False))
    return got.select("scene", F.when(beyond, "beyond").otherwise(c("outcome")).alias("outcome"), *[F.when(~beyond, c(x)).alias(x) for x in ("k", "dx", "dy", "n_matches", "agreement")])


def scale_correction(patches: DataFrame, *, by: str, scale: float = 0.02, degrees: float = 0.1) -> DataFrame:
    """by, scale_x, scale_y, rotation, x_spread, y_spread, n, n_valid, needed: medians of the patches (status, scale_x, scale_y,
    rotation, n_inliers) that hold or were filled, weighted by their inliers; spreads are of those that hold, 0 below two."""
    valid = patches.filter(F.col("status").isin("ok", "filled-neighbor", "filled-global"))
    weight = F.greatest(F.coalesce("n_inliers", F.lit(1)), F.lit(1))
    names = ("scale_x", "scale_y", "rotation")
    rows = valid.select(by, weight.alias("w"), F.inline(F.array(*[F.struct(F.lit(x).alias("name"), F.col(x).alias("v")) for x in names])))
    rows = rows.groupBy(by, "name", "v").agg(F.sum("w").alias("w"))
    group = W.partitionBy(by, "name")
    reached = rows.select(by, "name", "v", F.sum("w").over(group.orderBy("v")).alias("r"), F.sum("w").over(group).alias("t")).filter("r >= t / 2")
    mid = reached.groupBy(by).agg(*[F.min(F.when(F.col("name") == x, F.col("v"))).alias(x) for x in names])
    ok = lambda x: F.when(F.col("status") == "ok", F.col(x))
    spread = lambda x: F.when(F.count(ok(x)) >= 2, F.max(ok(x)) - F.min(ok(x))).otherwise(0.0)
    all_ = patches.groupBy(by).agg(spread("scale_x").alias("x_spread"), spread("scale_y").alias("y_spread"), F.count("*").alias("n"), F.count(F.when(F.col("status").isin("ok", "filled-neighbor", "filled-global"), 1)).alias("n_valid"))
    needed = ~((F.abs((F.col("scale_x") + F.col("scale_y")) / 2 - 1) <= scale) & (F.abs("rotation") <= degrees))
    return all_.join(mid, by, "left").select(by, *names, "x_spread", "y_spread", "n", "n_valid", F.coalesce(needed, F.lit(False)).alias("needed"))


def without_bias(flow: DataFrame, *, by: str, res_m: float, most_m: float, least_m: float = 5.0) -> DataFrame:
    """flow (by, dx, dy, reliable) less the median of its reliable places, capped, where that is beyond least_m on an axis."""
    held = lambda x: F.when(F.col("reliable"), F.col(x))
    mid = flow.groupBy(by).agg(_median(held("dx")).alias("bx"), _median(held("dy")).alias("by_"))
    biased = (F.abs("bx") * res_m > least_m) | (F.abs("by_") * res_m > least_m)
    cap = lambda x: F.greatest(F.lit(-most_m / res_m), F.least(F.lit(most_m / res_m), F.col(x)))
    moved = lambda x, b: (F.col(x) - F.when(biased, cap(b)).otherwise(0.0)).alias(x)
    rest = [x for x in flow.columns if x not in ("dx", "dy")]
    return flow.join(mid, by, "left").select(*rest, moved("dx", "bx"), moved("dy", "by_"))


def trusted_flow(places: DataFrame, *, by: str, most_px: float = 3.0) -> DataFrame:
    """places (by, error, uncertainty) with trusted: a small round-trip error, and no uncertainty far above the group's."""
    mid = places.groupBy(by).agg(_median(F.col("uncertainty")).alias("mid"))
    off = places.join(mid, by)
    mad = off.groupBy(by).agg(_median(F.abs(F.col("uncertainty") - F.col("mid"))).alias("mad"))
    small = F.col("uncertainty") < F.col("mid") + 2 * F.greatest(F.col("mad"), F.lit(0.1))
    return off.join(mad, by).withColumn("trusted", (F.col("error") < most_px) & F.coalesce(small, F.lit(True))).drop("mid", "mad")


def cuts(images: DataFrame, seams: DataFrame, *, share: float = 0.05, least: int = 50) -> DataFrame:
    """id, part, start, length: the parts of images (id, size) between their seams (id, at), widened towards a neighbour.

    A seam is a frame's edge within one scan, so an image has a handful of them.
    """
    held = images.join(seams.groupBy("id").agg(F.array_sort(F.collect_list(F.col("at").cast("long"))).alias("seams")), "id", "left")
    size = F.col("size").cast("long")
    edges = F.concat(F.array(F.lit(0).cast("long")), F.coalesce("seams", F.array().cast("array<bigint>")), F.array(size))
    parts = held.select("id", size.alias("size"), edges.alias("e"), F.explode(F.sequence(F.lit(0), F.size(edges) - 2)).alias("part"))
    lo, hi = F.get("e", F.col("part")), F.get("e", F.col("part") + 1)
    pad = F.greatest(F.lit(least), F.floor((hi - lo) * share))
    start = F.greatest(F.lit(0), lo - F.when(F.col("part") > 0, pad).otherwise(0))
    end = F.least(F.col("size"), hi + F.when(F.col("part") < F.size("e") - 2, pad).otherwise(0))
    return parts.select("id", "part", start.cast("long").alias("start"), (end - start).cast("long").alias("length"))


def geodetic(x: Column, y: Column, z: Column, rounds: int = 3) -> dict[str, Column]:
    """lat, lon (degrees) and height (m) of earth-centred points, by a parametric first guess that is refined a few times."""
    a, b = AXES
    flat, second = 1 - (b / a) ** 2, (a * a - b * b) / (b * b)
    p = F.hypot(x, y)
    t = F.atan2(z * a, p * b)
    lat = F.atan2(z + second * b * F.pow(F.sin(t), 3), p - flat * a * F.pow(F.cos(t), 3))
    normal = lambda at: a / F.sqrt(1 - flat * F.pow(F.sin(at), 2))
    for _ in range(rounds):
        # The latitude goes through a one-element array, or each round would repeat the last one's expression many times.
        lat = F.transform(F.array(lat), lambda v: F.atan2(z, p * (1 - flat * normal(v) / (p / F.cos(v)))))[0]
    return {"lat": F.degrees(lat), "lon": F.degrees(F.atan2(y, x)), "height": F.transform(F.array(lat), lambda v: p / F.cos(v) - normal(v))[0]}


def energies(nodes: DataFrame, *, by: str, dx_m: float, dy_m: float) -> DataFrame:
    """by, shear, bend: how far a grid of displacements (by, r, c, u, v in m) is from a similarity, and how much it bends."""
    along, down = W.partitionBy(by, "r").orderBy("c"), W.partitionBy(by, "c").orderBy("r")
    step = lambda x, w, d: (F.lead(x).over(w) - F.col(x)) / d
    first = nodes.select(by, "r", "c", *[step(x, w, d).alias(x + n) for x in "uv" for n, w, d in (("x", along, dx_m), ("y", down, dy_m))])
    twice = first.select("*", *[step(x + n, w, d).alias(x + n + n) for x in "uv" for n, w, d in (("x", along, dx_m), ("y", down, dy_m))])
    mean = lambda v: F.avg(F.pow(v, 2))
    c, area = F.col, dx_m * dy_m
    shear = (mean(c("ux") - c("vy")) + mean(c("uy") + c("vx"))) * area
    bend = (mean(c("uxx")) + mean(c("uyy")) + mean(c("vxx")) + mean(c("vyy"))) * area
    return twice.groupBy(by).agg(shear.alias("shear"), bend.alias("bend"))


def sampled(points: DataFrame, nodes: DataFrame, *, by: str, rows: int, columns: int) -> DataFrame:
    """points (by, id, x, y in -1 to 1) moved by the bilinear displacement of a grid (by, r, c, u, v); edge values go on outside."""
    place = lambda v, n: F.least(F.greatest((F.col(v) + 1) / 2 * (n - 1), F.lit(0.0)), F.lit(float(n - 1)))
    at = points.withColumn("gx", place("x", columns)).withColumn("gy", place("y", rows))
    c0, r0 = F.least(F.floor("gx"), F.lit(columns - 2)), F.least(F.floor("gy"), F.lit(rows - 2))
    fx, fy = F.col("gx") - c0, F.col("gy") - r0
    corner = lambda i, j: F.struct((r0 + i).cast("int").alias("r"), (c0 + j).cast("int").alias("c"), ((fy if i else 1 - fy) * (fx if j else 1 - fx)).alias("w"))
    asked = at.select(by, "id", "x", "y", F.inline(F.array(*[corner(i, j) for i in (0, 1) for j in (0, 1)])))
    got = asked.join(nodes.select(by, F.col("r").cast("int").alias("r"), F.col("c").cast("int").alias("c"), "u", "v"), [by, "r", "c"])
    return got.groupBy(by, "id", "x", "y").agg(F.sum(F.col("w") * F.col("u")).alias("du"), F.sum(F.col("w") * F.col("v")).alias("dv")).select(by, "id", (F.col("x") + F.col("du")).alias("x"), (F.col("y") + F.col("dv")).alias("y"))


def overlap_sums(met: DataFrame, *, least_px: int = 100, least_value: float = 5.0, least_std: float = 1.0) -> DataFrame:
    """mosaic, i, j, n, mean_i, mean_j, ii, jj, ij (sums over n) of pixels that two strips share (mosaic, i, j, a, b)."""
    a, b = F.col("a"), F.col("b")
    got = met.filter((a > least_value) & (b > least_value)).groupBy("mosaic", "i", "j")
    got = got.agg(F.count("*").alias("n"), F.avg(a).alias("mean_i"), F.avg(b).alias("mean_j"), F.stddev_pop(a).alias("sd_i"), F.stddev_pop(b).alias("sd_j"), F.avg(a * a).alias("ii"), F.avg(b * b).alias("jj"), F.avg(a * b).alias("ij"))
    return got.filter((F.col("n") >= least_px) & (F.col("sd_i") >= least_std) & (F.col("sd_j") >= least_std)).drop("sd_i", "sd_j")


def gains(sums: DataFrame, *, strength: float = 100.0) -> DataFrame:
    """mosaic, strip, gain, offset: the gains that bring shared pixels together while staying near 1, then half of what the
    means still differ, as an average over a strip's neighbours. A task holds the sums of one mosaic: a row a pair of strips."""

    def solve(pdf):
        import numpy as np
        import pandas as pd

        strips = np.unique(np.concatenate([pdf["i"], pdf["j"]]))
        i, j = np.searchsorted(strips, pdf["i"]), np.searchsorted(strips, pdf["j"])
        normal = np.eye(len(strips)) * strength
        np.add.at(normal, (i, i), pdf["ii"].to_numpy())
        np.add.at(normal, (j, j), pdf["jj"].to_numpy())
        np.add.at(normal, (i, j), -pdf["ij"].to_numpy())
        np.add.at(normal, (j, i), -pdf["ij"].to_numpy())
        gain = np.clip(np.linalg.solve(normal, np.full(len(strips), strength)), 0.5, 2.0)
        half = (pdf["mean_i"].to_numpy() * gain[i] - pdf["mean_j"].to_numpy() * gain[j]) / 2
        total = np.bincount(j, half, len(strips)) - np.bincount(i, half, len(strips))
        offset = np.clip(total / (np.bincount(i, minlength=len(strips)) + np.bincount(j, minlength=len(strips))), -50, 50)
        return pd.DataFrame({"mosaic": pdf["mosaic"].iloc[0], "strip": strips, "gain": gain, "offset": offset})

    return sums.groupBy("mosaic").applyInPandas(solve, "mosaic long, strip long, gain double, offset double")


def kept_anchors(anchors: DataFrame, fits: DataFrame, *, columns: int, rows: int, most: int = 3, factor: float = 4.0, floor_m: float = 100.0, sure_m: float = 30.0) -> DataFrame:
    """scene, id, residual, forced: anchors (scene, id, ref_x, ref_y, off_x, off_y) that a first fit bears out, and of the
    others up to ``most`` in grid cells that none of those holds, the nearest first, if two or more are rejected and the raw
    fit is tight. fits (scene, a, b, tx, c, d, ty, med_res, raw_med_res, left, bottom, right, top), one a scene."""
    c = F.col
    miss = F.hypot(c("ref_x") - (c("a") * c("off_x") + c("b") * c("off_y") + c("tx")), c("ref_y") - (c("c") * c("off_x") + c("d") * c("off_y") + c("ty")))
    cell = lambda v, lo, hi, n: F.least(F.lit(n - 1), F.greatest(F.lit(0), F.floor((c(v) - c(lo)) / ((c(hi) - c(lo)) / n))))
    rows_ = anchors.join(fits, "scene").select("scene", "id", miss.alias("residual"), "raw_med_res", cell("ref_x", "left", "right", columns).alias("gc"), cell("ref_y", "bottom", "top", rows).alias("gr"), (miss <= F.greatest(factor * c("med_res"), F.lit(floor_m))).alias("ok"))
    per_cell, per_scene = W.partitionBy("scene", "gr", "gc"), W.partitionBy("scene")
    seen = rows_.withColumn("held", F.max("ok").over(per_cell)).withColumn("lost", F.count_if(~c("ok")).over(per_scene))
    first = F.row_number().over(per_cell.orderBy("ok", "residual", "id"))
    able = ~c("ok") & ~c("held") & (c("lost") >= 2) & (c("raw_med_res") <= sure_m)
    seen = seen.withColumn("able", F.coalesce(able, F.lit(False)) & (first == 1))
    seen = seen.withColumn("place", F.row_number().over(per_scene.orderBy(F.desc("able"), "residual", "id")))
    return seen.filter(c("ok") | (c("able") & (c("place") <= most))).select("scene", "id", "residual", (~c("ok")).alias("forced"))


REPORT = "struct<candidate: string, total_score: double, accepted: boolean, grade: string, quality_grade: string, image_metrics: struct<patch_med: double, grid_score: double>>"


def selected_reports(files: DataFrame) -> DataFrame:
    """id, candidate, score, accepted, grade, patch_med, grid_score of QA files (id, json): the report written as selected, else
    the one of the selected name, else the first accepted one, else the first; nulls where the file can't be read."""
    got = files.select("id", F.from_json("json", f"struct<selected: {REPORT}, selected_candidate: string, reports: array<{REPORT}>>").alias("q"))
    first = lambda test: F.get(F.filter("q.reports", test), F.lit(0))
    pick = F.coalesce("q.selected", first(lambda r: r["candidate"] == F.col("q.selected_candidate")), first(lambda r: r["accepted"]), F.get("q.reports", F.lit(0)))
    got = got.select("id", pick.alias("r"))
    return got.select("id", F.col("r.candidate").alias("candidate"), F.col("r.total_score").alias("score"), F.col("r.accepted").alias("accepted"), F.coalesce("r.grade", "r.quality_grade").alias("grade"), F.col("r.image_metrics.patch_med").alias("patch_med"), F.col("r.image_metrics.grid_score").alias("grid_score"))
