"""Operators on match pairs: robust rejection, weighted affine fits, quotas, consistency with neighbours.

A pair is id, scene, is_anchor, ref_x, ref_y, off_x, off_y, confidence, prec. Displacement is offset minus reference; an
affine maps offset to reference coordinates. Statistics per scene are joined back to its pairs, so no scene is gathered in
one task; medians are exact.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orthoweave.functions.numbers import MAD_SCALE, clip, median, trunc0
from orthoweave.operators.nearest import _kept, nearest, nearest_places


def displaced(pairs: DataFrame) -> DataFrame:
    return pairs.withColumn("dx", F.col("off_x") - F.col("ref_x")).withColumn("dy", F.col("off_y") - F.col("ref_y"))


def reject_mad(pairs: DataFrame, *, sigmas: float = 2.5, coarse_total: float = 0.0) -> DataFrame:
    """Pairs within so many robust deviations of their scene's median displacement; anchors stay.

    A scene of four pairs or fewer, or one that would keep fewer than four, is left as it is.
    """
    floor = min(200.0, max(20.0, coarse_total * 0.03))
    rows = displaced(pairs)
    mid = rows.groupBy("scene").agg(F.count("*").alias("n"), median(F.col("dx")).alias("mx"), median(F.col("dy")).alias("my"))
    rows = rows.join(mid, "scene")
    spread = rows.groupBy("scene").agg((median(F.abs(F.col("dx") - F.col("mx"))) * MAD_SCALE).alias("sx"), (median(F.abs(F.col("dy") - F.col("my"))) * MAD_SCALE).alias("sy"))
    rows = rows.join(spread, "scene")
    near = lambda d, m, s: F.abs(F.col(d) - F.col(m)) < F.greatest(F.col(s), F.lit(floor)) * sigmas
    rows = rows.withColumn("near", F.col("is_anchor") | (near("dx", "mx", "sx") & near("dy", "my", "sy")))
    left = rows.groupBy("scene").agg(F.count_if("near").alias("left"))
    return rows.join(left, "scene").filter(F.col("near") | (F.col("n") <= 4) | (F.col("left") < 4)).select(*pairs.columns)


def anchor_displacement_outliers(anchors: DataFrame, *, min_keep: int = 4) -> DataFrame:
    """Anchors whose distance from the median displacement is below a limit that grows with confidence, 180 m at least."""
    rows = displaced(anchors)
    mid = rows.groupBy("scene").agg(F.count("*").alias("n"), median(F.col("dx")).alias("mx"), median(F.col("dy")).alias("my"))
    rows = rows.join(mid, "scene").withColumn("dist", F.sqrt(F.pow(F.col("dx") - F.col("mx"), 2) + F.pow(F.col("dy") - F.col("my"), 2)))
    rows = rows.join(rows.groupBy("scene").agg(median(F.col("dist")).alias("md")), "scene")
    rows = rows.join(rows.groupBy("scene").agg((median(F.abs(F.col("dist") - F.col("md"))) * MAD_SCALE).alias("mad")), "scene")
    limit = F.greatest(F.lit(180.0), clip((F.col("confidence") - 0.4) / 0.3 * 1.5 + 3.5, 3.5, 5.0) * F.col("mad"))
    rows = rows.withColumn("near", F.col("dist") <= limit)
    left = rows.groupBy("scene").agg(F.count_if("near").alias("left"))
    return rows.join(left, "scene").filter(F.col("near") | (F.col("n") < 6) | (F.col("left") < min_keep)).select(*anchors.columns)


def confidence_floor(pairs: DataFrame, *, floor: float = 0.25, least: int = 10) -> DataFrame:
    """Drops weak automatic pairs in scenes that have enough of them."""
    auto = pairs.groupBy("scene").agg(F.count_if(~F.col("is_anchor")).alias("auto"))
    return pairs.join(auto, "scene").filter(F.col("is_anchor") | (F.col("auto") < least) | (F.col("confidence") >= floor)).select(*pairs.columns)


def fit_affine(pairs: DataFrame, weight: Column | None = None, *, by: str = "scene") -> DataFrame:
    """by, n, a, b, tx, c, d, ty, status: weighted least squares from offset to reference coordinates.

    Coordinates are centred on their weighted means before sums of squares are taken; the 2x2 system that is left is
    solved in closed form. A group whose offsets lie on a line, or of fewer than 3 pairs, has status 'degenerate'.
    """
    rows = pairs.select(by, "ref_x", "ref_y", "off_x", "off_y", (F.lit(1.0) if weight is None else weight).alias("w"))
    mean = lambda c: (F.sum(F.col("w") * F.col(c)) / F.sum("w")).alias("m_" + c)
    rows = rows.join(rows.groupBy(by).agg(*[mean(c) for c in ("off_x", "off_y", "ref_x", "ref_y")]), by)
    u, v, x, y = (F.col(c) - F.col("m_" + c) for c in ("off_x", "off_y", "ref_x", "ref_y"))
    total = lambda p, q: F.sum(F.col("w") * p * q)
    sums = rows.groupBy(by).agg(
        F.count("*").alias("n"), *[F.first("m_" + c).alias("m_" + c) for c in ("off_x", "off_y", "ref_x", "ref_y")],
        total(u, u).alias("uu"), total(u, v).alias("uv"), total(v, v).alias("vv"), total(u, x).alias("ux"), total(v, x).alias("vx"), total(u, y).alias("uy"), total(v, y).alias("vy"),
    )
    det = F.col("uu") * F.col("vv") - F.col("uv") * F.col("uv")
    fine = (F.col("n") >= 3) & (det > F.col("uu") * F.col("vv") * 1e-12)
    solve = lambda p, q: F.when(fine, (p * F.col("vv") - q * F.col("uv")) / det), lambda p, q: F.when(fine, (q * F.col("uu") - p * F.col("uv")) / det)
    got = sums.select("*", solve[0](F.col("ux"), F.col("vx")).alias("a"), solve[1](F.col("ux"), F.col("vx")).alias("b"), solve[0](F.col("uy"), F.col("vy")).alias("c"), solve[1](F.col("uy"), F.col("vy")).alias("d"), F.when(fine, "ok").otherwise("degenerate").alias("status"))
    shift = lambda m, p, q: F.col(m) - F.col(p) * F.col("m_off_x") - F.col(q) * F.col("m_off_y")
    return got.select(by, "n", "a", "b", shift("m_ref_x", "a", "b").alias("tx"), "c", "d", shift("m_ref_y", "c", "d").alias("ty"), "status")


def residuals(pairs: DataFrame, fits: DataFrame, *, by: str = "scene") -> DataFrame:
    """pairs with residual, the distance between the mapped offset and the reference."""
    px = F.col("a") * F.col("off_x") + F.col("b") * F.col("off_y") + F.col("tx")
    py = F.col("c") * F.col("off_x") + F.col("d") * F.col("off_y") + F.col("ty")
    rows = pairs.join(fits.select(by, "a", "b", "tx", "c", "d", "ty"), by)
    return rows.select(*pairs.columns, F.sqrt(F.pow(px - F.col("ref_x"), 2) + F.pow(py - F.col("ref_y"), 2)).alias("residual"))


def residual_stats(rows: DataFrame, *, by: str = "scene") -> DataFrame:
    r = F.col("residual")
    return rows.groupBy(by).agg(F.count("*").alias("count"), F.avg(r).alias("mean_m"), median(r).alias("median_m"), F.percentile(r, F.lit(0.9)).alias("p90_m"), F.max(r).alias("max_m"))


def sufficient(pairs: DataFrame, *, target: int = 25) -> DataFrame:
    """scene, n, n_cells, sufficient: enough pairs, 100 m or more each way, and in 4 or more of 3x3 cells of their extent."""
    box = pairs.groupBy("scene").agg(F.count("*").alias("n"), *[f(c).alias(f"{p}_{c}") for c in ("ref_x", "ref_y") for p, f in (("lo", F.min), ("hi", F.max))])
    cell = lambda c: F.least(F.lit(2), trunc0((F.col(c) - F.col("lo_" + c)) / F.nullif(F.col("hi_" + c) - F.col("lo_" + c), F.lit(0.0)) * 3))
    cells = pairs.select("scene", "ref_x", "ref_y").join(box, "scene").select("scene", (cell("ref_x") * 3 + cell("ref_y")).alias("cell")).distinct().groupBy("scene").agg(F.count("cell").alias("n_cells"))
    wide = (F.col("hi_ref_x") - F.col("lo_ref_x") >= 100) & (F.col("hi_ref_y") - F.col("lo_ref_y") >= 100)
    return box.join(cells, "scene").select("scene", "n", "n_cells", ((F.col("n") >= target) & (F.col("n") >= 4) & wide & (F.col("n_cells") >= 4)).alias("sufficient"))


def quota(pairs: DataFrame, *, cell_m: float = 2000.0, quota: int = 28, per_side: int = 4, floor: int = 7, least: int = 100) -> DataFrame:
    """The most confident pairs of each of per_side squared parts of each cell; a cell left with fewer than floor gets its
    next best. Scenes of ``least`` pairs or fewer are left as they are."""
    part_m, most = cell_m / per_side, max(2, quota // 4)
    at = lambda c, m: F.floor(F.col(c) / m)
    rows = pairs.withColumn("cx", at("ref_x", cell_m)).withColumn("cy", at("ref_y", cell_m)).withColumn("px", at("ref_x", part_m)).withColumn("py", at("ref_y", part_m))
    best = [F.desc("confidence"), "id"]
    rows = rows.withColumn("rank", F.row_number().over(W.partitionBy("scene", "cx", "cy", "px", "py").orderBy(*best)))
    rows = rows.withColumn("taken", F.col("rank") <= most)
    cell = W.partitionBy("scene", "cx", "cy")
    rows = rows.withColumn("have", F.count_if("taken").over(cell)).withColumn("next", F.row_number().over(cell.orderBy("taken", *best)))
    rows = rows.join(pairs.groupBy("scene").agg(F.count("*").alias("n")), "scene")
    rescued = ~F.col("taken") & (F.col("next") <= floor - F.col("have"))
    return rows.filter(F.col("taken") | rescued | (F.col("n") <= least)).select(*pairs.columns)


def best_per_cell(pairs: DataFrame, *, cell_m: float, keep: int = 1) -> DataFrame:
    """The most confident pairs of each cell of a grid."""
    cell = [F.floor(F.col(c) / cell_m) for c in ("ref_x", "ref_y")]
    rank = F.row_number().over(W.partitionBy("scene", *cell).orderBy(F.desc("confidence"), "id"))
    return pairs.withColumn("rank", rank).filter(F.col("rank") <= keep).drop("rank")


#: Rows of a tile that one task's memory surely holds.
MOST = 500_000


def locally_consistent(candidates: DataFrame, reference: DataFrame, **more) -> DataFrame:
    """Candidates whose displacement is near the mean of their k nearest reference pairs within the radius, or which have
    none there but are confident."""
    known = reference.select("scene", "id", "ref_x", "ref_y", "off_x", "off_y").withColumn("_asked", F.lit(False)).withColumn("_known", F.lit(True))
    rows = candidates.withColumn("_asked", F.lit(True)).withColumn("_known", F.lit(False)).unionByName(known, allowMissingColumns=True)
    return _consistent(rows, **more)


def locally_consistent_within(pairs: DataFrame, asked: Column, **more) -> DataFrame:
    """The asked pairs that are consistent, as ``locally_consistent``, among all pairs: each row is dealt out once for both."""
    return _consistent(pairs.withColumn("_asked", F.coalesce(asked, F.lit(False))).withColumn("_known", F.lit(True)), **more)


def _consistent(rows: DataFrame, *, within_m: float = 50.0, k: int = 5, radius: float = 5000.0, alone: float = 0.65, most: int = MOST) -> DataFrame:
    """Those of rows (..., _asked, _known) that are asked and consistent with what is known.

    A task takes a tile of a scene and the known pairs up to the radius around it. Tiles of more than ``most`` rows are
    parted into smaller ones; what is still too dense goes by the joins of ``nearest``.
    """
    columns = [c for c in rows.columns if c not in ("_asked", "_known")]
    there = F.coalesce((F.abs("ref_x") < math.inf) & (F.abs("ref_y") < math.inf) & F.col("scene").isNotNull(), F.lit(False))
    kind = ", ".join(f"`{c}` {t}" for c, t in rows.select(*columns).dtypes)
    tile = ["scene", "_tx", "_ty"]

    def run(t):
        import pyarrow as pa
        import pyarrow.compute as pc

        t = t.take(pc.sort_indices(t["id"]))
        num = lambda c: (t[c].cast(pa.float64()).to_numpy(), t[c].is_valid().to_numpy())
        (x, _), (y, _), (u, has_u), (v, has_v), (sure, _) = (num(c) for c in ("ref_x", "ref_y", "off_x", "off_y", "confidence"))
        own, known = (np.flatnonzero(t[c].to_numpy()) for c in ("_own", "_known"))
        near = nearest_places(x[known], y[known], x[own], y[own], k, radius)
        found, near, mean = near >= 0, known[near] if len(known) else near, []
        for d, has in ((u - x, has_u), (v - y, has_v)):
            ok = found & has[near]
            mean.append((np.where(ok, d[near], 0).sum(1) / np.maximum(ok.sum(1), 1), ok.sum(1)))
        (mx, nx), (my, ny) = mean
        with np.errstate(invalid="ignore"):
            off = np.sqrt((u[own] - x[own] - mx) ** 2 + (v[own] - y[own] - my) ** 2)
            good = np.where(nx > 0, (ny > 0) & (off < within_m), sure[own] >= alone)
        return t.select(columns).take(own[good])

    found = [rows.filter(~there & F.col("_asked") & (F.col("confidence") >= alone))]
    rows = rows.filter(there)
    for side in (24 * radius, 6 * radius):
        at = lambda c, by=0.0: F.floor((F.col(c) + by) / side)  # noqa: B023, E731
        over = lambda c: F.when(F.col("_known"), F.sequence(at(c, -radius), at(c, radius))).otherwise(F.array(at(c)))  # noqa: B023, E731
        dealt = rows.withColumn("_tx", F.explode(over("ref_x"))).withColumn("_ty", F.explode(over("ref_y")))
        dealt = dealt.withColumn("_own", F.col("_asked") & (F.col("_tx") == at("ref_x")) & (F.col("_ty") == at("ref_y")))
        sizes = dealt.groupBy(*tile).agg(F.count("*").alias("n"), F.count_if("_own").alias("own")).filter("own > 0")
        total, largest = sizes.agg(F.sum("n"), F.max("n")).first()
        if total is None:
            break
        if largest > most or len(found) > 1:
            sizes = _kept(sizes, "tiles")
            dealt = dealt.join(sizes.filter(F.col("n") <= most).select(*tile), tile, "left_semi")
        parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), total // 200_000)
        found.append(dealt.repartition(parts, *tile).groupBy(*tile).applyInArrow(run, kind))
        if largest <= most:
            break
        dense = sizes.filter(F.col("n") > most).select(*tile, F.lit(True).alias("_dense"))
        rows = rows.withColumn("_tx", at("ref_x")).withColumn("_ty", at("ref_y")).join(dense, tile, "left").withColumn("_asked", F.col("_asked") & F.col("_dense").isNotNull()).drop("_tx", "_ty", "_dense")
        # What is no longer asked and not known is done.
        rows = rows.filter("_asked or _known")
    else:
        near = displaced(rows.filter("_known")).select("scene", F.col("ref_x").alias("qx"), F.col("ref_y").alias("qy"), F.col("id").alias("q"), F.col("dx").alias("n_dx"), F.col("dy").alias("n_dy"))
        asked = rows.filter("_asked")
        met = nearest(asked.select("scene", "id", F.col("ref_x").alias("x"), F.col("ref_y").alias("y")), near, k=k, cell=500.0, within=radius)
        mean = met.groupBy("scene", "id").agg(F.avg("n_dx").alias("mdx"), F.avg("n_dy").alias("mdy"))
        last = displaced(asked).join(mean, ["scene", "id"], "left")
        off = F.sqrt(F.pow(F.col("dx") - F.col("mdx"), 2) + F.pow(F.col("dy") - F.col("mdy"), 2))
        found.append(last.filter(F.when(F.col("mdx").isNull(), F.col("confidence") >= alone).otherwise(off < within_m)))
    got = found[0].select(*columns)
    for more_rows in found[1:]:
        got = got.unionByName(more_rows.select(*columns))
    return got


def weighted_median(rows: DataFrame, value: str, weight: str, *, by: str) -> DataFrame:
    """by, weighted_median: the first value at which half of the weight is reached. Weights are summed per value first."""
    sums = rows.groupBy(by, F.col(value).alias("v")).agg(F.sum(weight).alias("w"))
    reached = F.sum("w").over(W.partitionBy(by).orderBy("v"))
    sums = sums.withColumn("reached", reached).withColumn("total", F.sum("w").over(W.partitionBy(by)))
    return sums.filter(F.col("reached") >= F.col("total") / 2).groupBy(by).agg(F.min("v").alias("weighted_median"))


def translation(pairs: DataFrame) -> DataFrame:
    """scene, n, dx, dy, agreement: median displacement, and how far the pairs agree on it, between 0 and 1."""
    rows = displaced(pairs)
    mid = rows.groupBy("scene").agg(F.count("*").alias("n"), median(F.col("dx")).alias("mx"), median(F.col("dy")).alias("my"))
    off = rows.join(mid, "scene").groupBy("scene", "n", "mx", "my").agg((median(F.abs(F.col("dx") - F.col("mx"))) + median(F.abs(F.col("dy") - F.col("my")))).alias("mad"))
    return off.select("scene", "n", F.col("mx").alias("dx"), F.col("my").alias("dy"), (1 / (1 + F.col("mad") * MAD_SCALE / F.sqrt(F.col("n")))).alias("agreement"))


def precision_weights(pairs: DataFrame) -> DataFrame:
    """pairs with weight: precision over its scene's median, between 0.2 and 3."""
    mid = pairs.groupBy("scene").agg(median(F.col("prec")).alias("mid"))
    return pairs.join(mid, "scene").select(*pairs.columns, clip(F.col("prec") / F.col("mid"), 0.2, 3.0).alias("weight"))


def coverage(pairs: DataFrame, *, cells: int = 5) -> DataFrame:
    """scene, n, coverage: the share of cells of the extent of all scenes that hold a pair."""
    box = pairs.agg(*[f(c).alias(f"{p}_{c}") for c in ("ref_x", "ref_y") for p, f in (("lo", F.min), ("hi", F.max))])
    at = lambda c: F.least(F.lit(cells - 1), F.floor((F.col(c) - F.col("lo_" + c)) / F.greatest(F.col("hi_" + c) - F.col("lo_" + c), F.lit(1e-9)) * cells))
    seen = pairs.select("scene", "ref_x", "ref_y").crossJoin(F.broadcast(box)).groupBy("scene", (at("ref_x") * cells + at("ref_y")).alias("cell")).agg(F.count("*").alias("n"))
    return seen.groupBy("scene").agg(F.sum("n").alias("n"), (F.count("*") / float(cells * cells)).alias("coverage"))


def holdout(pairs: DataFrame, *, fraction: float = 0.2, least: int = 4) -> DataFrame:
    """pairs with holdout: a share of each scene's automatic pairs, by the order of a digest of their ids.

    The digest takes the place of a seeded shuffle, whose order no parallel engine can give. Scenes with fewer than
    max(least + 6, 12) automatic pairs hold nothing out; six stay for training.
    """
    auto = ~F.col("is_anchor")
    n = F.count_if(auto).over(W.partitionBy("scene"))
    rank = F.row_number().over(W.partitionBy("scene", "is_anchor").orderBy(F.md5(F.col("id").cast("binary")), "id"))
    take = F.least(F.greatest(F.lit(least), F.bround(n * fraction).cast("int")), F.greatest(F.lit(0), n - 6))
    return pairs.withColumn("n", n).withColumn("rank", rank).withColumn("take", take).select(*pairs.columns, (auto & (F.col("n") >= max(least + 6, 12)) & (F.col("rank") <= F.col("take"))).alias("holdout"))


def inverse_affine(fits: DataFrame, points: DataFrame) -> DataFrame:
    """points (scene, name, gx, gy) with off_x, off_y, where the fit's inverse puts them; none for a singular fit."""
    det = F.col("a") * F.col("d") - F.col("b") * F.col("c")
    x, y = F.col("gx") - F.col("tx"), F.col("gy") - F.col("ty")
    rows = points.join(fits, "scene").filter(F.abs(det) > 0)
    return rows.select(*points.columns, ((F.col("d") * x - F.col("b") * y) / det).alias("off_x"), ((F.col("a") * y - F.col("c") * x) / det).alias("off_y"))


def frame_points(frames: DataFrame, *, spacing: int = 500) -> DataFrame:
    """scene, edge, step, col, row: points every ``spacing`` pixels along the four edges of frames (scene, width, height)."""
    along = lambda n: F.sequence(F.lit(0), F.greatest(F.lit(2), F.floor(n / spacing) + 1).cast("int") - 1)
    edges = F.array(*[F.struct(F.lit(e).alias("edge"), along(F.col("width") if e in ("top", "bottom") else F.col("height")).alias("steps")) for e in ("top", "bottom", "left", "right")])
    rows = frames.select("scene", "width", "height", F.explode(edges).alias("e")).select("scene", "width", "height", "e.edge", F.size("e.steps").alias("n"), F.explode("e.steps").alias("step"))
    part = F.col("step") / (F.col("n") - 1)
    side = lambda first, last, full: F.when(F.col("edge") == first, F.lit(0.0)).when(F.col("edge") == last, F.col(full).cast("double")).otherwise(part * F.col(full))
    return rows.select("scene", "edge", "step", side("left", "right", "width").alias("col"), side("top", "bottom", "height").alias("row"))


def corroborated(anchors: DataFrame, presearch: DataFrame) -> DataFrame:
    """scene, dx, dy, reason: the median shift of few anchors, and why it is not to be trusted (null if it is).

    presearch: scene, pre_x, pre_y; a scene without one has no consensus to agree with.
    """
    rows = displaced(anchors).groupBy("scene").agg(median(F.col("dx")).alias("dx"), median(F.col("dy")).alias("dy"), F.greatest(F.stddev_pop("dx"), F.stddev_pop("dy")).alias("std"), median(F.col("confidence")).alias("conf")).join(presearch, "scene", "left")
    total = F.sqrt(F.pow("dx", F.lit(2)) + F.pow("dy", F.lit(2)))
    ex, ey = F.col("dx") - F.col("pre_x"), F.col("dy") - F.col("pre_y")
    reason = (
        F.when((total < 20) | (total > 1500), "shift out of range")
        .when(F.col("std") > 150, "anchors disagree")
        .when(F.col("conf") < 0.35, "low confidence")
        .when(F.col("pre_x").isNull(), "no presearch")
        .when((F.abs(ex) > 75) | (F.abs(ey) > 75) | (F.sqrt(ex * ex + ey * ey) > 100), "presearch disagrees")
    )
    return rows.select("scene", "dx", "dy", reason.alias("reason"))


def chamfer(pairs: DataFrame, *, soft_m: float = 500.0, slope: float = 0.3, cell_m: float = 500.0) -> DataFrame:
    """scene, chamfer_m: mean distance from each offset point to the nearest reference point, and back, halved.

    Distances beyond soft_m grow by ``slope`` only, without end. The search begins with cells of cell_m and widens them for
    points whose nearest neighbour is further away.
    """
    off = pairs.select("scene", "id", F.col("off_x").alias("x"), F.col("off_y").alias("y"))
    ref = pairs.select("scene", "id", F.col("ref_x").alias("x"), F.col("ref_y").alias("y"))

    def one_way(p: DataFrame, q: DataFrame) -> DataFrame:
        places = q.select("scene", F.col("x").alias("qx"), F.col("y").alias("qy")).distinct().withColumn("q", F.lit(0))
        soft = F.when(F.col("dist") > soft_m, soft_m + (F.col("dist") - soft_m) * slope).otherwise(F.col("dist"))
        return nearest(p, places, k=1, cell=cell_m).groupBy("scene").agg(F.avg(soft).alias("m"))

    there, back = one_way(off, ref), one_way(ref, off).withColumnRenamed("m", "b")
    return there.join(back, "scene").select("scene", ((F.col("m") + F.col("b")) / 2).alias("chamfer_m"))


def initial_affine(pairs: DataFrame) -> DataFrame:
    """First fit of each scene: by its anchors if there are four or more, else by anchors and automatic pairs at 50 to 1."""
    anchors = F.count_if("is_anchor").over(W.partitionBy("scene"))
    rows = pairs.withColumn("anchors", anchors).filter(F.col("is_anchor") | (F.col("anchors") < 4))
    return fit_affine(rows, F.when(F.col("is_anchor") & (F.col("anchors") < 4), 50.0).otherwise(1.0))


def quality_gate(pairs: DataFrame, *, most_m: float = 50.0) -> DataFrame:
    """Pairs of the scenes whose automatic pairs fit an affine with a mean residual below a limit; of others the anchors."""
    auto = pairs.filter(~F.col("is_anchor"))
    mean = residual_stats(residuals(auto, fit_affine(auto))).select("scene", F.col("mean_m").alias("m"))
    return pairs.join(mean, "scene", "left").filter(F.col("is_anchor") | (F.col("m") < most_m)).select(*pairs.columns)


def fit_or_shift(pairs: DataFrame) -> DataFrame:
    """The affine of each scene, or where its points determine none the median displacement as one."""
    mid = displaced(pairs).groupBy("scene").agg(median(F.col("dx")).alias("mx"), median(F.col("dy")).alias("my"))
    det = F.col("a") * F.col("d") - F.col("b") * F.col("c")
    bad = (F.col("status") == "degenerate") | (F.abs(det) < 1e-9)
    pick = lambda name, v: F.when(bad, v).otherwise(F.col(name)).alias(name)
    rows = fit_affine(pairs).join(mid, "scene")
    return rows.select("scene", "n", pick("a", F.lit(1.0)), pick("b", F.lit(0.0)), pick("tx", -F.col("mx")), pick("c", F.lit(0.0)), pick("d", F.lit(1.0)), pick("ty", -F.col("my")), F.when(bad, "translation").otherwise("affine").alias("kind"))


def correct_reference_offset(pairs: DataFrame, *, least_m: float = 20.0, most_mean_m: float = 50.0) -> DataFrame:
    """pairs whose automatic reference points are moved as the scene's anchors ask, by an affine of the anchors' shifts.

    Left as they are: scenes with fewer than three anchors or six automatic pairs, with a median shift below least_m, with
    fewer than three anchors near a first fit, or with a last fit of more than three anchors that misses by more on average.
    """
    auto, anchors = pairs.filter(~F.col("is_anchor")), pairs.filter("is_anchor")
    n = pairs.groupBy("scene").agg(F.count_if("is_anchor").alias("na"), F.count_if(~F.col("is_anchor")).alias("nb")).filter("na >= 3 and nb >= 6").select("scene")
    m = fit_affine(auto.join(n, "scene", "left_semi"))
    at = anchors.join(m.select("scene", "a", "b", "tx", "c", "d", "ty"), "scene")
    px, py = F.col("a") * F.col("off_x") + F.col("b") * F.col("off_y") + F.col("tx"), F.col("c") * F.col("off_x") + F.col("d") * F.col("off_y") + F.col("ty")
    shift = at.select("scene", "id", "off_x", "off_y", (F.col("ref_x") - px).alias("ref_x"), (F.col("ref_y") - py).alias("ref_y"))
    mid = shift.groupBy("scene").agg(median(F.col("ref_x")).alias("mx"), median(F.col("ref_y")).alias("my"))
    first = residuals(shift, fit_affine(shift))
    limit = first.groupBy("scene").agg(F.greatest(median(F.col("residual")) * 3, F.lit(50.0)).alias("limit"))
    near = first.join(limit, "scene").filter("residual < limit").select("scene", "id", "off_x", "off_y", "ref_x", "ref_y")
    last = fit_affine(near)
    miss = residual_stats(residuals(near, last)).select("scene", "count", "mean_m")
    good = last.filter("status = 'ok'").join(miss, "scene").join(mid, "scene").filter((F.sqrt(F.col("mx") * F.col("mx") + F.col("my") * F.col("my")) >= least_m) & (F.col("count") >= 3) & ((F.col("count") <= 3) | (F.col("mean_m") <= most_mean_m)))
    rows = pairs.join(good.select("scene", "a", "b", "tx", "c", "d", "ty"), "scene", "left")
    moves = ~F.col("is_anchor") & F.col("a").isNotNull()
    new = {"ref_x": F.when(moves, F.col("ref_x") + px).otherwise(F.col("ref_x")), "ref_y": F.when(moves, F.col("ref_y") + py).otherwise(F.col("ref_y"))}
    return rows.select(*[new[c].alias(c) if c in new else F.col(c) for c in pairs.columns], F.col("a").isNotNull().alias("corrected"))
