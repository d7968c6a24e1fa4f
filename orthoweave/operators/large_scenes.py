"""The loops of ``iterative`` over scenes too large for one task: each step is a pass over all rows.

Tasks send back sums of their rows only, so the driver holds a few numbers for each task and large scene, and large scenes
are at most rows / MOST. Least squares are solved from QR factors, which lose no digits as sums of squares do.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orthoweave.operators.nearest import _kept

#: Rows of a scene that one task's memory surely holds.
MOST = 200_000


def parted(pairs: DataFrame, most: int) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """The rows of small scenes, those of large ones, and how many each large one has."""
    large = {r.scene: r.n for r in pairs.groupBy("scene").agg(F.count("*").alias("n")).filter((F.col("n") > most) & F.col("scene").isNotNull()).collect()}
    of = F.coalesce(F.col("scene").isin(list(large)), F.lit(False)) if large else F.lit(False)
    return pairs.filter(~of), pairs.filter(of), large


def told(rows: DataFrame, step: Callable[[str, pd.DataFrame], dict], merge: Callable[[str | int, list], object]) -> dict:
    """{(scene, key): merged}: step gives each scene's rows of a batch as {key: value}, values are merged in a task and then
    in the order of the tasks."""

    def run(batches):
        from pyspark import TaskContext

        got: dict = {}
        for b in batches:
            for scene, g in b.groupby("scene", sort=False):
                for key, v in step(scene, g).items():
                    got[scene, key] = merge(key, [got[scene, key], v]) if (scene, key) in got else v
        if got:
            yield pd.DataFrame({"scene": [s for s, _ in got], "part": TaskContext.get().partitionId(), "key": [json.dumps(k) for _, k in got], "value": [json.dumps(v.tolist() if isinstance(v, np.ndarray) else v) for v in got.values()]})

    found: dict = {}
    for r in sorted(rows.mapInPandas(run, "scene string, part int, key string, value string").collect()):
        found.setdefault((r.scene, json.loads(r.key)), []).append(json.loads(r.value))
    return {k: merge(k[1], v) for k, v in found.items()}


def factor(off: np.ndarray, ref: np.ndarray, w: np.ndarray | None = None) -> np.ndarray:
    """What is needed of points for a fit: the triangle of QR over offset, 1 and reference."""
    a = np.c_[off, np.ones(len(off)), ref]
    return np.linalg.qr(a if w is None else a * np.sqrt(w)[:, None], mode="r")


def factors(got: list) -> np.ndarray:
    return np.linalg.qr(np.vstack([np.asarray(v, float).reshape(-1, 5) for v in got]), mode="r")


def solved(r: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """2x3 affine of a factor; centre: the points' plain mean, as in ``iterative.lstsq``."""
    a = np.asarray(r, float).copy()
    a[:, :2] -= a[:, 2:3] * centre
    m = np.linalg.lstsq(a[:, :3], a[:, 3:], rcond=None)[0].T
    m[:, 2] -= m[:, :2] @ centre
    return m


def plain_mean(r: np.ndarray) -> np.ndarray:
    """Mean offset of the unweighted points of a factor."""
    sums = r[:, 2] @ r[:, :3]
    return sums[:2] / sums[2]


def _points(g: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    return g[["off_x", "off_y"]].to_numpy(float), g[["ref_x", "ref_y"]].to_numpy(float)


def _errors(m: np.ndarray, off: np.ndarray, ref: np.ndarray) -> np.ndarray:
    return np.hypot(*(off @ m[:, :2].T + m[:, 2] - ref).T)


@functools.lru_cache(maxsize=2)
def _folds(n: int, folds: int) -> np.ndarray:
    return (np.random.default_rng(42).permutation(n) % folds).astype(np.int16)


def cross_validate(rows: DataFrame, n: dict[str, int], *, folds: int, refit_m: float) -> list[tuple[str, int, float]]:
    """(scene, folds, cv_mean_m). Places in the order of ids, which decide the folds, come from a sort by ranges."""
    at = rows.select("scene", "id", "off_x", "off_y", "ref_x", "ref_y").repartitionByRange("scene", "id").sortWithinPartitions("scene", "id")
    kept = _kept(at.select("scene", "off_x", "off_y", "ref_x", "ref_y", F.monotonically_increasing_id().alias("at")), "cross-validate")
    part = F.shiftright("at", 33)
    first, reached = {}, dict.fromkeys(n, 0)
    for r in sorted(kept.groupBy("scene", part.alias("part")).agg(F.min("at").alias("lo"), F.count("*").alias("k")).collect()):
        first.setdefault(r.scene, {})[r.part] = r.lo - reached[r.scene]
        reached[r.scene] += r.k

    def places(scene: str, g: pd.DataFrame) -> np.ndarray:
        a = g["at"].to_numpy()
        return a - pd.Series(a >> 33).map(first[scene]).to_numpy()

    def one(rows: DataFrame, among: dict[str, np.ndarray] | None = None) -> dict[str, float]:
        """Mean error by scene of what is held out; among: a model for each scene, whose inliers alone count."""

        def taken(scene, g):
            off, ref = _points(g)
            fold = _folds(n[scene], folds)[places(scene, g)]
            ok = slice(None) if among is None else _errors(among[scene], off, ref) < refit_m
            return off[ok], ref[ok], fold[ok]

        def fit(scene, g):
            off, ref, fold = taken(scene, g)
            return {int(k): factor(off[fold == k], ref[fold == k]) for k in np.unique(fold)}

        parts = told(rows, fit, lambda _, v: factors(v))
        size = {k: float(v[:, 2] @ v[:, 2]) for k, v in parts.items()}
        models = {}
        for scene in {s for s, _ in parts}:
            have = [k for k in range(folds) if (scene, k) in parts]
            if len(have) < folds or (among is not None and round(sum(size[scene, k] for k in have)) < 2 * folds):
                continue
            for k in have:
                r = factors([parts[scene, j] for j in have if j != k])
                models[scene, k] = solved(r, plain_mean(r))
        fitted = {s for s, _ in models}

        def miss(scene, g):
            if scene not in fitted:
                return {}
            off, ref, fold = taken(scene, g)
            return {0: np.array([len(off), sum(_errors(models[scene, int(k)], off[fold == k], ref[fold == k]).sum() for k in np.unique(fold))])}

        return {s: v[1] / v[0] for (s, _), v in told(rows, miss, lambda _, v: np.sum(v, 0)).items()}

    cv = one(kept)
    wild = [s for s, v in cv.items() if v > refit_m]
    if wild:
        some = kept.filter(F.col("scene").isin(wild))
        models = consensus(some, {s: n[s] for s in wild}, places, refit_m)
        cv |= one(some.filter(F.col("scene").isin(list(models))), models) if models else {}
    return [(s, folds, float(v)) for s, v in cv.items()]


def consensus(rows: DataFrame, n: dict[str, int], places: Callable, threshold: float, draws: int = 200, seed: int = 42) -> dict[str, np.ndarray]:
    """The draw of three points that most points agree with, by scene: the draws of ``iterative.robust_fit``."""
    from orthoweave.operators.iterative import lstsq

    drawn = {}
    for scene, k in n.items():
        rng = np.random.default_rng(seed)
        drawn[scene] = np.array([rng.choice(k, 3, replace=False) for _ in range(draws)])

    def pick(scene, g):
        at = places(scene, g)
        hit = np.isin(at, drawn[scene])
        return {int(i): p for i, p in zip(at[hit], g.loc[hit, ["off_x", "off_y", "ref_x", "ref_y"]].to_numpy(float), strict=True)}

    point = told(rows, pick, lambda _, v: np.asarray(v[0]))
    models = {}
    for scene, d in drawn.items():
        p = np.array([[point[scene, int(i)] for i in three] for three in d])
        models[scene] = [lstsq(q[:, :2], q[:, 2:]) for q in p]

    def agree(scene, g):
        off, ref = _points(g)
        return {0: np.array([int((_errors(m, off, ref) < threshold).sum()) for m in models[scene]])}

    hits = {s: v for (s, _), v in told(rows, agree, lambda _, v: np.sum(v, 0)).items()}
    return {s: models[s][int(np.argmax(v))] for s, v in hits.items() if v.max() > 0}


def outlier_removal(rows: DataFrame, n: dict[str, int], *, floor_m: float, rounds: int) -> DataFrame:
    """rows left with residual, as ``iterative.outlier_removal``, in three passes a round. Medians are not sought: how many
    errors lie below a third of the worst, and which are nearest to it, tell whether the worst is beyond three of them."""
    gone: dict[str, list[str]] = {s: [] for s in n}
    model: dict[str, np.ndarray] = {}
    box: dict[str, tuple[float, float, int]] = {}

    def of(scenes, *more: str) -> DataFrame:
        named = ["id"] if any(gone.values()) and "id" not in more else []
        return rows.filter(F.col("scene").isin(list(scenes))).select("scene", "off_x", "off_y", "ref_x", "ref_y", "is_anchor", *named, *more)

    def left(scene, g):
        return g[~g["id"].isin(gone[scene])] if gone[scene] else g

    def fit(scenes, anchors: float) -> None:
        def step(scene, g):
            g = left(scene, g)
            off, ref = _points(g)
            w = g.confidence.to_numpy(float) * np.where(g.is_anchor.to_numpy(bool), anchors, 1)
            return {"fit": factor(off, ref, w), "sum": np.r_[off.sum(0), len(g)], "lo": [off[:, 0].min(initial=np.inf)], "hi": [off[:, 0].max(initial=-np.inf)]}

        how = {"fit": factors, "sum": lambda v: np.sum(v, 0), "lo": min, "hi": max}
        got = told(of(scenes, "confidence"), step, lambda k, v: how[k](v))
        for s in scenes:
            sums = np.asarray(got[s, "sum"])
            model[s], box[s] = solved(got[s, "fit"], sums[:2] / sums[2]), (got[s, "lo"][0], got[s, "hi"][0], int(sums[2]))

    def judged(scene, g):
        g = left(scene, g)
        off, ref = _points(g)
        return g, _errors(model[scene], off, ref), off[:, 0] < (box[scene][0] + box[scene][1]) / 2

    def worst(scene, g):
        g, r, west = judged(scene, g)
        if not len(g):
            return {}
        at = np.flatnonzero(r == r.max())
        i = at[np.argmin(g["id"].to_numpy()[at])]
        return {"worst": [[-float(r[i]), g["id"].iloc[i], bool(west[i]), bool(g.is_anchor.iloc[i])]], "west": int(west.sum())}

    fit(n, 5)
    busy = set(n)
    for turn in range(rounds):
        busy = {s for s in busy if turn < n[s] // 3 and box[s][2] > 6}
        if not busy:
            break
        got = told(of(busy, "id"), worst, lambda k, v: [min(x[0] for x in v)] if k == "worst" else sum(v))
        top = {s: got[s, "worst"][0] for s in busy}
        halves = {s: got[s, "west"] >= 3 and box[s][2] - got[s, "west"] >= 3 for s in busy}
        busy = {s for s in busy if -top[s][0] > max(floor_m, max(5 * floor_m, 75) if top[s][3] else 0)}
        if not busy:
            break

        def near(scene, g):
            g, r, west = judged(scene, g)
            r = r[west == top[scene][2]] if halves[scene] else r
            less = 3 * r < -top[scene][0]
            return {"n": np.array([len(r), int(less.sum())]), "below": float(r[less].max(initial=-np.inf)), "above": float(r[~less].min(initial=np.inf))}

        how = {"n": lambda v: np.sum(v, 0), "below": max, "above": min}
        got = told(of(busy), near, lambda k, v: how[k](v))
        for s in list(busy):
            k, less = map(int, got[s, "n"])
            beyond = less > k // 2 if k % 2 or less != k // 2 else 3 * ((got[s, "below"] + got[s, "above"]) / 2) < -top[s][0]
            if beyond:
                gone[s].append(top[s][1])
            else:
                busy.remove(s)
        if busy:
            fit(sorted(busy), 1)
    changed = sorted(s for s in n if gone[s])
    if changed:
        fit(changed, 5)
    fits = rows.sparkSession.createDataFrame([(s, *map(float, m.ravel())) for s, m in model.items()], "scene string, _a double, _b double, _tx double, _c double, _d double, _ty double")
    away = F.lit(False)
    for s in changed:
        away = away | ((F.col("scene") == s) & F.col("id").isin(gone[s]))
    px = F.col("_a") * F.col("off_x") + F.col("_b") * F.col("off_y") + F.col("_tx") - F.col("ref_x")
    py = F.col("_c") * F.col("off_x") + F.col("_d") * F.col("off_y") + F.col("_ty") - F.col("ref_y")
    return rows.filter(~away).join(F.broadcast(fits), "scene").select(*rows.columns, F.sqrt(px * px + py * py).alias("residual"))
