"""Dense kernels: numpy on one tile at a time within Arrow batches. Results follow the definitions, not another library's
rounding."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def square(values) -> np.ndarray:
    side = int(len(values) ** 0.5)
    return np.asarray(values, np.float64)[: side * side].reshape(side, side)


def otsu(x: np.ndarray, bins: int = 64) -> float:
    """The level that parts values into two classes of least spread."""
    h, edges = np.histogram(x, bins)
    mid = (edges[1:] + edges[:-1]) / 2
    w = np.cumsum(h)
    m = np.cumsum(h * mid)
    with np.errstate(divide="ignore", invalid="ignore"):
        between = (m[-1] * w / w[-1] - m) ** 2 / (w * (w[-1] - w))
    return float(edges[1 + int(np.nanargmax(between[:-1]))]) if len(x) and h.max() < len(x) else float(x.min()) if len(x) else 0.0


def equalize(x: np.ndarray, clip: float = 3.0, bins: int = 256) -> np.ndarray:
    """Histogram equalisation with a clipped histogram, over the valid pixels of the tile."""
    on = x > 0
    if not on.any() or x[on].max() <= x[on].min():
        return np.zeros_like(x)
    u = np.zeros(x.shape, np.int64)
    u[on] = ((x[on] - x[on].min()) / (x[on].max() - x[on].min()) * (bins - 1)).astype(int)
    h = np.bincount(u[on], minlength=bins).astype(float)
    most = max(1.0, clip * h.sum() / bins)
    h = np.minimum(h, most) + np.maximum(h - most, 0).sum() / bins
    out = np.zeros_like(x)
    out[on] = (np.cumsum(h) / h.sum() * 255)[u[on]]
    return out


def phase_shift(a: np.ndarray, b: np.ndarray) -> tuple[float, float, float]:
    """Columns and rows by which b lies from a, to a part of a pixel, and the peak's height over the mean."""
    window = np.outer(np.hanning(a.shape[0]), np.hanning(a.shape[1]))
    cross = np.fft.fft2((b - b.mean()) * window) * np.conj(np.fft.fft2((a - a.mean()) * window))
    r = np.real(np.fft.ifft2(cross / np.maximum(np.abs(cross), 1e-12)))
    y, x = np.unravel_index(int(r.argmax()), r.shape)

    def top(before: float, at: float, after: float) -> float:
        bend = before - 2 * at + after
        return 0.0 if abs(bend) < 1e-12 else float(np.clip((before - after) / (2 * bend), -0.5, 0.5))

    h, w = r.shape
    fx, fy = top(r[y, x - 1], r[y, x], r[y, (x + 1) % w]), top(r[y - 1, x], r[y, x], r[(y + 1) % h, x])
    return (x + fx + w / 2) % w - w / 2, (y + fy + h / 2) % h - h / 2, float(r[y, x] - r.mean())


def laplacian_variance(x: np.ndarray) -> float:
    p = np.pad(x, 1, mode="reflect")
    return float((p[:-2, 1:-1] + p[2:, 1:-1] + p[1:-1, :-2] + p[1:-1, 2:] - 4 * x).var())


def dilate(mask: np.ndarray) -> np.ndarray:
    p = np.pad(mask, 1)
    return np.logical_or.reduce([p[i : i + mask.shape[0], j : j + mask.shape[1]] for i in range(3) for j in range(3)])


def erode(mask: np.ndarray) -> np.ndarray:
    return ~dilate(~mask)


def components(mask: np.ndarray) -> np.ndarray:
    """Labels of 8-connected parts, 0 outside, by repeated least neighbour."""
    label = np.where(mask, np.arange(1, mask.size + 1).reshape(mask.shape), 0)
    while True:
        p = np.pad(np.where(mask, label, mask.size + 1), 1, constant_values=mask.size + 1)
        least = np.minimum.reduce([p[i : i + mask.shape[0], j : j + mask.shape[1]] for i in range(3) for j in range(3)])
        new = np.where(mask, least, 0)
        if (new == label).all():
            return label
        label = new


def changed_land(a: np.ndarray, b: np.ndarray, least_px: int) -> np.ndarray:
    """Places that are land in one mask only: opened, small parts dropped, widened by one."""
    mask = dilate(erode(a != b))
    label = components(mask)
    size = np.bincount(label.ravel(), minlength=mask.size + 1)
    return dilate(mask & (size[label] >= least_px))


def masks(x: np.ndarray) -> dict[str, np.ndarray]:
    """Land, shoreline and stable places: brighter than Otsu's level, closed and opened; its rim; rim or strong texture."""
    on = x > 0
    land = on & (x > otsu(x[on])) if on.any() else on
    land = erode(dilate(land))
    land = dilate(erode(land)) & on
    shore = dilate(land) & ~erode(land)
    gy, gx = np.gradient(x)
    g = np.hypot(gx, gy)
    return {"land": land, "shoreline": shore & on, "stable": on & ((g / max(g.max(), 1e-9) > 0.22) | shore)}


def down(x: np.ndarray) -> np.ndarray:
    return (x[::2, ::2] + x[1::2, ::2] + x[::2, 1::2] + x[1::2, 1::2]) / 4


def up(x: np.ndarray) -> np.ndarray:
    return x.repeat(2, 0).repeat(2, 1)


def pyramid_blend(a: np.ndarray, b: np.ndarray, mask: np.ndarray, levels: int = 3) -> np.ndarray:
    """Blend of two tiles by a mask, band by band; sides must halve ``levels`` times."""
    if levels == 0 or min(a.shape) < 2 or a.shape[0] % 2 or a.shape[1] % 2:
        return a * mask + b * (1 - mask)
    la, lb = a - up(down(a)), b - up(down(b))
    return up(pyramid_blend(down(a), down(b), down(mask), levels - 1)) + la * mask + lb * (1 - mask)


def bilinear(x: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """Values at fractional places, 0 outside."""
    h, w = x.shape
    r0, c0 = np.floor(rows).astype(int), np.floor(cols).astype(int)
    out = np.zeros(rows.shape)
    for dr in (0, 1):
        for dc in (0, 1):
            r, c = r0 + dr, c0 + dc
            on = (r >= 0) & (r < h) & (c >= 0) & (c < w)
            weight = (1 - np.abs(rows - r)) * (1 - np.abs(cols - c))
            out[on] += weight[on] * x[r[on], c[on]]
    return out


def thin_plate(at: np.ndarray, values: np.ndarray, smooth: float = 0.0):
    """A function of places that passes through (or, smoothed, near) the values with least bending."""
    u = lambda d2: np.where(d2 > 0, d2 * np.log(np.maximum(d2, 1e-300)) / 2, 0.0)
    n = len(at)
    k = u(((at[:, None] - at[None]) ** 2).sum(-1)) + smooth * np.eye(n)
    p = np.c_[np.ones(n), at]
    m = np.block([[k, p], [p.T, np.zeros((3, 3))]])
    solved = np.linalg.lstsq(m, np.r_[values, np.zeros((3, *values.shape[1:]))], rcond=None)[0]
    return lambda q: u(((q[:, None] - at[None]) ** 2).sum(-1)) @ solved[:n] + np.c_[np.ones(len(q)), q] @ solved[n:]


def tile_measures(px: Column) -> Column:
    """struct of texture (Laplacian variance), land and stable shares, Otsu's level and the equalised mean."""

    @F.pandas_udf("texture double, level double, land double, stable double, equalized double")
    def run(column: pd.Series) -> pd.DataFrame:
        rows = []
        for v in column:
            x = square(v)
            m = masks(x)
            rows.append((laplacian_variance(x), otsu(x[x > 0]) if (x > 0).any() else 0.0, float(m["land"].mean()), float(m["stable"].mean()), float(equalize(x).mean())))
        return pd.DataFrame(rows, columns=["texture", "level", "land", "stable", "equalized"])

    return run(px)


def shifts(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """pairs with dx, dy, response of the phase correlation of two tiles, and changed: places of changed land."""

    @F.pandas_udf("dx double, dy double, response double, changed long")
    def run(x: pd.Series, y: pd.Series) -> pd.DataFrame:
        rows = []
        for u, v in zip(x, y, strict=True):
            p, q = square(u), square(v)
            rows.append((*phase_shift(p, q), int(changed_land(masks(p)["land"], masks(q)["land"], 2).sum())))
        return pd.DataFrame(rows, columns=["dx", "dy", "response", "changed"])

    return pairs.withColumn("s", run(F.col(a), F.col(b))).select(*pairs.columns, "s.*")


def blended(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """pairs with px: both tiles blended band by band, the first on the left."""

    @F.pandas_udf("array<double>")
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        out = []
        for u, v in zip(x, y, strict=True):
            p, q = square(u), square(v)
            out.append(pyramid_blend(p, q, (np.arange(p.shape[1]) < p.shape[1] / 2)[None, :] * np.ones_like(p)).ravel())
        return pd.Series(out)

    return pairs.withColumn("px", run(F.col(a), F.col(b)))


def warped(tiles: DataFrame, column: str, matrix: tuple[float, float, float, float, float, float]) -> DataFrame:
    """tiles with px: each place (r, c) takes the value at (a*c + b*r + tx, c'*c + d*r + ty) of the tile."""
    a, b, tx, c, d, ty = matrix

    @F.pandas_udf("array<double>")
    def run(x: pd.Series) -> pd.Series:
        out = []
        for u in x:
            p = square(u)
            rows, cols = np.mgrid[: p.shape[0], : p.shape[1]].astype(float)
            out.append(bilinear(p, c * cols + d * rows + ty, a * cols + b * rows + tx).ravel())
        return pd.Series(out)

    return tiles.withColumn("px", run(F.col(column)))
