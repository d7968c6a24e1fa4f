"""Dense kernels on pairs of tiles and on single ones: matching, boundaries, filling, lens and pose arithmetic; numpy only."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orthoweave.operators.iterative import delaunay, lstsq
from orthoweave.operators.kernels import bilinear, components, dilate, erode, masks, otsu, phase_shift, square


def edges(mask: np.ndarray) -> np.ndarray:
    return dilate(mask) & ~erode(mask)


def boundary_distance(a: np.ndarray, b: np.ndarray, valid: np.ndarray, res_m: float) -> float | None:
    """Median distance in m from the edge of either mask to the other's; None if one has no edge."""
    p, q = np.argwhere(edges(a) & valid), np.argwhere(edges(b) & valid)
    if not len(p) or not len(q):
        return None
    d = np.hypot(*(p[:, None] - q[None]).transpose(2, 0, 1))
    return float(np.median(np.r_[d.min(1), d.min(0)])) * res_m


def template_match(image: np.ndarray, patch: np.ndarray) -> tuple[float, float, float]:
    """Column, row and height of the best zero-mean normalised correlation of a patch within an image."""
    windows = np.lib.stride_tricks.sliding_window_view(image, patch.shape)
    w = windows - windows.mean((2, 3), keepdims=True)
    t = patch - patch.mean()
    norm = np.sqrt((w * w).sum((2, 3)) * (t * t).sum())
    r = np.where(norm > 1e-12, (w * t).sum((2, 3)) / np.maximum(norm, 1e-12), 0.0)
    y, x = np.unravel_index(int(r.argmax()), r.shape)

    def part(line: np.ndarray, i: int) -> float:
        if 0 < i < len(line) - 1 and abs(bend := line[i - 1] - 2 * line[i] + line[i + 1]) > 1e-12:
            return float(np.clip((line[i - 1] - line[i + 1]) / (2 * bend), -0.5, 0.5))
        return 0.0

    return x + part(r[y], x), y + part(r[:, x], y), float(r[y, x])


def land_offset(ref: np.ndarray, off: np.ndarray, half: int, floor: float = 0.25) -> tuple[float, float, float]:
    """Columns and rows by which the land in a tile's middle is found away from it, (0, 0, 0) below the floor."""
    m = ref.shape[0] // 2
    patch = masks(ref)["land"][m - half : m + half, m - half : m + half].astype(float)
    x, y, r = template_match(masks(off)["land"].astype(float), patch)
    return (x - (m - half), y - (m - half), r) if r >= floor else (0.0, 0.0, 0.0)


def patches(x: np.ndarray, size: int, stride: int, least_valid: float = 0.6) -> list[tuple[int, int]]:
    """First row and column of each square with enough valid pixels."""
    h, w = x.shape
    return [(r, c) for r in range(0, h - size + 1, stride) for c in range(0, w - size + 1, stride) if (x[r : r + size, c : c + size] > 0).mean() >= least_valid]


def displacement(a: np.ndarray, b: np.ndarray, size: int, stride: int, res_m: float, least: int = 2) -> dict[str, float] | None:
    """Median, 90th percentile and number of the patches' shifts in m; None if too few are valid in both."""
    both = np.where((a > 0) & (b > 0), a, 0)
    d = [float(np.hypot(*phase_shift(a[r : r + size, c : c + size], b[r : r + size, c : c + size])[:2])) * res_m for r, c in patches(both, size, stride)]
    return {"median_m": float(np.median(d)), "p90_m": float(np.percentile(d, 90)), "count": len(d)} if len(d) >= least else None


def mask_correlation(a: np.ndarray, b: np.ndarray) -> float | None:
    """Pearson correlation of two tiles' bright classes after a 2-98 % stretch; None with little overlap or one class."""
    on = (a > 0) & (b > 0)
    if on.mean() < 0.05:
        return None
    lands = []
    for x in (a, b):
        lo, hi = np.percentile(x[on], (2, 98))
        y = np.clip((x - lo) / max(hi - lo, 1e-9), 0, 1)
        land = (y > otsu(y[on]))[on]
        if not 0.02 <= land.mean() <= 0.98:
            return None
        lands.append(land.astype(float))
    return float(np.corrcoef(*lands)[0, 1])


def fill_interior(x: np.ndarray) -> np.ndarray:
    """Empty places that the border doesn't reach take the mean of filled neighbours, from the rim inwards."""
    label = components(x <= 0)
    rim = np.unique(np.r_[label[0], label[-1], label[:, 0], label[:, -1]])
    todo = (x <= 0) & ~np.isin(label, rim)
    out = x.astype(float)
    have = ~todo & (x > 0)
    while todo.any():
        p, k = np.pad(np.where(have, out, 0), 1), np.pad(have.astype(float), 1)
        near = lambda v: sum(v[i : i + x.shape[0], j : j + x.shape[1]] for i in range(3) for j in range(3))  # noqa: B023, E731
        total, n = near(p), near(k)
        now = todo & (n > 0)
        out[now] = total[now] / n[now]
        have |= now
        todo &= ~now
    return out


def sparse_parts(mask: np.ndarray, most_density: float = 0.5) -> np.ndarray:
    """The mask without parts that fill more of their bounding box than a line would."""
    label = components(mask)
    out = mask.copy()
    for k in np.unique(label[mask]):
        at = np.argwhere(label == k)
        box = np.prod(at.max(0) - at.min(0) + 1)
        if box > 9 and len(at) / box > most_density:
            out[label == k] = False
    return out


def gaussian(x: np.ndarray, sigma: float) -> np.ndarray:
    n = max(1, int(3 * sigma))
    k = np.exp(-((np.arange(-n, n + 1) / sigma) ** 2) / 2)
    rows = np.apply_along_axis(lambda v: np.convolve(v, k)[n : n + len(v)], 0, x)
    return np.apply_along_axis(lambda v: np.convolve(v, k)[n : n + len(v)], 1, rows)


def soft_zero(flow: np.ndarray, reliable: np.ndarray, sigma: float = 6.0) -> np.ndarray:
    """Unreliable places take the smoothed mean of reliable ones near them, none where there are none."""
    weight = gaussian(reliable.astype(float), sigma)
    mean = gaussian(np.where(reliable, flow, 0.0), sigma) / np.maximum(weight, 1e-12)
    return np.where(reliable, flow, np.where(weight > 1e-6, mean, 0.0))


def round_trip(forward: np.ndarray, backward: np.ndarray) -> np.ndarray:
    """How far each place is from itself after both flows (2, rows, columns: x then y)."""
    h, w = forward.shape[1:]
    r, c = np.mgrid[:h, :w].astype(float)
    back = np.stack([bilinear(backward[k], r + forward[1], c + forward[0]) for k in (0, 1)])
    return np.hypot(*(forward + back))


def vignette_fit(x: np.ndarray) -> tuple[float, float]:
    """Coefficients of the squared and fourth power of the radius by which brightness changes from the middle."""
    h, w = x.shape
    r, c = np.mgrid[:h, :w]
    r2 = ((r - h / 2) ** 2 + (c - w / 2) ** 2) / ((h / 2) ** 2 + (w / 2) ** 2)
    on = x > 0
    k = np.linalg.lstsq(np.c_[np.ones(on.sum()), r2[on], r2[on] ** 2], x[on], rcond=None)[0]
    return (float(k[1] / k[0]), float(k[2] / k[0])) if abs(k[0]) > 1e-12 else (0.0, 0.0)


def cross(size: int, width: int) -> np.ndarray:
    x = np.zeros((size, size))
    lo = (size - width) // 2
    x[lo : lo + width] = 1
    x[:, lo : lo + width] = 1
    return x


def line_tophat(x: np.ndarray, length: int, angles: int = 8) -> np.ndarray:
    """How far each place stands above the opening by a line, for the direction in which that is most."""
    best = np.zeros(x.shape)
    for k in range(angles):
        a = np.pi * k / angles
        steps = {(round(t * np.sin(a)), round(t * np.cos(a))) for t in range(-(length // 2), length // 2 + 1)}
        move = lambda v, f, e: f.reduce([np.pad(v, length, constant_values=e)[length + i : length + i + v.shape[0], length + j : length + j + v.shape[1]] for i, j in steps])  # noqa: B023, E731
        best = np.maximum(best, x - move(move(x, np.minimum, np.inf), np.maximum, -np.inf))
    return best


def piecewise_warp(x: np.ndarray, ref: np.ndarray, off: np.ndarray) -> np.ndarray:
    """The tile warped so that each triangle of off points (column, row) comes to lie on its ref points; 0 outside."""
    r, c = np.mgrid[: x.shape[0], : x.shape[1]].astype(float)
    at = np.c_[c.ravel(), r.ravel()]
    src, inside = np.full(at.shape, -10.0), np.zeros(len(at), bool)
    for t in delaunay(ref):
        bary = np.linalg.solve(np.r_[ref[t].T, [[1, 1, 1]]], np.c_[at, np.ones(len(at))].T).T
        on = (bary >= -1e-9).all(1) & ~inside
        src[on] = at[on] @ lstsq(ref[t], off[t])[:, :2].T + lstsq(ref[t], off[t])[:, 2]
        inside |= on
    return np.where(inside.reshape(x.shape), bilinear(x, src[:, 1].reshape(x.shape), src[:, 0].reshape(x.shape)), 0.0)


def quaternion(m: np.ndarray) -> np.ndarray:
    """Unit quaternion (w, x, y, z) of a rotation matrix, w not negative."""
    k = np.array(
        [[m[0, 0] + m[1, 1] + m[2, 2], 0, 0, 0], [m[2, 1] - m[1, 2], m[0, 0] - m[1, 1] - m[2, 2], 0, 0], [m[0, 2] - m[2, 0], m[1, 0] + m[0, 1], m[1, 1] - m[0, 0] - m[2, 2], 0], [m[1, 0] - m[0, 1], m[2, 0] + m[0, 2], m[2, 1] + m[1, 2], m[2, 2] - m[0, 0] - m[1, 1]]]
    )
    q = np.linalg.eigh(k / 3)[1][:, -1]
    return q if q[0] >= 0 else -q


def rotation(q: np.ndarray) -> np.ndarray:
    w, x, y, z = q / np.linalg.norm(q)
    return np.array([[1 - 2 * (y * y + z * z), 2 * (x * y - z * w), 2 * (x * z + y * w)], [2 * (x * y + z * w), 1 - 2 * (x * x + z * z), 2 * (y * z - x * w)], [2 * (x * z - y * w), 2 * (y * z + x * w), 1 - 2 * (x * x + y * y)]])


def slerp(a: np.ndarray, b: np.ndarray, t: float) -> np.ndarray:
    """The rotation matrix a share of the way from one to another."""
    p, q = quaternion(a), quaternion(b)
    dot = float(p @ q)
    q, dot = (q, dot) if dot >= 0 else (-q, -dot)
    angle = np.arccos(min(1.0, dot))
    return rotation(p + t * (q - p) if angle < 1e-6 else (np.sin((1 - t) * angle) * p + np.sin(t * angle) * q) / np.sin(angle))


def geodetic(xyz: np.ndarray, a: float = 6378137.0, b: float = 6356752.314245) -> tuple[float, float, float]:
    """Latitude and longitude in degrees and height in m of an earth-centred point."""
    e2 = 1 - b * b / (a * a)
    p = float(np.hypot(xyz[0], xyz[1]))
    lat = np.arctan2(xyz[2], p * (1 - e2))
    for _ in range(8):
        n = a / np.sqrt(1 - e2 * np.sin(lat) ** 2)
        lat = np.arctan2(xyz[2] + e2 * n * np.sin(lat), p)
    n = a / np.sqrt(1 - e2 * np.sin(lat) ** 2)
    height = p / np.cos(lat) - n if abs(np.cos(lat)) > 1e-6 else abs(xyz[2]) - b
    return float(np.degrees(lat)), float(np.degrees(np.arctan2(xyz[1], xyz[0]))), float(height)


def pair_diagnostics(pairs: DataFrame, a: str, b: str, *, res_m: float = 1.0) -> DataFrame:
    """pairs with boundary_m, land_dx, land_dy, land_ncc, mask_corr, median_m: one Arrow pass over both tiles."""

    @F.pandas_udf("boundary_m double, land_dx double, land_dy double, land_ncc double, mask_corr double, median_m double")
    def run(x: pd.Series, y: pd.Series) -> pd.DataFrame:
        rows = []
        for u, v in zip(x, y, strict=True):
            p, q = square(u), square(v)
            found = displacement(p, q, 4, 2, res_m)
            rows.append((boundary_distance(masks(p)["land"], masks(q)["land"], np.ones(p.shape, bool), res_m), *land_offset(p, q, 2), mask_correlation(p, q), found and found["median_m"]))
        return pd.DataFrame(rows, columns=["boundary_m", "land_dx", "land_dy", "land_ncc", "mask_corr", "median_m"], dtype="float64")

    return pairs.withColumn("d", run(F.col(a), F.col(b))).select(*pairs.columns, "d.*")


def restored(tiles: DataFrame, column: str) -> DataFrame:
    """tiles with px (interior gaps filled), vignette coefficients and the strongest line-like place."""

    @F.pandas_udf("px array<double>, k1 double, k2 double, line double")
    def run(x: pd.Series) -> pd.DataFrame:
        rows = []
        for u in x:
            p = square(u)
            rows.append((fill_interior(p).ravel().tolist(), *vignette_fit(p), float(line_tophat(p, 5).max())))
        return pd.DataFrame(rows, columns=["px", "k1", "k2", "line"])

    return tiles.withColumn("d", run(F.col(column))).select(*tiles.columns, "d.*")


def windowed_shifts(a: np.ndarray, b: np.ndarray, size: int, stride: int, least_valid: float, least_response: float) -> tuple[np.ndarray, int]:
    """Lengths in pixels of the shifts of windowed squares that are valid in both and respond, and how many were valid."""
    both = np.where((a > 0) & (b > 0), 1.0, 0.0)
    window = np.outer(np.hanning(size), np.hanning(size))
    at = patches(both, size, stride, least_valid)
    got = [phase_shift(a[r : r + size, c : c + size] * window, b[r : r + size, c : c + size] * window) for r, c in at]
    return np.array([np.hypot(x, y) for x, y, peak in got if peak > least_response]), len(at)


def cell_displacements(pairs: DataFrame, a: str, b: str, *, cells: int, size: int, stride: int, res_m: float, least_valid: float = 0.0, least_response: float = 0.03, least: int = 2) -> DataFrame:
    """pairs with row, col, patch_med, patch_p90, patch_max (m), patch_count, valid: each cell of a cells x cells grid over both
    tiles, and the whole tile as row and column -1. Cells with fewer than ``least`` shifts are invalid and have no figures."""
    one = "struct<row: int, col: int, patch_med: double, patch_p90: double, patch_max: double, patch_count: long, valid: boolean>"

    def figures(r: int, c: int, p: np.ndarray, q: np.ndarray) -> dict:
        d, asked = windowed_shifts(p, q, size, stride, least_valid, least_response)
        if asked < least or len(d) < least:
            return {"row": r, "col": c, "patch_med": None, "patch_p90": None, "patch_max": None, "patch_count": asked if asked < least else len(d), "valid": False}
        d = d * res_m
        return {"row": r, "col": c, "patch_med": float(np.median(d)), "patch_p90": float(np.percentile(d, 90)), "patch_max": float(d.max()), "patch_count": len(d), "valid": True}

    @F.pandas_udf(f"array<{one}>")
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        rows = []
        for u, v in zip(x, y, strict=True):
            p, q = square(u), square(v)
            edges_ = [round(k * p.shape[0] / cells) for k in range(cells + 1)]
            parts = [(r, c, slice(edges_[r], edges_[r + 1]), slice(edges_[c], edges_[c + 1])) for r in range(cells) for c in range(cells)]
            rows.append([figures(-1, -1, p, q), *[figures(r, c, p[i, j], q[i, j]) for r, c, i, j in parts]])
        return pd.Series(rows)

    return pairs.select(*pairs.columns, F.inline(run(F.col(a), F.col(b))))
