"""Known answers of the dense kernels."""

import numpy as np

from orthoweave.operators import imaging as im

R = np.random.default_rng(8)


def blob(dx=0, dy=0, n=24):
    r, c = np.mgrid[:n, :n]
    return np.where((r - 12 - dy) ** 2 + (c - 11 - dx) ** 2 < 25, 5.0, 1.0)


def test_matching():
    x = R.random((20, 20))
    got = im.template_match(x, x[4:12, 7:15])
    assert abs(got[0] - 7) < 0.5 and abs(got[1] - 4) < 0.5 and got[2] > 0.999
    dx, dy, r = im.land_offset(blob(), blob(2, -1), 8)
    assert abs(dx - 2) < 0.5 and abs(dy + 1) < 0.5 and r > 0.9
    assert im.mask_correlation(blob(), blob()) > 0.999 and im.mask_correlation(np.zeros((4, 4)), np.ones((4, 4))) is None


def test_boundaries():
    on = np.ones((24, 24), bool)
    assert im.boundary_distance(blob() > 2, blob() > 2, on, 4.0) == 0
    assert im.boundary_distance(blob() > 9, blob() > 2, on, 4.0) is None
    assert 0 < im.boundary_distance(blob() > 2, blob(3) > 2, on, 4.0) <= 12


def test_displacement_and_patches():
    x = R.random((32, 32)) + 0.1
    got = im.displacement(x, np.roll(x, 1, 1), 16, 8, 2.0)
    assert got["count"] == 9 and abs(got["median_m"] - 2) < 1
    assert im.displacement(np.zeros((8, 8)), np.zeros((8, 8)), 4, 2, 1.0) is None


def test_filling_and_smoothing():
    x = np.ones((9, 9))
    x[3:6, 3:6] = 0
    x[0, 0] = 0
    got = im.fill_interior(x)
    assert (got[3:6, 3:6] == 1).all() and got[0, 0] == 0
    flow, ok = np.full((12, 12), 3.0), np.ones((12, 12), bool)
    ok[5, 5], flow[5, 5] = False, 99.0
    assert abs(im.soft_zero(flow, ok)[5, 5] - 3) < 1e-9
    assert np.allclose(im.round_trip(np.ones((2, 6, 6)), -np.ones((2, 6, 6)))[:4, :4], 0)


def test_lines_and_parts():
    x = np.zeros((15, 15))
    x[7] = 1
    y = x.copy()
    y[2:5, 2:5] = 1
    assert im.line_tophat(y, 7)[7].max() == 1
    kept = im.sparse_parts(np.pad(np.ones((5, 5), bool), 3) | np.eye(11, dtype=bool)[::-1] & False)
    assert not kept.any() and im.sparse_parts(np.eye(9, dtype=bool)).sum() == 9
    assert im.cross(7, 1).sum() == 13


def test_lens_and_pose():
    r, c = np.mgrid[:40, :40]
    r2 = ((r - 20) ** 2 + (c - 20) ** 2) / 800
    assert np.allclose(im.vignette_fit(100 * (1 - 0.3 * r2 + 0.1 * r2**2)), (-0.3, 0.1), atol=1e-6)
    turn = lambda a: np.array([[np.cos(a), -np.sin(a), 0], [np.sin(a), np.cos(a), 0], [0, 0, 1.0]])
    assert np.allclose(im.rotation(im.quaternion(turn(2.5))), turn(2.5))
    assert np.allclose(im.slerp(turn(0.2), turn(1.2), 0.3), turn(0.5))
    lat, lon, h = np.radians(26.2), np.radians(50.5), 170000.0
    n = 6378137.0 / np.sqrt(1 - (1 - (6356752.314245 / 6378137.0) ** 2) * np.sin(lat) ** 2)
    p = np.array([(n + h) * np.cos(lat) * np.cos(lon), (n + h) * np.cos(lat) * np.sin(lon), (n * (6356752.314245 / 6378137.0) ** 2 + h) * np.sin(lat)])
    assert np.allclose(im.geodetic(p), (26.2, 50.5, h), atol=1e-4)


def test_piecewise_warp():
    x = R.random((16, 16))
    ref = np.array([[0, 0], [15, 0], [0, 15], [15, 15], [7, 8]], float)
    assert np.allclose(im.piecewise_warp(x, ref, ref), x, atol=1e-6)
