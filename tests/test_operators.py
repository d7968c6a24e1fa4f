"""Known answers and properties of operators without SQL."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from orthoweave.functions import entities
from orthoweave.operators import documents, iterative, kernels, orbits, pairs
from pyspark.sql import functions as F


def _pairs(spark, n=40, m=((1.01, 0.02, 100.0), (-0.03, 0.99, -50.0)), bad=(), scene="s"):
    rng = np.random.default_rng(1)
    off = rng.uniform(0, 10000, (n, 2))
    m = np.array(m)
    ref = off @ m[:, :2].T + m[:, 2]
    for i in bad:
        ref[i] += 3000
    df = pd.DataFrame({"id": [f"p{i:03d}" for i in range(n)], "scene": scene, "is_anchor": False, "ref_x": ref[:, 0], "ref_y": ref[:, 1], "off_x": off[:, 0], "off_y": off[:, 1], "confidence": 0.9, "prec": 1.0})
    return spark.createDataFrame(df)


def test_affine_is_recovered_and_degenerate_groups_say_so(spark):
    rows = _pairs(spark).unionByName(_pairs(spark, n=2, scene="few"))
    got = {r.scene: r for r in pairs.fit_affine(rows, F.col("prec")).collect()}
    assert np.allclose([got["s"][c] for c in ("a", "b", "tx", "c", "d", "ty")], [1.01, 0.02, 100, -0.03, 0.99, -50], atol=1e-6)
    assert got["few"].status == "degenerate" and got["few"].a is None


def test_outliers_are_removed(spark):
    got = iterative.outlier_removal(_pairs(spark, bad=(3, 17))).toPandas()
    assert set(got.id) == {f"p{i:03d}" for i in range(40)} - {"p003", "p017"}
    assert got.residual.max() < 1e-3
    fit = iterative.ransac_affine(_pairs(spark, bad=(3, 17))).first()
    assert fit.inliers == 38 and abs(fit.a - 1.01) < 1e-6


def test_cross_validation_and_selection(spark):
    assert iterative.cross_validate(_pairs(spark)).first().cv_mean_m < 1e-6
    assert iterative.select_gcps(_pairs(spark, n=60)).count() == 25


def test_mesh_without_points_is_the_mesh_of_the_rest():
    rng = np.random.default_rng(3)
    for p in (rng.uniform(0, 100, (40, 2)), np.array([(x * 10.0, y * 200.0) for x in range(6) for y in range(5)])):
        mesh, left = iterative.Mesh(p), list(range(len(p)))
        for i in rng.permutation(len(p))[:-4].tolist():
            mesh.remove(i)
            left.remove(i)
            tris = mesh.triangles()
            assert not len(tris) or not any(mesh._inside(*t, d) for t in tris.tolist() for d in left)
            assert len(tris) == len(iterative.Mesh(p[left]).triangles())


def test_triangle_filter_is_the_loop_that_builds_the_mesh_anew(spark):
    rng = np.random.default_rng(4)
    ref = rng.uniform(0, 1000, (80, 2))
    off = ref + rng.normal(0, 30, (80, 2))
    df = pd.DataFrame({"id": [f"p{i:03d}" for i in range(80)], "scene": "s", "is_anchor": False, "ref_x": ref[:, 0], "ref_y": ref[:, 1], "off_x": off[:, 0], "off_y": off[:, 1], "confidence": 0.9, "prec": 1.0})
    left = list(range(80))
    while len(left) > 4:
        ratio = iterative.area_ratios(ref[left], off[left])
        if ratio.max() <= 1.5:
            break
        del left[int(ratio.argmax())]
    got = iterative.triangle_filter(spark.createDataFrame(df)).sort("id").toPandas()
    assert 4 < len(left) < 80 and list(got.id) == [f"p{i:03d}" for i in left] and np.allclose(got.ratio, ratio)


def test_queries_on_pairs_see_automatic_pairs_too(spark):
    from orthoweave.plans import catalog
    from orthoweave.sources.roles import match_pairs

    sf, queries = "/root/testdata/sf0.001", catalog.queries()
    rows = match_pairs(spark, sf)
    n = {r.scene: r["count"] for r in rows.groupBy("scene").count().collect()}
    assert {r.scene: r.n for r in queries["ransac_affine"](spark, sf).collect()} == n
    auto = rows.filter("NOT is_anchor").select("id").distinct()
    for name in ("triangle_area_ratio", "iterative_outlier_removal", "gcp_selection"):
        assert queries[name](spark, sf).join(auto, "id", "left_semi").count() > 0
    same = lambda a, b: sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    assert same(queries["cross_validation"](spark, sf), iterative.cross_validate(rows)) and same(queries["chamfer_distance"](spark, sf), pairs.chamfer(rows))


def test_chamfer_is_the_true_minimum_however_far(spark):
    rng = np.random.default_rng(6)
    ref = np.r_[rng.uniform(0, 3000, (30, 2)), [[90000.0, -70000.0]]]
    for shift in (5.0, 25000.0):
        off = ref + [shift, -shift]
        df = pd.DataFrame({"id": [f"p{i:03d}" for i in range(31)], "scene": "s", "is_anchor": False, "ref_x": ref[:, 0], "ref_y": ref[:, 1], "off_x": off[:, 0], "off_y": off[:, 1], "confidence": 0.9, "prec": 1.0})
        d = np.hypot(*(off[:, None] - ref[None]).transpose(2, 0, 1))
        soft = lambda m: np.where(m > 500, 500 + (m - 500) * 0.3, m).mean()
        assert abs(pairs.chamfer(spark.createDataFrame(df)).first().chamfer_m - (soft(d.min(0)) + soft(d.min(1))) / 2) < 1e-6


def test_local_consistency_looks_5_km_around(spark):
    from orthoweave.plans import catalog
    from orthoweave.sources.roles import match_pairs

    sf = "/root/testdata/sf0.001"
    g = match_pairs(spark, sf).toPandas().sort_values("id", ignore_index=True)

    def brute(g):
        want = set()
        for _, h in g.groupby("scene"):
            h = h.reset_index(drop=True)
            ref, move = h[["ref_x", "ref_y"]].to_numpy(), h[["off_x", "off_y"]].to_numpy() - h[["ref_x", "ref_y"]].to_numpy()
            for i in np.flatnonzero(~h.is_anchor.to_numpy(bool)):
                d = np.hypot(*(ref - ref[i]).T)
                near = [j for j in np.argsort(d, kind="stable")[:5] if d[j] < 5000]
                if np.hypot(*(move[i] - move[near].mean(0))) < 50:
                    want.add((h.id[i], h.scene[i]))
        return want

    got = [tuple(r) for r in catalog.queries()["local_consistency"](spark, sf).collect()]
    assert set(got) == brute(g) and len(got) == len(set(got))
    g = g.groupby("scene").head(60).reset_index(drop=True)
    g["ref_x"], g["ref_y"] = g.ref_x * 20, g.ref_y * 20
    g["off_x"], g["off_y"] = g.ref_x + 3 * (np.arange(len(g)) % 30), g.ref_y
    rows = spark.createDataFrame(g)
    want = brute(g)
    alone = lambda r: pairs.locally_consistent(rows.filter("NOT is_anchor"), rows, radius=r)
    assert {(r.id, r.scene) for r in alone(5000.0).collect()} == want != {(r.id, r.scene) for r in alone(100.0).collect()}


def test_overlaps_of_all_scenes_are_those_of_brute_force(spark):
    from orthoweave.plans import catalog
    from orthoweave.sources.roles import scenes as scene_table

    sf = "/root/testdata/sf0.001"
    g = scene_table(spark, sf).toPandas()
    a, b = (g[g.designation == d].reset_index(drop=True) for d in "AF")
    assert len(a) + len(b) == len(g)
    side = lambda c, f: f(a[c].to_numpy()[:, None], b[c].to_numpy()[None, :])
    w, s, e, n = side("west", np.maximum), side("south", np.maximum), side("east", np.minimum), side("north", np.minimum)
    i, j = np.nonzero((w < e) & (s < n))
    part = ((e - w) * (n - s))[i, j] / ((b.east - b.west) * (b.north - b.south)).to_numpy()[j]
    want = pd.DataFrame({"right_id": b.entity_id.to_numpy()[j], "fraction": part}).groupby("right_id").fraction.agg(["count", "max"])
    got = catalog.queries()["footprint_overlap"](spark, sf).toPandas().set_index("right_id").sort_index()
    assert (got.index == want.index).all() and len(got) > 100 and (got.n == want["count"]).all() and np.allclose(got.best, want["max"])


def test_every_two_tiles_of_a_strip_are_correlated(spark):
    from orthoweave.plans import catalog
    from orthoweave.sources.roles import pixels

    sf = "/root/testdata/sf0.001"
    strip = dict(pixels(spark, sf).select("tile", "strip").distinct().collect())
    got = {(r.tile, r.other) for r in catalog.queries()["tile_correlation"](spark, sf).collect()}
    assert got == {(a, b) for a in strip for b in strip if a < b and strip[a] == strip[b]} and any(a % 10 for a, _ in got)


def test_frame_order_loses_no_frame(spark):
    from orthoweave.operators import strips

    rng = np.random.default_rng(8)
    links = [("long", i, i + 1, 5) for i in range(99)] + [("cycle", 1, 2, 4), ("cycle", 2, 3, 9), ("cycle", 3, 1, 4), ("two", 1, 2, 3), ("two", 5, 4, 3)]
    frames = [("two", 9), ("alone", 3), ("alone", 1)]
    for k in range(40):
        n, to = 7, rng.permutation(7)
        links += [(f"r{k}", i, int(to[i]), int(rng.integers(1, 50))) for i in range(n) if to[i] != i and rng.random() < 0.8]
        frames += [(f"r{k}", i) for i in range(n)]
    want = {}
    for s in {x[0] for x in links + frames}:
        mine = {i: (j, o) for t, i, j, o in links if t == s}
        every = sorted({i for t, i in frames if t == s} | set(mine) | {j for j, _ in mine.values()})
        free = [i for i in every if i not in {j for j, _ in mine.values()}]
        at = free[0] if free else max(sorted(mine), key=lambda k: mine[k][1])
        path = [(at, 0)]
        while at in mine and mine[at][0] not in {i for i, _ in path}:
            path.append(mine[at])
            at = mine[at][0]
        path += [(i, 0) for i in every if i not in {j for j, _ in path}]
        want |= {(s, k): x for k, x in enumerate(path)}
    got = strips.frame_order(spark.createDataFrame(frames, "strip string, i long"), spark.createDataFrame(links, "strip string, i long, j long, overlap long"), by="strip").collect()
    assert {(r.strip, r.seq): (r.i, r.overlap) for r in got} == want and len(got) == len(want)
    assert [want["cycle", k][0] for k in range(3)] == [2, 3, 1] and ("long", 99) in want


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.floats(0, 2000), st.floats(0, 2000)), max_size=60))
def test_greedy_dedup_is_apart_and_maximal(points):
    x, y = (np.array([p[i] for p in points], float) for i in (0, 1))
    keep = iterative.greedy_apart(x, y, 50.0)
    cells = np.stack([np.trunc(x / 50), np.trunc(y / 50)], 1)
    near = np.abs(cells[:, None] - cells[None]).max(-1) <= 1 if len(points) else np.zeros((0, 0), bool)
    kept = np.flatnonzero(keep)
    assert not any(near[i, j] for i in kept for j in kept if i != j)
    assert all(keep[i] or near[i, kept].any() for i in range(len(points)))


def test_delaunay_has_empty_circles():
    p = np.random.default_rng(5).uniform(0, 100, (30, 2))
    tris = iterative.delaunay(p)
    for t in tris:
        a = np.c_[2 * p[t], np.ones(3)]
        cx, cy, k = np.linalg.solve(a, (p[t] ** 2).sum(1))
        r2 = k + cx * cx + cy * cy
        assert (((p - [cx, cy]) ** 2).sum(1) >= r2 * (1 - 1e-9)).all()


def test_triangle_filter_drops_the_point_that_moved(spark):
    got = iterative.triangle_filter(_pairs(spark, n=25, bad=(7,))).toPandas()
    assert "p007" not in set(got.id) and got.ratio.max() <= 1.5


@settings(max_examples=20, deadline=None)
@given(st.integers(-3, 3), st.integers(-3, 3))
def test_phase_correlation_finds_whole_shifts(dx, dy):
    x = np.random.default_rng(2).random((32, 32))
    got = kernels.phase_shift(x, np.roll(x, (dy, dx), (0, 1)))
    assert abs(got[0] - dx) < 0.5 and abs(got[1] - dy) < 0.5


def test_kernels():
    x = np.random.default_rng(3).random((8, 8))
    assert np.allclose(kernels.pyramid_blend(x, x, np.ones_like(x)), x)
    assert np.allclose(kernels.bilinear(x, *np.mgrid[:8, :8].astype(float)), x)
    mask = np.zeros((6, 6), bool)
    mask[0, 0] = mask[1, 1] = mask[4, 4] = True
    assert len(set(kernels.components(mask)[mask])) == 2
    at = np.random.default_rng(4).random((10, 2))
    f = kernels.thin_plate(at, at @ [[2.0], [3.0]])
    assert np.allclose(f(at), at @ [[2.0], [3.0]], atol=1e-6)


def test_names(spark):
    rows = spark.createDataFrame([("DS1104-1057DA024",), ("x/D3C1213-200346A003_stitched_ortho.tif",), ("DZB00403600089H015001",), ("nothing",), (None,)], "e string")
    got = rows.select(entities.strip_index(F.col("e")).alias("s"), entities.mission(F.col("e")).alias("m"), entities.profile(F.col("e")).alias("p")).collect()
    assert got[0].s == ("DA", 24) and got[0].m.system == "KH-4B" and got[0].p == "kh4b"
    assert got[1].s == ("A", 3) and got[1].p == "kh9"
    assert got[2].m.mission_id == "4036" and got[2].m.system == "KH-7" and got[2].p == "kh7"
    assert got[3].s is None and got[3].m is None and got[4].p is None


def test_profiles_inherit_and_are_closed():
    base = {"_base": {"qa": {"a": 1, "b": 2}}, "kh4": {"inherits": "_base", "qa": {"b": 3}}, "x": {"inherits": "y"}, "y": {"inherits": "x"}}
    assert documents.profile("kh4", base) == {"qa": {"a": 1, "b": 3}}
    for bad in (lambda: documents.profile("x", base), lambda: documents.profile("kh4", base, known={"qa": {"a"}})):
        try:
            bad()
        except ValueError:
            continue
        raise AssertionError


def test_epoch_pivot(spark):
    lines = spark.createDataFrame([("1 09059U 76065A   76220.50000000  .0  0 0",), ("1 09059U 76065A   05001.00000000  .0  0 0",), ("1 short",)], "l string")
    got = [r[0] for r in lines.select(orbits.epoch(F.col("l")).cast("string")).collect()]
    assert got == ["1976-08-07 12:00:00", "2005-01-01 00:00:00", None]


def test_no_cross_product_in_spatial_joins(spark):
    from orthoweave.operators import scenes as ops
    from orthoweave.sources.roles import match_pairs
    from orthoweave.sources.roles import scenes as scene_table

    for df in (ops.overlaps(scene_table(spark, "/root/testdata/sf0.01"), scene_table(spark, "/root/testdata/sf0.01")), pairs.locally_consistent(match_pairs(spark, "/root/testdata/sf0.01"), match_pairs(spark, "/root/testdata/sf0.01"))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_rest_imports_without_the_llm_folders(tmp_path):
    import os
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shutil.copytree(f"{root}/orthoweave", tmp_path / "orthoweave", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not any(n.startswith('op1_') or n == 'pipeline' for n in q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, check=True, timeout=120)


def test_stacked_choice_ladder(spark):
    from orthoweave.operators import coarse

    P = "scene string, k int, dx double, dy double, ncc double, vdx double, vdy double, n_matches long, agreement double"
    none = (None, None, None, None)
    peaks = [("v", 0, 0.0, 0.0, 0.9, 5.0, 5.0, 100, 0.5), ("v", 1, 0.0, 0.0, 0.4, 7.0, 7.0, 50, 0.9)]
    peaks += [("c", i, 100.0 * i, 50.0, 0.2, *none) for i in range(3)] + [("cp", i, 100.0 * i, 50.0, 0.5, *none) for i in range(3)]
    peaks += [("two", i, 100.0 * i, 50.0, 0.5, *none) for i in range(2)] + [("p", 0, 900.0, 0.0, 0.6, *none), ("p", 1, 5000.0, 0.0, 0.9, *none), ("u", 0, 900.0, 0.0, 0.6, *none)]
    peaks += [("x", 0, 9000.0, 0.0, 0.6, *none), ("a", 0, 0.0, 9000.0, 0.6, *none), ("far", 0, 0.0, 0.0, 0.6, 90000.0, 0.0, 99, 0.9)]
    priors = spark.createDataFrame([("cp", 100.0, 50.0), ("p", 800.0, 0.0), ("u", 800.0, 0.0), ("x", 0.0, 0.0), ("a", 0.0, 0.0)], "scene string, dx double, dy double")
    single = spark.createDataFrame([("p", 500.0, 0.0), ("u", 20000.0, 0.0)], "scene string, dx double, dy double")
    got = {r.scene: tuple(r)[1:] for r in coarse.stacked_choice(spark.createDataFrame(peaks, P), priors, single, radius_m=20000, cross_m=1000, along_m=2000).collect()}
    gone = (None,) * 5
    assert got == {
        "v": ("validated", 1, 7.0, 7.0, 50, 0.9), "c": ("cluster", 1, 100.0, 50.0, 0, 0.3), "cp": ("cluster", 1, 100.0, 50.0, 0, 0.5), "two": ("no_prior", *gone), "p": ("prior", 0, 900.0, 0.0, 0, 0.6),
        "u": ("uncorroborated", *gone), "x": ("cross", *gone), "a": ("along", *gone), "far": ("beyond", *gone),
    }


def test_gains_bring_strips_together(spark):
    from orthoweave.operators import coarse

    rnd = np.random.default_rng(3)
    scene = rnd.uniform(40, 120, 400)
    strips = [scene * g + o for g, o in ((1.0, 0.0), (1.25, 0.0), (0.8, 10.0))]
    rows = [(1, i, i + 1, float(a), float(b)) for i in (0, 1) for a, b in zip(strips[i], strips[i + 1])] + [(2, 0, 1, 3.0, 50.0)] * 200
    sums = coarse.overlap_sums(spark.createDataFrame(rows, "mosaic long, i long, j long, a double, b double"))
    assert [(r.mosaic, r.n) for r in sums.collect()] == [(1, 400)] * 2
    got = {r.strip: (r.gain, r.offset) for r in coarse.gains(sums, strength=1e-3 * 100).collect()}
    normal, right = np.eye(3) * 0.1, np.full(3, 0.1)
    for i, j in ((0, 1), (1, 2)):
        a, b = strips[i], strips[j]
        normal[i, i] += np.mean(a * a)
        normal[j, j] += np.mean(b * b)
        normal[i, j] -= np.mean(a * b)
        normal[j, i] -= np.mean(a * b)
    gain = np.clip(np.linalg.solve(normal, right), 0.5, 2)
    means = [np.mean(s) * g for s, g in zip(strips, gain)]
    half = [(means[0] - means[1]) / 2, (means[1] - means[2]) / 2]
    want = [-half[0], (half[0] - half[1]) / 2, half[1]]
    for k in range(3):
        assert got[k] == pytest.approx((gain[k], want[k]), abs=1e-6)


def test_geographic_filter_and_similarity(spark):
    turn = ((0.99, -0.05, 30.0), (0.05, 0.99, -20.0))
    rows = _pairs(spark, m=turn, bad=(3, 8)).unionByName(_pairs(spark, n=5, bad=(0,), scene="few")).withColumn("is_anchor", F.col("id") == "p008")
    got = {(r.scene, r.id) for r in iterative.geographic_filter(rows).collect()}
    assert ("s", "p003") not in got and ("s", "p008") in got and len(got) == 39 + 5
    fits = {r.scene: r for r in iterative.similarity_fits(rows).collect()}
    assert np.allclose([fits["s"][c] for c in ("a", "b", "tx", "c", "d", "ty")], [*turn[0], *turn[1]], atol=1e-6) and fits["s"].inliers == 38
    assert iterative.similarity_fits(rows.filter("id < 'p004'")).count() == 0


def test_cell_displacements_find_a_known_shift(spark):
    from orthoweave.operators import imaging

    x = np.random.default_rng(5).uniform(1, 2, (80, 80))
    a, b = x[8:72, 8:72], x[8:72, 6:70]
    empty = a.copy()
    empty[:32, :32] = 0
    df = spark.createDataFrame([(0, a.ravel().tolist(), b.ravel().tolist()), (1, empty.ravel().tolist(), b.ravel().tolist())], "tile long, a array<double>, b array<double>")
    got = {(r.tile, r.row, r.col): r for r in imaging.cell_displacements(df, "a", "b", cells=2, size=16, stride=8, res_m=10.0, least_valid=0.5).collect()}
    assert len(got) == 10 and all(abs(r.patch_med - 20) < 1.5 and r.patch_max >= r.patch_p90 for r in got.values() if r.valid)
    assert not got[1, 0, 0].valid and got[1, 0, 0].patch_med is None and sum(r.valid for r in got.values()) == 9
