"""What larger tables change: plans that must not broadcast, numbers written out, places met often."""

import duckdb
import numpy as np
import pandas as pd

from orthoweave.plans.registry import REGISTERED
from orthoweave.plans import catalog  # noqa: F401
from tests.oracle import assert_same, connect

SF = "/root/testdata/sf0.001"


def test_translation_groups_are_named_as_sql_names_them_beyond_ten_million(spark, tmp_path):
    for t in "nation region customer supplier part orders events documents embeddings pages benchmark labels conversations".split():
        (tmp_path / f"{t}.parquet").symlink_to(f"{SF}/{t}.parquet")
    duckdb.sql(f"COPY (SELECT * REPLACE (50 * l_partkey AS l_partkey, l_suppkey + 59990 AS l_suppkey, 0.1 AS l_discount) FROM '{SF}/lineitem.parquet' LIMIT 15) TO '{tmp_path}/lineitem.parquet'")
    q = REGISTERED["translation_where_degenerate"]
    got = q.run(spark, str(tmp_path))
    assert any(r.scene.endswith("000.0") for r in got.collect())
    assert_same(got, q.sql, connect(str(tmp_path)))


def test_sidecars_are_joined_by_shuffle(spark):
    """The names of all images' sidecars are many times the table that Spark judges them by."""
    plan = REGISTERED["sidecar_paths"].run(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_point_weights_search_each_place_once(spark, monkeypatch):
    from orthoweave.operators import frames

    rng = np.random.default_rng(9)
    g = pd.DataFrame({"g": rng.choice(["a", "b"], 900), "id": range(900), "x": rng.integers(0, 12, 900) / 12, "y": rng.integers(0, 3, 900) / 3, "virtual": rng.random(900) < 0.98, "prec": 2.0})
    g = pd.concat([g, pd.DataFrame({"g": "alone", "id": [900, 901], "x": 0.5, "y": 0.5, "virtual": True, "prec": 2.0})])
    asked, search = [], frames.nearest
    monkeypatch.setattr(frames, "nearest", lambda a, *args, **more: asked.append(a.count()) or search(a, *args, **more))
    got = {r.id: r.weight for r in frames.point_weights(spark.createDataFrame(g), by="g").collect()}
    want = {}
    for r in g.itertuples():
        real = g[(g.g == r.g) & ~g.virtual]
        d = np.hypot(real.x - r.x, real.y - r.y).min() if len(real) else 1.0
        want[r.id] = min(1, max(0, (d - 0.1) / 0.2)) * 0.35 + 0.05 if r.virtual else r.prec
    assert len(got) == len(g) and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    assert asked == [len(g[g.virtual][["g", "x", "y"]].drop_duplicates())]


def _scenes(spark, wild: bool):
    rng = np.random.default_rng(12)
    off = rng.uniform(0, 1e4, (700, 2))
    ref = off @ np.array([[1.01, -0.03], [0.02, 0.99]]) + [100, -50] + rng.normal(0, 8, (700, 2))
    bad = rng.choice(700, 200 if wild else 7, replace=False)
    ref[bad] += rng.normal(0, 400, (len(bad), 2)) + 300
    g = pd.DataFrame({"id": [f"p{i}" for i in rng.permutation(700)], "scene": np.where(np.arange(700) < 400, "s", "t"), "is_anchor": rng.random(700) < 0.1, "ref_x": ref[:, 0], "ref_y": ref[:, 1], "off_x": off[:, 0], "off_y": off[:, 1], "confidence": rng.random(700), "prec": 1.0})
    few = g.head(30).assign(scene="few", id=[f"q{i}" for i in range(30)])
    return spark.createDataFrame(pd.concat([g, few])).repartition(5)


def test_cross_validation_of_large_scenes_is_that_of_one_task(spark):
    from orthoweave.operators import iterative

    for wild in (False, True):
        rows = _scenes(spark, wild)
        whole, passes = ({r.scene: r.cv_mean_m for r in iterative.cross_validate(rows, most=m).collect()} for m in (10**6, 50))
        assert len(passes) == 3 and passes.keys() == whole.keys() and all(abs(passes[s] / whole[s] - 1) < 1e-9 for s in whole)
    assert max(whole.values()) < 40


def test_outliers_of_large_scenes_are_those_of_one_task(spark):
    from orthoweave.operators import iterative

    for wild in (False, True):
        rows = _scenes(spark, wild)
        whole, passes = ({(r.scene, r.id): r.residual for r in iterative.outlier_removal(rows, most=m).collect()} for m in (10**6, 50))
        assert passes.keys() == whole.keys() and len(whole) < 730 and all(abs(passes[k] - whole[k]) < 1e-6 for k in whole)


def test_spatial_dedup_in_tiles_is_the_loop_over_all(spark, tmp_path):
    from orthoweave.operators import iterative

    rng = np.random.default_rng(4)
    xy = rng.uniform(-1500, 1500, (4000, 2))
    xy[:300, 0], xy[:300, 1] = np.arange(300) * 10 - 1500, 5.0  # a chain: each hangs on the one before
    g = pd.DataFrame({"id": [f"p{i:04d}" for i in range(4000)], "scene": np.where(np.arange(4000) < 2500, "s", "t"), "confidence": rng.integers(0, 5, 4000) / 5, "ref_x": xy[:, 0], "ref_y": xy[:, 1]})
    g.loc[:299, "confidence"] = 1.0 - np.arange(300) / 1000
    want = set()
    for _, h in g.sort_values(["confidence", "id"], ascending=[False, True]).groupby("scene"):
        taken, full, first = set(), set(), {}
        for r in h.itertuples():
            c, q = (int(r.ref_x / 20), int(r.ref_y / 20)), (r.ref_x // 50, r.ref_y // 50)
            first.setdefault(q, r.id)
            if not any((c[0] + i, c[1] + j) in taken for i in (-1, 0, 1) for j in (-1, 0, 1)):
                taken.add(c)
                full.add(q)
                want.add(r.id)
        want |= {i for q, i in first.items() if q not in full}
    got = [r.id for r in iterative.spatial_dedup(spark.createDataFrame(g), apart=20.0, cell=50.0, tile=8, halo=2).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_tiles_are_correlated_by_blocks_as_by_pixels(spark):
    from orthoweave.operators import tiles

    rng = np.random.default_rng(8)
    x = rng.normal(5, 1, (60, 16)) * (rng.random((60, 16)) < 0.97)
    x[3], x[4], x[5] = 0.0, 7.0, [1.0] + [0.0] * 15
    x[:, ::2] = np.where(x[:, ::2] == 0, 0.5, x[:, ::2])
    x[3] = 0.0
    px = spark.createDataFrame(pd.DataFrame([(t, t % 3, r, c, x[t, 4 * r + c]) for t in range(60) for r in range(4) for c in range(4)], columns=["tile", "strip", "r", "c", "px"]))
    there = px.withColumnRenamed("tile", "other").withColumnRenamed("px", "py")
    want = {(r.tile, r.other): r.zncc for r in tiles.correlated(px.join(there, ["strip", "r", "c"]).filter("tile < other")).collect()}
    for block in (7, 100):
        df = tiles.correlated_within(px, by="strip", size=4, block=block)
        got = [((r.tile, r.other), r.zncc) for r in df.collect()]
        assert len(got) == len(want) and dict(got).keys() == want.keys() and all(abs(z - want[k]) < 1e-9 for k, z in got)
        assert {-1.0} < {z for _, z in got}


def _boxes(rng, n, step):
    w, s = (np.round(rng.integers(-40, 40, n) * step, 9) for _ in range(2))
    return pd.DataFrame({"entity_id": rng.permutation(n), "west": w, "south": s, "east": w + rng.integers(1, 9, n) * step, "north": s + rng.integers(1, 9, n) * step})


def _overlaps(a, b):
    got = {}
    for r in b.itertuples():
        w, h = (np.minimum(a[hi], getattr(r, hi)) - np.maximum(a[lo], getattr(r, lo)) for lo, hi in (("west", "east"), ("south", "north")))
        on = (w > 0) & (h > 0)
        part = (w * h / ((r.east - r.west) * (r.north - r.south)))[on]
        whole = a.entity_id[on][part.round(9) >= 1]
        if on.any():
            got[r.entity_id] = (int(on.sum()), part.max(), whole.min() if len(whole) else None)
    return got


def test_overlaps_are_summed_up_as_their_pairs_are(spark):
    from orthoweave.operators import scenes

    rng = np.random.default_rng(21)
    a, b = _boxes(rng, 500, 0.1), _boxes(rng, 400, 0.1)
    a.loc[:19, ["west", "south"]] += rng.choice([-1e-10, 1e-10, 3e-9], (20, 2))
    a = pd.concat([a, b.head(30).assign(entity_id=range(900, 930)), a.head(3).assign(entity_id=[800, 801, 802], east=a.west.head(3))])
    want = _overlaps(a, b)
    assert None in {w[2] for w in want.values()} and len({w[2] for w in want.values()}) > 20
    for most in (1000, 0):
        rows = scenes.overlap_summary(spark.createDataFrame(a), spark.createDataFrame(b), most=most).collect()
        assert {r.right_id: (r.n, r.best, r.first_whole) for r in rows} == want and len(rows) == len(want)


def test_equal_footprints_are_met_once(spark):
    """120,000 scenes on either side, of 200 boxes."""
    from pyspark.sql import functions as F

    from orthoweave.operators import scenes

    boxes = _boxes(np.random.default_rng(22), 200, 0.1)
    many = spark.range(600).crossJoin(spark.createDataFrame(boxes)).withColumn("entity_id", F.col("entity_id") + F.col("id") * 200)
    got = {r.right_id: (r.n, r.best, r.first_whole) for r in scenes.overlap_summary(many, many).filter("right_id < 200").collect()}
    assert got == {k: (600 * n, best, first) for k, (n, best, first) in _overlaps(boxes, boxes).items()}


def test_local_consistency_by_tiles_deals_a_row_out_a_few_times_only(spark, monkeypatch):
    """Tiles, smaller tiles and joins agree with brute force, ties and dense places included; tiles alone need no join."""
    from orthoweave.operators import pairs

    rng = np.random.default_rng(31)
    ref = np.r_[rng.integers(-900, 900, (500, 2)) * 100.0, rng.integers(0, 6, (150, 2)) * 10.0, rng.uniform(9e5, 2e6, (20, 2))]
    n = len(ref)
    g = pd.DataFrame({"id": [f"p{i:03d}" for i in rng.permutation(n)], "scene": rng.choice(["s", "t"], n), "is_anchor": rng.random(n) < 0.1, "ref_x": ref[:, 0], "ref_y": ref[:, 1], "off_x": ref[:, 0] + rng.normal(0, 30, n), "off_y": ref[:, 1] + rng.normal(0, 30, n), "confidence": rng.random(n), "prec": 1.0})
    nowhere = g.head(4).assign(id=["q0", "q1", "q2", "q3"], ref_x=[np.nan, np.inf, 0.0, np.nan], is_anchor=False, confidence=[0.9, 0.9, 0.9, 0.1], scene=["s", "s", None, "s"])
    g = pd.concat([g, nowhere], ignore_index=True)
    x, y, u, v = (g[c].to_numpy() for c in ("ref_x", "ref_y", "off_x", "off_y"))

    def brute(known):
        want = set()
        for i in np.flatnonzero(~g.is_anchor.to_numpy(bool)):
            with np.errstate(invalid="ignore"):
                d = np.sqrt((x - x[i]) ** 2 + (y - y[i]) ** 2)
            j = sorted(np.flatnonzero(known & (g.scene == g.scene[i]) & (d < 5000)), key=lambda j: (d[j], g.id[j]))[:5]
            near = np.hypot((u - x)[i] - (u - x)[j].mean(), (v - y)[i] - (v - y)[j].mean()) < 50 if j else g.confidence[i] >= 0.65
            if near:
                want.add(g.id[i])
        return want

    rows = spark.createDataFrame([tuple(None if c == "scene" and v is None else v for c, v in zip(g.columns, r, strict=True)) for r in g.itertuples(index=False)], "id string, scene string, is_anchor boolean, ref_x double, ref_y double, off_x double, off_y double, confidence double, prec double")
    for most in (10**6, 100, 20):
        got = [r.id for r in pairs.locally_consistent_within(rows, ~rows.is_anchor, most=most).collect()]
        assert len(got) == len(set(got)) and set(got) == brute(np.ones(len(g), bool))
    got = [r.id for r in pairs.locally_consistent(rows.filter("NOT is_anchor"), rows.filter("is_anchor")).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(g.is_anchor.to_numpy(bool))
    monkeypatch.setattr(pairs, "nearest", None)
    assert pairs.locally_consistent(rows.filter("NOT is_anchor"), rows).count() == len(brute(np.ones(len(g), bool)))


def test_a_mesh_holds_few_bytes_a_point():
    """A scene's mesh lies in one task's memory; edges in a dictionary took 949 bytes a point."""
    import tracemalloc

    from orthoweave.operators import iterative

    p = np.random.default_rng(41).integers(0, 10**7, (6000, 2)).astype(float)
    tracemalloc.start()
    mesh = iterative.Mesh(p)
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert len(mesh.triangles()) > 11900 and held / len(p) < 600
    left = list(range(300, 6000))
    for i in range(300):
        mesh.remove(i)
    tris = lambda m, at: {frozenset(map(tuple, at[t])) for t in m.triangles()}
    assert tris(mesh, p) == tris(iterative.Mesh(p[left]), p[left])


def test_triangles_of_a_scene_parted_into_tiles_are_those_of_one_task(spark):
    """Ties of a lattice, points of one place, two blocks with nothing between them, and a few that moved far."""
    from orthoweave.operators import iterative, mesh_tiles

    rng = np.random.default_rng(51)
    ref = np.r_[rng.integers(0, 2000, (5000, 2)), rng.integers(0, 2000, (3000, 2)) + [9000, 2500]] * [10.0, 10.0]
    off = ref + rng.normal(0, 3, ref.shape) + np.where(rng.random((8000, 1)) < 0.01, rng.normal(0, 300, ref.shape), 0)
    g = pd.DataFrame({"id": [f"p{i:05d}" for i in rng.permutation(8000)], "scene": "s", "ref_x": ref[:, 0], "ref_y": ref[:, 1], "off_x": off[:, 0], "off_y": off[:, 1], "confidence": rng.integers(0, 5, 8000) / 5})
    g = pd.concat([g, g.head(50).assign(id=[f"q{i}" for i in range(50)])])
    rows = spark.createDataFrame(g)
    want = {r.id: r.ratio for r in iterative.triangle_filter(rows).collect()}
    assert 4000 < len(want) < 7990
    tiled, open_ = mesh_tiles.filtered(rows, {"s": 8050}, most=1.5, keep=["id", "scene"], tile=2500, halo=10.0)
    got = {r.id: r.ratio for r in tiled.collect()}
    assert not open_ and got.keys() == want.keys() and all(abs(got[i] - v) < 1e-12 * v for i, v in want.items())
    assert {r.id for r in iterative.triangle_filter(rows, keep=["id"], many=100).collect()} == want.keys()


def test_a_mesh_hangs_on_its_points_only():
    from orthoweave.operators import iterative

    rng = np.random.default_rng(52)
    for n, side, at in ((40, 6, 0.0), (400, 25, 0.0), (900, 40, 2.0**40), (900, 10**9, 0.0)):
        p = rng.integers(0, side, (n, 2)) + at
        tris = lambda q: {frozenset(map(tuple, q[t])) for t in iterative.Mesh(q).triangles()}
        assert tris(p) == tris(p[rng.permutation(n)]) == tris(p[::-1])
