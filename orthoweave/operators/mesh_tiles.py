"""``iterative.triangle_filter`` over scenes too large for one task: tiles with their surroundings, side by side.

A triangle whose circle lies within what a tile sees is one of the whole scene. A tile settles its own points whose triangles
all do, except those within a few edges of others: these, the core, and their neighbours go to one task a scene, whose mesh has
all triangles of the core. Points go in chains: where one goes its neighbours change, and may go next. A chain and all points it
touches hang on nothing else. Whoever settles one of these points must have found the same chain; a scene where two differ is done
again with wider surroundings, and at last in one task.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from orthoweave.operators.nearest import _kept

#: Points of a tile, without its surroundings.
TILE = 200_000
#: Rows of a scene that are looked at to lay its tiles.
SEEN = 20_000
SETTLED, CORE, BESIDE, CHAIN = 0, 1, 2, 3
MARKS = ", ratio double, _kind int, _x double, _y double, _hash long, _own boolean"


def laid(x: np.ndarray, y: np.ndarray, n: int, tile: int, halo: float) -> np.ndarray:
    """Tiles (west, south, east, north, and the same with surroundings) by halves of the points seen; the outer are open."""
    out, share = [], n / max(1, len(x))

    def part(ids, w, s, e, t):
        for horizontal in sorted((True, False), key=lambda h: -np.ptp((x if h else y)[ids]) if len(ids) else 0):
            c = (x if horizontal else y)[ids]
            if len(ids) * share <= tile or len(ids) < 2:
                break
            mid = float(np.median(c))
            low = c < mid
            if 0 < low.sum() < len(c):
                for half, box in ((low, (w, s, mid, t) if horizontal else (w, s, e, mid)), (~low, (mid, s, e, t) if horizontal else (w, mid, e, t))):
                    part(ids[half], *box)
                return
        long, wide = (np.ptp(x[ids]), np.ptp(y[ids])) if len(ids) else (0.0, 0.0)
        many = max(1.0, len(ids) * share)
        h = halo * max(math.sqrt(long * wide / many), (long + wide) / many)
        out.append((w, s, e, t, w - h, s - h, e + h, t + h))

    part(np.arange(len(x)), -np.inf, -np.inf, np.inf, np.inf)
    return np.array(out)


def _circles(ref: np.ndarray, tri: np.ndarray) -> np.ndarray:
    """Boxes around the triangles' circles, wide enough for what floats lose."""
    a, b, c = ref[tri[:, 0]], ref[tri[:, 1]], ref[tri[:, 2]]
    b, c = b - a, c - a
    d = 2 * (b[:, 0] * c[:, 1] - b[:, 1] * c[:, 0])
    lost = 1e-14 * 2 * (np.abs(b[:, 0] * c[:, 1]) + np.abs(b[:, 1] * c[:, 0]))
    bb, cc = (b**2).sum(1), (c**2).sum(1)
    with np.errstate(divide="ignore", invalid="ignore"):
        at = np.c_[c[:, 1] * bb - b[:, 1] * cc, b[:, 0] * cc - c[:, 0] * bb] / d[:, None]
        r = np.hypot(*at.T)
        far = np.abs(at).sum(1) + r
        slack = far * (1e-9 + 2 * lost / np.abs(d)) + 1e-9 * np.abs(a).max(1, initial=0)
    box = np.c_[a + at - (r + slack)[:, None], a + at + (r + slack)[:, None]]
    bad = ~(np.isfinite(box).all(1) & (np.abs(d) > 8 * lost))
    box[bad] = -np.inf, -np.inf, np.inf, np.inf
    return box


def _boxes(ref: np.ndarray, tri: np.ndarray) -> np.ndarray:
    """The box around the circles of each point's triangles; a point of the hull has no bounds."""
    n = len(ref)
    box = np.c_[np.full((n, 2), np.inf), np.full((n, 2), -np.inf)]
    circle = _circles(ref, tri)
    for j in range(3):
        for c in range(2):
            np.minimum.at(box[:, c], tri[:, j], circle[:, c])
            np.maximum.at(box[:, c + 2], tri[:, j], circle[:, c + 2])
    u, v = tri.ravel().astype(np.int64), tri[:, [1, 2, 0]].ravel().astype(np.int64)
    side = np.sort(np.minimum(u, v) * n + np.maximum(u, v))
    twice = np.r_[side[1:] == side[:-1], False]
    single = side[~(twice | np.r_[False, twice[:-1]])] if len(side) else side
    open_ = np.ones(n, bool)
    open_[u] = False
    open_[single // n] = open_[single % n] = True
    box[open_] = -np.inf, -np.inf, np.inf, np.inf
    return box


def _mixed(v: np.ndarray) -> np.ndarray:
    v = (v ^ (v >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    v = (v ^ (v >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return v ^ (v >> np.uint64(32))


def distinct(ref: np.ndarray, conf: np.ndarray, id_of: Callable[[int], object]) -> np.ndarray:
    """Rows that stand for their place: the most confident, ties by id."""
    order = np.lexsort((-conf, ref[:, 1], ref[:, 0]))
    q, k = ref[order], conf[order]
    new = np.r_[True, (q[1:] != q[:-1]).any(1)] if len(q) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    best = order[first]
    last = np.r_[first[1:], len(order)] if len(first) else first
    for g in np.flatnonzero(last - first > 1).tolist():
        lo, hi = int(first[g]), int(last[g])
        same = [int(order[j]) for j in range(lo, hi) if k[j] == k[lo] or (k[j] != k[j] and k[lo] != k[lo])]
        best[g] = min(same, key=id_of)
    return best


def gone(ref: np.ndarray, off: np.ndarray, id_of: Callable[[int], object], most: float, look: Callable[[np.ndarray], None] | None = None):
    """(points left, ratios, {chain: points touched}, {chain: hash of what went in which order, and of what it touched}) of points
    of distinct places. look is given the mesh's triangles before any goes."""
    from orthoweave.operators.iterative import Mesh, _flat, _ratio

    mesh, n = Mesh(ref), len(ref)
    tri = mesh.triangles()
    if look:
        look(tri)
    r, o = _flat(ref), _flat(off)
    area = lambda p: np.abs((p[tri[:, 1], 0] - p[tri[:, 0], 0]) * (p[tri[:, 2], 1] - p[tri[:, 0], 1]) - (p[tri[:, 1], 1] - p[tri[:, 0], 1]) * (p[tri[:, 2], 0] - p[tri[:, 0], 0]))
    with np.errstate(divide="ignore", invalid="ignore"):
        u, v = area(ref), area(off)
        change = np.maximum(u / v, v / u)
        count = np.bincount(tri.ravel(), minlength=n)
        ratio = np.where(count > 0, np.bincount(tri.ravel(), np.repeat(change, 3), n) / count, 1.0)
    # Sums of floats hang on their order, and areas close to nothing on the corner they are taken from.
    thin = np.zeros(n, bool)
    with np.errstate(invalid="ignore"):
        for p, s in ((ref, u), (off, v)):
            reach = np.abs(p[tri[:, 1]] - p[tri[:, 0]]).max(1) * np.abs(p[tri[:, 2]] - p[tri[:, 0]]).max(1) if len(tri) else s
            thin[tri[~(s > 1e-9 * reach)].ravel()] = True
        maybe = np.flatnonzero((~(ratio < most * (1 - 1e-5)) | thin))
    for i in maybe.tolist():
        ratio[i] = _ratio(mesh, r, o, i)
    heap = [(-ratio[i], id_of(i), i) for i in maybe.tolist() if not ratio[i] <= most]
    heapq.heapify(heap)
    place = _mixed(np.ascontiguousarray(ref[:, 0] + 0.0).view(np.uint64)) + np.uint64(3) * _mixed(np.ascontiguousarray(ref[:, 1] + 0.0).view(np.uint64) + np.uint64(1))
    place = _mixed(place)
    on, root, events = np.ones(n, bool), {}, []

    def top(i: int) -> int:
        while root.setdefault(i, i) != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    while heap:
        x, _, i = heapq.heappop(heap)
        if not on[i] or -x != ratio[i]:
            continue
        on[i] = False
        hull = -1 in mesh.around(i)
        ring = mesh.remove(i)
        events.append((i, 5 * int(place[i]) + hull + sum(int(place[u]) for u in ring)))
        for u in ring:
            root[top(u)] = top(i)
            if (new := _ratio(mesh, r, o, u)) != ratio[u]:
                ratio[u] = new
                if not new <= most:
                    heapq.heappush(heap, (-new, id_of(u), u))
    chains: dict[int, list[int]] = {}
    for i in list(root):
        chains.setdefault(top(i), []).append(i)
    went: dict[int, int] = {}
    whole = (1 << 64) - 1
    for i, what in events:
        went[top(i)] = (went.get(top(i), 1) * 0x100000001B3 + what) & whole
    hashes = {c: (went[c] * 31 + sum(int(place[i]) for i in q)) & whole for c, q in chains.items()}
    return on, ratio, chains, hashes


def _near(mask: np.ndarray, tri: np.ndarray, edges: int) -> np.ndarray:
    mask = mask.copy()
    for _ in range(edges):
        mask[tri[mask[tri].any(1)].ravel()] = True
    return mask


def _rows(table: pa.Table, at: np.ndarray, n: int, schema: pa.Schema, **marks) -> pa.Table:
    """Rows of a table with marks, in the columns of a schema."""
    got = table.take(pa.array(at))
    return pa.table([got[f.name].cast(f.type) if f.name in got.column_names and f.name not in marks else pa.array(np.broadcast_to(marks[f.name], n), f.type) if f.name in marks else pa.nulls(n, f.type) for f in schema], schema=schema)


def _claims(table: pa.Table, schema: pa.Schema, ref: np.ndarray, mine: np.ndarray, chains: dict, hashes: dict) -> pa.Table:
    """What chains that touch points of others and of one's own touch."""
    at, h = [], []
    for c, q in chains.items():
        own = mine[q]
        if own.any() and not own.all():
            at += q
            h += [hashes[c]] * len(q)
    at = np.array(at, np.int64)
    rows = _rows(table.select(["scene"]), np.zeros(len(at), np.int64), len(at), schema, _kind=CHAIN, _x=ref[at, 0], _y=ref[at, 1], _hash=np.array(h, np.uint64).view(np.int64), _own=mine[at])
    return rows


def _numbers(t: pa.Table, *names: str) -> np.ndarray:
    return np.column_stack([t[c].cast(pa.float64()).to_numpy() for c in names])


def _ids(t: pa.Table, at: np.ndarray) -> Callable[[int], object]:
    ids = t["id"].combine_chunks()
    return lambda i: ids[int(at[i])].as_py()


def filtered(pairs: DataFrame, n: dict[str, int], *, most: float, keep: list[str], tile: int = TILE, halo: float = 20.0, edges: int = 4, tries: int = 3) -> tuple[DataFrame | None, list[str]]:
    """The kept columns of the pairs left with ratio, and the scenes that stay open after some tries."""
    spark, done, turn = pairs.sparkSession, [], list(n)
    need = list(dict.fromkeys([*keep, "id", "scene", "ref_x", "ref_y", "off_x", "off_y", "confidence"]))
    pairs = pairs.select(*need)
    kinds = dict(pairs.dtypes)
    out = ", ".join(f"{c} {kinds[c]}" for c in need) + MARKS
    for _ in range(tries):
        if not turn:
            break
        rows = pairs.filter(F.col("scene").isin(turn))
        share = min(1.0, SEEN * len(turn) / sum(n[s] for s in turn))
        seen = rows.select("scene", F.col("ref_x").cast("double").alias("x"), F.col("ref_y").cast("double").alias("y"))
        seen = seen.filter(F.pmod(F.xxhash64("x", "y"), F.lit(1 << 20)) < math.ceil(share * (1 << 20))).toPandas()
        tiles = {}
        for s in turn:
            g = seen[seen.scene == s]
            tiles[s] = laid(g.x.to_numpy(float), g.y.to_numpy(float), n[s], tile, halo)
        done.append(_turn(rows, tiles, out, most=most, keep=keep, edges=edges))
        turn, halo, edges = done[-1][1], 2 * halo, 2 * edges
    got = None
    for rows, bad in done:
        rows = rows.filter(~F.col("scene").isin(bad)) if bad else rows
        got = rows if got is None else got.unionByName(rows)
    return got, turn


def _turn(rows: DataFrame, tiles: dict[str, np.ndarray], out: str, *, most: float, keep: list[str], edges: int) -> tuple[DataFrame, list[str]]:
    schema = to_arrow_schema(rows.sparkSession.createDataFrame([], out).schema)
    first = np.cumsum([0] + [len(t) for t in tiles.values()]).tolist()
    start = dict(zip(tiles, first, strict=False))

    def deal(batches):
        for b in batches:
            x, y = (b.column(c).cast(pa.float64()).to_numpy(zero_copy_only=False) for c in ("ref_x", "ref_y"))
            code = b.column("scene").dictionary_encode()
            which = code.indices.to_numpy(zero_copy_only=False)
            at, to = [], []
            for j, scene in enumerate(code.dictionary.to_pylist()):
                ids = np.flatnonzero(which == j)
                u, v = x[ids], y[ids]
                for k, (w, s, e, t) in enumerate(tiles[scene][:, 4:].tolist()):
                    hit = ids[(u >= w) & (u <= e) & (v >= s) & (v <= t)]
                    at.append(hit)
                    to.append(np.full(len(hit), start[scene] + k, np.int32))
            if at:
                yield pa.RecordBatch.from_arrays([*b.take(pa.array(np.concatenate(at))).columns, pa.array(np.concatenate(to))], [*b.schema.names, "_tile"])

    def one(t: pa.Table) -> pa.Table:
        ref, conf = _numbers(t, "ref_x", "ref_y"), t["confidence"].cast(pa.float64()).to_numpy()
        ids = t["id"].combine_chunks()
        t = t.take(pa.array(distinct(ref, conf, lambda i: ids[i].as_py()))).combine_chunks()
        del ids
        ref, off, n = _numbers(t, "ref_x", "ref_y"), _numbers(t, "off_x", "off_y"), t.num_rows
        scene = t["scene"][0].as_py()
        all_, k = tiles[scene], t["_tile"][0].as_py() - start[scene]
        at = lambda r: (ref[:, 0] >= r[0]) & (ref[:, 1] >= r[1]) & (ref[:, 0] < r[2]) & (ref[:, 1] < r[3])
        seen = {}

        def look(tri):
            box = _boxes(ref, tri)
            within = lambda r: (box[:, 0] > r[0]) & (box[:, 1] > r[1]) & (box[:, 2] < r[2]) & (box[:, 3] < r[3])
            exact = within(all_[k, 4:])
            seed = ~exact
            for j, r in enumerate(all_):
                if j != k and (theirs := at(r)).any():
                    seed |= theirs & ~within(r[4:])
            own = at(all_[k])
            core = own & (_near(seed, tri, edges) | ~exact)
            seen["own"], seen["core"], seen["beside"] = own, core, _near(core, tri, edges + 2) & ~core

        on, ratio, chains, hashes = gone(ref, off, _ids(t, np.arange(n)), most, look)
        own, core, beside = (seen[c] for c in ("own", "core", "beside"))
        mine = own & ~core
        a, b, c = np.flatnonzero(mine & on), np.flatnonzero(core), np.flatnonzero(beside)
        return pa.concat_tables(
            [
                _rows(t.select(keep), a, len(a), schema, _kind=SETTLED, ratio=ratio[a]),
                _rows(t, b, len(b), schema, _kind=CORE),
                _rows(t, c, len(c), schema, _kind=BESIDE),
                _claims(t, schema, ref, mine, chains, hashes),
            ]
        )

    def rest(t: pa.Table) -> pa.Table:
        ref, kind = _numbers(t, "ref_x", "ref_y"), t["_kind"].to_numpy()
        order = np.lexsort((kind, ref[:, 1], ref[:, 0]))
        q = ref[order]
        t = t.take(pa.array(order[np.r_[True, (q[1:] != q[:-1]).any(1)]])).combine_chunks()
        ref, off, core = _numbers(t, "ref_x", "ref_y"), _numbers(t, "off_x", "off_y"), t["_kind"].to_numpy() == CORE
        on, ratio, chains, hashes = gone(ref, off, _ids(t, np.arange(len(ref))), most)
        a = np.flatnonzero(core & on)
        return pa.concat_tables([_rows(t.select(keep), a, len(a), schema, _kind=SETTLED, ratio=ratio[a]), _claims(t, schema, ref, core, chains, hashes)])

    dealt = rows.mapInArrow(deal, ", ".join(f"{c} {k}" for c, k in rows.dtypes) + ", _tile int")
    parts = max(first[-1], 1)
    met = _kept(dealt.repartition(min(parts, 2000), "_tile").groupBy("_tile").applyInArrow(one, out), "mesh-tiles")
    left = _kept(met.filter(F.col("_kind").isin(CORE, BESIDE)).groupBy("scene").applyInArrow(rest, out), "mesh-rest")
    both = met.unionByName(left)
    chains = both.filter(F.col("_kind") == CHAIN).groupBy("scene", "_x", "_y").agg(F.min("_hash").alias("lo"), F.max("_hash").alias("hi"), F.max("_own").alias("own"))
    bad = {r.scene for r in chains.filter("lo != hi OR NOT own").select("scene").distinct().collect()}
    settled = both.filter(F.col("_kind") == SETTLED)
    # The last four points of a scene never go.
    many = {r.scene: r.n for r in settled.groupBy("scene").agg(F.count("*").alias("n")).collect()}
    bad |= {s for s in tiles if many.get(s, 0) <= 4}
    return settled.select(*keep, "ratio"), sorted(bad)
