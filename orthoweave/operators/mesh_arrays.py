"""Delaunay triangles of many points at once: arrays of points enter a mesh together, then edges are flipped in rounds.

Triangles are counterclockwise rows of three corners, with the triangles beyond the sides opposite to them. The point after the
last is the ghost beyond the hull, as in ``iterative.Mesh``. Of four points on a circle the last by place (x, then y) has no
diagonal, so that the mesh depends on the points only, and not on their order. Signs are exact: where floats don't tell, whole numbers do.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

EPS = 2.0**-53


class Signs:
    """Exact signs of turns and circle tests; whole: the coordinates as integers of one scale."""

    def __init__(self, p: np.ndarray, whole: tuple[Sequence[int], Sequence[int]]):
        self.x, self.y = (np.ascontiguousarray(np.r_[c, 0.0]) for c in p.T)
        self.whole = whole
        # Sums and products of integers below 2**53 are exact.
        self.exact = 2.0**53 if (p == np.floor(p)).all() and (np.abs(p) < 2.0**52).all() else 0.0

    def turn(self, a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
        x, y = self.x, self.y
        xa, ya = x[a], y[a]
        left, right = (x[b] - xa) * (y[c] - ya), (y[b] - ya) * (x[c] - xa)
        det, size = left - right, np.abs(left) + np.abs(right)
        sign = np.sign(det)
        unsure = np.flatnonzero((np.abs(det) <= 4 * EPS * size) & (size >= self.exact))
        if len(unsure):
            x, y = self.whole
            for k, i, j, m in zip(unsure.tolist(), a[unsure].tolist(), b[unsure].tolist(), c[unsure].tolist(), strict=True):
                v = (x[j] - x[i]) * (y[m] - y[i]) - (y[j] - y[i]) * (x[m] - x[i])
                sign[k] = (v > 0) - (v < 0)
        return sign

    def between(self, a: np.ndarray, b: np.ndarray, d: np.ndarray) -> np.ndarray:
        """Whether d, on the line of a and b, lies between them."""
        p, q, r = (np.where(self.x[a] != self.x[b], self.x[i], self.y[i]) for i in (a, b, d))
        return (np.minimum(p, q) < r) & (r < np.maximum(p, q))

    def inside(self, w: np.ndarray, u: np.ndarray, v: np.ndarray, d: np.ndarray) -> np.ndarray:
        """Whether d, beyond the side from u to v, lies in the circle of w, u and v."""
        x, y = self.x, self.y
        xd, yd = x[d], y[d]
        ax, ay, bx, by, cx, cy = x[w] - xd, y[w] - yd, x[u] - xd, y[u] - yd, x[v] - xd, y[v] - yd
        al, bl, cl = ax * ax + ay * ay, bx * bx + by * by, cx * cx + cy * cy
        b1, b2, c1, c2, a1, a2 = bx * cy, by * cx, cx * ay, cy * ax, ax * by, ay * bx
        det = al * (b1 - b2) + bl * (c1 - c2) + cl * (a1 - a2)
        size = al * (np.abs(b1) + np.abs(b2)) + bl * (np.abs(c1) + np.abs(c2)) + cl * (np.abs(a1) + np.abs(a2))
        sign = np.sign(det)
        unsure = np.flatnonzero((np.abs(det) <= 16 * EPS * size) & (size >= self.exact))
        if len(unsure):
            x, y = self.whole
            for i, j, m, n, k in zip(*(c[unsure].tolist() for c in (w, u, v, d)), unsure.tolist(), strict=True):
                x0, y0 = x[n], y[n]
                far = [(x[q] - x0, y[q] - y0) for q in (i, j, m)]
                (px, py), (qx, qy), (rx, ry) = far
                s = (px * px + py * py) * (qx * ry - qy * rx) + (qx * qx + qy * qy) * (rx * py - ry * px) + (rx * rx + ry * ry) * (px * qy - py * qx)
                sign[k] = (s > 0) - (s < 0)
        got = sign > 0
        tied = np.flatnonzero(sign == 0)
        if len(tied):
            w, u, v, d = w[tied], u[tied], v[tied], d[tied]
            after = lambda p, q: (self.x[p] > self.x[q]) | ((self.x[p] == self.x[q]) & (self.y[p] > self.y[q]))
            last, other = np.where(after(u, v), u, v), np.where(after(w, d), w, d)
            got[tied] = after(last, other)
        return got


def triangles(p: np.ndarray, whole: tuple[Sequence[int], Sequence[int]], order: np.ndarray, first: tuple[int, int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Corners and neighbours of the mesh of distinct points; order: all of them, neighbours one after the other; first: three
    of them, counterclockwise."""
    n = len(p)
    signs, ghost = Signs(p, whole), n
    corner, beyond = np.full((2 * n - 2, 3), ghost, np.int32), np.full((2 * n - 2, 3), -1, np.int32)
    a, b, c = first
    corner[:4] = (a, b, c), (c, b, ghost), (a, c, ghost), (b, a, ghost)
    beyond[:4] = (1, 2, 3), (3, 2, 0), (1, 3, 0), (2, 1, 0)
    used, near = 4, np.full(n + 1, -1, np.int32)
    near[[a, b, c]] = 0
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    rest = np.random.default_rng(7).permutation(n)
    turns = np.linspace(0, 2 * np.pi, 64, endpoint=False)
    hull = np.unique([np.argmax(p[:, 0] * np.cos(g) + p[:, 1] * np.sin(g)) for g in turns])
    rest = np.r_[hull, rest[~np.isin(rest, hull)]]
    rest = rest[~np.isin(rest, first)]
    owner = np.full(2 * n - 2, -1, np.int64)
    child = np.full((2 * n - 2, 3), -1, np.int32)
    pool, at = np.zeros(0, np.int64), np.zeros(0, np.int64)
    taken, inserted = 0, 3
    while taken < len(rest) or len(pool):
        if taken < len(rest) and len(pool) < max(4, inserted):
            new = rest[taken : taken + max(4, inserted - len(pool))]
            taken += len(new)
            known = np.where(near[order] >= 0, np.arange(n), -1)
            before = np.maximum.accumulate(known)
            before[before < 0] = known[known >= 0][0]
            pool, at = np.r_[pool, new], np.r_[at, near[order[before[place[new]]]]]
        at, edge = _walk(signs, corner, beyond, ghost, pool, at)
        # A point takes its triangle, and where it lies on a side the one beyond, before others do.
        which = np.arange(len(pool))
        other = np.where(edge >= 0, beyond[at, np.maximum(edge, 0)], at)
        owner[np.c_[at, other].ravel()] = np.repeat(which, 2)
        won = (owner[at] == which) & (owner[other] == which)
        # Half planes beyond the hull overlap, so one point beyond it enters at a time.
        won[np.flatnonzero(won & (edge < 0) & (corner[at] == ghost).any(1))[1:]] = False
        t, q = at[won], pool[won]
        pool, at = pool[~won], at[~won]
        k = len(t)
        t1, t2 = used + np.arange(k), used + k + np.arange(k)
        used, inserted = used + 2 * k, inserted + k
        old, out = corner[t], beyond[t]
        # Where the sides of a parted triangle go, and at which place of a neighbour each lay.
        back = [_slot(beyond[out[:, j]], t) for j in range(3)]
        child[t, 0], child[t, 1], child[t, 2] = t1, t2, t
        corner[t, 2], beyond[t, 0], beyond[t, 1] = q, t1, t2
        corner[t1], corner[t2] = np.c_[old[:, 1], old[:, 2], q], np.c_[old[:, 2], old[:, 0], q]
        beyond[t1, 0], beyond[t1, 1], beyond[t2, 0], beyond[t2, 1] = t2, t, t, t1
        for j, s in ((0, t1), (1, t2), (2, t)):
            g = out[:, j]
            moved = child[g, back[j]]
            far, slot = np.where(moved >= 0, moved, g), np.where(moved >= 0, 2, back[j])
            beyond[s, 2], beyond[far, slot] = far, s
        child[t] = -1
        for s, three in ((t, (0, 1)), (t1, (0, 1)), (t2, (0, 1))):
            for j in three:
                near[corner[s, j]] = s
        near[q] = t
        _flip(signs, corner, beyond, ghost, near, owner, child, np.r_[t, t1, t2], np.full(3 * k, 2))
    return corner, beyond


def _slot(rows: np.ndarray, value: np.ndarray) -> np.ndarray:
    return np.where(rows[:, 0] == value, 0, np.where(rows[:, 1] == value, 1, 2))


def _walk(signs: Signs, corner, beyond, ghost: int, q: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The triangle that holds each point, and the side it lies on or -1."""
    t, edge = np.asarray(t, np.int64).copy(), np.full(len(q), -1)
    open_ = np.arange(len(q))
    while len(open_):
        c, p = corner[t[open_]], q[open_]
        outer = (c == ghost).any(1)
        go = np.full(len(open_), -1)
        real = np.flatnonzero(~outer)
        if len(real):
            r, pr = c[real], p[real]
            s = np.c_[signs.turn(r[:, 1], r[:, 2], pr), signs.turn(r[:, 2], r[:, 0], pr), signs.turn(r[:, 0], r[:, 1], pr)]
            least = s.argmin(1)
            low = s[np.arange(len(s)), least]
            go[real] = np.where(low < 0, least, -1)
            edge[open_[real]] = np.where(low == 0, least, -1)
        far = np.flatnonzero(outer)
        if len(far):
            k = _slot(c[far], np.full(len(far), ghost))
            i = np.arange(len(far))
            u, v, pf = c[far][i, (k + 1) % 3], c[far][i, (k + 2) % 3], p[far]
            s = signs.turn(u, v, pf)
            x, y = signs.x, signs.y
            # On the line of a hull edge: past u, past v, or on the edge.
            along = np.where(x[u] != x[v], (x[pf] - x[u]) * np.sign(x[v] - x[u]), (y[pf] - y[u]) * np.sign(y[v] - y[u]))
            long = np.where(x[u] != x[v], np.abs(x[v] - x[u]), np.abs(y[v] - y[u]))
            go[far] = np.where(s < 0, k, np.where(s > 0, -1, np.where(along < 0, (k + 2) % 3, np.where(along > long, (k + 1) % 3, -1))))
            edge[open_[far]] = np.where(s == 0, k, -1)
        on = go >= 0
        open_ = open_[on]
        t[open_] = beyond[t[open_], go[on]]
    return t, edge


def _flip(signs: Signs, corner, beyond, ghost: int, near, owner, partner, t: np.ndarray, k: np.ndarray) -> None:
    mate = partner[:, 0]
    while len(t):
        i = np.arange(len(t))
        c, b = corner[t], beyond[t]
        w, u, v, o = c[i, k], c[i, (k + 1) % 3], c[i, (k + 2) % 3], b[i, k]
        co = corner[o]
        m = np.where((co[:, 0] != u) & (co[:, 0] != v), 0, np.where((co[:, 1] != u) & (co[:, 1] != v), 1, 2))
        x = co[i, m]
        bad = np.zeros(len(t), bool)
        tip, side = (w == ghost) | (x == ghost), (u == ghost) | (v == ghost)
        real = np.flatnonzero(~tip & ~side)
        bad[real] = signs.inside(w[real], u[real], v[real], x[real])
        if (j := np.flatnonzero(tip)).size:
            d = np.where(w == ghost, x, w)[j]
            bad[j] = (signs.turn(u[j], v[j], d) == 0) & signs.between(u[j], v[j], d)
        if (j := np.flatnonzero(side)).size:
            s = signs.turn(np.where(u == ghost, v, w)[j], np.where(u == ghost, w, u)[j], x[j])
            bad[j] = (s > 0) | ((s == 0) & ~signs.between(w[j], x[j], np.where(u == ghost, v, u)[j]))
        bad = np.flatnonzero(bad)
        if not len(bad):
            return
        owner[np.c_[t[bad], o[bad]].ravel()] = np.repeat(bad, 2)
        won = (owner[t[bad]] == bad) & (owner[o[bad]] == bad)
        again, j = bad[~won], bad[won]
        w, u, v, x, tt, oo = w[j], u[j], v[j], x[j], t[j], o[j]
        bt, bo, kj, mj, i = b[j], beyond[oo], k[j], m[j], np.arange(len(j))
        vw, wu, ux, xv = bt[i, (kj + 1) % 3], bt[i, (kj + 2) % 3], bo[i, (mj + 1) % 3], bo[i, (mj + 2) % 3]
        corner[tt], corner[oo] = np.c_[w, u, x], np.c_[w, x, v]
        beyond[tt, 1], beyond[oo, 2] = oo, tt
        mate[tt], mate[oo] = oo, tt
        near[w], near[u], near[x], near[v] = tt, tt, tt, oo
        sides = []
        for s, slot, p, q, g in ((tt, 0, u, x, ux), (tt, 2, w, u, wu), (oo, 0, x, v, xv), (oo, 1, v, w, vw)):
            cg = corner[g]
            has = ((cg == p[:, None]) | (cg == q[:, None])).sum(1) == 2
            g = np.where(has, g, mate[g])
            cg = corner[g]
            at = np.where((cg[:, 0] != p) & (cg[:, 0] != q), 0, np.where((cg[:, 1] != p) & (cg[:, 1] != q), 1, 2))
            sides.append((s, slot, g, at))
        for s, slot, g, at in sides:
            beyond[s, slot], beyond[g, at] = g, s
        mate[tt] = mate[oo] = -1
        # An edge that waits may have got another place; its triangle's and its neighbour's sides are looked at again.
        t2, o2 = t[again].astype(np.int64), o[again].astype(np.int64)
        t = np.r_[tt, tt, oo, oo, t2, t2, t2, o2, o2, o2].astype(np.int64)
        k = np.r_[np.full(len(tt), 0), np.full(len(tt), 2), np.full(len(tt), 0), np.full(len(tt), 1), np.repeat([0, 1, 2, 0, 1, 2], len(t2))]
        # One side of each edge is enough.
        far = beyond[t, k]
        key = np.where(t < far, t * 3 + k, -1)
        if (j := np.flatnonzero(key < 0)).size:
            key[j] = far[j].astype(np.int64) * 3 + _slot(beyond[far[j]], t[j])
        key = np.unique(key)
        t, k = key // 3, key % 3


def whole(p: np.ndarray) -> tuple[list[int], list[int]]:
    """Coordinates as integers of one scale."""
    if (p == np.floor(p)).all() and (np.abs(p) < 2.0**62).all():
        return tuple(c.astype(np.int64).tolist() for c in p.T)
    parts = [[v.as_integer_ratio() for v in c.tolist()] for c in p.T]
    scale = max((d for c in parts for _, d in c), default=1)
    return tuple([n * (scale // d) for n, d in c] for c in parts)
