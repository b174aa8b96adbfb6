"""Repair of polygons: crossing rings are noded, and what an odd number of rings surrounds becomes parts of their own.

An Arrow UDF over the coordinates of a batch: every step treats the edges of all its polygons at once, each beside the
number of its owner, and edges of different owners never meet. Rows that need no repair are told apart by a sweep over
sorted boxes and come back as they are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, StructType

from deslinde.functions import geometry as G
from deslinde.functions.cover import PAIRS, rings_of
from deslinde.functions.shapes import _expand

# Points nearer than this share of the polygon's extent are one.
SNAP = 1e-11
# Vertices treated together; a larger polygon is a step of its own.
VERTICES = 200_000


def _segments(points: np.ndarray, ring: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (ax, ay, bx, by) of all rings, closed where they are open, none of length zero, and their owners."""
    ends = np.concatenate([ring[1:] != ring[:-1], np.ones(min(1, len(ring)), bool)])
    following = np.arange(1, len(ring) + 1)
    following[ends] = np.concatenate([np.zeros(min(1, len(ring)), np.int64), np.flatnonzero(ends)[:-1] + 1])
    s = np.concatenate([points, points[following]], axis=1)
    good = (s[:, :2] != s[:, 2:]).any(axis=1)
    return s[good], owner[ring[good]]


def _ranges(own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every place of sorted owners, where its owner's places begin and how many there are."""
    first = np.searchsorted(own, own, "left")
    return first, np.searchsorted(own, own, "right") - first


def _extent(s: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every edge, its owner's lowest corner and longer side."""
    at = np.flatnonzero(np.concatenate([np.ones(min(1, len(own)), bool), own[1:] != own[:-1]]))
    if not len(at):
        return np.zeros((0, 2)), np.zeros(0)
    low = np.minimum.reduceat(np.minimum(s[:, :2], s[:, 2:]), at)
    high = np.maximum.reduceat(np.maximum(s[:, :2], s[:, 2:]), at)
    which = np.repeat(np.arange(len(at)), np.diff(np.concatenate([at, [len(own)]])))
    return low[which], (high - low).max(axis=1)[which]


def _near_pairs(s: np.ndarray, own: np.ndarray):
    """Pairs of edges of one owner whose boxes meet."""
    left, right = np.minimum(s[:, 0], s[:, 2]), np.maximum(s[:, 0], s[:, 2])
    low, high = np.minimum(s[:, 1], s[:, 3]), np.maximum(s[:, 1], s[:, 3])
    n = len(s)
    order = np.lexsort((left, own))
    # how many edges begin before each one ends, its own and earlier owners' among them
    every = np.lexsort((np.repeat([0, 1], n), np.concatenate([left, right]), np.concatenate([own, own])))
    begun = np.empty(2 * n, np.int64)
    begun[every] = np.cumsum(every < n)
    first = np.arange(1, n + 1)
    times = np.maximum(begun[n + order] - first, 0)
    for k, place in _expand(first, times, PAIRS):
        i, j = order[k], order[place]
        near = (low[i] <= high[j]) & (low[j] <= high[i])
        yield i[near], j[near]


def _cuts(s: np.ndarray, own: np.ndarray, scale: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(edge, point) of the points inside edges where another edge crosses, touches or ends; ``scale`` is each edge's tolerance."""
    edges, points = [np.zeros(0, np.int64)], [np.zeros((0, 2))]
    a, d = s[:, :2], s[:, 2:] - s[:, :2]
    length = np.hypot(*d.T)

    def inside(i: np.ndarray, p: np.ndarray) -> None:
        """Points that lie on the edges, away from their ends."""
        along = ((p - a[i]) * d[i]).sum(axis=1) / length[i]
        off = np.abs((p - a[i])[:, 0] * d[i, 1] - (p - a[i])[:, 1] * d[i, 0]) / length[i]
        good = (off <= scale[i]) & (along > scale[i]) & (along < length[i] - scale[i])
        edges.append(i[good])
        points.append(p[good])

    for i, j in _near_pairs(s, own):
        det = d[i, 0] * d[j, 1] - d[i, 1] * d[j, 0]
        gap = a[j] - a[i]
        with np.errstate(divide="ignore", invalid="ignore"):
            t, u = (gap[:, 0] * d[j, 1] - gap[:, 1] * d[j, 0]) / det, (gap[:, 0] * d[i, 1] - gap[:, 1] * d[i, 0]) / det
        met = (det != 0) & (t > 0) & (t < 1) & (u > 0) & (u < 1)
        p = a[i[met]] + t[met, None] * d[i[met]]
        inside(i[met], p)
        inside(j[met], p)
        for one, other in ((i, j), (j, i)):
            inside(one, s[other, :2])
            inside(one, s[other, 2:])
    return np.concatenate(edges), np.concatenate(points)


def _numbered(own: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Equal rows of one owner as one: the place of the first of each, the number of every row's, and how often each occurs; by owner and row."""
    order = np.lexsort((*rows.T[::-1], own))
    o, r = own[order], rows[order]
    new = np.concatenate([np.ones(min(1, len(o)), bool), (o[1:] != o[:-1]) | (r[1:] != r[:-1]).any(axis=1)])
    number = np.empty(len(o), np.int64)
    number[order] = np.cumsum(new) - 1
    return order[new], number, np.bincount(number, minlength=int(new.sum()))


def _noded(s: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges cut where they meet, with their owners; pieces that lie on one another an even number of times are gone, as nothing lies between."""
    low, extent = _extent(s, own)
    scale = SNAP * extent
    edge, cut = _cuts(s, own, scale)
    n = np.arange(len(s))
    edge = np.concatenate([n, n, edge])
    points = np.concatenate([s[:, :2], s[:, 2:], cut])
    first, number, _ = _numbered(own[edge], np.rint((points - low[edge]) / scale[edge, None]))
    points = points[first[number]]
    along = ((points - s[edge, :2]) * (s[edge, 2:] - s[edge, :2])).sum(axis=1)
    order = np.lexsort((along, edge))
    edge, points = edge[order], points[order]
    same = edge[1:] == edge[:-1]
    pieces, whose = np.concatenate([points[:-1], points[1:]], axis=1)[same], own[edge[1:][same]]
    long = (pieces[:, :2] != pieces[:, 2:]).any(axis=1)
    pieces, whose = pieces[long], whose[long]
    back = (pieces[:, 0] > pieces[:, 2]) | ((pieces[:, 0] == pieces[:, 2]) & (pieces[:, 1] > pieces[:, 3]))
    pieces[back] = pieces[back][:, [2, 3, 0, 1]]
    first, _, times = _numbered(whose, pieces)
    first = first[times % 2 == 1]
    return pieces[first], whose[first]


def _oriented(s: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Edges turned so that what an odd number of edges surrounds lies to their left."""
    steep = np.abs(s[:, 3] - s[:, 1]) >= np.abs(s[:, 2] - s[:, 0])
    middle, odd = (s[:, :2] + s[:, 2:]) / 2, np.zeros(len(s), bool)
    for i, j in _expand(*_ranges(own), PAIRS):
        for which, x, y in ((steep, 0, 1), (~steep, 1, 0)):
            mine = which[i] & (i != j)
            k, e = i[mine], s[j[mine]]
            my = middle[k, y]
            straddles = (e[:, y] > my) != (e[:, y + 2] > my)
            k, e, my = k[straddles], e[straddles], my[straddles]
            at = e[:, x] + (my - e[:, y]) * (e[:, x + 2] - e[:, x]) / (e[:, y + 2] - e[:, y])
            odd ^= np.bincount(k[at > middle[k, x]], minlength=len(s)) % 2 == 1
    up, east = s[:, 3] > s[:, 1], s[:, 2] > s[:, 0]
    # a ray to the right or upwards that meets an odd number of other edges starts on the inner side
    turn = np.where(steep, up == odd, east != odd)
    out = s.copy()
    out[turn] = s[turn][:, [2, 3, 0, 1]]
    return out


def _areas(points: np.ndarray, ring: np.ndarray, n: int) -> np.ndarray:
    """Signed areas of ``n`` closed rings."""
    x, y = (points - points[np.searchsorted(ring, ring)]).T
    same = ring[1:] == ring[:-1]
    return np.bincount(ring[1:][same], (x[:-1] * y[1:] - x[1:] * y[:-1])[same], minlength=n) / 2


def _area(ring: np.ndarray) -> float:
    return float(_areas(ring, np.zeros(len(ring), np.int64), 1)[0])


def _walked(s: np.ndarray) -> list[np.ndarray]:
    """Closed rings of the faces to the left of one owner's edges; a ring that passes a point twice is two rings."""
    points, ends = np.unique(np.concatenate([s[:, :2], s[:, 2:]]), axis=0, return_inverse=True)
    ends = ends.ravel()
    start, stop = ends[: len(s)], ends[len(s) :]
    angle = np.arctan2(s[:, 3] - s[:, 1], s[:, 2] - s[:, 0])
    leaving: dict[int, list[int]] = {}
    for e in np.lexsort((angle, start)):
        leaving.setdefault(int(start[e]), []).append(int(e))
    used, rings = np.zeros(len(s), bool), []
    for first in range(len(s)):
        if used[first]:
            continue
        path, place, e = [], {}, first
        while not used[e]:
            used[e] = True
            v = int(start[e])
            if v in place:  # a loop is complete
                rings.append(path[place[v] :])
                for w in path[place[v] :]:
                    place.pop(w, None)
                path = path[: len(path) - len(rings[-1])]
            place[v] = len(path)
            path.append(v)
            back = np.arctan2(s[e, 1] - s[e, 3], s[e, 0] - s[e, 2])
            options = [o for o in leaving.get(int(stop[e]), []) if not used[o]]
            if not options:
                break
            # the first edge clockwise from where the path came keeps to the same face
            e = max(options, key=lambda o: (angle[o] < back, angle[o]))
        if len(path) > 2:
            rings.append(path)
    return [points[np.array([*r, r[0]])] for r in rings if len(r) > 2]


def _following(s: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """The edge that goes on along the face to the left of each: the first one clockwise that leaves its end; -1 if none does."""
    n = len(s)
    leaves = np.arctan2(s[:, 3] - s[:, 1], s[:, 2] - s[:, 0])
    back = np.arctan2(s[:, 1] - s[:, 3], s[:, 0] - s[:, 2])
    order = np.lexsort((leaves, start))
    every = np.lexsort((np.repeat([1, 0], n), np.concatenate([leaves, back]), np.concatenate([start, stop])))
    before = np.empty(2 * n, np.int64)
    before[every] = np.cumsum(every < n)
    first, last = np.searchsorted(start[order], stop, "left"), np.searchsorted(start[order], stop, "right") - 1
    place = np.where(before[n:] > first, before[n:] - 1, last)
    return np.where(last >= first, order[np.clip(place, 0, max(n - 1, 0))], -1)


def _faces(s: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(points, ring of each, owner of each ring): closed rings of the faces to the left of the edges, none through a point twice.

    Faces of all owners are followed at once by doubling steps. Owners with a face that passes a point twice, or with edges
    that no walk orders, are walked by themselves.
    """
    n = len(s)
    _, number, _ = _numbered(np.concatenate([own, own]), np.concatenate([s[:, :2], s[:, 2:]]))
    start, stop = number[:n], number[n:]
    following = _following(s, start, stop)
    times = np.bincount(following[following >= 0], minlength=n)
    odd = np.isin(own, own[(following < 0) | (times != 1)])
    following = np.where(odd, np.arange(n), following)
    lead, jump = np.arange(n), following
    while True:
        less = np.minimum(lead, lead[jump])
        if (less == lead).all():
            break
        lead, jump = less, jump[jump]
    left = np.where(lead == np.arange(n), 0, 1)  # steps to the leader
    jump = np.where(left == 0, np.arange(n), following)
    while (jump != lead).any():
        left, jump = left + left[jump], jump[jump]
    _, visit, seen = _numbered(lead, start[:, None])
    odd = np.isin(own, own[odd | (seen[visit] > 1)])
    order = np.lexsort((-left, left > 0, lead))
    order = order[~odd[order]]
    _, face, edges = np.unique(lead[order], return_inverse=True, return_counts=True)
    order, face = order[edges[face] > 2], face[edges[face] > 2]
    begins = np.flatnonzero(np.concatenate([np.ones(min(1, len(face)), bool), face[1:] != face[:-1]]))
    # every ring ends with its first point
    place = np.argsort(np.concatenate([face, face[begins]]), kind="stable")
    points = [np.concatenate([s[order, :2], s[order[begins], :2]])[place]]
    sizes, whose = list(np.diff(np.concatenate([begins, [len(face)]])) + 1) if len(begins) else [], list(own[order[begins]])
    for o in np.unique(own[odd]):
        for r in _walked(s[own == o]):
            points.append(r)
            sizes.append(len(r))
            whose.append(o)
    return np.concatenate(points), np.repeat(np.arange(len(sizes)), np.array(sizes, np.int64)), np.array(whose, np.int64)


def _holds(ring: np.ndarray, p: np.ndarray) -> bool:
    a, b = ring[:-1], ring[1:]
    over = (a[:, 1] > p[1]) != (b[:, 1] > p[1])
    with np.errstate(divide="ignore", invalid="ignore"):
        at = a[:, 0] + (p[1] - a[:, 1]) * (b[:, 0] - a[:, 0]) / (b[:, 1] - a[:, 1])
    return bool((over & (p[0] < at)).sum() % 2)


def _parts(points: np.ndarray, ring: np.ndarray, owner: np.ndarray) -> list[tuple[int, int, np.ndarray]]:
    """(owner, part, ring) by owner, part and shell first: what an odd number of an owner's rings surrounds, larger parts first."""
    s, own = _segments(points, ring, owner)
    if not len(s):
        return []
    tolerance = np.zeros(int(own[-1]) + 1)
    tolerance[own] = (SNAP * _extent(s, own)[1]) ** 2
    s, own = _noded(s, own)
    if not len(s):
        return []
    points, ring, owner = _faces(_oriented(s, own), own)
    areas = _areas(points, ring, len(owner))
    at = np.searchsorted(ring, np.arange(len(owner) + 1))
    out, parts, last = [], [], -1
    order = np.lexsort((-np.abs(areas), areas < 0, owner))
    order = order[np.abs(areas[order]) > tolerance[owner[order]]]
    for k, o, a in zip(order.tolist(), owner[order].tolist(), areas[order].tolist()):
        if o != last:
            out += [(last, p, r) for p, (_, *rs) in enumerate(parts) for r in rs]
            parts, last = [], o
        r = points[at[k] : at[k + 1]]
        if a > 0:
            parts.append([a, r])
        else:
            # the smallest shell around it; a step off its edge, into the hole, lies inside the shell as well
            middle = (r[0] + r[1]) / 2
            around = [p for p in parts if p[0] >= -a and _holds(p[1], middle)]
            if around:
                around[-1].append(r)
    return out + [(last, p, r) for p, (_, *rs) in enumerate(parts) for r in rs]


def _unsound(points: np.ndarray, ring: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` owners have open or flat rings, edges that meet other than at the ends of neighbours, or holes outside their shell?"""
    rings = len(owner)
    at = np.searchsorted(ring, np.arange(rings + 1))
    size, bad = np.diff(at), np.zeros(rings, bool)
    bad |= size < 4
    some = np.flatnonzero(size > 0)
    bad[some] |= (points[at[some]] != points[at[some + 1] - 1]).any(axis=1)
    bad[ring[1:][(ring[1:] == ring[:-1]) & (points[1:] == points[:-1]).all(axis=1)]] = True
    bad |= _areas(points, ring, rings) == 0
    out = np.zeros(n, bool)
    out[owner[bad]] = True
    # from here on only closed rings of owners still thought sound
    mine = ~out[owner[ring]]
    inner = mine.copy()
    inner[at[some + 1] - 1] = False
    first, _, times = _numbered(owner[ring[inner]], points[inner])
    out[owner[ring[inner]][first[times > 1]]] = True
    s = np.concatenate([points[:-1], points[1:]], axis=1)[inner[:-1]]
    of = ring[:-1][inner[:-1]]
    own = owner[of]
    edge, _ = _cuts(s, own, SNAP * _extent(s, own)[1])
    out[own[edge]] = True
    shell = np.searchsorted(owner, owner)  # each ring's owner's first
    holes = np.flatnonzero((shell != np.arange(rings)) & ~out[owner])
    p = points[at[holes]]
    first = np.searchsorted(own, owner[holes], "left")
    within = np.zeros(len(holes), bool)
    for k, e in _expand(first, np.searchsorted(own, owner[holes], "right") - first, PAIRS):
        over = (s[e, 1] > p[k, 1]) != (s[e, 3] > p[k, 1])
        k, e = k[over], e[over]
        over = p[k, 0] < s[e, 0] + (p[k, 1] - s[e, 1]) * (s[e, 2] - s[e, 0]) / (s[e, 3] - s[e, 1])
        k, which = k[over], of[e[over]]
        first_, _, times = _numbered(k, which[:, None])
        k, which = k[first_[times % 2 == 1]], which[first_[times % 2 == 1]]
        around = which == shell[holes[k]]
        within[k[around]] = True
        out[owner[holes[k[~around & (which != holes[k])]]]] = True
    out[owner[holes[~within]]] = True
    return out


def _listed(rings: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rings of one owner as (points, ring of each, owner of each ring)."""
    points = np.concatenate([np.zeros((0, 2)), *rings])
    return points, np.repeat(np.arange(len(rings)), [len(r) for r in rings]), np.zeros(len(rings), np.int64)


def repaired(rings: list[np.ndarray]) -> list[list[np.ndarray]]:
    """Parts [shell, hole, ...] of what an odd number of the rings surrounds, larger ones first."""
    parts: list[list[np.ndarray]] = []
    for _, p, r in _parts(*_listed(rings)):
        parts[p:] = [[*parts[p], r] if p < len(parts) else [r]]
    return parts


def needs_repair(rings: list[np.ndarray]) -> bool:
    """Are there open or flat rings, edges that meet other than at the ends of neighbours, or holes outside their shell?"""
    return bool(_unsound(*_listed(rings), 1)[0])


def _steps(shell: pa.Array, holes: pa.Array):
    """(first owner, number of owners, points, ring of each, owner of each ring) of a batch, some owners at a time, without rings that are not finite."""
    points, ring, owner = rings_of(shell, holes)
    fine = np.bincount(ring[~np.isfinite(points).all(axis=1)], minlength=len(owner)) == 0
    points, ring = points[fine[ring]], (np.cumsum(fine) - 1)[ring[fine[ring]]]
    owner = owner[fine]
    total = np.cumsum(np.bincount(owner[ring], minlength=len(shell)))
    a = 0
    while a < len(shell):
        b = max(a + 1, int(np.searchsorted(total, (total[a - 1] if a else 0) + VERTICES, "right")))
        r0, r1 = np.searchsorted(owner, [a, b])
        p0, p1 = np.searchsorted(ring, [r0, r1])
        yield a, b - a, points[p0:p1], ring[p0:p1] - r0, owner[r0:r1] - a
        a = b


def _rings_array(rings: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, rings)]).astype(np.int32)
    x, y = np.concatenate([np.zeros((0, 2)), *rings]).T
    return pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays([pa.array(x.copy()), pa.array(y.copy())], names=["x", "y"]))


RING = ArrayType(StructType().add("x", DoubleType()).add("y", DoubleType()))


@F.arrow_udf(ArrayType(StructType().add("shell", RING).add("holes", ArrayType(RING))))
def _repair_udf(shell: pa.Array, holes: pa.Array) -> pa.Array:
    sound, shells, others, n_holes, n_parts = np.zeros(len(shell), bool), [], [], [], np.zeros(len(shell), np.int64)
    for at, n, points, ring, owner in _steps(shell, holes):
        broken = _unsound(points, ring, owner, n)
        some = np.zeros(n, bool)
        some[owner] = True
        sound[at : at + n] = some & ~broken
        of = broken[owner]
        points, ring, owner = points[of[ring]], (np.cumsum(of) - 1)[ring[of[ring]]], owner[of]
        last = None
        for o, p, r in _parts(points, ring, owner):
            if (o, p) == last:
                others.append(r)
                n_holes[-1] += 1
            else:
                shells.append(r)
                n_holes.append(0)
                n_parts[at + o] += 1
                last = (o, p)
    ends = lambda counts: pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
    parts = pa.StructArray.from_arrays([_rings_array(shells), pa.ListArray.from_arrays(ends(n_holes), _rings_array(others))], names=["shell", "holes"])
    return pa.ListArray.from_arrays(ends(n_parts), parts, mask=pa.array(sound))


_repair_udf = _repair_udf.asNondeterministic()  # kept whole, or it would run once for every use of its result


@F.arrow_udf(BooleanType())
def _unsound_udf(shell: pa.Array, holes: pa.Array) -> pa.Array:
    return pa.array(np.concatenate([np.zeros(0, bool), *(_unsound(points, ring, owner, n) for _, n, points, ring, owner in _steps(shell, holes))]))


def _given(shell: Column, holes: Column) -> list[Column]:
    """Shell and holes as the steps take them; null holes are none, and null rings among them are left out."""
    rings = F.filter(F.coalesce(holes, G.no_holes()), lambda r: r.isNotNull())
    return [shell.cast(G.RING), rings.cast(f"array<{G.RING}>")]


def unsound(shell: Column, holes: Column) -> Column:
    """Would `make_valid` change anything?"""
    return _unsound_udf(*_given(shell, holes))


def make_valid(polygons: DataFrame) -> DataFrame:
    """Every polygon as sound parts: the given columns with ``shell`` and ``holes`` of the part, ``part`` from 0, ``repaired``.

    Sound polygons are their only part, unchanged. Otherwise the parts are what an odd number of rings surrounds: a bow tie
    becomes two triangles, a spike vanishes, a hole that leaves its shell is cut at it. What has no area gives no row, nor
    does a null or empty shell.
    """
    holes = F.coalesce(F.col("holes"), G.no_holes())
    found = polygons.where(G.has_geometry(F.col("shell"))).withColumn("_parts", _repair_udf(*_given(F.col("shell"), holes)))
    parts = F.when(F.col("_parts").isNull(), F.array(F.struct(F.col("shell"), holes.alias("holes")))).otherwise(F.col("_parts"))
    rows = found.withColumn("repaired", F.col("_parts").isNotNull()).select("*", F.posexplode(parts).alias("part", "_p"))
    return rows.withColumn("shell", F.col("_p.shell")).withColumn("holes", F.col("_p.holes")).drop("_p", "_parts")
