"""Runs of grid cells that polygons cover or come near to, for a batch of polygons at a time.

What lies within a distance of an edge is convex, and so is its part inside a row of cells; its shadow on the row is one
interval. A cell of the row is near exactly if it meets that interval, so no cell is tried by itself.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from deslinde.functions.shapes import _expand

# Pairs of edge and row that one vectorised step holds.
PAIRS = 200_000


def rings_of(shell: pa.Array, holes: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(points, ring of each point, owner of each ring) of a batch: the shell of an owner, then its holes; null rings have no points."""
    lengths = lambda a: pc.fill_null(pc.list_value_length(a), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    rings = holes.flatten()
    owner = np.concatenate([np.arange(len(shell)), np.repeat(np.arange(len(shell)), lengths(holes))])
    flat = [shell.flatten(), rings.flatten()]
    points = np.concatenate([
        np.stack([pc.struct_field(f, [k]).to_numpy(zero_copy_only=False).astype(float) for k in (0, 1)], axis=1) for f in flat
    ])
    ring = np.repeat(np.arange(len(owner)), np.concatenate([lengths(shell), lengths(rings)]))
    order = np.argsort(owner, kind="stable")
    number = np.empty_like(order)
    number[order] = np.arange(len(order))
    ring = number[ring]
    place = np.argsort(ring, kind="stable")
    return points[place], ring[place], owner[order]


def _shadow(e: np.ndarray, top: np.ndarray, size: float, reach: float) -> tuple[np.ndarray, np.ndarray]:
    """First and last x of what lies within ``reach`` of the edges and in the rows below ``top``; infinite the wrong way round if nothing does."""
    bottom = top - size
    turned = e[:, 1] > e[:, 3]
    px, py, qx, qy = np.where(turned[:, None], e[:, [2, 3, 0, 1]], e).T
    with np.errstate(divide="ignore", invalid="ignore"):
        slope = np.where(qy > py, (qx - px) / (qy - py), 0.0)
    left, right = np.minimum(px, qx), np.maximum(px, qx)
    between = lambda y: np.clip(px + (y - py) * slope, left, right)
    lower = lambda y: np.where(y <= py, px, between(y))
    upper = lambda y: np.where(y >= qy, qx, between(y))
    first, last = np.full(len(e), np.inf), np.full(len(e), -np.inf)

    def take(good: np.ndarray, x: np.ndarray, wide) -> None:
        np.minimum(first, np.where(good, x - wide, np.inf), out=first)
        np.maximum(last, np.where(good, x + wide, -np.inf), out=last)

    a, b = np.maximum(py, bottom), np.minimum(qy, top)
    for x in (lower(a), upper(b)):
        take(a <= b, x, reach)
    # beside the row an edge at distance d reaches sqrt(reach^2 - d^2) into it: its ends there, or where the edge's lean makes up for the loss
    for a, b, away, lean in (
        (np.maximum(py, top), np.minimum(qy, top + reach), lambda y: y - top, slope),
        (np.maximum(py, bottom - reach), np.minimum(qy, bottom), lambda y: bottom - y, -slope),
    ):
        good = a <= b
        wide = lambda y: np.sqrt(np.maximum(reach * reach - away(y) ** 2, 0.0))
        take(good, lower(a), wide(a))
        take(good, upper(b), wide(b))
        best = reach * np.abs(lean) / np.hypot(1.0, lean)
        y = top + best if lean is slope else bottom - best
        take(good & (a < y) & (y < b), between(y), wide(y))
    return first, last


def _merged(key: np.ndarray, r: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs with those of one key and row that overlap or touch as one."""
    if not len(key):
        return key, r, a, b
    order = np.lexsort((a, r, key))
    key, r, a, b = key[order], r[order], a[order], b[order]
    new = np.concatenate([[True], (key[1:] != key[:-1]) | (r[1:] != r[:-1])])
    far = int(b.max() - a.min()) + 3
    shift = np.cumsum(new) * far
    ends = np.maximum.accumulate(b + shift)
    start = np.concatenate([[True], a[1:] + shift[1:] > ends[:-1] + 1])
    at = np.flatnonzero(start)
    last = np.concatenate([at[1:], [len(a)]]) - 1
    return key[at], r[at], a[at], ends[last] - shift[last]


def covered(points: np.ndarray, ring: np.ndarray, owner: np.ndarray, key: np.ndarray, size: float, half: float, reach: float) -> tuple[np.ndarray, ...]:
    """(key, row, first column, last column) of the cells within ``reach`` of the polygons; ``key`` names an owner's group."""
    same = ring[1:] == ring[:-1]
    e = np.concatenate([points[:-1], points[1:]], axis=1)[same]
    whose = owner[ring[1:][same]]
    good = np.isfinite(e).all(axis=1)
    e, whose = e[good], whose[good]
    low, high = np.minimum(e[:, 1], e[:, 3]), np.maximum(e[:, 1], e[:, 3])
    number = lambda v: v.astype(np.int64)
    first = number(np.ceil((half - (high + reach)) / size)) - 1
    times = number(np.floor((half - (low - reach)) / size)) - first + 1
    none = np.zeros(0, np.int64)
    runs = [(none, none, none, none)]
    for i, r in _expand(first, times, PAIRS):
        x0, x1 = _shadow(e[i], half - r * size, size, reach)
        met = x0 <= x1
        i, r = i[met], r[met]
        runs.append(_merged(key[whose[i]], r, number(np.ceil((x0[met] + half) / size)) - 1, number(np.floor((x1[met] + half) / size))))
    # inside, away from every edge: cells whose middle an odd number of the polygon's edges lies before
    middle = lambda y: (half - y) / size - 0.5
    first = number(np.floor(middle(high))) + 1
    times = np.maximum(number(np.floor(middle(low))) - first + 1, 0)
    found = [(none, none, np.zeros(0))]
    for i, r in _expand(first, times, PAIRS):
        y = half - (r + 0.5) * size
        found.append((whose[i], r, e[i, 0] + (y - e[i, 1]) * (e[i, 2] - e[i, 0]) / (e[i, 3] - e[i, 1])))
    own, r, x = (np.concatenate(f) for f in zip(*found))
    order = np.lexsort((x, r, own))
    own, r, x = own[order], r[order], x[order]
    begins = np.concatenate([[True], (own[1:] != own[:-1]) | (r[1:] != r[:-1])])[: len(own)]
    place = np.arange(len(own)) - np.maximum.accumulate(np.where(begins, np.arange(len(own)), 0))
    opens = np.flatnonzero((place[:-1] % 2 == 0) & ~begins[1:])
    a, b = number(np.ceil((x[opens] + half) / size - 0.5)), number(np.floor((x[opens + 1] + half) / size - 0.5))
    full = a <= b
    runs.append((key[own[opens]][full], r[opens][full], a[full], b[full]))
    return _merged(*(np.concatenate(f) for f in zip(*runs)))
