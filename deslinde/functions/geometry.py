"""Polygon expressions over coordinate arrays.

A ring is ``ARRAY<STRUCT<x DOUBLE, y DOUBLE>>``, closed (first vertex repeated).
A polygon is a ``shell`` ring and a ``holes`` array of rings. All sums are taken
relative to the first vertex, so areas of metre-sized shapes survive in degrees.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from deslinde import constants as C

RING = "array<struct<x:double,y:double>>"
POLYGON_COLUMNS = "shell array<struct<x:double,y:double>>, holes array<array<struct<x:double,y:double>>>"


def box_ring(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    corner = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    return F.array(corner(x0, y0), corner(x1, y0), corner(x1, y1), corner(x0, y1), corner(x0, y0))


def no_holes() -> Column:
    return F.array().cast(f"array<{RING}>")


def edges(ring: Column) -> Column:
    """Consecutive vertex pairs."""
    n = F.greatest(F.size(ring) - 1, F.lit(0))
    return F.zip_with(
        F.slice(ring, F.lit(1), n), F.slice(ring, F.lit(2), n),
        lambda a, b: F.struct(a["x"].alias("ax"), a["y"].alias("ay"), b["x"].alias("bx"), b["y"].alias("by")),
    )


def all_edges(shell: Column, holes: Column) -> Column:
    return F.flatten(F.concat(F.array(edges(shell)), F.transform(holes, edges)))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)


def _signed_area(ring: Column) -> Column:
    o = ring[0]
    cross = F.transform(
        edges(ring),
        lambda e: (e["ax"] - o["x"]) * (e["by"] - o["y"]) - (e["bx"] - o["x"]) * (e["ay"] - o["y"]),
    )
    return _sum(cross) / 2.0


def ring_area(ring: Column) -> Column:
    return F.abs(_signed_area(ring))


def ring_length(ring: Column) -> Column:
    return _sum(F.transform(edges(ring), lambda e: F.hypot(e["bx"] - e["ax"], e["by"] - e["ay"])))


def area(shell: Column, holes: Column) -> Column:
    return ring_area(shell) - _sum(F.transform(holes, ring_area))


def _on_edge(e: Column, x: Column, y: Column) -> Column:
    cross = (e["bx"] - e["ax"]) * (y - e["ay"]) - (e["by"] - e["ay"]) * (x - e["ax"])
    return (
        (cross == 0)
        & x.between(F.least(e["ax"], e["bx"]), F.greatest(e["ax"], e["bx"]))
        & y.between(F.least(e["ay"], e["by"]), F.greatest(e["ay"], e["by"]))
    )


def _crosses(e: Column, x: Column, y: Column) -> Column:
    """Does the ray to the right of (x, y) cross the edge?"""
    straddles = (e["ay"] > y) != (e["by"] > y)
    at = e["ax"] + (y - e["ay"]) * (e["bx"] - e["ax"]) / (e["by"] - e["ay"])
    return F.when(straddles, x < at).otherwise(False)


def contains(shell: Column, holes: Column, x: Column, y: Column) -> Column:
    """Strictly inside: the boundary, of holes too, is outside."""
    every = all_edges(shell, holes)
    return ~F.exists(every, lambda e: _on_edge(e, x, y)) & (
        F.size(F.filter(every, lambda e: _crosses(e, x, y))) % 2 == 1
    )


def edge_distance(e: Column, x: Column, y: Column) -> Column:
    dx, dy = e["bx"] - e["ax"], e["by"] - e["ay"]
    length2 = dx * dx + dy * dy
    along = F.when(length2 > 0, ((x - e["ax"]) * dx + (y - e["ay"]) * dy) / length2).otherwise(0.0)
    t = F.least(F.lit(1.0), F.greatest(F.lit(0.0), along))
    return F.hypot(x - (e["ax"] + t * dx), y - (e["ay"] + t * dy))


def boundary_distance(shell: Column, holes: Column, x: Column, y: Column) -> Column:
    return F.array_min(F.transform(all_edges(shell, holes), lambda e: edge_distance(e, x, y)))


def distance(shell: Column, holes: Column, x: Column, y: Column) -> Column:
    """Distance from a point, zero inside."""
    return F.when(contains(shell, holes, x, y), 0.0).otherwise(boundary_distance(shell, holes, x, y))


def box_distance(minx: Column, miny: Column, maxx: Column, maxy: Column, x: Column, y: Column) -> Column:
    zero = F.lit(0.0)
    return F.hypot(F.greatest(minx - x, x - maxx, zero), F.greatest(miny - y, y - maxy, zero))


def centroid(shell: Column, holes: Column) -> Column:
    """Area centroid as struct (x, y), holes taken out."""
    o = shell[0]
    zero = F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("mx"), F.lit(0.0).alias("my"))

    def add(acc: Column, a: Column, mx: Column, my: Column) -> Column:
        return F.struct((acc["a"] + a).alias("a"), (acc["mx"] + mx).alias("mx"), (acc["my"] + my).alias("my"))

    def scaled(m: Column, by: Column) -> Column:
        return F.struct((m["a"] * by).alias("a"), (m["mx"] * by).alias("mx"), (m["my"] * by).alias("my"))

    def step(acc: Column, e: Column) -> Column:
        ax, ay, bx, by = e["ax"] - o["x"], e["ay"] - o["y"], e["bx"] - o["x"], e["by"] - o["y"]
        cross = ax * by - bx * ay
        return add(acc, cross, cross * (ax + bx), cross * (ay + by))

    def moments(ring: Column) -> Column:
        return F.aggregate(edges(ring), zero, step, lambda m: scaled(m, F.signum(m["a"])))

    rings = F.concat(
        F.array(moments(shell)), F.transform(holes, lambda h: scaled(moments(h), F.lit(-1.0)))
    )
    return F.aggregate(
        rings, zero, lambda acc, m: add(acc, m["a"], m["mx"], m["my"]),
        lambda m: F.struct(
            (o["x"] + m["mx"] / (3.0 * m["a"])).alias("x"), (o["y"] + m["my"] / (3.0 * m["a"])).alias("y")
        ),
    )


def bounds(shell: Column) -> Column:
    xs, ys = F.transform(shell, lambda p: p["x"]), F.transform(shell, lambda p: p["y"])
    return F.struct(
        F.array_min(xs).alias("minx"), F.array_min(ys).alias("miny"),
        F.array_max(xs).alias("maxx"), F.array_max(ys).alias("maxy"),
    )


def boxes_touch(a: Column, b: Column) -> Column:
    return (
        (a["minx"] <= b["maxx"]) & (b["minx"] <= a["maxx"])
        & (a["miny"] <= b["maxy"]) & (b["miny"] <= a["maxy"])
    )


def fill_holes(holes: Column, min_area: float | Column) -> Column:
    """Keep holes of at least ``min_area``; smaller ones are filled."""
    return F.filter(holes, lambda h: ring_area(h) >= min_area)


def compactness(ring: Column) -> Column:
    """4 pi A / P squared: one for a circle, near zero for a sliver."""
    p = ring_length(ring)
    return F.when(p > 0, 4 * math.pi * ring_area(ring) / (p * p)).otherwise(1.0)


def fill_compact_holes(holes: Column, max_area: float = C.HOLE_FILL_COMPACT_M2, area_scale: float = 1.0) -> Column:
    """Fill small round holes (printed text); elongated ones (passages) are kept."""
    return F.filter(
        holes,
        lambda h: ~((ring_area(h) * area_scale < max_area) & (compactness(h) > C.HOLE_COMPACTNESS)),
    )


def has_geometry(shell: Column) -> Column:
    return F.coalesce(F.size(shell) > 0, F.lit(False))


def is_closed(ring: Column) -> Column:
    return F.coalesce(ring[0] == F.element_at(ring, -1), F.lit(False))


def _side(ax: Column, ay: Column, bx: Column, by: Column, px: Column, py: Column) -> Column:
    return F.signum((bx - ax) * (py - ay) - (by - ay) * (px - ax))


def ring_problem(ring: Column) -> Column:
    """Name of the first validity rule a ring breaks, null when it is sound."""
    from deslinde.functions.shapes import self_crosses

    return (
        F.when(ring.isNull() | (F.size(ring) == 0), "empty")
        .when(~is_closed(ring), "open")
        .when(F.size(ring) < 4, "too_few_points")
        .when(ring_area(ring) == 0, "zero_area")
        .when(self_crosses(ring), "self_crossing")
    )


def drop_repeats(ring: Column) -> Column:
    """Remove vertices equal to the one before."""
    return F.filter(ring, lambda p, i: (i == 0) | (p != F.try_element_at(ring, F.greatest(i, F.lit(1)))))


def close_ring(ring: Column) -> Column:
    return F.when((F.size(ring) > 0) & ~is_closed(ring), F.concat(ring, F.slice(ring, 1, 1))).otherwise(ring)


def repair_ring(ring: Column) -> Column:
    """The two safe repairs: drop repeated vertices, close the ring."""
    return close_ring(drop_repeats(ring))


def reproject(ring: Column, fx, fy) -> Column:
    """Apply one expression to every x and another to every y."""
    return F.transform(ring, lambda p: F.struct(fx(p["x"]).alias("x"), fy(p["y"]).alias("y")))


def position(shell: Column, holes: Column, x: Column, y: Column) -> Column:
    """Struct (inside, d): strict containment and boundary distance in one pass over the edges."""
    start = F.struct(F.lit(False).alias("odd"), F.lit(float("inf")).alias("d"))
    walked = F.aggregate(
        all_edges(shell, holes), start,
        lambda acc, e: F.struct(
            (acc["odd"] != _crosses(e, x, y)).alias("odd"),
            F.least(acc["d"], edge_distance(e, x, y)).alias("d"),
        ),
        lambda acc: F.struct((acc["odd"] & (acc["d"] > 0)).alias("inside"), acc["d"].alias("d")),
    )
    return walked
