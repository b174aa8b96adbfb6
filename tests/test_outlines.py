"""Rings by list ranking, repair of polygons, shared borders, grid covers: against plain versions on small planes."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from deslinde.functions import geometry as G
from deslinde.functions import shapes, validity
from deslinde.operators import overlap, planning, raster, topology


def runs_of_mask(spark, mask, size):
    """Labelled runs of the 4-connected regions of a mask, cut at tile edges."""
    rows = []
    for y, line in enumerate(mask):
        x = 0
        while x < len(line):
            if line[x]:
                end = x
                while end + 1 < len(line) and line[end + 1] and (end + 1) % size:
                    end += 1
                rows.append(("urban", x // size, y, x, end))
                x = end
            x += 1
    runs = spark.createDataFrame(rows, raster.RUN)
    return raster.label_components(runs, size)


def inside(ring, x, y):
    odd = False
    for (ax, ay), (bx, by) in zip(ring, ring[1:]):
        if (ay > y) != (by > y) and x < ax + (y - ay) * (bx - ax) / (by - ay):
            odd = not odd
    return odd


def check_outlines(spark, mask, size):
    labelled = raster.cut(runs_of_mask(spark, mask, size))
    pixels = {}
    for r in labelled.collect():
        pixels.setdefault(r.label, set()).update((x, r.y) for x in range(r.x0, r.x1 + 1))
    rings = {}
    for r in raster.outline_rings(labelled).collect():
        rings.setdefault(r.label, []).append([(p.x, p.y) for p in r.corners])
    assert set(rings) == set(pixels)
    for label, own in rings.items():
        for ring in own:
            closed = ring + ring[:1]
            turns = [(ax == bx, ay == by) for (ax, ay), (bx, by) in zip(closed, closed[1:])]
            assert all(a != b for a, b in zip(turns, turns[1:])) and turns[0] != turns[-1]  # only corners
        covered = {(x, y) for y in range(len(mask)) for x in range(len(mask[0])) if sum(inside(r + r[:1], x + 0.5, y + 0.5) for r in own) % 2}
        assert covered == pixels[label]
    shaped = raster.trace_outlines(labelled, 1.0).select("label", "holes", G.area(F.col("shell"), F.col("holes")).alias("a")).collect()
    assert {r.label: round(r.a) for r in shaped} == {k: len(v) for k, v in pixels.items()}
    assert {r.label: len(r.holes) for r in shaped} == {k: len(v) - 1 for k, v in rings.items()}


@pytest.mark.parametrize("square", [4, 512])
@pytest.mark.parametrize("share", [0.5, 0.75])
def test_rings_surround_exactly_the_pixels(spark, monkeypatch, square, share):
    monkeypatch.setattr(raster, "CHAIN_PX", square)
    rng = np.random.default_rng(int(square + 10 * share))
    check_outlines(spark, rng.random((22, 30)) < share, 8)


def test_one_ring_winds_through_all_squares(spark, monkeypatch):
    """A meander of one region: its ring enters and leaves every square many times."""
    monkeypatch.setattr(raster, "CHAIN_PX", 4)
    mask = np.zeros((32, 32), bool)
    mask[::4] = True
    mask[1::4, -1] = mask[2::4, 0] = True
    for k in range(0, 28, 4):
        mask[k : k + 5, -1 if k // 4 % 2 == 0 else 0] = True
    check_outlines(spark, mask, 8)


def test_a_plane_too_tall_for_its_strip_is_refused(spark):
    tiles = spark.createDataFrame([(1, 0, 0, 4, bytearray(64)), (1, 0, raster.STRIP_PX // 4 + 1, 4, bytearray(64))], "comuna int, tx bigint, ty bigint, size int, rgba binary")
    with pytest.raises(ValueError, match="strip"):
        raster.vectorize_layers(tiles, 4)


def ring(*points):
    return np.array([*points, points[0]], float)


def square(x, y, w):
    return ring((x, y), (x + w, y), (x + w, y + w), (x, y + w))


@pytest.mark.parametrize("rings, areas", [
    ([ring((0, 0), (2, 2), (2, 0), (0, 2))], [[1], [1]]),
    ([square(0, 0, 4)], [[16]]),
    ([ring((0, 0), (4, 0), (4, 4), (4, 8), (4, 4), (0, 4))], [[16]]),
    ([square(0, 0, 4), square(0, 1, 2)], [[12]]),
    ([square(0, 0, 4), square(3, 1, 2)], [[14], [2]]),
    ([square(0, 0, 4), square(6, 1, 2)], [[16], [4]]),
    ([square(0, 0, 6), square(1, 1, 1), square(2, 2, 1)], [[36, -1, -1]]),
    ([square(0, 0, 6), square(1, 1, 1), square(2, 1, 1)], [[36, -2]]),
    ([square(0, 0, 4), ring((0, 0), (2, 1), (4, 4), (1, 2))], [[6], [6]]),
    ([square(0, 0, 6), square(1, 1, 4), square(2, 2, 1)], [[36, -16], [1]]),
    ([ring((0, 0), (1, 1), (2, 2))], []),
])
def test_repaired_areas_by_hand(rings, areas):
    assert [[round(validity._area(r), 9) for r in part] for part in validity.repaired(rings)] == areas


def test_repair_of_random_rings_keeps_what_an_odd_number_surrounds():
    rng = np.random.default_rng(5)
    xs = (np.arange(300) + 0.5) / 50
    x, y = np.meshgrid(xs, xs + 1e-5)
    for _ in range(80):
        r = rng.integers(0, 6, (7, 2)).astype(float)
        r = np.concatenate([r, r[:1]])
        odd = np.zeros(x.shape, bool)
        for a, b in zip(r[:-1], r[1:]):
            if a[1] != b[1]:
                odd ^= ((a[1] > y) != (b[1] > y)) & (x < a[0] + (y - a[1]) * (b[0] - a[0]) / (b[1] - a[1]))
        parts = validity.repaired([r])
        assert sum(validity._area(p) for part in parts for p in part) == pytest.approx(odd.sum() / 2500, abs=0.3)
        assert not any(shapes.ring_crosses(p) for part in parts for p in part)


def test_sound_rows_pass_repair_unchanged(spark):
    rows = [(1, [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0), (0.0, 0.0)], [[(1.0, 1.0), (2.0, 1.0), (2.0, 2.0), (1.0, 1.0)]]), (2, None, None), (3, [], []), (4, [(0.0, 0.0), (1.0, 0.0), (0.0, 0.0)], None)]
    df = spark.createDataFrame(rows, f"poly_idx int, {G.POLYGON_COLUMNS}")
    got = validity.make_valid(df).collect()
    assert [(r.poly_idx, r.part, r.repaired) for r in got] == [(1, 0, False)]
    assert [tuple(p) for p in got[0].shell] == rows[0][1] and len(got[0].holes) == 1


def test_neighbours_keep_their_common_border(spark):
    """A ring inside the hole of another, and two halves with a ragged border: no gap, no overlap, all sound."""
    rng = random.Random(2)
    border = [(2.0 + rng.uniform(-0.3, 0.3), k / 20) for k in range(21)]
    border[0], border[-1] = (2.0, 0.0), (2.0, 1.0)
    left = [(0.0, 0.0), *border, (0.0, 1.0), (0.0, 0.0)]
    right = [(4.0, 0.0), (4.0, 1.0), *reversed(border), (4.0, 0.0)]
    core = [(6.0 + np.cos(t) * 0.9 + rng.uniform(-0.05, 0.05), 0.5 + np.sin(t) * 0.9) for t in np.linspace(0, 2 * np.pi, 40)[:-1]]
    core = [(float(x), float(y)) for x, y in core]
    frame = [(4.5, -1.0), (7.5, -1.0), (7.5, 2.0), (4.5, 2.0), (4.5, -1.0)]
    rows = [(1, 1, left, []), (1, 2, right, []), (1, 3, frame, [list(reversed(core + core[:1]))]), (1, 4, core[5:] + core[:6], []), (1, 5, None, None)]
    df = spark.createDataFrame(rows, f"comuna int, poly_idx bigint, {G.POLYGON_COLUMNS}")
    got = {r.poly_idx: r for r in topology.simplify_topology(df, F.when(F.col("poly_idx") == 1, 0.5).otherwise(0.2)).collect()}
    points = lambda ps: [(p.x, p.y) for p in ps]
    shared = set(points(got[1].shell)) & set(points(got[2].shell))
    assert set(points(got[1].shell)) - shared <= {(0.0, 0.0), (0.0, 1.0)} and set(points(got[2].shell)) - shared <= {(4.0, 0.0), (4.0, 1.0)}
    assert len(got[1].shell) < len(left) and set(points(got[3].holes[0])) == set(points(got[4].shell)) and len(got[4].shell) < 30
    assert got[5].shell is None
    for r in (got[1], got[2], got[3], got[4]):
        assert not validity.needs_repair([np.array(points(x)) for x in [r.shell, *r.holes]])


def test_what_would_break_keeps_its_arcs(spark):
    """A thin bay that a coarse line would cross: the polygon stays sound, as does its neighbour."""
    bay = [(0.0, 0.0), (10.0, 0.0), (10.0, 1.0), (5.2, 1.0), (5.1, 0.1), (5.0, 1.0), (0.0, 1.0), (0.0, 0.0)]
    plug = [(5.0, 1.0), (5.1, 0.1), (5.2, 1.0), (5.0, 1.0)]
    df = spark.createDataFrame([(1, 1, bay, []), (1, 2, plug, [])], f"comuna int, poly_idx bigint, {G.POLYGON_COLUMNS}")
    got = {r.poly_idx: [(p.x, p.y) for p in r.shell] for r in topology.simplify_topology(df, F.lit(2.0)).collect()}
    for points in got.values():
        assert not validity.needs_repair([np.array(points)])
    assert set(got[2]) == set(plug) and set(plug) <= set(got[1])


def test_grid_cover_of_slanted_shapes(spark):
    """Every cell by its plain distance to the polygon."""
    rng = random.Random(6)
    size = planning.M.TILE_M * planning.C.CELL_TILES
    shapes_ = {str(k): [(-7.87e6 + rng.uniform(0, 4000), -3.9e6 + rng.uniform(0, 4000)) for _ in range(3)] for k in range(6)}
    df = spark.createDataFrame([(k, [*p, p[0]], []) for k, p in shapes_.items()], f"cod string, {G.POLYGON_COLUMNS}")
    got = {(r.cod, r.scx // 4, r.scy // 4) for r in planning.grid_cover(df, 700.0).collect()}

    def distance(p, a, b):
        d = np.subtract(b, a)
        t = min(1.0, max(0.0, float(np.dot(np.subtract(p, a), d) / np.dot(d, d))))
        return float(np.hypot(*(np.subtract(p, a) - t * d)))

    half = planning.C.MERCATOR_HALF
    for k, p in shapes_.items():
        xs, ys = [q[0] for q in p], [q[1] for q in p]
        for c in range(int((min(xs) + half) // size) - 4, int((max(xs) + half) // size) + 5):
            for r in range(int((half - max(ys)) // size) - 4, int((half - min(ys)) // size) + 5):
                x0, y1 = c * size - half, half - r * size
                box = [(x0, y1 - size), (x0 + size, y1 - size), (x0 + size, y1), (x0, y1)]
                near = min(
                    [distance(q, a, b) for q in box for a, b in zip(p, p[1:] + p[:1])] + [distance(q, a, b) for q in p for a, b in zip(box, box[1:] + box[:1])]
                )
                tri = p + p[:1]
                meets = any(inside(tri, *q) for q in box) or any(x0 <= x <= x0 + size and y1 - size <= y <= y1 for x, y in p)
                crossing = shapes._cross_heights(np.array([[*a, *b] for a, b in zip(p, tri[1:])]).T, np.array([[*a, *b] for a, b in zip(box, box[1:] + box[:1])]).T)
                want = meets or len(crossing) > 0 or near <= 700.0
                if abs(near - 700.0) > 1e-3:
                    assert ((k, c, r) in got) == want, (k, c, r, near)


def test_joint_index_counts_urban_first(spark):
    rows = [("agri", 1, 0), ("urban", 1, 7), ("urban", 1, 3), ("agri", 2, 5), ("agri", 1, 9)]
    df = spark.createDataFrame(rows, "layer string, comuna int, poly_idx bigint").withColumn("old", F.col("poly_idx"))
    got = sorted((r.comuna, r.poly_idx, r.layer, r.old) for r in overlap.joint_index(df).collect())
    assert got == [(1, 0, "urban", 3), (1, 1, "urban", 7), (1, 2, "agri", 0), (1, 3, "agri", 9), (2, 0, "agri", 5)]


@pytest.mark.parametrize("name", ["repair_windows", "burn_runs", "vectorize_legacy"])
def test_a_tall_raster_gets_a_tall_strip(spark, tmp_path, name):
    """Rasters of 5.8 million pixel rows, as 360 copies of the parts make them, blank in the middle."""
    import __spark_entry__ as entry
    from conformance.compare import compare, duck

    keys = [*range(80), *range(7_199_880, 7_200_000)]
    spark.createDataFrame([(k,) for k in keys], "p_partkey bigint").write.parquet(f"{tmp_path}/part.parquet")
    con = duck(str(tmp_path / 'none'))
    con.execute(f"CREATE OR REPLACE VIEW part AS SELECT * FROM '{tmp_path}/part.parquet/*.parquet'")
    text, _, ok = compare(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], str(tmp_path))
    assert ok and not text.endswith(" 0"), text
