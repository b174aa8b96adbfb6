"""Whole-operator checks: brute force on small inputs, hot keys, files, repeated runs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conformance import fixtures as X
from deslinde.functions import geometry as G
from deslinde.functions import shapes
from deslinde.operators import enrich, graph, inherit, metrics, ordered, raster, spatial
from deslinde.plans import cascade as P
from deslinde.session import scratch_path
from deslinde.sources import sinks, tables
from deslinde.streaming import ingest


def boxes(spark, rows):
    df = spark.createDataFrame(rows, "comuna int, poly_idx bigint, x0 double, y0 double, w double, h double")
    ring = G.box_ring(F.col("x0"), F.col("y0"), F.col("x0") + F.col("w"), F.col("y0") + F.col("h"))
    return df.select("comuna", "poly_idx", ring.alias("shell"), G.no_holes().alias("holes"))


def random_boxes(n, seed):
    r = random.Random(seed)
    # sizes over four orders of magnitude, so that several levels are in use
    return [(r.choice([1, 2]), i, r.uniform(-71, -70.9), r.uniform(-33.6, -33.5), 10 ** r.uniform(-4.5, -1.5), 10 ** r.uniform(-4.5, -1.5)) for i in range(n)]


def random_points(n, seed):
    r = random.Random(seed)
    return [(r.choice([1, 2]), i, r.uniform(-71.05, -70.85), r.uniform(-33.65, -33.45)) for i in range(n)]


def brute(points, rows):
    out = {}
    for c, i, x, y in points:
        best = None
        for pc, j, x0, y0, w, h in rows:
            if pc != c:
                continue
            if x0 < x < x0 + w and y0 < y < y0 + h:
                key = (0, 0, j)
            else:
                dx, dy = max(x0 - x, x - x0 - w, 0), max(y0 - y, y - y0 - h, 0)
                key = (1, round(np.hypot(dx, dy) * 10**8), j)
            best = key if best is None else min(best, key)
        out[i] = best
    return out


@pytest.fixture(scope="module")
def scene(spark):
    rows, pts = random_boxes(300, 1), random_points(200, 2)
    return rows, pts, boxes(spark, rows), spark.createDataFrame(pts, "comuna int, id bigint, x double, y double")


def test_pip_equals_brute_force(scene):
    rows, pts, polygons, points = scene
    want = {i: b[2] for i, b in brute(pts, rows).items() if b[0] == 0}
    got = {r.id: r.poly_idx for r in spatial.pip_join(points, polygons).collect()}
    assert got == want and want


@pytest.mark.parametrize("metres", [10, 500, 5000])
def test_nearest_within_equals_brute_force(scene, metres):
    rows, pts, polygons, points = scene
    want = {i: b[2] for i, b in brute(pts, rows).items() if b[0] == 0 or b[1] * 111000 <= metres * 10**8}
    got = {r.id: r.poly_idx for r in spatial.nearest_within(points, polygons, metres).collect()}
    assert got == want


def test_nearest_unlimited_equals_brute_force(scene):
    rows, pts, polygons, points = scene
    got = {r.id: r.poly_idx for r in spatial.nearest_unlimited(points, polygons).collect()}
    assert got == {i: b[2] for i, b in brute(pts, rows).items()}


def test_one_place_holding_most_rows(spark, scene):
    """A default coordinate shared by most parcels is located once."""
    polygons = scene[2]
    hot = spark.range(20000).select(F.lit(1).alias("comuna"), "id", F.lit(-70.95).alias("x"), F.lit(-33.55).alias("y"))
    assert spatial.sites_of(hot).count() == 1
    found = spatial.nearest_unlimited(hot, polygons)
    assert found.count() == 20000 and found.select("poly_idx").distinct().count() == 1


def test_asof_against_brute_force_in_one_hot_block(spark):
    r = random.Random(3)
    donors = [(1, "00001", r.randrange(3000), i) for i in range(150)]
    targets = [(1, "00001", r.randrange(3000), i) for i in range(400)]
    d = spark.createDataFrame(donors, "comuna int, manzana string, num bigint, poly_idx bigint")
    t = spark.createDataFrame(targets, "comuna int, manzana string, num bigint, id bigint")
    for tolerance in (20, None):
        got = {x.id: (x.diff, x.poly_idx) for x in inherit.asof_neighbor(t, d, tolerance).collect()}
        want = {}
        for _, _, n, i in targets:
            diff, _, p = min((abs(dn - n), dn, p) for _, _, dn, p in donors)
            if tolerance is None or diff <= tolerance:
                want[i] = (diff, p)
        assert got == want


def test_neighbour_at_twenty_but_not_twentyone(spark):
    d = spark.createDataFrame([(1, "a", 100, 5)], "comuna int, manzana string, num bigint, poly_idx bigint")
    t = spark.createDataFrame([(1, "a", 120, 0), (1, "a", 121, 1), (1, "a", 80, 2), (1, "b", 100, 3)], "comuna int, manzana string, num bigint, id bigint")
    assert sorted(r.id for r in inherit.asof_neighbor(t, d).collect()) == [0, 2]


def test_components_on_random_graphs_chains_and_stars(spark):
    r = random.Random(4)
    edges = [(r.randrange(400), r.randrange(400)) for _ in range(300)]
    edges += [(1000 + i, 1001 + i) for i in range(300)] + [(5000, 5001 + i) for i in range(300)]
    r.shuffle(edges)
    parent = {}

    def find(a):
        parent.setdefault(a, a)
        while parent[a] != a:
            a = parent[a]
        return a

    for u, v in edges:
        a, b = find(u), find(v)
        parent[max(a, b)] = min(a, b)
    df = spark.createDataFrame(edges, "u bigint, v bigint")
    got = dict(graph.connected_components(df).collect())
    looped = {u for u, v in edges if u == v}
    assert {k: v for k, v in got.items()} == {k: find(k) for k in parent if k in got}
    assert set(parent) - set(got) <= looped


def test_ordered_scans_do_not_depend_on_partitions(spark):
    r = random.Random(5)
    rows, counter = [], 0
    for i in range(3000):  # one worker holds nearly everything
        counter += r.random() < 0.2
        rows.append((1 if i % 50 else 2, i * r.choice([20, 40, 90]) + i * 100, i, r.random() < 0.5, counter))
    df = spark.createDataFrame(rows, "worker bigint, s bigint, event_id bigint, ok boolean, counter bigint").withColumn("ts", F.timestamp_seconds("s"))
    want, run = set(), {}
    for w, s, i, ok, _ in sorted(rows, key=lambda x: (x[0], x[1], x[2])):
        if not ok:
            run.setdefault(w, []).append(s)
        else:
            if len(run.get(w, [])) >= 5:
                want.add((w, run[w][0], len(run[w])))
            run[w] = []
    want |= {(w, v[0], len(v)) for w, v in run.items() if len(v) >= 5}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("1", "7"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            got = {(x.worker, int(x.first_ts.timestamp()), x.failures) for x in ordered.failure_runs(df, 5).collect()}
            assert got == want
            stalls = ordered.stall_gaps(df, 600).count()
            assert stalls == ordered.stall_gaps(df.repartition(5), 600).count() > 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_percentiles_of_skewed_values(spark):
    r = random.Random(6)
    rows = [("a", 1.0)] * 500 + [("a", r.uniform(0, 3)) for _ in range(301)] + [("b", r.random()) for _ in range(10)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {(x.k, x.fraction): x.v for x in metrics.exact_percentiles(df, ["k"], [0.0, 0.25, 0.5, 0.75, 1.0], 0.01).collect()}
    for k in "ab":
        vals = [v for kk, v in rows if kk == k]
        for f in (0.0, 0.25, 0.5, 0.75, 1.0):
            assert abs(got[k, f] - np.quantile(vals, f)) < 1e-12


def test_cascade_places_every_parcel_once(spark, sf):
    parcels, polygons = X.parcels(spark, sf), X.polygons(spark, sf)
    out = P.match_cascade_v3(parcels, polygons)
    assert out.count() == parcels.count() == out.select(*P.KEY).distinct().count()
    full = P.append_orphans(out, polygons)
    used = out.where("poly_idx is not null").select("poly_idx").distinct().count()
    assert full.count() == parcels.count() + polygons.count() - used
    again = P.match_cascade_v3(parcels.repartition(3).orderBy(F.rand(1)), polygons.repartition(5))
    assert out.exceptAll(again).count() == 0


def test_v1_fallback_radius(spark, sf):
    """With every parcel in a block of its own, nothing but the radius can place the far ones."""
    polygons = X.polygons(spark, sf)
    parcels = X.parcels(spark, sf).withColumn("manzana", F.format_string("%05d", "ok"))
    out = P.match_cascade_v1(parcels, polygons, fallback_m=500)
    assert out.where("match_method = '6_fallback_nearest'").count() > 0
    assert out.count() == parcels.count()
    assert P.match_cascade_v1(parcels, polygons).where("match_method = '6_fallback_nearest'").count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_traced_outlines_keep_the_area(spark, seed):
    rng = np.random.default_rng(seed)
    size = 8
    red = np.where(rng.random((16, 24)) < 0.6, 180, 90).astype(np.uint8)
    tiles = []
    for ty in range(2):
        for tx in range(3):
            img = np.zeros((size, size, 4), dtype=np.uint8)
            img[..., 0], img[..., 3] = red[ty * 8 : ty * 8 + 8, tx * 8 : tx * 8 + 8], 255
            tiles.append((tx, ty, size, bytearray(img.tobytes())))
    df = spark.createDataFrame(tiles, "tx bigint, ty bigint, size int, rgba binary")
    runs = raster.pixel_runs(df).where("cls = 'urban_fill'").withColumn("cls", F.lit("urban"))
    labelled = raster.label_components(runs).cache()
    same = raster.label_components(runs, size)  # tile by tile, then over the seams
    assert sorted(map(tuple, same.select("id", "label").collect())) == sorted(map(tuple, labelled.select("id", "label").collect()))
    m = {r.label: r.pixels for r in raster.component_measures(labelled, 1.0).collect()}
    t = raster.trace_outlines(labelled, 1.0).select("label", G.area(F.col("shell"), F.col("holes")).alias("a"), shapes.self_crosses(F.col("shell")).alias("bad")).collect()
    assert {r.label: round(r.a) for r in t} == m and not any(r.bad for r in t)
    assert sum(m.values()) == int((red == 180).sum())


def test_gate_edge(spark):
    img = np.zeros((16, 16, 4), dtype=np.uint8)
    img.reshape(-1, 4)[:100] = (180, 0, 0, 255)
    df = spark.createDataFrame([(0, 0, 16, bytearray(img.tobytes()))], "tx bigint, ty bigint, size int, rgba binary")
    gates = raster.block_gates(raster.pixel_runs(df), 16).first()
    assert gates.visible == 100 and gates.urban_ok and not gates.agri_ok


def test_files_of_answers_and_tiles(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"data": {"x": 1}}')
    (tmp_path / "b.json").write_text('{"data": ')
    good, bad = tables.read_answers(spark, str(tmp_path))
    assert [p.path[-6:] for p in good.collect()] == ["a.json"] and [p.path[-6:] for p in bad.collect()] == ["b.json"]
    tiles = tmp_path / "tiles"
    tiles.mkdir()
    (tiles / "sc_4_8.png").write_bytes(b"x" * 100)
    (tiles / "sc_4_12.png").write_bytes(b"x" * 99)
    (tiles / "other.png").write_bytes(b"x" * 500)
    assert [(r.sc_x, r.sc_y) for r in tables.list_tiles(spark, str(tiles)).collect()] == [(4, 8)]


def test_incremental_append_keeps_the_header(spark, tmp_path):
    rows = spark.createDataFrame([(1, "v1", {"lat": "1", "new": "2"})], "comuna int, v string, attrs map<string,string>")
    header = sinks.header_for(["v", "comuna", "lat"])
    assert header == ["v", "comuna", "lat", "_extra_json"]
    for _ in range(2):
        sinks.write_quoted_csv(sinks.project_to_header(rows, header), str(tmp_path / "out"))
    back = spark.read.option("header", True).csv(str(tmp_path / "out"))
    assert back.count() == 2 and back.first()["_extra_json"] == '{"new":"2"}'


def test_ingest_twice_adds_nothing(spark):
    source, target, mark = (scratch_path(spark, n) for n in ("in", "out", "mark"))
    line = '{"comuna":1,"manzana":"1","predio":"1","attempt":%d,"status":200,"body":"{\\"data\\":{\\"existePredio\\":1}}"}'
    for attempt in (1, 2):
        spark.createDataFrame([(line % attempt,), ("broken",)], "value string").write.mode("append").text(source)
        ingest.ingest(spark, source, target, mark).awaitTermination()
    rows = spark.read.schema(ingest.KEPT).parquet(target).collect()
    assert [(r.comuna, r.attempt) for r in rows] == [(1, 1)]


def test_spatial_join_has_no_nested_loop(spark, sf):
    plan = spatial.pip_join(X.points(spark, sf), X.polygons(spark, sf))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_registry_scan_reads_only_what_it_needs(spark, sf):
    path = scratch_path(spark, "layers")
    sinks.write_geometry(X.polygons(spark, sf), path)
    plan = spark.read.parquet(path).where("comuna = 13102 and minx > -70.69").select("poly_idx")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(comuna" in plan and "GreaterThan(minx" in plan and "shell" not in plan


def test_a_region_over_every_tile_is_one(spark):
    size, wide = 4, 6
    snake = np.zeros((size * wide, size * wide), dtype=bool)
    snake[::2, :] = True
    snake[1::4, -1] = snake[3::4, 0] = True
    rows = []
    for tx in range(wide):
        image, y, a, b = raster.mask_runs(snake[None, :, tx * size : (tx + 1) * size])
        rows += [("urban", tx, int(k), int(i) + tx * size, int(j) + tx * size) for k, i, j in zip(y, a, b)]
    runs = spark.createDataFrame(rows, raster.RUN)
    labels = raster.label_components(runs, size)
    assert labels.count() == len(rows) and labels.select("label").distinct().count() == 1


def test_unreadable_lines_are_kept_apart(spark, tmp_path):
    lines = ['{"comuna":1,"manzana":"2","predio":"3","attempt":1,"status":200,"body":"{\\"data\\":{\\"existePredio\\":1}}"}', "no json", '{"comuna":1,"manzana":"2"}', '{"comuna":1,']
    source, target, rejects = (str(tmp_path / n) for n in ("in", "out", "rejects"))
    spark.createDataFrame([(line,) for line in lines], "value string").write.text(source)
    ingest.ingest(spark, source, target, str(tmp_path / "mark"), rejects=rejects).awaitTermination()
    assert spark.read.parquet(target).count() == 1
    got = {r["value"]: r["reason"] for r in spark.read.parquet(rejects).collect()}
    assert got == {"no json": "not json", '{"comuna":1,"manzana":"2"}': "no key", '{"comuna":1,': "not json"}


def test_registry_keys_that_are_no_numbers_are_counted(spark):
    rows = spark.createDataFrame([("1", "2", "3"), ("1", "2.0", "4.5"), ("x", "None", "\t7")], "comuna string, manzana string, predio string")
    assert {r["part"]: r["rows"] for r in enrich.bad_keys(rows).collect()} == {"comuna": 1, "manzana": 1, "predio": 1}


def test_registry_columns_that_clash_get_a_suffix(spark):
    parcels = spark.createDataFrame([(1, "00002", "00003", "mine")], "comuna int, manzana string, predio string, serie string")
    registry = spark.createDataFrame([("1", "2", "3.0", "its", "d")], "comuna string, manzana string, predio string, serie string, dc_direccion string")
    assert enrich.enrich_registry(parcels, registry, ["serie"]).columns == ["comuna", "manzana", "predio", "serie", "dc_direccion"]
    row = enrich.enrich_registry(parcels, registry, ["serie"], clash="_cat").first()
    assert (row["serie"], row["serie_cat"], row["dc_direccion"]) == ("mine", "its", "d")


def diamonds(spark, rows):
    """Polygons (comuna, poly_idx, cx, cy, r) as squares on their corner: a box holds much that the shape doesn't."""
    data = [
        (c, j, [(x, y - r), (x + r, y), (x, y + r), (x - r, y), (x, y - r)], [])
        for c, j, x, y, r in rows
    ]
    return spark.createDataFrame(data, f"comuna int, poly_idx bigint, {G.POLYGON_COLUMNS}")


def diamond_distance(x, y, cx, cy, r):
    """Plain distance to a square on its corner, negative inside."""
    dx, dy = abs(x - cx), abs(y - cy)
    t = min(1.0, max(0.0, (dx - dy + r) / (2 * r)))
    edge = float(np.hypot(dx - t * r, dy - (1 - t) * r))
    return -edge if dx + dy < r else edge


def diamond_scene(seed=8):
    """Four sizes, from a plot to a commune; none of the big ones holds the places beside its corners."""
    rng, rows = random.Random(seed), []
    for r, n in ((0.0002, 120), (0.002, 60), (0.02, 30), (0.15, 12)):
        for _ in range(n):
            rows.append((rng.choice([1, 2]), len(rows), -71 + rng.random() * 0.6, -33 + rng.random() * 0.6, r))
    places = [(rng.choice([1, 2]), k, -71.3 + rng.random() * 1.2, -33.3 + rng.random() * 1.2) for k in range(250)]
    return rows, places


def test_nearest_among_four_sizes_of_diamonds(spark):
    rows, places = diamond_scene()
    want = {}
    for c, k, x, y in places:
        found = [(max(0, round(diamond_distance(x, y, cx, cy, r) * 1e8)), j) for pc, j, cx, cy, r in rows if pc == c]
        want[k] = min(found)
    points = spark.createDataFrame(places, "comuna int, id bigint, x double, y double")
    got = spatial.nearest_unlimited(points, diamonds(spark, rows)).collect()
    assert len(got) == len(places)
    for r in got:
        # a millimetre apart is a tie for the plain formula
        assert abs(dict((j, q) for q, j in [
            (max(0, round(diamond_distance(r.x, r.y, cx, cy, d) * 1e8)), j) for pc, j, cx, cy, d in rows if pc == r.comuna
        ])[r.poly_idx] - want[r.id][0]) <= 2


def test_large_overlapping_polygons_carry_few_nodes(spark):
    """400 diamonds as wide as the commune, one over the other: a place outside all of them meets few of their pieces."""
    rng = random.Random(4)
    rows = [(1, j, -71 + rng.random() * 0.01, -33 + rng.random() * 0.01, 0.2 + rng.random() * 0.002) for j in range(400)]
    places = [(1, k, -71 + sx * (0.16 + 0.002 * k), -33 + sy * 0.16) for k, (sx, sy) in enumerate([(1, 1), (-1, 1), (1, -1), (-1, -1)] * 5)]
    points, polygons = spark.createDataFrame(places, "comuna int, id bigint, x double, y double"), diamonds(spark, rows)
    met = []
    for found in spatial.tree_steps(spatial.sites_of(points), polygons, spatial.DEGREES):
        met.append(found.where("q is null").groupBy("x", "y").count().agg(F.max("count")).first()[0] or 0)
    assert max(met) <= 40, met
    got = {r.id: r.poly_idx for r in spatial.nearest_unlimited(points, polygons).collect()}
    for c, k, x, y in places:
        near = {j: diamond_distance(x, y, cx, cy, d) for _, j, cx, cy, d in rows}
        assert near[got[k]] <= min(near.values()) + 2e-8
