"""Steps whose rows follow the input."""

import random

import pytest
from pyspark.sql import functions as F

from deslinde.functions import answers
from deslinde.operators import planning, raster


def test_a_name_many_share_is_not_paired(spark, monkeypatch):
    """300 ask for a name that 200 communes bear: a try per asking row, ambiguous all the same."""
    seen = []
    only = planning._only
    monkeypatch.setattr(planning, "_only", lambda tries, keys: seen.append(tries.count()) or only(tries, keys))
    dim = spark.range(200).selectExpr("cast(20000 + id as string) as cod", "'Peñalolén' as name")
    dim = dim.unionByName(spark.createDataFrame([("30001", "Ñuñoa")], "cod string, name string"))
    asked = spark.range(300).selectExpr("cast(1000 + id as int) as comuna", "if(id = 0, 'NUNOA', 'PENALOLEN') as layer")
    got = {r.comuna: (r.cod, r.status) for r in planning.resolve_name(asked, dim).collect()}
    assert got == {1000: ("30001", "found"), **{1000 + i: (None, "ambiguous") for i in range(1, 300)}}
    assert seen == [300]


def test_small_tiles_share_a_python_step(spark):
    """Regions of 24 tiles of 32 pixels in one call, the same as without tiles; touching rows of neighbours stay apart inside."""
    rng = random.Random(5)
    rows = []
    for y in range(128):
        for tile in range(6):
            at = tile * 32
            while at < tile * 32 + 32:
                end = min(at + rng.randrange(1, 9), tile * 32 + 31)
                rows.append(("exact", tile, y, at, end))
                at = end + rng.randrange(2, 6)
    runs = spark.createDataFrame(rows, "cls string, tile_x bigint, y bigint, x0 bigint, x1 bigint")
    plain = {(r.y, r.x0): r.label for r in raster.label_components(runs).collect()}
    tiled = {(r.y, r.x0): r.label for r in raster.label_components(runs, 32).collect()}
    assert tiled == plain
    ided = raster.with_run_id(runs).toPandas().drop(columns="label", errors="ignore")
    whole = raster._tile_roots(ided, 32).set_index("id").root.to_dict()
    for _, one in ided.groupby(["tile_x", ided.y // 32]):
        assert raster._tile_roots(one, 32).set_index("id").root.to_dict() == {i: whole[i] for i in one.id}


def test_a_key_answered_twice_is_one_row(spark):
    """A key with a bad and a good answer: the good one, once for every request."""
    asked = spark.createDataFrame([(1, "a", "x"), (1, "a", "x"), (1, "a", "y")], "comuna int, manzana string, predio string")
    got = spark.createDataFrame([(1, "a", "x", False, 500), (1, "a", "x", True, 200)], "comuna int, manzana string, predio string, _ok boolean, _status int")
    rows = sorted((r.predio, r._ok, r._status, r._error) for r in answers.failure_rows(asked, got).collect())
    assert rows == [("x", True, 200, None), ("x", True, 200, None), ("y", False, 0, "max_retries")]


def test_tiles_gather_lines_not_pixels(spark, tmp_path):
    """A tile looks up its 16 lines, not each of its 256 pixels; pixels and gaps lie where they were."""
    from conformance.queries import raster as pixels

    keys = [0, 1, 3, 15, 16, 47, 99, 100, 131, 1550, 1699, 2500]
    spark.createDataFrame([(k, 1.0) for k in keys], "o_orderkey bigint, o_totalprice double").write.parquet(f"{tmp_path}/orders.parquet")
    made = pixels.tiles(spark, str(tmp_path))
    want = {(r.x, r.y): (r.r, r.a) for r in pixels.X.table(spark, str(tmp_path), "fx_pixels").collect()}
    got = {}
    for t in made.collect():
        assert len(t.rgba) == 1024
        for at in range(256):
            r, g, b, a = t.rgba[at * 4 : at * 4 + 4]
            assert g == b == 0
            if r or a:
                got[t.tx * 16 + at % 16, t.ty * 16 + at // 16] = (r, a)
    assert got == want and len(got) == len(keys)
    assert "bit_or" in made._jdf.queryExecution().optimizedPlan().toString()


def test_no_layer_passes_through_the_driver(spark, sf):
    """Joins on arcs and outlines are dealt out, however small the input looks."""
    from conformance.registry import QUERIES
    import __spark_entry__  # noqa: F401

    store = spark._jsparkSession.sharedState().statusStore()
    known = {store.executionsList().apply(i).executionId() for i in range(store.executionsList().size())}
    assert QUERIES["g_simplify_topology"](spark, sf).count() == 200
    runs = [store.executionsList().apply(i) for i in range(store.executionsList().size())]
    plans = [r.physicalPlanDescription() for r in runs if r.executionId() not in known]
    assert plans and not any("BroadcastHashJoin" in p for p in plans)


def test_layers_are_read_in_one_cast(spark):
    """Layers are not built anew item by item; odd parts and labels count as before."""
    text = """{"data":{"datosCapas":[4,{"titulo":"Á b","datos":[{"etiqueta":"x","valor":"1"},{"etiqueta":"x","valor":2},{"etiqueta":"x__2","valor":3},7]},
        {"titulo":"Observatorio","datos":[{"etiqueta":"Comuna","valor":"a"},{"etiqueta":"Otro\\u0001 ΑΣ","valor":true},{"etiqueta":"Comuna","valor":null}]},
        {"titulo":"Observatorio 2","datos":[{"etiqueta":"Comuna","valor":"z"}]},{"titulo":null,"datos":"none"}]}}"""
    rows = spark.createDataFrame([(text,)], "json string").selectExpr("try_parse_json(json) as a").select(answers.layer_items(F.col("a")).alias("i"))
    made = rows.select(answers.flatten_layers(F.col("i")).alias("f"), answers.observatory(F.col("i")).alias("o"))
    plan = made._jdf.queryExecution().analyzed().toString()
    assert "ArrayType(VariantType" not in plan
    got = made.first()
    assert got.f == {
        "cap__á_b__x": "1", "cap__á_b__x__2": "2", "cap__á_b__x__2__2": "3", "cap__observatorio__comuna": "a", "cap__observatorio__otro_ας": "true",
        "cap__observatorio__comuna__2": None, "cap__observatorio_2__comuna": "z",
    }
    assert got.o == {"obs_otro_ας": "true", "obs_comuna": None}


def _joins(spark, run):
    """Physical plans of what ``run`` executes, as Spark first meant them."""
    store = spark._jsparkSession.sharedState().statusStore()
    ids = lambda: {store.executionsList().apply(i).executionId(): store.executionsList().apply(i) for i in range(store.executionsList().size())}
    known = ids()
    run()
    return [r.physicalPlanDescription() for i, r in ids().items() if i not in known]


@pytest.mark.parametrize("name", ["overlap_dedup", "g_overlap_ratio", "append_orphans", "match_metrics", "match_cascade_v1"])
def test_a_layer_is_dealt_out_by_cell(spark, sf, name):
    """However small the input looks, polygons, places and donors are not broadcast."""
    from conformance.registry import QUERIES
    import __spark_entry__  # noqa: F401

    plans = _joins(spark, lambda: QUERIES[name](spark, sf).count())
    assert plans and not any("BroadcastHashJoin" in p for p in plans if "_cx" in p or "poly_idx" in p)


def test_marks_are_scanned_once(spark):
    """The windows over the numbers of a block run once, though their rows are used twice."""
    from deslinde.operators import inherit

    rows = spark.createDataFrame([(1, "a", 5), (1, "a", 300)], "comuna int, manzana string, num bigint")
    donors = spark.createDataFrame([(1, "a", 9, 7)], "comuna int, manzana string, num bigint, poly_idx bigint")
    made = inherit.asof_neighbor(rows, donors, None)
    assert made._jdf.queryExecution().optimizedPlan().toString().count("Window [") == 1
    assert sorted((r.num, r.poly_idx, r.diff) for r in made.collect()) == [(5, 7, 4), (300, 7, 291)]


def test_windows_are_made_only_where_they_stay(spark):
    """Rasters narrower than a sliver, or without a pixel, have no window; none is made and dropped."""
    sizes = spark.createDataFrame([(1, 0, 900), (2, 255, 900), (3, 256, 256), (4, 16511, 300), (5, 16512, 16512), (6, None, 900), (7, 900, 255)], "raster int, width bigint, height bigint")
    made = raster.raster_windows(sizes)
    assert sorted((r.raster, r.col, r.row, r.w, r.h) for r in made.collect()) == [
        (3, 0, 0, 256, 256), (4, 0, 0, 16384, 300),
        (5, 0, 0, 16384, 16384), (5, 0, 16256, 16384, 256), (5, 16256, 0, 256, 16384), (5, 16256, 16256, 256, 256),
    ]
    assert made.columns == ["raster", "width", "height", "col", "row", "w", "h"]
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert "Filter" not in plan[: plan.rindex("Generate ")]


def test_polygons_of_a_cod_cover_what_each_covers(spark):
    """Two equal polygons, and one half over them, leave no gap where they lie on one another; null holes are none; one shuffle."""
    from deslinde.functions import geometry as G

    x, y, size = -7.87e6, -3.9e6, planning.M.TILE_M * planning.C.CELL_TILES
    square = lambda a, b, w: [(x + a * size, y + b * size), (x + (a + w) * size, y + b * size), (x + (a + w) * size, y + (b + w) * size), (x + a * size, y + (b + w) * size), (x + a * size, y + b * size)]
    rows = [("one", square(0, 0, 30), []), ("two", square(0, 0, 30), []), ("two", square(0, 0, 30), None), ("two", square(15, 0, 15), []), ("hole", square(0, 0, 30), [square(5, 5, 20)]), (None, None, [])]
    made = planning.grid_cover(spark.createDataFrame(rows, f"cod string, {G.POLYGON_COLUMNS}"), 300.0)
    got = made.collect()
    cells = lambda cod: {(r.scx // 4, r.scy // 4) for r in got if r.cod == cod}
    assert len(got) == len({(r.cod, r.scx, r.scy) for r in got}) == sum(len(cells(c)) for c in ("one", "two", "hole"))
    assert cells("one") == cells("two") and len(cells("one")) >= 32 * 32 and cells("hole") < cells("one")
    assert 16 * 16 <= len(cells("one") - cells("hole")) <= 19 * 19
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [") == 1 and "Join" not in plan


def test_cells_by_their_plain_distance():
    """Runs of random edges, level and upright ones too, hold exactly the cells within reach, one by one."""
    import numpy as np

    from deslinde.functions import cover

    rng = np.random.default_rng(3)
    box = lambda c, r: (c * 1.0 - 50, 49.0 - r, c - 49.0, 50.0 - r)
    for reach in (0.3, 1.0, 2.6):
        for _ in range(60):
            a, b = rng.uniform(-3, 3, 2), rng.uniform(-3, 3, 2)
            b = [b, np.array([b[0], a[1]]), np.array([a[0], b[1]])][rng.integers(0, 3)]
            made = cover.covered(np.array([a, b]), np.zeros(2, int), np.zeros(1, int), np.zeros(1, int), 1.0, 50.0, reach)
            got = {(int(c), int(r)) for _, r, first, last in zip(*made) for c in range(first, last + 1)}
            t = np.linspace(0, 1, 4001)[:, None]
            line = a + t * (b - a)
            for c in range(42, 58):
                for r in range(42, 58):
                    x0, y0, x1, y1 = box(c, r)
                    off = np.hypot(np.maximum(np.maximum(x0 - line[:, 0], line[:, 0] - x1), 0), np.maximum(np.maximum(y0 - line[:, 1], line[:, 1] - y1), 0)).min()
                    if abs(off - reach) > 2e-3:
                        assert ((c, r) in got) == (off <= reach), (a, b, reach, c, r, off)


def test_polygons_are_repaired_together(monkeypatch):
    """400 polygons of a batch are noded in one step, and come out as each by itself."""
    import numpy as np

    from deslinde.functions import validity

    rng = np.random.default_rng(8)
    polygons = []
    for k in range(400):
        rings = [(rng.integers(0, 6, (m, 2)) if k % 2 else rng.random((m, 2)) * 6).astype(float) for m in rng.integers(3, 8, rng.integers(1, 4))]
        polygons.append([np.concatenate([r, r[:1]]) for r in rings])
    shapes_of = lambda parts: [[r.tolist() for r in p] for p in parts]
    alone = [shapes_of(validity.repaired(p)) for p in polygons]
    broken = [validity.needs_repair(p) for p in polygons]
    assert 0 < sum(broken) < 400
    seen, cuts = [], validity._cuts
    monkeypatch.setattr(validity, "_cuts", lambda *a: seen.append(len(a[0])) or cuts(*a))
    points = np.concatenate([r for p in polygons for r in p])
    ring = np.repeat(np.arange(sum(map(len, polygons))), [len(r) for p in polygons for r in p])
    owner = np.repeat(np.arange(400), [len(p) for p in polygons])
    assert validity._unsound(points, ring, owner, 400).tolist() == broken
    together = [[] for _ in polygons]
    for o, p, r in validity._parts(points, ring, owner):
        together[o][p:] = [[*together[o][p], r.tolist()] if p < len(together[o]) else [r.tolist()]]
    assert together == alone and len(seen) == 2


def test_repair_of_odd_rows(spark):
    """Null rings are left out, rings that are not finite too; without any ring left, or without area, no row."""
    from deslinde.functions import geometry as G
    from deslinde.functions.validity import make_valid

    square = lambda a, w: [(a, a), (a + w, a), (a + w, a + w), (a, a + w), (a, a)]
    rows = [
        (1, square(0.0, 4.0), [None, square(1.0, 1.0)]), (2, square(0.0, 4.0), [square(1.0, 1.0), square(3.0, 2.0)]), (3, square(float("nan"), 1.0), []),
        (4, [(0.0, 0.0), (1.0, 1.0), (0.0, 0.0)], None), (5, [(0.0, 0.0), (2.0, 2.0), (2.0, 0.0), (0.0, 2.0), (0.0, 0.0)], []), (6, square(0.0, 4.0), [[]]), (7, None, []),
    ]
    made = make_valid(spark.createDataFrame(rows, f"poly_idx int, {G.POLYGON_COLUMNS}"))
    got = made.select("poly_idx", "part", F.size("holes").alias("n"), "repaired", F.abs(G._signed_area(F.col("shell"))).alias("a")).collect()
    assert sorted((r.poly_idx, r.part, r.n, r.repaired, round(r.a, 9)) for r in got) == [
        (1, 0, 2, False, 16.0), (2, 0, 1, True, 15.0), (2, 1, 0, True, 3.0), (5, 0, 0, True, 1.0), (5, 1, 0, True, 1.0), (6, 0, 0, True, 16.0),
    ]


@pytest.mark.parametrize("name", ["vectorize_printed", "trace_outline"])
def test_no_region_passes_through_the_driver(spark, sf, name):
    """Runs, regions, chains and outlines are dealt out, however small they look compressed."""
    from conformance.registry import QUERIES
    import __spark_entry__  # noqa: F401

    plans = _joins(spark, lambda: QUERIES[name](spark, sf).count())
    assert plans and not any("BroadcastHashJoin" in p for p in plans)


@pytest.mark.parametrize("by_distance", [False, True])
def test_a_heap_of_polygons_is_met_in_parts(spark, monkeypatch, by_distance):
    """Squares on one another: a place stops at the first that holds it; the few that only the last part has are found as well."""
    from deslinde.functions import geometry as G
    from deslinde.operators import spatial

    rng = random.Random(9)
    squares = [(i, rng.randrange(0, 900), rng.randrange(0, 900), rng.choice([100, 700, 900])) for i in range(2_000)]
    squares += [(2_000 + i, 2_000 + 40 * i, 0, 40) for i in range(5)]
    places = [(rng.randrange(0, 1_900), rng.randrange(0, 1_900)) for _ in range(300)] + [(2_020, 20), (2_040, 20), (2_100, 80)]
    u = lambda c: F.col(c) / 1e6
    rows = spark.createDataFrame(squares, "poly_idx bigint, a bigint, b bigint, w bigint")
    shell = G.box_ring(u("a"), u("b"), (F.col("a") + F.col("w")) / 1e6, (F.col("b") + F.col("w")) / 1e6)
    polygons = rows.select(F.lit(1).alias("comuna"), "poly_idx", shell.alias("shell"), G.no_holes().alias("holes"))
    sites = spark.createDataFrame(places, "x bigint, y bigint").select(F.lit(1).alias("comuna"), u("x").alias("x"), u("y").alias("y")).distinct()
    seen, pairs = [], spatial.candidates
    monkeypatch.setattr(spatial, "candidates", lambda *a: seen.append(pairs(*a).count()) or pairs(*a))
    run = lambda: sorted(tuple(r) for r in spatial.locate_sites(sites, polygons, within_m=10.0, by_distance=by_distance).collect())
    got, met = run(), sum(seen)
    seen.clear()
    monkeypatch.setattr(spatial, "index_parts", lambda boxed, reach: [boxed])
    assert got == run() and len(got) > 200
    assert met < seen[0] / 10
