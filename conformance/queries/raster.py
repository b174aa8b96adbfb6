"""Overlaps, simplification, pixels and regions."""

from __future__ import annotations

from pyspark.sql import functions as F

from conformance import fixtures as X
from conformance.registry import query
from deslinde.functions import geometry as G
from deslinde.operators import overlap as V
from deslinde.operators import raster as R
from deslinde.session import cut, large

# --- overlaps: every polygon also as a shifted agricultural one ---------------------------
X.add_table("fx_shifted", """
    SELECT poly_idx, comuna, x0_u + (poly_idx % 5) * w_u // 4 AS x0_u, y0_u + (poly_idx % 3) * w_u // 8 AS y0_u, w_u FROM fx_polygons""", ["fx_polygons"])
OVER = """SELECT a.comuna, a.poly_idx AS a_idx, b.poly_idx AS b_idx, a.w_u * a.w_u AS whole,
    (least(a.x0_u + a.w_u, b.x0_u + b.w_u) - greatest(a.x0_u, b.x0_u)) * (least(a.y0_u + a.w_u, b.y0_u + b.w_u) - greatest(a.y0_u, b.y0_u)) AS common
  FROM fx_shifted a JOIN fx_polygons b ON a.comuna = b.comuna AND a.x0_u < b.x0_u + b.w_u AND b.x0_u < a.x0_u + a.w_u AND a.y0_u < b.y0_u + b.w_u AND b.y0_u < a.y0_u + a.w_u"""


def layers(spark, sf):
    plain = X.polygons(spark, sf).withColumn("holes", G.no_holes())
    x0, y0, w = F.col("x0_u"), F.col("y0_u"), F.col("w_u")
    shifted = X.table(spark, sf, "fx_shifted").select(
        "poly_idx", "comuna", X.box(x0, y0, x0 + w, y0 + w).alias("shell"), G.no_holes().alias("holes")
    )
    return plain, shifted


@query("g_overlap_ratio", f"SELECT comuna, a_idx, b_idx, round(CAST(common AS DOUBLE) / whole, 6) AS share FROM ({OVER})", ["fx_polygons", "fx_shifted"])
def g_overlap_ratio(spark, sf):
    plain, shifted = layers(spark, sf)
    return V.overlap_shares(shifted, plain).withColumn("share", F.round("share", 6))


@query("overlap_dedup", f"""SELECT 'urban' AS layer, comuna, poly_idx FROM fx_polygons UNION ALL
    SELECT 'agri', comuna, poly_idx FROM fx_shifted WHERE poly_idx NOT IN (SELECT a_idx FROM ({OVER}) WHERE 2 * common > whole)""", ["fx_polygons", "fx_shifted"])
def overlap_dedup(spark, sf):
    plain, shifted = layers(spark, sf)
    return V.overlap_dedup(plain, shifted).select("layer", "comuna", "poly_idx")


@query("overlap_used", """SELECT DISTINCT comuna, poly_idx FROM fx_polygons WHERE poly_idx % 5 = 0 AND poly_idx % 3 = 0""", ["fx_polygons"])
def overlap_used(spark, sf):
    """Only shapes that were not shifted fill a polygon by more than nine tenths."""
    plain, shifted = layers(spark, sf)
    return V.overlap_used(shifted, plain)


@query("g_simplify", """SELECT poly_idx, 5 AS n_points, CAST(has_hole AS INT) + CAST(has_slit AS INT) AS n_holes,
    CAST(round(w_u * w_u * 0.012321, 2) AS DOUBLE) AS shell_m2, CAST(NULL AS VARCHAR) AS problem FROM fx_polygons""", ["fx_polygons"])
def g_simplify(spark, sf):
    """Squares with a slightly displaced extra vertex on every side come back as squares."""
    p = X.polygons(spark, sf).withColumn("match_method", F.when(F.col("poly_idx") % 3 == 0, "unmatched_polygon"))
    e = G.edges(F.col("shell"))
    bumped = F.concat(F.slice("shell", 1, 1), F.flatten(F.transform(e, lambda s: F.array(
        F.struct(((s["ax"] + s["bx"]) / 2 + 3e-6).alias("x"), ((s["ay"] + s["by"]) / 2 + 3e-6).alias("y")),
        F.struct(s["bx"].alias("x"), s["by"].alias("y"))))))
    thin = V.simplify_layer(p.withColumn("shell", bumped))
    return thin.select(
        "poly_idx", F.size("shell").alias("n_points"), F.size("holes").alias("n_holes"),
        F.round(G.ring_area(F.col("shell")) * 111000.0**2 + 1e-6, 2).alias("shell_m2"), "problem",
    )


# broken in six ways; areas by hand, in squares of a micro-degree
@query("g_make_valid", """
    SELECT poly_idx, part, n_holes, round(area, 3)::DOUBLE AS area, k > 0 AS repaired FROM (
        SELECT poly_idx, k, part, CASE WHEN k = 5 THEN 1 ELSE 0 END AS n_holes,
               w * w * CASE k WHEN 1 THEN 0.25 WHEN 3 THEN 0.9375 WHEN 4 THEN CASE part WHEN 0 THEN 0.875 ELSE 0.125 END WHEN 5 THEN 0.875 ELSE 1 END AS area
        FROM (SELECT poly_idx, poly_idx % 6 AS k, CAST(w_u AS DOUBLE) AS w FROM fx_polygons), (SELECT 0 AS part UNION ALL SELECT 1) p
        WHERE part = 0 OR k IN (1, 4))""", ["fx_polygons"])
def g_make_valid(spark, sf):
    """Sound, bow tie, spike, hole along the border, hole over the border, two holes side by side."""
    from deslinde.functions.validity import make_valid

    x0, y0, w, k = F.col("x0_u"), F.col("y0_u"), F.col("w_u"), F.col("poly_idx") % 6
    at = lambda *ps: F.array(*[F.struct((x0 + w * a).cast("double").alias("x"), (y0 + w * b).cast("double").alias("y")) for a, b in ps])
    square = lambda a, b, s: at((a, b), (a + s, b), (a + s, b + s), (a, b + s), (a, b))
    shell = F.when(k == 1, at((0, 0), (1, 1), (1, 0), (0, 1), (0, 0))).when(
        k == 2, at((0, 0), (1, 0), (1, 1), (1, 2), (1, 1), (0, 1), (0, 0))).otherwise(square(0, 0, 1))
    holes = F.when(k == 3, F.array(square(0, 0.25, 0.25))).when(k == 4, F.array(square(0.75, 0.25, 0.5))).when(
        k == 5, F.array(square(0.25, 0.25, 0.25), square(0.5, 0.25, 0.25))).otherwise(G.no_holes())
    made = make_valid(X.table(spark, sf, "fx_polygons").select("poly_idx", shell.alias("shell"), holes.alias("holes")))
    return made.select("poly_idx", "part", F.size("holes").alias("n_holes"), F.round(G.area(F.col("shell"), F.col("holes")), 3).alias("area"), "repaired")


# cells of one plane, 400 wide; the border between two has a vertex 3 or 30 micro-degrees off its middle
X.add_table("fx_plane", """SELECT p_partkey AS poly_idx, p_partkey % 100 AS i, p_partkey // 100 AS j, p_partkey % 7 = 0 OR p_partkey % 7 = 1 AS orphan,
    (SELECT max(p_partkey) // 100 FROM part) AS top FROM part WHERE p_partkey < (SELECT count(*) // 100 * 100 FROM part)""", ["part"])
X.add_table("fx_plane_sides", """SELECT poly_idx, i, j, orphan, side, CASE side WHEN 'l' THEN i - 1 ELSE i END AS ei, CASE side WHEN 'b' THEN j - 1 ELSE j END AS ej,
    CASE WHEN side IN ('l', 'r') THEN 0 ELSE 1 END AS across
    FROM fx_plane, (SELECT 'l' AS side UNION ALL SELECT 'r' UNION ALL SELECT 'b' UNION ALL SELECT 't') s""", ["fx_plane"])


@query("g_simplify_topology", """
    WITH s AS (SELECT *, CASE WHEN across = 0 THEN (ei + ej + 10) % 3 = 0 ELSE (ei + 2 * ej + 10) % 4 = 0 END AS big, bool_and(orphan) OVER (PARTITION BY across, ei, ej) AS coarse FROM fx_plane_sides)
    SELECT poly_idx, 5 + count(*) FILTER (WHERE big AND NOT coarse) AS n_points,
           round(160000 + sum(CASE WHEN big AND NOT coarse THEN CASE WHEN side IN ('r', 't') THEN 6000 ELSE -6000 END ELSE 0 END), 1)::DOUBLE AS area, false AS unsound
    FROM s GROUP BY poly_idx""", ["fx_plane_sides"])
def g_simplify_topology(spark, sf):
    """A plane of touching cells: both sides of a border keep or lose its vertex, by the finer tolerance of the two."""
    from deslinde.functions.validity import unsound
    from deslinde.operators.topology import simplify_topology

    def corner(a, b):
        return F.struct(((-70700000 + (F.col("i") + a) * 400) / 1e6).alias("x"), ((-33500000 + (F.col("j") + b) * 400) / 1e6).alias("y"))

    def middle(ei, ej, across):
        off = F.when((ei + ej + 10) % 3 == 0, 30).otherwise(3) if not across else F.when((ei + 2 * ej + 10) % 4 == 0, 30).otherwise(3)
        x, y = (ei + 1) * 400 + off if not across else ei * 400 + 200, ej * 400 + 200 if not across else (ej + 1) * 400 + off
        return F.struct(((-70700000 + x) / 1e6).alias("x"), ((-33500000 + y) / 1e6).alias("y"))

    i, j = F.col("i"), F.col("j")
    ring = F.array(corner(0, 0), middle(i, j - 1, True), corner(1, 0), middle(i, j, False), corner(1, 1), middle(i, j, True), corner(0, 1), middle(i - 1, j, False), corner(0, 0))
    rows = X.table(spark, sf, "fx_plane").select(
        F.lit(1).alias("comuna"), "poly_idx", ring.alias("shell"), G.no_holes().alias("holes"), F.when(F.col("orphan"), "unmatched_polygon").alias("match_method"),
    )
    thin = simplify_topology(rows)
    return thin.select(
        "poly_idx", F.size("shell").alias("n_points"), F.round(G.ring_area(F.col("shell")) * 1e12, 1).alias("area"),
        unsound(F.col("shell"), F.col("holes")).alias("unsound"),
    )


# --- pixels -----------------------------------------------------------------------------------
SIZE = 16
X.add_table("fx_pixels", """
    SELECT x, y, CASE WHEN urban THEN CASE WHEN border THEN 90 ELSE CASE WHEN ok % 4 = 0 THEN 182 ELSE 180 END END ELSE 10 END AS r,
           CASE WHEN urban THEN 255 WHEN border THEN 230 ELSE 179 END AS a, urban, border
    FROM (SELECT o_orderkey AS ok, o_orderkey % 100 AS x, o_orderkey // 100 AS y, (o_orderkey % 100) // 50 % 2 = 0 AS urban,
                 (o_orderkey % 100 % 12 = 0 OR o_orderkey // 100 % 10 = 0) AND o_orderkey % 31 <> 0 AS border FROM orders)""", ["orders"])


def tiles(spark, sf):
    """Tiles of 16 x 16 RGBA bytes cut from the pixel table; a line of four numbers, four pixels each, then at most 16 lines make one."""
    p = X.table(spark, sf, "fx_pixels")
    pixels = F.expr("shiftleft(cast(r * 256 + a as bigint), cast(48 - x % 4 * 16 as int))")
    four = lambda k: F.coalesce(F.bit_or(F.when(F.floor(F.col("x") % SIZE / 4) == k, pixels)), F.lit(0).cast("bigint"))
    lines = p.groupBy(
        F.floor(F.col("x") / SIZE).alias("tx"), F.floor(F.col("y") / SIZE).alias("ty"), (F.col("y") % SIZE).alias("line")
    ).agg(*[four(k).alias(f"f{k}") for k in range(SIZE // 4)])
    red_alpha = F.concat(*[F.lpad(F.hex(f"f{k}"), 16, "0") for k in range(SIZE // 4)])
    rgba = F.regexp_replace(red_alpha, "(..)(..)", "$10000$2")
    cells = lines.groupBy("tx", "ty").agg(F.map_from_entries(F.collect_list(F.struct("line", rgba.alias("v")))).alias("m"))
    every = F.transform(F.sequence(F.lit(0).cast("bigint"), F.lit(SIZE - 1).cast("bigint")),
                        lambda i: F.coalesce(F.try_element_at(F.col("m"), i), F.lit("00000000" * SIZE)))
    return cells.select("tx", "ty", F.lit(SIZE).alias("size"), F.unhex(F.array_join(every, "")).alias("rgba"))


CLASSES = {"urban_fill": "urban AND NOT border", "urban_border": "urban AND border", "agri_fill": "NOT urban AND NOT border",
           "agri_border": "(urban OR border)", "exact_fill": "r = 182", "visible": "a > 0"}
_class_rows = " UNION ALL ".join(f"SELECT '{c}' AS cls, x, y FROM fx_pixels WHERE {w}" for c, w in CLASSES.items())


def runs_of(rows: str) -> str:
    """Runs per class, tile column and row of pixel rows (cls, x, y)."""
    return f"""SELECT cls, x // 16 AS tile_x, y, min(x) AS x0, max(x) AS x1 FROM (
        SELECT *, x - row_number() OVER (PARTITION BY cls, x // 16, y ORDER BY x) AS g FROM ({rows})) GROUP BY cls, x // 16, y, g"""


@query("pixel_classes", runs_of(_class_rows), ["fx_pixels"])
def pixel_classes(spark, sf):
    return R.pixel_runs(tiles(spark, sf))


@query("block_gates", f"""
    WITH t AS (SELECT x // 16 AS tx, y // 16 AS ty, count(*) AS visible, count(*) FILTER (WHERE urban AND NOT border) AS urban_fill,
                      count(*) FILTER (WHERE NOT urban AND NOT border) AS agri_fill, count(*) FILTER (WHERE urban OR border) AS agri_border FROM fx_pixels GROUP BY ALL),
    b AS (SELECT bx, "by", CAST(sum(visible) AS BIGINT) AS visible, CAST(sum(urban_fill) AS BIGINT) AS urban_fill, CAST(sum(agri_fill) AS BIGINT) AS agri_fill, CAST(sum(agri_border) AS BIGINT) AS agri_border
          FROM t, (SELECT unnest(generate_series(0, 6, 2)) AS bx), (SELECT unnest(generate_series(0, (SELECT max(ty) FROM t), 2)) AS "by")
          WHERE tx >= bx AND tx < bx + 3 AND ty >= "by" AND ty < "by" + 3 GROUP BY ALL)
    SELECT *, visible >= 100 AND urban_fill > 50 AS urban_ok, visible >= 100 AND agri_fill > 100 AND agri_border > 5 AS agri_ok FROM b""", ["fx_pixels"])
def block_gates(spark, sf):
    """Blocks of three tiles, two apart, so that tiles fall into several."""
    return R.block_gates(R.pixel_runs(tiles(spark, sf)), SIZE, block=3, step=2)


X.add_table("fx_cells", "SELECT DISTINCT 4 * (o_orderkey % 97) + 159000 AS sc_x, 4 * (o_orderkey // 97) + 315000 AS sc_y FROM orders", ["orders"])


@query("block_assign", """
    SELECT sc_x, sc_y, bx, "by" FROM fx_cells, (SELECT unnest(generate_series((SELECT min(sc_x) FROM fx_cells), (SELECT max(sc_x) FROM fx_cells), 60)) AS bx),
        (SELECT unnest(generate_series((SELECT min(sc_y) FROM fx_cells), (SELECT max(sc_y) FROM fx_cells), 60)) AS "by")
    WHERE sc_x >= bx AND sc_x < bx + 64 AND sc_y >= "by" AND sc_y < "by" + 64""", ["fx_cells"])
def block_assign(spark, sf):
    return R.assign_blocks(X.table(spark, sf, "fx_cells"))


X.add_table("fx_rasters", "SELECT p_partkey AS raster, 300 + p_partkey * 37 AS width, 200 + p_partkey * 23 % 40000 AS height FROM part", ["part"])


@query("block_windows", """
    SELECT raster, col, row, least(16384, width - col) AS w, least(16384, height - row) AS h
    FROM fx_rasters, LATERAL (SELECT unnest(generate_series(0, width - 1, 16256)) AS col) a, LATERAL (SELECT unnest(generate_series(0, height - 1, 16256)) AS row) b
    WHERE least(16384, width - col) >= 256 AND least(16384, height - row) >= 256""", ["fx_rasters"])
def block_windows(spark, sf):
    return R.raster_windows(X.table(spark, sf, "fx_rasters")).select("raster", "col", "row", "w", "h")


INTERIOR = """SELECT 'urban' AS cls, x, y FROM fx_pixels p WHERE urban AND NOT border AND NOT EXISTS (
        SELECT 1 FROM fx_pixels q WHERE q.urban AND q.border AND abs(q.x - p.x) + abs(q.y - p.y) <= {u})
    UNION ALL SELECT 'agri', x, y FROM fx_pixels p WHERE NOT urban AND NOT border AND NOT EXISTS (
        SELECT 1 FROM fx_pixels q WHERE (q.urban OR q.border) AND abs(q.x - p.x) + abs(q.y - p.y) <= {a})"""
# the same by offsets, so that the oracle joins on equal pixels
_off = lambda k: f"(SELECT dx, dy FROM (SELECT unnest(generate_series(-{k}, {k})) AS dx), (SELECT unnest(generate_series(-{k}, {k})) AS dy) WHERE abs(dx) + abs(dy) <= {k})"
INNER = f"""SELECT 'urban' AS cls, x, y FROM fx_pixels p WHERE urban AND NOT border AND (x, y) NOT IN (
        SELECT (q.x + dx, q.y + dy) FROM fx_pixels q, {_off(1)} WHERE q.urban AND q.border)
    UNION ALL SELECT 'agri', x, y FROM fx_pixels p WHERE NOT urban AND NOT border AND (x, y) NOT IN (
        SELECT (q.x + dx, q.y + dy) FROM fx_pixels q, {_off(3)} WHERE q.urban OR q.border)"""


@query("dilate_subtract", runs_of(INNER), ["fx_pixels"])
def dilate_subtract(spark, sf):
    return R.interior_runs(R.pixel_runs(tiles(spark, sf)), SIZE)


FILLS = "SELECT CASE WHEN urban THEN 'urban' ELSE 'agri' END AS cls, x, y FROM fx_pixels WHERE NOT border"


def component_sql(rows: str) -> str:
    """CTEs ending in ``fx_labelled`` (cls, tile_x, y, x0, x1, id, label): smallest reachable run id."""
    return f"""WITH RECURSIVE fx_runs AS (SELECT *, ((y << 28) | x0) * 2 + CASE WHEN cls = 'urban' THEN 0 ELSE 1 END AS id FROM ({runs_of(rows)})),
  fx_edges AS (
    SELECT a.id AS u, b.id AS v FROM fx_runs a JOIN fx_runs b ON a.cls = b.cls AND a.tile_x = b.tile_x AND abs(a.y - b.y) = 1 AND a.x0 <= b.x1 AND b.x0 <= a.x1
    UNION SELECT a.id, b.id FROM fx_runs a JOIN fx_runs b ON a.cls = b.cls AND a.y = b.y AND (a.x1 + 1 = b.x0 OR b.x1 + 1 = a.x0)),
  fx_reach AS (SELECT id, id AS label FROM fx_runs UNION SELECT e.v, r.label FROM fx_reach r JOIN fx_edges e ON e.u = r.id WHERE e.v > r.label),
  fx_labels AS (SELECT id, min(label) AS label FROM fx_reach GROUP BY id),
  fx_labelled AS (SELECT * FROM fx_runs JOIN fx_labels USING (id))"""


def fills(spark, sf):
    runs = R.pixel_runs(tiles(spark, sf))
    kind = F.when(F.col("cls") == "urban_fill", "urban").when(F.col("cls") == "agri_fill", "agri")
    return runs.withColumn("cls", kind).where("cls is not null")


@query("components", component_sql(FILLS) + " SELECT cls, tile_x, y, x0, x1, label FROM fx_labelled", ["fx_pixels"])
def components(spark, sf):
    return R.label_components(fills(spark, sf), SIZE).select("cls", "tile_x", "y", "x0", "x1", "label")


# with pixels of two metres the bands cut on both sides
MEASURES = "SELECT label, cls, CAST(sum(x1 - x0 + 1) AS BIGINT) AS pixels, min(x0) AS px0, min(y) AS py0, max(x1) AS px1, max(y) AS py1, CAST(sum(x1 - x0 + 1) * 4 AS DOUBLE) AS area_m2 FROM fx_labelled GROUP BY ALL"


@query("component_measures", component_sql(FILLS) + f" SELECT * FROM ({MEASURES}) WHERE CASE WHEN cls = 'urban' THEN area_m2 BETWEEN 1 AND 50000 ELSE area_m2 >= 5000 END", ["fx_pixels"])
def component_measures(spark, sf):
    return R.in_area_band(R.component_measures(R.label_components(fills(spark, sf)), 2.0))


# pixels of twenty metres: a hole of one is 400 m2, filled in agricultural regions by kind and in all by the finished layer
BIG = "(SELECT label, cls, pixels, pixels * 400 AS a FROM (" + MEASURES + ")) WHERE CASE WHEN cls = 'urban' THEN a BETWEEN 1 AND 50000 ELSE a >= 5000 END AND a >= 500"


@query("seam_merge", component_sql(INNER) + f" SELECT label, cls, pixels FROM {BIG}", ["fx_pixels"])
def seam_merge(spark, sf):
    """Regions of the dilated interiors over all tiles, at the finished layer's size; pixels of twenty metres."""
    labelled = R.label_components(R.interior_runs(R.pixel_runs(tiles(spark, sf)), SIZE))
    return R.in_area_band(R.component_measures(labelled, 20.0), 500.0).select("label", "cls", "pixels")


@query("trace_outline", component_sql(FILLS) + " SELECT label, cls, pixels, area_m2 FROM (" + MEASURES + ")", ["fx_pixels"])
def trace_outline(spark, sf):
    """The traced polygon's area, holes taken out, has to be the pixel count times the pixel size."""
    labelled = cut(R.label_components(fills(spark, sf)))
    traced = R.trace_outlines(labelled, 2.0)
    m = R.component_measures(labelled, 2.0).select("label", "cls", "pixels")
    return traced.join(large(m), "label").select("label", "cls", "pixels", F.round(G.area(F.col("shell"), F.col("holes")), 3).alias("area_m2"))


@query("vectorize", component_sql(INNER) + f" SELECT label, cls, CAST(a AS DOUBLE) AS area_m2, 0 AS n_holes FROM {BIG}", ["fx_pixels"])
def vectorize(spark, sf):
    """Tiles to finished polygons, all steps; every block of this plane passes its gates."""
    return R.vectorize(tiles(spark, sf), SIZE, 20.0).select("label", "cls", F.round("area_m2", 3).alias("area_m2"), F.size("holes").alias("n_holes"))


@query("block_gates_published", """
    WITH t AS (SELECT x // 16 * 500 AS tx, y // 16 * 700 AS ty, count(*) AS visible, count(*) FILTER (WHERE urban AND NOT border) AS urban_fill,
                      count(*) FILTER (WHERE NOT urban AND NOT border) AS agri_fill, count(*) FILTER (WHERE urban OR border) AS agri_border FROM fx_pixels GROUP BY ALL),
    b AS (SELECT bx, "by", CAST(sum(visible) AS BIGINT) AS visible, CAST(sum(urban_fill) AS BIGINT) AS urban_fill, CAST(sum(agri_fill) AS BIGINT) AS agri_fill, CAST(sum(agri_border) AS BIGINT) AS agri_border
          FROM t, (SELECT unnest(generate_series(0, 3000, 960)) AS bx), (SELECT unnest(generate_series(0, (SELECT max(ty) FROM t), 960)) AS "by")
          WHERE tx >= bx AND tx < bx + 1024 AND ty >= "by" AND ty < "by" + 1024 GROUP BY ALL)
    SELECT *, visible >= 100 AND urban_fill > 50 AS urban_ok, visible >= 100 AND agri_fill > 100 AND agri_border > 5 AS agri_ok FROM b""", ["fx_pixels"])
def block_gates_published(spark, sf):
    """Published blocks of 16,384 pixels, 15,360 apart, over tiles that lie far from each other."""
    runs = R.pixel_runs(tiles(spark, sf).withColumn("tx", F.col("tx") * 500).withColumn("ty", F.col("ty") * 700))
    return R.block_gates(runs, SIZE)


# parcels of 20 x 20 to 25 x 25 inner pixels around a printed number that leaves a hole of 25 to 81 pixels; a pixel is a metre
X.add_table("fx_prints", """SELECT p_partkey AS k, p_partkey % 20 AS tx, p_partkey // 20 AS ty, 22 + p_partkey % 6 AS s, 5 + p_partkey // 6 % 5 AS h FROM part""", ["part"])


def printed(spark, sf):
    """A tile is written from its row alone: its lines are of three kinds, border, fill inside it, and fill with the number."""
    border, fill, number = (lambda n, c=c: F.repeat(F.lit(c), n) for c in ("5A0000FF", "B40000FF", "DC0000FF"))
    s, h = F.col("s").cast("int"), F.col("h").cast("int")
    edge = border(F.lit(32))
    plain = F.concat(border(F.lit(3)), fill(s), border(29 - s))
    holed = F.concat(border(F.lit(3)), fill(F.lit(9)), number(h), fill(s - 9 - h), border(29 - s))
    whole = F.concat(
        F.repeat(edge, F.lit(3)), F.repeat(plain, F.lit(9)), F.repeat(holed, h), F.repeat(plain, s - 9 - h), F.repeat(edge, 29 - s)
    )
    return X.table(spark, sf, "fx_prints").select("tx", "ty", F.lit(32).alias("size"), F.unhex(whole).alias("rgba"))


@query("vectorize_printed", """SELECT tx, ty, CAST((s - 2) * (s - 2) AS DOUBLE) AS area_m2, 0 AS n_holes FROM fx_prints
    WHERE (s - 2) * (s - 2) - CASE WHEN h * h >= 50 THEN h * h ELSE 0 END >= 500""", ["fx_prints"])
def vectorize_printed(spark, sf):
    """Published limits: a printed number below 50 m2 does not push its parcel under the floor, a larger one does."""
    made = R.vectorize(printed(spark, sf), 32, 1.0)
    place = lambda v: F.floor(v / 32).cast("bigint")
    return made.select(
        place(F.col("shell")[0]["x"] + R.C.MERCATOR_HALF).alias("tx"), place(R.C.MERCATOR_HALF - F.col("shell")[0]["y"]).alias("ty"),
        F.round("area_m2", 3).alias("area_m2"), F.size("holes").alias("n_holes"),
    )


@query("vectorize_layers", component_sql(INNER) + f""", fx_done AS (SELECT *, row_number() OVER (ORDER BY label) - 1 AS poly_idx FROM (SELECT label, cls, CAST(a AS DOUBLE) AS area_m2 FROM {BIG})),
    fx_side AS (SELECT label, min(x0) AS px0, min(y) AS py0 FROM fx_labelled GROUP BY label)
    SELECT c.comuna, poly_idx, cls, area_m2, round((px0 * 20 + c.dx * 320 - 20037508.342789244) / 20037508.342789244 * 180, 5)::DOUBLE AS west,
           round(degrees(atan(sinh((20037508.342789244 - py0 * 20 - c.dy * 320) / 20037508.342789244 * pi()))), 5)::DOUBLE AS north
    FROM fx_done JOIN fx_side USING (label), (VALUES (13101, 1000, 0), (13102, 0, 90000), (13103, 1003, 7)) AS c(comuna, dx, dy)""", ["fx_pixels"])
def vectorize_layers(spark, sf):
    """The plane three times, as communes far apart and overlapping: each gets the same polygons at its own place."""
    plane = cut(tiles(spark, sf))
    every = None
    for comuna, dx, dy in ((13101, 1000, 0), (13102, 0, 90000), (13103, 1003, 7)):
        own = plane.select(F.lit(comuna).alias("comuna"), (F.col("tx") + dx).alias("tx"), (F.col("ty") + dy).alias("ty"), "size", "rgba")
        every = own if every is None else every.unionByName(own)
    made = R.vectorize_layers(every, SIZE, 20.0)
    return made.select(
        "comuna", "poly_idx", "cls", F.round("area_m2", 3).alias("area_m2"),
        F.round(F.array_min(F.transform("shell", lambda p: p["x"])), 5).alias("west"), F.round(F.array_max(F.transform("shell", lambda p: p["y"])), 5).alias("north"),
    )


X.add_table("fx_windows", """SELECT p_partkey AS win, (p_partkey % 9) * 11 AS x0, p_partkey // 9 * 12 AS y0, (p_partkey % 9) * 11 + 11 AS x1, p_partkey // 9 * 12 + 12 AS y1,
    5 AS w, 4 AS h FROM part""", ["part"])
X.add_table("fx_coarse", """SELECT win, c % 5 AS cx, c // 5 AS cy, CASE WHEN (c * 7 + win) % 3 = 0 OR win % 4 = 1 THEN 182 ELSE 60 END AS r, CASE WHEN (c + win) % 11 = 0 THEN 0 ELSE 255 END AS a
    FROM (SELECT o_orderkey // 20 AS win, o_orderkey % 20 AS c FROM orders) k""", ["orders"])


@query("burn_border", """
    WITH b AS (SELECT * FROM fx_coarse WHERE r <> 182 AND a > 0), good AS (SELECT win FROM b GROUP BY win HAVING count(*) >= 10),
    hit AS (SELECT DISTINCT p.x, p.y FROM fx_pixels p JOIN fx_windows w ON p.x >= w.x0 AND p.x < w.x1 AND p.y >= w.y0 AND p.y < w.y1
            JOIN b ON b.win = w.win AND b.cx = CAST(floor((p.x - w.x0 + 0.5) * w.w / (w.x1 - w.x0)) AS BIGINT) AND b.cy = CAST(floor((p.y - w.y0 + 0.5) * w.h / (w.y1 - w.y0)) AS BIGINT)
            WHERE w.win IN (SELECT win FROM good))
    SELECT x, y, CAST(CASE WHEN (x, y) IN (SELECT (x, y) FROM hit) THEN 0 ELSE r END AS INT) AS r FROM fx_pixels""", ["fx_pixels", "fx_windows", "fx_coarse"])
def burn_border(spark, sf):
    fine = X.table(spark, sf, "fx_pixels").select("x", "y", "r")
    return R.burn_border(fine, X.table(spark, sf, "fx_windows"), X.table(spark, sf, "fx_coarse"))


# --- the legacy plan: tiles of 32 x 32 pixels of 8 metres in two rasters ------------------------
# a frame and a line of border, two holes in a third of the tiles; every thirtieth tile is blank inside, and too large
X.add_table("fx_legacy", """SELECT p_partkey AS k, CAST(p_partkey % 2 AS INT) AS raster, p_partkey // 2 % 20 AS tx, p_partkey // 40 AS ty,
    CASE WHEN p_partkey % 30 = 0 THEN 99 WHEN p_partkey % 3 = 0 THEN 16 WHEN p_partkey % 3 = 1 THEN 11 ELSE 20 END AS line FROM part""", ["part"])
X.add_table("fx_legacy_windows", """SELECT k, raster, tx, ty, res, greatest(0, tx * 32 - 1) AS x0, greatest(0, ty * 32 - 1) AS y0,
        least(width, tx * 32 + 32) AS x1, least(height, ty * 32 + 32) AS y1, CAST(CASE res WHEN 2.0 THEN 256 WHEN 1.0 THEN 260 ELSE 520 END AS INT) AS side
    FROM fx_legacy JOIN (SELECT raster, (max(tx) + 1) * 32 AS width, (max(ty) + 1) * 32 AS height FROM fx_legacy GROUP BY raster) s USING (raster),
        (SELECT CAST(2.0 AS DOUBLE) AS res UNION ALL SELECT 1.0 UNION ALL SELECT 0.5) r WHERE line = 99""", ["fx_legacy"])
# the columns of border in an image: a quarter from the left at two metres, the middle at one; every other blank tile has nine pixels of it only
X.add_table("fx_legacy_hit", """SELECT k, raster, tx, ty, i, i + tx * 32 AS x FROM fx_legacy_windows,
        (SELECT p_partkey AS i FROM part WHERE p_partkey < 32) c
    WHERE res > 0.5 AND k % 60 <> 0 AND floor((i + tx * 32 - x0 + 0.5) * side / (x1 - x0)) >= CASE WHEN res = 2.0 THEN side // 4 ELSE side // 2 END
        AND floor((i + tx * 32 - x0 + 0.5) * side / (x1 - x0)) < CASE WHEN res = 2.0 THEN side // 4 ELSE side // 2 END + 12""", ["fx_legacy_windows", "part"])
X.add_table("fx_legacy_columns", """SELECT k, raster, tx, ty, line, i FROM fx_legacy, (SELECT p_partkey AS i FROM part WHERE p_partkey BETWEEN 1 AND 30) c
    WHERE i <> line AND (k, i) NOT IN (SELECT k, i FROM fx_legacy_hit)""", ["fx_legacy", "fx_legacy_hit", "part"])


def legacy_tiles(spark, sf):
    """A tile is written from its row alone: its lines are of four kinds, edge, plain and two with a hole."""
    holes = (F.col("k") % 3 == 2) & (F.col("line") != 99)

    def line(y):
        hole = lambda x: (x == 5) if y == 5 else x.isin(9, 10) if y == 9 else F.lit(False)
        border = lambda x: F.lit(y == 0) | x.isin(0, 31) | (x == F.col("line")) | (holes & hole(x))
        return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(31)), lambda x: F.when(border(x), "5A0000FF").otherwise("B60000FF")), "")

    edge, plain = line(0), line(1)
    whole = F.concat(edge, F.repeat(plain, F.lit(4)), line(5), F.repeat(plain, F.lit(3)), line(9), F.repeat(plain, F.lit(21)), edge)
    return X.table(spark, sf, "fx_legacy").select("raster", "tx", "ty", F.lit(32).alias("size"), F.unhex(whole).alias("rgba"))


def legacy_images(windows):
    """Images as they would be answered, in slices of 100 rows."""
    tile = F.floor(F.col("x0") / 32 + 0.5) + 20 * F.floor(F.col("y0") / 32 + 0.5)
    quiet = (2 * tile + F.col("raster")) % 60 == 0
    start = F.when(F.col("res") == 2.0, F.floor(F.col("w") / 4)).otherwise(F.floor(F.col("w") / 2)).cast("int")
    fill, line = F.lit("B60000FF"), F.lit("5A0000FF")
    lined = F.concat(F.repeat(fill, start), F.repeat(line, F.lit(12)), F.repeat(fill, F.col("w") - start - 12))
    plain = F.repeat(fill, F.col("w"))
    # nine pixels of border in the first row, as a lost label may leave them
    spot = F.concat(F.repeat(line, F.lit(9)), F.repeat(fill, F.col("w") - 9))
    rows = F.least(F.lit(100), F.col("h") - F.col("row0"))
    text = F.when(~quiet & (F.col("res") > 0.5), F.repeat(lined, rows)).when(F.col("row0") == 0, F.concat(spot, F.repeat(plain, rows - 1))).otherwise(F.repeat(plain, rows))
    sliced = windows.withColumn("row0", F.explode(F.sequence(F.lit(0), F.col("h") - 1, F.lit(100))))
    return sliced.select("raster", "label", "res", "row0", F.unhex(text).alias("rgba"))


@query("repair_windows", "SELECT raster, res, x0, y0, x1, y1, side AS w, side AS h FROM fx_legacy_windows", ["fx_legacy_windows"])
def repair_windows(spark, sf):
    """Windows from regions over 50,000 m2, ten metres around them, at three resolutions."""
    moved, boxes = R._strips(legacy_tiles(spark, sf), "raster", 32, grow=True)
    _, regions = R.legacy_regions(R.pixel_runs(moved).where("cls = 'exact_fill'"), boxes, 32, 8.0)
    return R.repair_windows(regions, 8.0).drop("label")


@query("burn_runs", """SELECT raster, tx, ty, 30 * count(*) - CASE WHEN any_value(k) % 3 = 2 AND any_value(line) <> 99 THEN 3 ELSE 0 END AS pixels
    FROM fx_legacy_columns GROUP BY raster, tx, ty""", ["fx_legacy_columns"])
def burn_runs(spark, sf):
    """Exact pixels left of every tile once coarse borders are burnt in."""
    runs, boxes = R.legacy_runs(legacy_tiles(spark, sf), legacy_images, 32, 8.0)
    placed = R.in_strips(runs, boxes)
    ty = F.floor((F.col("y") - F.col("_top")) / 32)
    return placed.groupBy("raster", F.col("tile_x").alias("tx"), ty.alias("ty")).agg(F.sum(F.col("x1") - F.col("x0") + 1).alias("pixels"))


@query("vectorize_legacy", """
    WITH island AS (SELECT *, i - row_number() OVER (PARTITION BY k ORDER BY i) AS g FROM fx_legacy_columns),
    piece AS (SELECT k, raster, tx, ty, line, min(i) AS first, max(i) AS last, count(*) * 30 * 64 AS area FROM island GROUP BY k, raster, tx, ty, line, g),
    holed AS (SELECT *, k % 3 = 2 AND line <> 99 AND first <= 5 AS printed FROM piece)
    SELECT raster, tx, ty, first, CAST(area - CASE WHEN printed THEN 128 ELSE 0 END AS DOUBLE) AS area_m2,
           CAST(printed AS INT) AS holes_filled, CAST(printed AS INT) AS holes_kept
    FROM holed WHERE area - CASE WHEN printed THEN 128 ELSE 0 END BETWEEN 1 AND 50000""", ["fx_legacy_columns"])
def vectorize_legacy(spark, sf):
    """Published limits: a hole of one pixel (64 m2) is filled, one of two stays; blank tiles are cut by two lines or dropped."""
    made = R.vectorize_legacy(legacy_tiles(spark, sf), legacy_images, 32, 8.0)
    west = F.array_min(F.transform("shell", lambda p: p["x"])) + R.C.MERCATOR_HALF
    north = R.C.MERCATOR_HALF - F.array_max(F.transform("shell", lambda p: p["y"]))
    column = F.round(west / 8).cast("bigint")
    return made.select(
        "raster", F.floor(column / 32).alias("tx"), F.floor(F.round(north / 8) / 32).alias("ty"), (column % 32).alias("first"),
        "area_m2", "holes_filled", "holes_kept",
    )
