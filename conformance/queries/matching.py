"""Spatial joins, inheritance joins and the cascades."""

from __future__ import annotations

from pyspark.sql import functions as F

from conformance import fixtures as X
from conformance.registry import query
from deslinde import constants as C
from deslinde.functions import coords as M
from deslinde.functions import geometry as G
from deslinde.functions import keys as K
from deslinde.functions import text as T
from deslinde.operators import inherit as I
from deslinde.operators import overlap as V
from deslinde.operators import spatial as S
from deslinde.plans import cascade as P
from deslinde.session import cut, large

# --- oracle fragments over the fixture rectangles --------------------------------
IN_SHELL = "x > x0_u AND x < x0_u + w_u AND y > y0_u AND y < y0_u + w_u"
IN_HOLE = "(has_hole AND x BETWEEN x0_u + 50 AND x0_u + 90 AND y BETWEEN y0_u + 50 AND y0_u + 90)"
IN_SLIT = "(has_slit AND x BETWEEN x0_u + 120 AND x0_u + 124 AND y BETWEEN y0_u + 50 AND y0_u + 110)"
INSIDE = f"({IN_SHELL} AND NOT {IN_HOLE} AND NOT {IN_SLIT})"
DIST_U = f"""CASE WHEN {INSIDE} THEN 0
    WHEN {IN_HOLE} THEN least(x - x0_u - 50, x0_u + 90 - x, y - y0_u - 50, y0_u + 90 - y)
    WHEN {IN_SLIT} THEN least(x - x0_u - 120, x0_u + 124 - x, y - y0_u - 50, y0_u + 110 - y)
    ELSE sqrt(power(greatest(x0_u - x, x - x0_u - w_u, 0), 2) + power(greatest(y0_u - y, y - y0_u - w_u, 0), 2)) END"""
PAIRS = f"""fx_sites AS (SELECT DISTINCT comuna, x_u AS x, y_u AS y FROM fx_parcels WHERE x_u IS NOT NULL),
  fx_pairs AS (
    SELECT s.comuna, s.x, s.y, g.poly_idx, {INSIDE} AS inside, CAST(round(({DIST_U}) * 100) AS BIGINT) AS q
    FROM fx_sites s JOIN fx_polygons g USING (comuna)),
  fx_best AS (
    SELECT comuna, x, y, arg_min(poly_idx, (NOT inside, q, poly_idx)) AS poly_idx,
           bool_or(inside) AS inside, min(q) AS q
    FROM fx_pairs GROUP BY comuna, x, y)"""
METRES = "CAST((q * 1110000 + 50000000) // 100000000 AS DOUBLE) / 10"
NEAR = "q * 111000 <= 10 * 100000000"


@query("pip_join", f"""
    SELECT p.ok, min(g.poly_idx) AS poly_idx, CAST(0 AS DOUBLE) AS dist_m
    FROM (SELECT *, x_u AS x, y_u AS y FROM fx_parcels) p JOIN fx_polygons g USING (comuna)
    WHERE {INSIDE} GROUP BY p.ok""", ["fx_parcels", "fx_polygons"])
def pip_join(spark, sf):
    return S.pip_join(X.points(spark, sf), X.polygons(spark, sf)).select("ok", "poly_idx", "dist_m")


@query("nearest_within", f"""
    WITH {PAIRS}
    SELECT p.ok, b.poly_idx, {METRES} AS dist_m
    FROM fx_parcels p JOIN fx_best b ON p.comuna = b.comuna AND p.x_u = b.x AND p.y_u = b.y
    WHERE b.inside OR {NEAR}""", ["fx_parcels", "fx_polygons"])
def nearest_within(spark, sf):
    return S.nearest_within(X.points(spark, sf), X.polygons(spark, sf)).select("ok", "poly_idx", "dist_m")


@query("nearest_fallback_500m", f"""
    WITH {PAIRS}
    SELECT p.ok, b.poly_idx, {METRES} AS dist_m
    FROM fx_parcels p JOIN fx_best b ON p.comuna = b.comuna AND p.x_u = b.x AND p.y_u = b.y
    WHERE b.inside OR q * 111000 <= 500 * CAST(100000000 AS BIGINT)""", ["fx_parcels", "fx_polygons"])
def nearest_fallback_500m(spark, sf):
    return S.nearest_within(X.points(spark, sf), X.polygons(spark, sf), C.FALLBACK_NEAREST_M).select(
        "ok", "poly_idx", "dist_m"
    )


@query("nearest_unlimited", f"""
    WITH {PAIRS}
    SELECT p.ok, b.poly_idx, {METRES} AS dist_m
    FROM fx_parcels p JOIN fx_best b ON p.comuna = b.comuna AND p.x_u = b.x AND p.y_u = b.y""",
    ["fx_parcels", "fx_polygons"])
def nearest_unlimited(spark, sf):
    return S.nearest_unlimited(X.points(spark, sf), X.polygons(spark, sf)).select("ok", "poly_idx", "dist_m")


# squares on their corner, of four sizes from 20 metres to 2 kilometres, and places up to far outside of all
X.add_table("fx_diamonds", """SELECT p_partkey AS poly_idx, CAST(13101 + p_partkey % 3 AS INT) AS comuna, -70700000 + p_partkey * 7919 % 90000 AS cx, -33500000 + p_partkey * 6151 % 80000 AS cy,
    CASE p_partkey % 4 WHEN 0 THEN 200 WHEN 1 THEN 900 WHEN 2 THEN 4100 ELSE 20000 END + p_partkey % 97 AS r FROM part WHERE p_partkey % 4 < 3 OR p_partkey % 40 = 3""", ["part"])
X.add_table("fx_far_places", """SELECT s_suppkey AS id, CAST(13101 + s_suppkey % 3 AS INT) AS comuna, -70760000 + s_suppkey * 104729 % 210000 AS x, -33560000 + s_suppkey * 15485863 % 200000 AS y FROM supplier""", ["supplier"])


@query("nearest_diamonds", """
    WITH o AS (SELECT id, poly_idx, r, abs(x - cx) AS dx, abs(y - cy) AS dy FROM fx_far_places JOIN fx_diamonds USING (comuna)),
    t AS (SELECT *, least(1.0, greatest(0.0, (dx - dy + r) / (2.0 * r))) AS t FROM o),
    d AS (SELECT id, poly_idx, CASE WHEN dx + dy < r THEN 0 ELSE round(sqrt(power(dx - t * r, 2) + power(dy - (1 - t) * r, 2)) * 100) END AS q FROM t)
    SELECT id, arg_min(poly_idx, (q, poly_idx)) AS poly_idx FROM d GROUP BY id""", ["fx_diamonds", "fx_far_places"])
def nearest_diamonds(spark, sf):
    """Places far from anything, which only the tree settles, among shapes whose boxes hold much that they don't."""
    at = lambda dx, dy: F.struct(((F.col("cx") + F.col("r") * dx) / 1e6).alias("x"), ((F.col("cy") + F.col("r") * dy) / 1e6).alias("y"))
    shell = F.array(at(0, -1), at(1, 0), at(0, 1), at(-1, 0), at(0, -1))
    polygons = X.table(spark, sf, "fx_diamonds").select("comuna", "poly_idx", shell.alias("shell"), G.no_holes().alias("holes"))
    places = X.table(spark, sf, "fx_far_places").select("id", "comuna", (F.col("x") / 1e6).alias("x"), (F.col("y") / 1e6).alias("y"))
    return S.nearest_unlimited(places, polygons).select("id", "poly_idx")


PLACED = f"""WITH {PAIRS},
  fx_placed AS (
    SELECT p.*, CASE WHEN b.inside OR {NEAR} THEN b.poly_idx END AS poly_idx,
           CASE WHEN b.inside THEN 'point_in_polygon' WHEN {NEAR} THEN 'nearest_10m' END AS method,
           CASE WHEN b.inside OR {NEAR} THEN {METRES} END AS dist_m
    FROM fx_parcels p LEFT JOIN fx_best b ON p.comuna = b.comuna AND p.x_u = b.x AND p.y_u = b.y)"""


@query("inherit_coord", """
    WITH donors AS (
        SELECT comuna, x_u, y_u, arg_min(h, (manzana, predio)) AS poly_idx FROM fx_parcels
        WHERE ok % 3 <> 0 AND x_u IS NOT NULL GROUP BY ALL)
    SELECT p.ok, d.poly_idx FROM fx_parcels p JOIN donors d USING (comuna, x_u, y_u) WHERE p.ok % 3 = 0""",
    ["fx_parcels"])
def inherit_coord(spark, sf):
    pts = X.points(spark, sf).join(X.table(spark, sf, "fx_parcels").select("ok", "h"), "ok")
    donors = pts.where("ok % 3 <> 0").withColumn("poly_idx", F.col("h"))
    return I.inherit_coord(pts.where("ok % 3 = 0"), donors, P.ORDER).select("ok", "poly_idx")


def split_rows(spark, sf):
    """Parcels with the polygon of their containment match, and those without."""
    rows = X.parcels(spark, sf).withColumn("addr", T.address_base(F.col("address")))
    hit = S.pip_join(X.points(spark, sf), X.polygons(spark, sf)).select("ok", "poly_idx")
    joined = cut(rows.join(large(hit), "ok", "left"))
    return joined.where("poly_idx is null").drop("poly_idx"), joined.where("poly_idx is not null")


SPLIT = f"""fx_hits AS (
    SELECT p.ok, min(g.poly_idx) AS poly_idx
    FROM (SELECT *, x_u AS x, y_u AS y FROM fx_parcels) p JOIN fx_polygons g USING (comuna) WHERE {INSIDE} GROUP BY p.ok),
  fx_done AS (SELECT p.*, poly_idx FROM fx_parcels p JOIN fx_hits USING (ok)),
  fx_todo AS (SELECT p.* FROM fx_parcels p ANTI JOIN fx_hits USING (ok))"""


@query("inherit_address", f"""
    WITH {SPLIT}, d AS (
        SELECT comuna, manzana, addr_expected, arg_min(poly_idx, (manzana, predio)) AS poly_idx FROM fx_done
        WHERE addr_expected IS NOT NULL GROUP BY ALL)
    SELECT t.ok, d.poly_idx FROM fx_todo t JOIN d USING (comuna, manzana, addr_expected)""",
    ["fx_parcels", "fx_polygons"])
def inherit_address(spark, sf):
    todo, done = split_rows(spark, sf)
    return I.inherit_address(todo, done, P.ORDER).select("ok", "poly_idx")


@query("inherit_block_any", f"""
    WITH {SPLIT}, d AS (
        SELECT comuna, manzana, arg_min(poly_idx, (manzana, predio)) AS poly_idx FROM fx_done GROUP BY ALL)
    SELECT t.ok, d.poly_idx FROM fx_todo t JOIN d USING (comuna, manzana)""", ["fx_parcels", "fx_polygons"])
def inherit_block_any(spark, sf):
    todo, done = split_rows(spark, sf)
    return I.inherit_block_any(todo, done, P.ORDER).select("ok", "poly_idx")


ASOF = """SELECT t.ok, arg_min(d.poly_idx, (abs(d.num - t.num), d.num, d.poly_idx)) AS poly_idx,
       min(abs(d.num - t.num)) AS diff
    FROM {todo} t JOIN {donors} d USING (comuna, manzana) GROUP BY t.ok"""


@query("asof_neighbor", f"""
    WITH {SPLIT}, n AS ({ASOF.format(todo="fx_todo", donors="fx_done")})
    SELECT * FROM n WHERE diff <= 20""", ["fx_parcels", "fx_polygons"])
def asof_neighbor(spark, sf):
    todo, done = split_rows(spark, sf)
    return I.asof_neighbor(todo, done).select("ok", "poly_idx", "diff")


X.add_table("fx_anchors", """
    SELECT poly_idx, comuna, CASE WHEN poly_idx % 3 = 0 THEN lpad(CAST(poly_idx // 10 AS STRING), 5, '0') || '-'
           || lpad(CAST((poly_idx % 10) * 12 AS STRING), 5, '0') END AS rol
    FROM fx_polygons""", ["fx_polygons"])
X.add_table("fx_number_reads", """
    SELECT poly_idx, comuna, CASE WHEN poly_idx % 4 = 0 THEN CAST((poly_idx % 10) * 12 AS BIGINT) END AS number FROM fx_polygons""", ["fx_polygons"])
ANCHOR_DONORS = """SELECT comuna, substr(rol, 1, 5) AS manzana, CAST(substr(rol, 7) AS BIGINT) AS num, poly_idx
    FROM fx_anchors"""


@query("asof_anchor", f"""
    WITH {SPLIT}, a AS ({ANCHOR_DONORS})
    {ASOF.format(todo="fx_todo", donors="a")}""", ["fx_parcels", "fx_polygons", "fx_anchors"])
def asof_anchor(spark, sf):
    todo, _ = split_rows(spark, sf)
    return I.asof_anchor(todo, X.table(spark, sf, "fx_anchors")).select("ok", "poly_idx", "diff")


@query("inherit_coords_by_address", """
    WITH d AS (
        SELECT comuna, manzana, addr_expected, arg_min(x_u, (manzana, predio)) AS dx, arg_min(y_u, (manzana, predio)) AS dy,
               arg_min(CASE WHEN ok % 2 = 0 THEN num END, (manzana, predio)) FILTER (WHERE ok % 2 = 0) AS unused
        FROM fx_parcels WHERE x_u IS NOT NULL AND addr_expected IS NOT NULL GROUP BY ALL),
      f AS (
        SELECT comuna, manzana, addr_expected, ok AS dok, CASE WHEN ok % 2 = 0 THEN predio END AS dpub FROM (
            SELECT *, row_number() OVER (PARTITION BY comuna, manzana, addr_expected ORDER BY manzana, predio) AS rn
            FROM fx_parcels WHERE x_u IS NOT NULL AND addr_expected IS NOT NULL) WHERE rn = 1)
    SELECT p.ok, CAST(coalesce(p.y_u, d.dy) AS DOUBLE) / 1000000 AS lat, CAST(coalesce(p.x_u, d.dx) AS DOUBLE) / 1000000 AS lon,
           CASE WHEN p.x_u IS NOT NULL THEN CASE WHEN p.ok % 2 = 0 THEN predio END
                ELSE coalesce(CASE WHEN p.ok % 2 = 0 THEN predio END, f.dpub) END AS published,
           p.x_u IS NULL AND d.dx IS NOT NULL AS inherited
    FROM fx_parcels p LEFT JOIN d USING (comuna, manzana, addr_expected)
         LEFT JOIN f USING (comuna, manzana, addr_expected)""", ["fx_parcels"])
def inherit_coords_by_address(spark, sf):
    rows = X.parcels(spark, sf).withColumn("addr", T.address_base(F.col("address")))
    rows = rows.withColumn("lat", F.col("lat").cast("string")).withColumn("lon", F.col("lon").cast("string"))
    rows = rows.withColumn("published", F.when(F.col("ok") % 2 == 0, F.col("predio")))
    out = I.fill_from_address_donors(rows, ["published"], P.ORDER)
    return out.select(
        "ok", F.col("lat").cast("double").alias("lat"), F.col("lon").cast("double").alias("lon"), "published", "inherited"
    )


@query("address_backfill", """
    WITH r AS (SELECT ok, h AS poly_idx, address, manzana, predio FROM fx_parcels),
    d AS (SELECT poly_idx, arg_min(address, predio) AS given FROM r WHERE address IS NOT NULL GROUP BY 1)
    SELECT r.ok, r.poly_idx, coalesce(r.address, d.given) AS address FROM r LEFT JOIN d USING (poly_idx)""",
    ["fx_parcels"])
def address_backfill(spark, sf):
    rows = X.table(spark, sf, "fx_parcels").select("ok", F.col("h").alias("poly_idx"), "address", "manzana", "predio")
    return I.address_backfill(rows, P.ORDER).select("ok", "poly_idx", "address")


V3 = f"""{PLACED},
  donors AS (SELECT comuna, manzana, addr_expected, arg_min(poly_idx, (manzana, predio)) AS dp FROM fx_placed
             WHERE poly_idx IS NOT NULL AND addr_expected IS NOT NULL GROUP BY ALL),
  fx_v3 AS (
    SELECT p.ok, p.comuna, p.manzana, p.predio, p.num, p.addr_expected, p.x_u, p.y_u, coalesce(p.poly_idx, d.dp) AS poly_idx,
           coalesce(p.method, CASE WHEN d.dp IS NOT NULL THEN 'address_inheritance' END) AS match_method,
           p.dist_m AS match_dist_m
    FROM fx_placed p LEFT JOIN donors d USING (comuna, manzana, addr_expected))"""


@query("match_cascade_v3", f"""{V3}
    SELECT comuna, manzana, predio, coalesce(poly_idx, -1) AS poly_idx, match_method, match_dist_m FROM fx_v3""",
    ["fx_parcels", "fx_polygons"])
def match_cascade_v3(spark, sf):
    return P.match_cascade_v3(X.parcels(spark, sf), X.polygons(spark, sf)).select(
        *P.KEY, F.coalesce("poly_idx", F.lit(-1)).alias("poly_idx"), "match_method", "match_dist_m"
    )


AREA_M2 = """round((w_u * w_u - CASE WHEN has_hole THEN 1600 ELSE 0 END - CASE WHEN has_slit THEN 240 ELSE 0 END)
    * 0.012321, 4)"""


@query("append_orphans", f"""{V3}
    SELECT o.comuna, manzana, predio, CASE WHEN manzana IS NULL THEN -2 ELSE coalesce(poly_idx, -1) END AS poly_idx,
           match_method, CAST({AREA_M2} AS DOUBLE) AS pol_area_m2
    FROM (SELECT comuna, manzana, predio, poly_idx, match_method FROM fx_v3
          UNION ALL SELECT comuna, NULL, NULL, poly_idx, 'unmatched_polygon' FROM fx_polygons
                    WHERE poly_idx NOT IN (SELECT poly_idx FROM fx_v3 WHERE poly_idx IS NOT NULL)) o
         LEFT JOIN (SELECT poly_idx, w_u, has_hole, has_slit FROM fx_polygons) g USING (poly_idx)""",
    ["fx_parcels", "fx_polygons"])
def append_orphans(spark, sf):
    polygons = X.polygons(spark, sf)
    matched = P.attach_geometry(P.match_cascade_v3(X.parcels(spark, sf), polygons), polygons)
    return P.append_orphans(matched, polygons).select(
        "comuna", "manzana", "predio",
        F.when(F.col("manzana").isNull(), -2).otherwise(F.coalesce("poly_idx", F.lit(-1))).alias("poly_idx"),
        "match_method", F.round("pol_area_m2", 4).alias("pol_area_m2"),
    )


@query("attach_geometry", f"""
    SELECT p.ok, p.poly_idx, CAST({AREA_M2} AS DOUBLE) AS pol_area_m2, CAST(5 AS INT) AS shell_points,
           CASE WHEN has_hole THEN 1 ELSE 0 END + CASE WHEN has_slit THEN 1 ELSE 0 END AS hole_count
    FROM (SELECT ok, comuna, h AS poly_idx FROM fx_parcels) p JOIN fx_polygons g USING (comuna, poly_idx)""",
    ["fx_parcels", "fx_polygons"])
def attach_geometry(spark, sf):
    rows = X.table(spark, sf, "fx_parcels").select("ok", "comuna", F.col("h").alias("poly_idx"))
    return P.attach_geometry(rows, X.polygons(spark, sf)).select(
        "ok", "poly_idx", F.round("pol_area_m2", 4).alias("pol_area_m2"),
        F.size("shell").alias("shell_points"), F.size("holes").alias("hole_count"),
    )


# --- legacy cascade ---------------------------------------------------------------
R = C.EARTH_RADIUS
mx = lambda u: f"(radians(({u}) / 1000000.0) * {R})"
my = lambda u: f"(ln(tan(pi() / 4 + radians(({u}) / 1000000.0) / 2)) * {R})"
DIST_M = f"""CASE WHEN {INSIDE} THEN 0
    WHEN {IN_HOLE} THEN least({mx('x')} - {mx('x0_u + 50')}, {mx('x0_u + 90')} - {mx('x')}, {my('y')} - {my('y0_u + 50')}, {my('y0_u + 90')} - {my('y')})
    WHEN {IN_SLIT} THEN least({mx('x')} - {mx('x0_u + 120')}, {mx('x0_u + 124')} - {mx('x')}, {my('y')} - {my('y0_u + 50')}, {my('y0_u + 110')} - {my('y')})
    ELSE sqrt(power(greatest({mx('x0_u')} - {mx('x')}, {mx('x')} - {mx('x0_u + w_u')}, 0), 2)
            + power(greatest({my('y0_u')} - {my('y')}, {my('y')} - {my('y0_u + w_u')}, 0), 2)) END"""
V1 = f"""fx_sites AS (SELECT DISTINCT comuna, x_u AS x, y_u AS y FROM fx_parcels WHERE x_u IS NOT NULL),
  fx_close AS (
    SELECT s.comuna, s.x, s.y, g.poly_idx, {INSIDE} AS inside, CAST(round(({DIST_M}) * 1000) AS BIGINT) AS q
    FROM fx_sites s JOIN fx_polygons g ON s.comuna = g.comuna AND x BETWEEN x0_u - 200 AND x0_u + w_u + 200
         AND y BETWEEN y0_u - 200 AND y0_u + w_u + 200),
  fx_best AS (
    SELECT comuna, x, y, arg_min(poly_idx, (NOT inside, q, poly_idx)) AS p1, bool_or(inside) AS inside, min(q) AS q
    FROM fx_close WHERE inside OR q <= 10000 GROUP BY ALL),
  s1 AS (
    SELECT p.*, b.p1, CASE WHEN b.inside THEN '1_contains' WHEN b.p1 IS NOT NULL
           THEN '2_nearest_' || printf('%.1f', ((q * 10 + 500) // 1000) / 10.0) || 'm' END AS m1
    FROM fx_parcels p LEFT JOIN fx_best b ON p.comuna = b.comuna AND p.x_u = b.x AND p.y_u = b.y),
  d1 AS (SELECT * FROM s1 WHERE p1 IS NOT NULL),
  n4 AS (SELECT t.ok, arg_min(d.p1, (abs(d.num - t.num), d.num, d.p1)) AS p4, min(abs(d.num - t.num)) AS diff4
         FROM s1 t JOIN d1 d USING (comuna, manzana) WHERE t.p1 IS NULL GROUP BY t.ok),
  s4 AS (SELECT s1.*, CASE WHEN diff4 <= 20 THEN p4 END AS p4, CASE WHEN diff4 <= 20 THEN '4_manzana_d' || diff4 END AS m4
         FROM s1 LEFT JOIN n4 USING (ok)),
  lacking AS (SELECT DISTINCT comuna FROM s4 WHERE (comuna, manzana) NOT IN
              (SELECT (comuna, manzana) FROM s4 WHERE coalesce(p1, p4) IS NOT NULL)),
  anchors AS (SELECT * FROM ({ANCHOR_DONORS}) a WHERE comuna IN (SELECT comuna FROM lacking)
              AND poly_idx NOT IN (SELECT coalesce(p1, p4) FROM s4 WHERE coalesce(p1, p4) IS NOT NULL)),
  n5 AS (SELECT t.ok, arg_min(a.poly_idx, (abs(a.num - t.num), a.num, a.poly_idx)) AS p5, min(abs(a.num - t.num)) AS diff5
         FROM s4 t JOIN anchors a USING (comuna, manzana) WHERE coalesce(t.p1, t.p4) IS NULL GROUP BY t.ok),
  b6 AS (SELECT comuna, manzana, arg_min(p1, (num, predio)) AS p6 FROM d1 GROUP BY ALL),
  fx_v1 AS (
    SELECT s4.comuna, s4.manzana, s4.predio, coalesce(p1, p4, p5, p6) AS poly_idx,
           coalesce(m1, m4, CASE WHEN p5 IS NOT NULL THEN '5_fi_manzana_d' || diff5 END,
                    CASE WHEN p6 IS NOT NULL THEN '6_manzana_any' END) AS match_method
    FROM s4 LEFT JOIN n5 USING (ok) LEFT JOIN b6 USING (comuna, manzana))"""


@query("match_cascade_v1", f"""WITH {V1}
    SELECT comuna, manzana, predio, coalesce(poly_idx, -1) AS poly_idx, match_method FROM fx_v1""",
    ["fx_parcels", "fx_polygons", "fx_anchors"])
def match_cascade_v1(spark, sf):
    return P.match_cascade_v1(X.parcels(spark, sf), X.polygons(spark, sf), X.table(spark, sf, "fx_anchors")).select(
        *P.KEY, F.coalesce("poly_idx", F.lit(-1)).alias("poly_idx"), "match_method"
    )


# --- recovery -----------------------------------------------------------------------
X.add_table("fx_utm_parcels", """
    SELECT ok, comuna, manzana, predio,
           CASE ok % 4 WHEN 0 THEN CAST(340000 + (h % 100) * 40 AS STRING) WHEN 2 THEN 'None' END AS ah_utm_x,
           CASE ok % 4 WHEN 0 THEN CAST(6290000 + (h // 100) * 40 + ok % 30 AS STRING) END AS ah_utm_y,
           CASE ok % 4 WHEN 1 THEN CAST(340010 + (h % 100) * 40 AS STRING) WHEN 0 THEN '1' ELSE '' END AS csa_utm_x,
           CASE ok % 4 WHEN 1 THEN CAST(6290005 + (h // 100) * 40 + ok % 17 AS STRING) END AS csa_utm_y
    FROM fx_parcels""", ["fx_parcels"])
_f = 1 / 298.257223563
_n = _f / (2 - _f)
_A = R / (1 + _n) * (1 + _n**2 / 4 + _n**4 / 64)
_B = [_n / 2 - 2 * _n**2 / 3 + 37 * _n**3 / 96, _n**2 / 48 + _n**3 / 15, 17 * _n**3 / 480]
_D = [2 * _n - 2 * _n**2 / 3 - 2 * _n**3, 7 * _n**2 / 3 - 8 * _n**3 / 5, 56 * _n**3 / 15]
UTM = f"""SELECT * EXCLUDE (xi0, eta0, xi, eta, chi), degrees(atan2(sinh(eta), cos(xi))) - 69 AS lon,
      degrees(chi + {' + '.join(f'{d!r} * sin({2 * j} * chi)' for j, d in enumerate(_D, 1))}) AS lat
    FROM (SELECT *, asin(sin(xi) / cosh(eta)) AS chi
    FROM (SELECT *, xi0 - ({' + '.join(f'{b!r} * sin({2 * j} * xi0) * cosh({2 * j} * eta0)' for j, b in enumerate(_B, 1))}) AS xi,
                 eta0 - ({' + '.join(f'{b!r} * cos({2 * j} * xi0) * sinh({2 * j} * eta0)' for j, b in enumerate(_B, 1))}) AS eta
    FROM (SELECT *, (north - 10000000.0) / {0.9996 * _A!r} AS xi0, (east - 500000.0) / {0.9996 * _A!r} AS eta0 FROM {{src}})))"""


@query("utm_to_lonlat", f"""
    SELECT poly_idx, round(lon, 7) AS lon, round(lat, 7) AS lat
    FROM ({UTM.format(src='(SELECT poly_idx, CAST(ux AS DOUBLE) AS east, CAST(uy AS DOUBLE) AS north FROM fx_utm)')})""",
    ["fx_utm"])
def utm_to_lonlat(spark, sf):
    ll = M.utm_to_lonlat(F.col("ux").cast("double"), F.col("uy").cast("double"))
    return X.table(spark, sf, "fx_utm").select("poly_idx", ll.alias("ll")).select(
        "poly_idx", F.round("ll.lon", 7).alias("lon"), F.round("ll.lat", 7).alias("lat")
    )


UTM_PLACED = f"""fx_ll AS ({UTM.format(src='''(
    SELECT ok, comuna, src, CAST(e AS DOUBLE) AS east, CAST(n AS DOUBLE) AS north FROM (
        SELECT *, CASE WHEN ah_utm_x NOT IN ('', 'None', 'nan') THEN 'ah'
                       WHEN csa_utm_x NOT IN ('', 'None', 'nan') THEN 'csa' END AS src,
               CASE src WHEN 'ah' THEN ah_utm_x WHEN 'csa' THEN csa_utm_x END AS e,
               CASE src WHEN 'ah' THEN ah_utm_y WHEN 'csa' THEN csa_utm_y END AS n
        FROM fx_utm_parcels) WHERE src IS NOT NULL)''')}),
  fx_utm_pairs AS (
    SELECT l.ok, l.src, g.poly_idx, {INSIDE} AS inside, CAST(round(({DIST_U}) * 100) AS BIGINT) AS q
    FROM (SELECT *, lon * 1000000 AS x, lat * 1000000 AS y FROM fx_ll) l JOIN fx_polygons g USING (comuna)),
  fx_by_utm AS (
    SELECT ok, arg_min(poly_idx, (NOT inside, q, poly_idx)) AS poly_idx,
           any_value(src) || CASE WHEN bool_or(inside) THEN '_utm_pip' ELSE '_utm_nearest' END AS match_method,
           {METRES.replace('q', 'min(q)')} AS match_dist_m
    FROM fx_utm_pairs GROUP BY ok)"""


@query("utm_fallback", f"WITH {UTM_PLACED} SELECT * FROM fx_by_utm", ["fx_utm_parcels", "fx_polygons"])
def utm_fallback(spark, sf):
    rows = X.table(spark, sf, "fx_utm_parcels").withColumn("x", F.lit(None)).withColumn("y", F.lit(None))
    return P.utm_fallback(rows, X.polygons(spark, sf)).select("ok", "poly_idx", "match_method", "match_dist_m")


def cascade_rows(spark, sf):
    """First-stage result (containment and nearest only) with the projected coordinates joined on."""
    cascade = P.Cascade(P.match_rows(X.parcels(spark, sf)))
    polygons = X.polygons(spark, sf)
    cascade.stage(lambda rows: P._place_stage(
        rows, polygons, S.DEGREES, C.NEAREST_M, "point_in_polygon", F.lit("nearest_10m"), "coord_inheritance"))
    utm = X.table(spark, sf, "fx_utm_parcels").drop("ok")
    return cascade.result().join(utm, P.KEY, "left"), polygons


CENTRE = """SELECT poly_idx, comuna,
    x0_u + (w_u * w_u * (w_u / 2.0) - CASE WHEN has_hole THEN 1600 * 70.0 ELSE 0 END - CASE WHEN has_slit THEN 240 * 122.0 ELSE 0 END)
         / (w_u * w_u - CASE WHEN has_hole THEN 1600 ELSE 0 END - CASE WHEN has_slit THEN 240 ELSE 0 END) AS cx,
    y0_u + (w_u * w_u * (w_u / 2.0) - CASE WHEN has_hole THEN 1600 * 70.0 ELSE 0 END - CASE WHEN has_slit THEN 240 * 80.0 ELSE 0 END)
         / (w_u * w_u - CASE WHEN has_hole THEN 1600 ELSE 0 END - CASE WHEN has_slit THEN 240 ELSE 0 END) AS cy
  FROM fx_polygons"""


def reads_sql(placed: str, todo: str) -> str:
    """CTEs naming parcels of ``todo`` from unused polygons' numbers; ends with fx_named."""
    return f"""fx_centre AS ({CENTRE}),
  fx_home AS (SELECT comuna, poly_idx, arg_min(manzana, (manzana, predio)) AS manzana FROM {placed} GROUP BY ALL),
  fx_ask AS (SELECT r.poly_idx, r.comuna, r.number, c.cx, c.cy FROM fx_number_reads r JOIN fx_centre c USING (poly_idx)
             JOIN fx_polygons g ON g.poly_idx = r.poly_idx
             WHERE r.number BETWEEN 1 AND 89999 AND {AREA_M2} >= 200
               AND r.poly_idx NOT IN (SELECT poly_idx FROM {placed})),
  fx_to AS (SELECT a.poly_idx, a.comuna, a.number,
                   arg_min(h.manzana, (CAST(round(sqrt(power(a.cx - c.cx, 2) + power(a.cy - c.cy, 2)) * 100) AS BIGINT), c.poly_idx)) AS manzana
            FROM fx_ask a JOIN fx_centre c USING (comuna) JOIN fx_home h ON h.poly_idx = c.poly_idx AND h.comuna = c.comuna
            GROUP BY ALL),
  fx_named AS (SELECT t.comuna, t.manzana, u.predio, min(t.poly_idx) AS poly_idx
               FROM fx_to t JOIN {todo} u ON u.comuna = t.comuna AND u.manzana = t.manzana AND u.num = t.number GROUP BY ALL)"""


@query("number_read_match", f"""WITH {SPLIT}, {reads_sql('fx_done', 'fx_todo')}
    SELECT * FROM fx_named""", ["fx_parcels", "fx_polygons", "fx_number_reads"])
def number_read_match(spark, sf):
    todo, done = split_rows(spark, sf)
    return P.number_read_match(X.table(spark, sf, "fx_number_reads"), X.polygons(spark, sf), done, todo)


@query("recovery_cascade", f"""{PLACED}, {UTM_PLACED},
  r1 AS (SELECT p.ok, p.comuna, p.manzana, p.predio, p.num, p.addr_expected, p.x_u, p.y_u,
                coalesce(p.poly_idx, b.poly_idx) AS poly_idx, coalesce(p.method, b.match_method) AS match_method
         FROM fx_placed p LEFT JOIN fx_by_utm b USING (ok)),
  r2 AS (SELECT r1.* EXCLUDE (poly_idx, match_method), coalesce(r1.poly_idx, b.poly_idx) AS poly_idx,
                coalesce(match_method, CASE WHEN b.poly_idx IS NOT NULL THEN 'nearest_unlimited' END) AS match_method
         FROM r1 LEFT JOIN fx_best b ON r1.comuna = b.comuna AND r1.x_u = b.x AND r1.y_u = b.y),
  r2_done AS (SELECT * FROM r2 WHERE poly_idx IS NOT NULL), r2_todo AS (SELECT * FROM r2 WHERE poly_idx IS NULL),
  {reads_sql('r2_done', 'r2_todo')},
  r3 AS (SELECT r2.* EXCLUDE (poly_idx, match_method), coalesce(r2.poly_idx, n.poly_idx) AS poly_idx,
                coalesce(match_method, CASE WHEN n.poly_idx IS NOT NULL THEN 'ocr_orphan' END) AS match_method
         FROM r2 LEFT JOIN fx_named n USING (comuna, manzana, predio)),
  d4 AS (SELECT comuna, manzana, addr_expected, arg_min(poly_idx, (manzana, predio)) AS dp FROM r3
         WHERE poly_idx IS NOT NULL AND addr_expected IS NOT NULL GROUP BY ALL)
    SELECT r3.comuna, r3.manzana, r3.predio, coalesce(r3.poly_idx, dp, -1) AS poly_idx,
           coalesce(match_method, CASE WHEN dp IS NOT NULL THEN 'address_inheritance' END, 'sin_resultado') AS match_method
    FROM r3 LEFT JOIN d4 USING (comuna, manzana, addr_expected)""",
    ["fx_parcels", "fx_polygons", "fx_utm_parcels", "fx_number_reads"])
def recovery_cascade(spark, sf):
    rows, polygons = cascade_rows(spark, sf)
    reads = X.table(spark, sf, "fx_number_reads")
    return P.recover(rows, polygons, reads).select(
        *P.KEY, F.coalesce("poly_idx", F.lit(-1)).alias("poly_idx"), "match_method"
    )
