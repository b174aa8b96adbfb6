"""Names, tile plans and grid covers."""

from __future__ import annotations

from pyspark.sql import functions as F

from conformance import fixtures as X
from conformance.queries.scalars import TX, TY
from conformance.queries.summaries import IQR, data_points
from conformance.registry import query
from deslinde import constants as C
from deslinde.functions import coords as M
from deslinde.functions import geometry as G
from deslinde.operators import metrics as A
from deslinde.operators import planning as L
from deslinde.plans.cascade import to_mercator

S = lambda e: f"CAST({e} AS STRING)"
# one commune name per customer, several customers to a name
X.add_table("fx_names", f"""
    SELECT 13000 + c_custkey AS cod_n, {S('13000 + c_custkey')} AS cod,
           CASE c_custkey % 5 WHEN 0 THEN 'Ñuñoa ' WHEN 1 THEN 'San José de ' WHEN 2 THEN 'Peñalolén' WHEN 3 THEN 'Río ' ELSE '' END
           || CASE WHEN c_custkey % 5 = 2 THEN '' ELSE upper(substr(c_name, 1, 4)) || {S('c_custkey % 300')} END AS name,
           CASE c_custkey % 5 WHEN 0 THEN 'NUNOA ' WHEN 1 THEN 'SAN JOSE DE ' WHEN 2 THEN 'PENALOLEN' WHEN 3 THEN 'RIO ' ELSE '' END
           || CASE WHEN c_custkey % 5 = 2 THEN '' ELSE upper(substr(c_name, 1, 4)) || {S('c_custkey % 300')} END AS plain
    FROM customer""", ["customer"])
X.add_table("fx_layer_asked", f"""
    SELECT cod_n AS comuna, CASE cod_n % 7 WHEN 0 THEN replace(plain, ' ', '_') WHEN 1 THEN 'PENALOLEN_ORIENTE' WHEN 2 THEN ''
        WHEN 3 THEN 'NO_SUCH' WHEN 4 THEN replace(name, ' ', '_') WHEN 5 THEN {S('cod_n')} ELSE 'CUST' || {S('cod_n % 300')} || '_X' END AS layer
    FROM fx_names""", ["fx_names"])


@query("resolve_name", """
    WITH a AS (SELECT comuna, layer, upper(strip_accents(replace(layer, '_', ' '))) AS s FROM fx_layer_asked),
    t AS (SELECT a.comuna, a.layer, 1 AS tier, n.cod FROM a JOIN fx_names n ON n.plain = a.s AND a.s <> ''
          UNION ALL SELECT a.comuna, a.layer, 2, n.cod FROM a JOIN fx_names n ON a.s LIKE '% %' AND n.plain = split_part(a.s, ' ', 1)
          UNION ALL SELECT a.comuna, a.layer, 3, n.cod FROM a JOIN fx_names n ON n.cod = CAST(a.comuna AS VARCHAR)),
    b AS (SELECT comuna, layer, tier, count(*) AS matches, min(cod) AS cod, min(tier) OVER (PARTITION BY comuna, layer) AS best FROM t GROUP BY comuna, layer, tier)
    SELECT a.comuna, a.layer, CASE WHEN matches = 1 THEN cod END AS cod,
           CASE WHEN matches IS NULL THEN 'not_found' WHEN matches > 1 THEN 'ambiguous' ELSE 'found' END AS status
    FROM a LEFT JOIN (SELECT * FROM b WHERE tier = best) USING (comuna, layer)""", ["fx_layer_asked", "fx_names"])
def resolve_name(spark, sf):
    return L.resolve_name(X.table(spark, sf, "fx_layer_asked"), X.table(spark, sf, "fx_names").select("cod", "name"))


X.add_table("fx_dim", f"""
    SELECT {S('13101 + n_nationkey')} AS cod, CASE n_nationkey % 4 WHEN 0 THEN 'San_Ñandú' WHEN 1 THEN 'Viña_del_Mar' WHEN 2 THEN 'Nación' ELSE n_name END
        || CASE WHEN n_nationkey % 4 = 3 THEN '' ELSE '_' || {S('n_nationkey // 4 * 3')} END AS name,
        CASE n_nationkey % 4 WHEN 0 THEN 'SAN_NANDU' WHEN 1 THEN 'VINA_DEL_MAR' WHEN 2 THEN 'NACION' ELSE upper(n_name) END
        || CASE WHEN n_nationkey % 4 = 3 THEN '' ELSE '_' || {S('n_nationkey // 4 * 3')} END AS plain
    FROM nation""", ["nation"])
X.add_table("fx_typed", f"""
    SELECT c_custkey AS id, CASE c_custkey % 8 WHEN 0 THEN {S('13095 + c_custkey % 40')} WHEN 1 THEN 'nation_' || {S('c_custkey % 30')} WHEN 2 THEN ' viña del mar ' || {S('c_custkey % 20')}
        WHEN 3 THEN 'ñandu' WHEN 4 THEN 'la nacion_' || {S('c_custkey % 20')} || ' grande' WHEN 5 THEN 'mar vina ' || {S('c_custkey % 20')}
        WHEN 6 THEN 'zz ' || {S('c_custkey % 9')} ELSE 'NACIÓN_' || {S('c_custkey % 20')} END AS q FROM customer""", ["customer"])


@query("fuzzy_lookup", """
    WITH t AS (SELECT DISTINCT q, trim(q) AS tq, replace(upper(strip_accents(trim(q))), ' ', '_') AS n FROM fx_typed),
    hits AS (
      SELECT q, 1 AS tier, cod FROM t JOIN fx_dim d ON t.tq = d.cod
      UNION ALL SELECT q, 2, min(cod) FROM t JOIN fx_dim d ON t.n = d.plain GROUP BY q
      UNION ALL SELECT q, 3, cod FROM t JOIN fx_dim d ON contains(d.plain, t.n) OR contains(t.n, d.plain)
      UNION ALL SELECT q, 4, cod FROM t JOIN fx_dim d ON list_bool_and(list_transform(string_split(replace(n, '_', ' '), ' '), lambda w: contains(d.plain, w)))),
    best AS (SELECT q, tier, list_sort(list(DISTINCT cod)) AS cods, min(tier) OVER (PARTITION BY q) AS b FROM hits GROUP BY q, tier)
    SELECT id, q, CASE WHEN len(cods) = 1 THEN cods[1] END AS cod, CASE WHEN cods IS NULL THEN 'not_found' WHEN len(cods) > 1 THEN 'ambiguous' ELSE 'found' END AS status,
           CASE WHEN len(cods) > 1 THEN array_to_string(cods, ' ') END AS options, CAST(coalesce(len(cods), 0) AS INTEGER) AS hits
    FROM fx_typed LEFT JOIN (SELECT * FROM best WHERE tier = b) USING (q)""", ["fx_typed", "fx_dim"])
def fuzzy_lookup(spark, sf):
    found = L.fuzzy_lookup(X.table(spark, sf, "fx_typed"), X.table(spark, sf, "fx_dim").select("cod", "name"))
    return found.withColumn("options", F.array_join("options", " "))


@query("list_communes", "SELECT cod, name FROM fx_dim WHERE contains(plain, 'VINA_DEL')", ["fx_dim"])
def list_communes(spark, sf):
    return L.list_communes(X.table(spark, sf, "fx_dim").select("cod", "name"), "viña_del")


@query("commune_dimension", """
    SELECT cod, name AS nombre, plain AS nombre_normalizado, CASE WHEN cod = '13101' THEN 'SANTIAGO_CENTRO' ELSE plain END AS nombre_wms,
           'data/x/' || cod || '_' || name || '.csv' AS path FROM fx_dim""", ["fx_dim"])
def commune_dimension(spark, sf):
    files = X.table(spark, sf, "fx_dim")
    path = F.concat(F.lit("data/x/"), F.col("cod"), F.lit("_"), F.col("name"), F.lit(".csv"))
    return L.commune_dimension(files.select(path.alias("path")).union(files.select(F.lit("data/x/readme.txt"))))


# --- tiles ---------------------------------------------------------------------------------
X.add_table("fx_own_boxes", f"""
    SELECT {S('13101 + n_nationkey')} AS cod, CASE WHEN n_nationkey % 3 = 0 THEN '' ELSE 'Ñame ' || {S('n_nationkey')} END AS nombre,
           CASE WHEN n_nationkey % 4 = 1 THEN NULL ELSE -70700000 - n_nationkey * 1000 END AS x0,
           CASE WHEN n_nationkey % 5 = 2 THEN -60700000 ELSE -70650000 + n_nationkey * 1000 END AS x1, -33500000 AS y0,
           CASE WHEN n_nationkey % 5 = 2 THEN -23500000 ELSE -33450000 END AS y1, CASE WHEN n_nationkey % 2 = 0 THEN 'A' WHEN n_nationkey % 7 = 5 THEN 'C' ELSE 'B' END AS tier
    FROM nation""", ["nation"])
BOX = ["min_lon", "min_lat", "max_lon", "max_lat"]
_tx = lambda lo, hi: f"abs({TX.format(lon=hi)} - {TX.format(lon=lo)}) + 1"
_ty = lambda lo, hi: f"abs({TY.format(lat=lo)} - {TY.format(lat=hi)}) + 1"
PLAN = f"""{IQR},
  o AS (SELECT cod, nombre, tier, x0 / 1e6 AS x0, x1 / 1e6 AS x1, y0 / 1e6 AS y0, y1 / 1e6 AS y1, x0 IS NOT NULL AS has FROM fx_own_boxes),
  j AS (SELECT o.*, i.comuna IS NOT NULL AS dhas, lon_min - 0.002 AS dx0, lon_max + 0.002 AS dx1, lat_min - 0.002 AS dy0, lat_max + 0.002 AS dy1,
               CASE WHEN o.has AND ({_tx('x0', 'x1')}) * ({_ty('y0', 'y1')}) <= 50000 THEN 'own' WHEN i.comuna IS NOT NULL THEN 'data' WHEN o.has THEN 'own_large' END AS source
        FROM o LEFT JOIN iqr i ON CAST(i.comuna AS VARCHAR) = o.cod),
  k AS (SELECT cod, tier, source, CASE WHEN source = 'data' THEN dx0 ELSE x0 END AS a, CASE WHEN source = 'data' THEN dx1 ELSE x1 END AS b,
               CASE WHEN source = 'data' THEN dy0 ELSE y0 END AS c, CASE WHEN source = 'data' THEN dy1 ELSE y1 END AS d,
               CASE WHEN source = 'data' THEN coalesce(n.nombre, nullif(j.nombre, '')) ELSE coalesce(nullif(j.nombre, ''), n.nombre) END AS nm
        FROM j LEFT JOIN (SELECT CAST(comuna AS VARCHAR) AS cod, 'Dato ' || comuna AS nombre FROM iqr WHERE comuna % 2 = 0) n USING (cod) WHERE source IS NOT NULL),
  fx_plan AS (SELECT cod, CASE WHEN cod = '13101' THEN 'SANTIAGO_CENTRO' ELSE upper(strip_accents(replace(nm, ' ', '_'))) END AS nombre_wms,
                     printf('%.6f,%.6f,%.6f,%.6f', a, c, b, d) AS bbox, tier, {_tx('a', 'b')} AS tiles_x, {_ty('c', 'd')} AS tiles_y,
                     ({_tx('a', 'b')}) * ({_ty('c', 'd')}) AS tiles_total,
                     round((({_tx('a', 'b')}) * 256.0 * ({_ty('c', 'd')}) * 256 * 4) / 1073741824, 1)::DOUBLE AS ram_gb, source,
                     ({_tx('a', 'b')}) * ({_ty('c', 'd')}) > 50000 AS large FROM k WHERE nm IS NOT NULL)"""


def plan(spark, sf):
    own = X.table(spark, sf, "fx_own_boxes")
    boxes = own.where("x0 is not null").select(
        "cod", "nombre", *[(F.col(c) / 1e6).alias(n) for c, n in zip(("x0", "y0", "x1", "y1"), BOX)]
    )
    named = own.where("x0 is null").select("cod", "nombre", *[F.lit(None).cast("double").alias(n) for n in BOX])
    data = A.iqr_bbox(data_points(spark, sf)).withColumn("cod", F.col("comuna").cast("string"))
    names = data.where("comuna % 2 = 0").select("cod", F.concat(F.lit("Dato "), F.col("cod")).alias("nombre"))
    return L.tile_plan(own.select("cod", "tier"), boxes.unionByName(named), data, names)


@query("tile_plan", f"{PLAN} SELECT * FROM fx_plan", ["fx_own_boxes", "fx_data_points"])
def tile_plan(spark, sf):
    return plan(spark, sf)


@query("queue_order", f"""{PLAN} SELECT cod, tier, tiles_total, row_number() OVER (ORDER BY tier, tiles_total, cod) - 1 AS position
    FROM fx_plan WHERE tier IN ('A', 'B')""", ["fx_own_boxes", "fx_data_points"])
def queue_order(spark, sf):
    """The order is the result, so the position is read off the ordered communes (one row each)."""
    ordered = L.queue_order(plan(spark, sf)).select("cod", "tier", "tiles_total")
    listed = ordered.agg(F.array_sort(F.collect_list(F.struct("tier", "tiles_total", "cod"))).alias("q"))
    return listed.select(F.posexplode("q").alias("position", "r")).select(
        "r.cod", "r.tier", "r.tiles_total", F.col("position").cast("bigint").alias("position")
    )


@query("tier_totals", f"""{PLAN} SELECT tier, count(*) AS communes, CAST(sum(tiles_total) AS BIGINT) AS tiles, count(*) FILTER (WHERE large) AS large
    FROM fx_plan WHERE tier IN ('A', 'B') GROUP BY tier""", ["fx_own_boxes", "fx_data_points"])
def tier_totals(spark, sf):
    return L.tier_totals(plan(spark, sf))


X.add_table("fx_ranges", """
    SELECT poly_idx, CAST(159000 + poly_idx * 3 AS BIGINT) AS x0, CAST(159000 + poly_idx * 3 + w_u // 30 AS BIGINT) AS x1,
           CAST(315000 + poly_idx AS BIGINT) AS y0, CAST(315000 + poly_idx + w_u // 25 AS BIGINT) AS y1 FROM fx_polygons""", ["fx_polygons"])
CELLS = """cells AS (
    SELECT r.*, cx.c AS scx, cy.c AS scy FROM fx_ranges r, LATERAL (SELECT unnest(generate_series(x0 - x0 % 4, x1, 4)) AS c) cx, LATERAL (SELECT unnest(generate_series(y0 - y0 % 4, y1, 4)) AS c) cy)"""


@query("cell_counts", f"""WITH {CELLS} SELECT poly_idx, scx, scy, (least(scx + 3, x1) - greatest(scx, x0) + 1) * (least(scy + 3, y1) - greatest(scy, y0) + 1) AS n_tiles FROM cells""", ["fx_ranges"])
def cell_counts(spark, sf):
    return L.cells_of_range(X.table(spark, sf, "fx_ranges")).select("poly_idx", "scx", "scy", "n_tiles")


@query("split_cells", """SELECT poly_idx, tx - tx % 4 AS scx, ty - ty % 4 AS scy, tx, ty
    FROM fx_ranges r, LATERAL (SELECT unnest(generate_series(x0, x1)) AS tx) a, LATERAL (SELECT unnest(generate_series(y0, y1)) AS ty) b""", ["fx_ranges"])
def split_cells(spark, sf):
    cells = L.cells_of_range(X.table(spark, sf, "fx_ranges"))
    return L.split_cells(cells).select("poly_idx", "scx", "scy", "tx", "ty")


SIZE, HALF, R = 4 * 2 * C.MERCATOR_HALF / 2**C.ZOOM, C.MERCATOR_HALF, C.EARTH_RADIUS
_mx, _my = (lambda u: f"radians(({u}) / 1e6) * {R}"), (lambda u: f"ln(tan(pi() / 4 + radians(({u}) / 1e6) / 2)) * {R}")


@query("grid_cover", f"""
    WITH b AS (SELECT CAST(poly_idx AS VARCHAR) AS cod, {_mx('x0_u')} AS x0, {_mx('x0_u + w_u * 50')} AS x1, {_my('y0_u')} AS y0, {_my('y0_u + w_u * 50')} AS y1 FROM fx_polygons),
    c AS (SELECT b.*, a.c, d.r FROM b, LATERAL (SELECT unnest(generate_series(CAST(floor((x0 - 1500 + {HALF}) / {SIZE!r}) AS BIGINT), CAST(floor((x1 + 1500 + {HALF}) / {SIZE!r}) AS BIGINT))) AS c) a,
          LATERAL (SELECT unnest(generate_series(CAST(floor(({HALF} - y1 - 1500) / {SIZE!r}) AS BIGINT), CAST(floor(({HALF} - y0 + 1500) / {SIZE!r}) AS BIGINT))) AS r) d)
    SELECT cod, c * 4 AS scx, r * 4 AS scy FROM c
    WHERE sqrt(power(greatest(x0 - ((c + 1) * {SIZE!r} - {HALF}), (c * {SIZE!r} - {HALF}) - x1, 0), 2)
             + power(greatest(y0 - ({HALF} - r * {SIZE!r}), ({HALF} - (r + 1) * {SIZE!r}) - y1, 0), 2)) <= 1500""", ["fx_polygons"])
def grid_cover(spark, sf):
    """Squares fifty times as wide, so that cells lie inside them too."""
    x0, y0, w = F.col("x0_u"), F.col("y0_u"), F.col("w_u") * 50
    wide = X.table(spark, sf, "fx_polygons").select(
        "poly_idx", "comuna", X.box(x0, y0, x0 + w, y0 + w).alias("shell"), G.no_holes().alias("holes")
    )
    return L.grid_cover(to_mercator(wide).withColumn("cod", F.col("poly_idx").cast("string")))
