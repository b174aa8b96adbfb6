"""Keys, text, coordinates and geometry expressions."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from conformance import fixtures as X
from conformance.registry import query
from deslinde import constants as C
from deslinde.functions import coords as M
from deslinde.functions import geometry as G
from deslinde.functions import keys as K
from deslinde.functions import text as T

X.add_table("fx_key_text", """
    SELECT o_orderkey AS ok,
           CASE o_orderkey % 6 WHEN 0 THEN ' ' || CAST(o_orderkey AS STRING) || ' ' WHEN 1 THEN CAST(o_orderkey * 997 AS STRING)
                WHEN 2 THEN 'None' WHEN 3 THEN '' WHEN 4 THEN '00' || CAST(o_orderkey AS STRING)
                ELSE CASE o_orderkey % 4 WHEN 0 THEN CAST(o_orderkey AS STRING) || '.0' WHEN 1 THEN CAST(o_orderkey AS STRING) || '.5'
                     WHEN 2 THEN chr(9) || CAST(o_orderkey AS STRING) || chr(10) END END AS raw,
           CASE o_orderkey % 5 WHEN 0 THEN '13101|' || lpad(CAST(o_orderkey % 977 AS STRING), 5, '0') || '|00012'
                WHEN 1 THEN '13101|00001' WHEN 2 THEN 'x|00001|00002' WHEN 3 THEN CAST(o_orderkey AS STRING) || '| 7 |8 ' END AS v,
           CASE o_orderkey % 8 WHEN 0 THEN 'True' WHEN 1 THEN ' si ' WHEN 2 THEN '1' WHEN 3 THEN 'no' WHEN 4 THEN 'YES'
                WHEN 5 THEN '0' WHEN 6 THEN 'nan' END AS flag
    FROM orders""", ["orders"])


def keys(spark, sf):
    return X.table(spark, sf, "fx_key_text")


@query("key_zfill", """SELECT ok, CASE WHEN length(t) >= 5 THEN t ELSE lpad(t, 5, '0') END AS key
    FROM (SELECT ok, regexp_replace(raw, '^\\s+|\\s+$', '', 'g') AS t FROM fx_key_text)""", ["fx_key_text"])
def key_zfill(spark, sf):
    return keys(spark, sf).select("ok", K.zfill(F.col("raw")).alias("key"))


@query("key_int", """SELECT ok, n IS NULL AS bad, coalesce(n, -1) AS key
    FROM (SELECT ok, CASE WHEN regexp_full_match(t, '[0-9]+(\\.0)?') THEN CAST(split_part(t, '.', 1) AS BIGINT) END AS n
          FROM (SELECT ok, regexp_replace(raw, '^\\s+|\\s+$', '', 'g') AS t FROM fx_key_text))""", ["fx_key_text"])
def key_int(spark, sf):
    k = K.key_int(F.col("raw"))
    return keys(spark, sf).select("ok", k.isNull().alias("bad"), F.coalesce(k, F.lit(-1)).alias("key"))


@query("key_compose_parse", """
    SELECT ok, v AS given, c IS NOT NULL AS valid, CASE WHEN c IS NOT NULL THEN trim(s[2]) END AS manzana,
           CASE WHEN c IS NOT NULL THEN trim(s[3]) END AS predio,
           CASE WHEN c IS NOT NULL THEN CAST(c AS VARCHAR) || '|' || trim(s[2]) || '|' || trim(s[3]) END AS composed,
           CASE WHEN c IS NOT NULL THEN trim(s[2]) || '-' || trim(s[3]) END AS rol
    FROM (SELECT *, CASE WHEN len(s) = 3 THEN TRY_CAST(s[1] AS INTEGER) END AS c
          FROM (SELECT *, string_split(v, '|') AS s FROM fx_key_text))""", ["fx_key_text"])
def key_compose_parse(spark, sf):
    p = keys(spark, sf).select("ok", F.col("v").alias("given"), K.parse_v(F.col("v")).alias("p"))
    return p.select(
        "ok", "given", "p.valid", "p.manzana", "p.predio",
        K.compose_v(F.col("p.comuna"), F.col("p.manzana"), F.col("p.predio")).alias("composed"),
        K.rol(F.col("p.manzana"), F.col("p.predio")).alias("rol"),
    )


@query("truthy", """SELECT ok, coalesce(lower(trim(flag)) IN ('true', '1', 't', 'yes', 'y', 'si'), false) AS yes
    FROM fx_key_text""", ["fx_key_text"])
def truthy(spark, sf):
    return keys(spark, sf).select("ok", T.truthy(F.col("flag")).alias("yes"))


@query("null_sentinels", """SELECT ok, CASE WHEN raw NOT IN ('', 'None', 'nan') THEN raw END AS raw,
    CASE WHEN flag NOT IN ('', 'None', 'nan') THEN flag END AS flag FROM fx_key_text""", ["fx_key_text"])
def null_sentinels(spark, sf):
    return keys(spark, sf).select(
        "ok", T.null_if_blank_word(F.col("raw")).alias("raw"), T.null_if_blank_word(F.col("flag")).alias("flag")
    )


X.add_table("fx_coord_text", """
    SELECT o_orderkey AS ok,
           CASE o_orderkey % 9 WHEN 0 THEN NULL WHEN 1 THEN 'abc' ELSE CAST(-70 + o_orderkey % 70 AS STRING) || '.25' END AS lat,
           CASE o_orderkey % 7 WHEN 0 THEN 'nan?' ELSE CAST(-85 + o_orderkey % 30 AS STRING) || '.5' END AS lon
    FROM orders""", ["orders"])


@query("coord_valid", """
    WITH c AS (SELECT ok, TRY_CAST(lat AS DOUBLE) AS la, TRY_CAST(lon AS DOUBLE) AS lo FROM fx_coord_text)
    SELECT ok, coalesce(la BETWEEN -62 AND -17 AND lo BETWEEN -80 AND -64, false) AS valid,
           CASE WHEN la BETWEEN -62 AND -15 AND lo BETWEEN -80 AND -64 THEN la END AS lat_legacy,
           CASE WHEN la BETWEEN -62 AND -15 AND lo BETWEEN -80 AND -64 THEN lo END AS lon_legacy FROM c""", ["fx_coord_text"])
def coord_valid(spark, sf):
    lat, lon = F.col("lat").try_cast("double"), F.col("lon").try_cast("double")
    legacy = M.valid_coord(lat, lon, legacy=True)
    return X.table(spark, sf, "fx_coord_text").select(
        "ok", M.valid_coord(lat, lon).alias("valid"),
        F.when(legacy, lat).alias("lat_legacy"), F.when(legacy, lon).alias("lon_legacy"),
    )


SLUG = """substr(trim(regexp_replace(regexp_replace(lower({0}), '[^\\p{{L}}\\p{{N}}_\\s-]+', '', 'g'), '[\\s-]+', '_', 'g'), '_'), 1, 120)"""


@query("slug", f"SELECT doc_id, {SLUG.format('text')} AS slug, {SLUG.format(chr(39) + 'Valor m² (CLP) - ' + chr(39) + ' || lang')} AS label FROM documents")
def slug(spark, sf):
    label = F.concat(F.lit("Valor m² (CLP) - "), F.col("lang"))
    return X.source(spark, sf, "documents").select("doc_id", T.slug(F.col("text")).alias("slug"), T.slug(label).alias("label"))


@query("address_base", """
    SELECT ok, addr_expected AS addr FROM fx_parcels""", ["fx_parcels"])
def address_base(spark, sf):
    return X.table(spark, sf, "fx_parcels").select("ok", T.address_base(F.col("address")).alias("addr"))


@query("address_base_text", """
    SELECT doc_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(upper(replace(trim(t), 'ß', 'ss')),
        '\\s+[A-E]?DP\\s+\\d+\\w*[^\\n]*$', ''), '\\s+BX\\s+\\d+[^\\n]*$', ''), '\\s+BD\\s+\\d+[^\\n]*$', ''), '\\s+', ' ', 'g')) AS addr
    FROM (SELECT doc_id, text || CASE doc_id % 4 WHEN 0 THEN '  DP 301 BL 2' WHEN 1 THEN ' cdp 12' WHEN 2 THEN ' BX 9 BD 3' ELSE ' BDP  12 T' END AS t
          FROM documents)""")
def address_base_text(spark, sf):
    tail = F.expr("CASE doc_id % 4 WHEN 0 THEN '  DP 301 BL 2' WHEN 1 THEN ' cdp 12' WHEN 2 THEN ' BX 9 BD 3' ELSE ' BDP  12 T' END")
    return X.source(spark, sf, "documents").select(
        "doc_id", T.address_base(F.concat(F.col("text"), tail)).alias("addr")
    )


@query("strip_accents", """
    SELECT doc_id, upper(strip_accents(replace(text, 'ß', 'ss'))) AS plain, upper(strip_accents(replace(replace(text, ' ', '_'), 'ß', 'ss'))) AS layer,
           trim(upper(regexp_replace(strip_accents(text), '[^\\x00-\\x7F]', '', 'g')), E' \\n\\t\\r') AS ascii_only
    FROM documents""")
def strip_accents(spark, sf):
    t = F.col("text")
    return X.source(spark, sf, "documents").select(
        "doc_id", T.normal_name(t).alias("plain"), T.layer_word(t).alias("layer"), T.ascii_name(t).alias("ascii_only")
    )


X.add_table("fx_money", """
    SELECT o_orderkey AS ok, CAST(o_totalprice AS BIGINT) * 1000 + o_orderkey % 1000 AS amount,
           ' $' || CAST((CAST(o_totalprice AS BIGINT) * 1000 + o_orderkey % 1000) // 1000000 AS STRING) || '.'
           || lpad(CAST((CAST(o_totalprice AS BIGINT) * 1000 + o_orderkey % 1000) // 1000 % 1000 AS STRING), 3, '0') || ','
           || lpad(CAST(o_orderkey % 1000 AS STRING), 3, '0') || ' ' AS shown
    FROM (SELECT o_orderkey, floor(o_totalprice) AS o_totalprice FROM orders)""", ["orders"])


@query("money_clean", "SELECT ok, CAST(amount AS VARCHAR) AS text, amount FROM fx_money WHERE amount >= 1000000 UNION ALL "
       "SELECT ok, '0' || lpad(CAST(amount AS VARCHAR), 6, '0'), amount FROM fx_money WHERE amount < 1000000", ["fx_money"])
def money_clean(spark, sf):
    digits = T.money_digits(F.col("shown"))
    return X.table(spark, sf, "fx_money").select(
        "ok", digits.alias("text"), digits.try_cast("decimal(18,0)").cast("bigint").alias("amount")
    )


X.add_table("fx_layer_words", """
    SELECT o_orderkey AS ok, CASE o_orderkey % 7 WHEN 0 THEN 'SAN_PEDRODELAPAZ' WHEN 1 THEN 'DIEGODE_ALMAGRO' WHEN 2 THEN 'O''HIGGINS'
           WHEN 3 THEN 'PADRE' WHEN 4 THEN 'VILLADEL_SOL' WHEN 5 THEN 'PUERTADELAS_ROSAS' ELSE 'TIERRADELOS' END
           || '_' || CAST(o_orderkey % 50 AS STRING) AS word FROM orders""", ["orders"])


@query("name_variants", """
    WITH s AS (SELECT ok, word, array_to_string(list_transform(string_split(word, '_'), lambda p:
        CASE WHEN p LIKE '%_DELAPAZ' THEN p[:-8] || '_DE_LA_PAZ' WHEN p LIKE '%_DELAS' THEN p[:-6] || '_DE_LAS'
             WHEN p LIKE '%_DELOS' THEN p[:-6] || '_DE_LOS' WHEN p LIKE '%_DELA' THEN p[:-5] || '_DE_LA'
             WHEN p LIKE '%_DEL' THEN p[:-4] || '_DEL' WHEN p LIKE '%_DE' THEN p[:-3] || '_DE' ELSE p END), '_') AS v1,
        replace(word, '''', '') AS v2, replace(word, '_', '') AS v3 FROM fx_layer_words)
    SELECT ok, concat_ws(' ', CASE WHEN v1 <> word THEN v1 END, CASE WHEN v2 <> word AND v2 <> v1 THEN v2 END,
           CASE WHEN v3 <> word AND v3 <> v1 AND v3 <> v2 THEN v3 END) AS variants FROM s""", ["fx_layer_words"])
def name_variants(spark, sf):
    return X.table(spark, sf, "fx_layer_words").select(
        "ok", F.array_join(T.name_variants(F.col("word")), " ").alias("variants")
    )


X.add_table("fx_size_items", """
    SELECT p_partkey AS item, CAST(floor(p_retailprice) AS BIGINT) * 1048576 // 3 + p_partkey AS bytes FROM part""", ["part"])


@query("size_tier", """SELECT item, CASE WHEN mb > 500 THEN 'huge' WHEN mb > 200 THEN 'large' WHEN mb > 50 THEN 'medium' ELSE 'small' END AS tier
    FROM (SELECT item, bytes // 1048576 // 7 AS mb FROM fx_size_items)""", ["fx_size_items"])
def size_tier(spark, sf):
    return X.table(spark, sf, "fx_size_items").select("item", T.size_tier(F.col("bytes") / 7).alias("tier"))


# --- coordinates ---------------------------------------------------------------------
PT = "SELECT ok, x_u / 1000000.0 AS lon, y_u / 1000000.0 AS lat, x_u, y_u FROM fx_parcels WHERE x_u IS NOT NULL"
N = 2**C.ZOOM
TX = "CAST(trunc(({lon} + 180) / 360 * " + str(N) + ") AS BIGINT)"
TY = "CAST(trunc((1 - asinh(tan(radians({lat}))) / pi()) / 2 * " + str(N) + ") AS BIGINT)"


@query("lonlat_to_tile", f"SELECT ok, {TX.format(lon='lon')} AS tx, {TY.format(lat='lat')} AS ty FROM ({PT})", ["fx_parcels"])
def lonlat_to_tile(spark, sf):
    return X.points(spark, sf).select("ok", M.tile_x(F.col("x")).alias("tx"), M.tile_y(F.col("y")).alias("ty"))


@query("bbox_tiles", f"""
    SELECT poly_idx, tx, ty, tx * ty AS total, round(tx * 256.0 * ty * 256 * 4 / 1073741824, 1) AS ram_gb
    FROM (SELECT poly_idx, abs({TX.format(lon='x1')} - {TX.format(lon='x0')}) + 1 AS tx, abs({TY.format(lat='y0')} - {TY.format(lat='y1')}) + 1 AS ty
          FROM (SELECT poly_idx, x0_u / 1000000.0 AS x0, (x0_u + w_u * 10) / 1000000.0 AS x1, y0_u / 1000000.0 AS y0,
                       (y0_u + w_u * 10) / 1000000.0 AS y1 FROM fx_polygons))""", ["fx_polygons"])
def bbox_tiles(spark, sf):
    x0, y0, w = F.col("x0_u"), F.col("y0_u"), F.col("w_u") * 10
    t = M.tile_range(x0 / 1e6, y0 / 1e6, (x0 + w) / 1e6, (y0 + w) / 1e6)
    out = X.table(spark, sf, "fx_polygons").select("poly_idx", t.alias("t")).select(
        "poly_idx", (F.col("t.x1") - F.col("t.x0") + 1).alias("tx"), (F.col("t.y1") - F.col("t.y0") + 1).alias("ty")
    )
    return out.select("*", (F.col("tx") * F.col("ty")).alias("total"), M.raster_gb(F.col("tx"), F.col("ty")).alias("ram_gb"))


@query("tile_bbox", f"""
    WITH t AS (SELECT DISTINCT {TX.format(lon='lon')} AS tx, {TY.format(lat='lat')} AS ty FROM ({PT})), s AS (SELECT 2 * 20037508.34 / {N} AS s)
    SELECT tx, ty, tx - tx % 4 AS cx, ty - ty % 4 AS cy,
           round((tx - tx % 4) * s - 20037508.34, 3) AS minx, round(20037508.34 - (ty - ty % 4) * s - 4 * s, 3) AS miny,
           round((tx - tx % 4) * s - 20037508.34 + 4 * s, 3) AS maxx, round(20037508.34 - (ty - ty % 4) * s, 3) AS maxy FROM t, s""",
    ["fx_parcels"])
def tile_bbox(spark, sf):
    t = X.points(spark, sf).select(M.tile_x(F.col("x")).alias("tx"), M.tile_y(F.col("y")).alias("ty")).distinct()
    t = t.select("*", M.align(F.col("tx")).alias("cx"), M.align(F.col("ty")).alias("cy"))
    t = t.withColumn("b", M.tile_box(F.col("cx"), F.col("cy"), C.CELL_TILES))
    return t.select("tx", "ty", "cx", "cy", *[F.round(f"b.{c}", 3).alias(c) for c in ("minx", "miny", "maxx", "maxy")])


@query("mercator_roundtrip", f"""
    SELECT ok, round(radians(lon) * 6378137, 3) AS mx, round(ln(tan(pi() / 4 + radians(lat) / 2)) * 6378137, 3) AS my,
           round(lon, 9) AS lon, round(lat, 9) AS lat FROM ({PT})""", ["fx_parcels"])
def mercator_roundtrip(spark, sf):
    p = X.points(spark, sf).select("ok", M.mercator_x(F.col("x")).alias("mx"), M.mercator_y(F.col("y")).alias("my"))
    return p.select(
        "ok", F.round("mx", 3).alias("mx"), F.round("my", 3).alias("my"),
        F.round(M.lon_of(F.col("mx")), 9).alias("lon"), F.round(M.lat_of(F.col("my")), 9).alias("lat"),
    )


@query("coord_key", f"SELECT ok, x_u AS kx, y_u AS ky FROM ({PT})", ["fx_parcels"])
def coord_key(spark, sf):
    return X.points(spark, sf).select("ok", K.coord_key(F.col("x")).alias("kx"), K.coord_key(F.col("y")).alias("ky"))


@query("deg_to_m", """
    SELECT poly_idx, CAST(round(w_u * 0.111, 4) AS DOUBLE) AS side_m, CAST(round(w_u * w_u * 0.012321, 4) AS DOUBLE) AS area_m2,
           round(w_u * w_u / 1e12 * power(pi() * 6378137 / 180, 2) * cos(radians(y0_u / 1000000.0)), 2) AS true_m2
    FROM fx_polygons""", ["fx_polygons"])
def deg_to_m(spark, sf):
    ring = F.col("shell")
    return X.polygons(spark, sf).select(
        "poly_idx", F.round(M.degree_metres(ring[1]["x"] - ring[0]["x"]), 4).alias("side_m"),
        F.round(M.degree_area_m2(G.ring_area(ring)), 4).alias("area_m2"),
        F.round(M.true_area_m2(G.ring_area(ring), ring[0]["y"]), 2).alias("true_m2"),
    )


# --- geometry ------------------------------------------------------------------------
HOLES = "CASE WHEN has_hole THEN {0} ELSE 0 END + CASE WHEN has_slit THEN {1} ELSE 0 END"
AREA = f"(w_u * w_u - ({HOLES.format(1600, 240)}))"


@query("g_area", f"SELECT poly_idx, CAST(round({AREA} * 0.012321, 4) AS DOUBLE) AS area_m2, CAST(round(w_u * 0.444, 4) AS DOUBLE) AS perimeter_m FROM fx_polygons", ["fx_polygons"])
def g_area(spark, sf):
    return X.polygons(spark, sf).select(
        "poly_idx", F.round(M.degree_area_m2(G.area(F.col("shell"), F.col("holes"))), 4).alias("area_m2"),
        F.round(M.degree_metres(G.ring_length(F.col("shell"))), 4).alias("perimeter_m"),
    )


@query("g_centroid", f"""
    SELECT poly_idx, round((x0_u + (w_u * w_u * (w_u / 2.0) - ({HOLES.format('1600 * 70.0', '240 * 122.0')})) / {AREA}) / 1e6, 8) AS cx,
           round((y0_u + (w_u * w_u * (w_u / 2.0) - ({HOLES.format('1600 * 70.0', '240 * 80.0')})) / {AREA}) / 1e6, 8) AS cy
    FROM fx_polygons""", ["fx_polygons"])
def g_centroid(spark, sf):
    c = G.centroid(F.col("shell"), F.col("holes"))
    return X.polygons(spark, sf).select("poly_idx", c.alias("c")).select(
        "poly_idx", F.round("c.x", 8).alias("cx"), F.round("c.y", 8).alias("cy")
    )


@query("g_bounds", """SELECT poly_idx, x0_u / 1000000.0 AS minx, y0_u / 1000000.0 AS miny,
    (x0_u + w_u) / 1000000.0 AS maxx, (y0_u + w_u) / 1000000.0 AS maxy FROM fx_polygons""", ["fx_polygons"])
def g_bounds(spark, sf):
    return X.polygons(spark, sf).select("poly_idx", G.bounds(F.col("shell")).alias("b")).select("poly_idx", "b.*")


def placed_pairs(spark, sf):
    """Every parcel with coordinates beside the polygon of its own number."""
    pts = X.points(spark, sf).join(X.table(spark, sf, "fx_parcels").select("ok", "h"), "ok")
    return pts.join(X.polygons(spark, sf).drop("comuna"), F.col("h") == F.col("poly_idx"))


PAIR = "(SELECT p.ok, p.x_u AS x, p.y_u AS y, g.* FROM fx_parcels p JOIN fx_polygons g ON p.h = g.poly_idx WHERE x_u IS NOT NULL)"


def _register_pairs():
    from conformance.queries.matching import DIST_U, INSIDE

    @query("g_contains", f"SELECT ok, {INSIDE} AS inside FROM {PAIR}", ["fx_parcels", "fx_polygons"])
    def g_contains(spark, sf):
        inside = G.contains(F.col("shell"), F.col("holes"), F.col("x"), F.col("y"))
        return placed_pairs(spark, sf).select("ok", inside.alias("inside"))

    @query("g_distance", f"SELECT ok, round(({DIST_U}) * 0.111, 4) AS dist_m FROM {PAIR}", ["fx_parcels", "fx_polygons"])
    def g_distance(spark, sf):
        d = G.distance(F.col("shell"), F.col("holes"), F.col("x"), F.col("y"))
        return placed_pairs(spark, sf).select("ok", F.round(M.degree_metres(d), 4).alias("dist_m"))


_register_pairs()


# holes of 40 x 40 are 19.7 m2 by the degree rule, slits 2.96 m2
@query("g_fill_holes", f"""
    SELECT poly_idx, CAST(has_hole AS INTEGER) AS at_10, CAST(0 AS INTEGER) AS at_50, CAST(round((w_u * w_u - CASE WHEN has_hole THEN 1600 ELSE 0 END) * 0.012321, 4) AS DOUBLE) AS area_10
    FROM fx_polygons""", ["fx_polygons"])
def g_fill_holes(spark, sf):
    unit = float(C.METRES_PER_DEGREE) ** 2
    at = lambda m2: G.fill_holes(F.col("holes"), m2 / unit)
    return X.polygons(spark, sf).select(
        "poly_idx", F.size(at(10.0)).alias("at_10"), F.size(at(C.HOLE_FILL_URBAN_M2)).alias("at_50"),
        F.round(M.degree_area_m2(G.area(F.col("shell"), at(10.0))), 4).alias("area_10"),
    )


@query("g_fill_compact", """
    SELECT poly_idx, CAST(has_slit AS INTEGER) AS kept, CAST(round(area, 1) AS DOUBLE) AS area_m2 FROM (
        SELECT *, (w_u * w_u - CASE WHEN has_slit THEN 240 ELSE 0 END) * 0.012321 AS area FROM fx_polygons)
    WHERE area BETWEEN 1 AND 800""", ["fx_polygons"])
def g_fill_compact(spark, sf):
    scale = float(C.METRES_PER_DEGREE) ** 2
    p = X.polygons(spark, sf).withColumn("kept", G.fill_compact_holes(F.col("holes"), area_scale=scale))
    p = p.withColumn("a", M.degree_area_m2(G.area(F.col("shell"), F.col("kept"))))
    return p.where(F.col("a").between(1.0, 800.0)).select("poly_idx", F.size("kept").alias("kept"), F.round("a", 1).alias("area_m2"))


@query("g_validity", """
    SELECT poly_idx, CASE poly_idx % 6 WHEN 1 THEN 'open' WHEN 2 THEN 'self_crossing' WHEN 3 THEN 'zero_area' WHEN 4 THEN 'too_few_points'
           WHEN 5 THEN 'empty' END AS problem, CASE poly_idx % 6 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN 'self_crossing' WHEN 3 THEN 'too_few_points'
           WHEN 4 THEN 'too_few_points' ELSE 'empty' END AS after_repair FROM fx_polygons""", ["fx_polygons"])
def g_validity(spark, sf):
    s = F.col("shell")
    k = F.col("poly_idx") % 6
    high = F.struct(s[3]["x"].alias("x"), (s[3]["y"] * 2 - s[0]["y"]).alias("y"))
    ring = (
        F.when(k == 1, F.slice(s, 1, 4)).when(k == 2, F.array(s[0], s[2], s[1], high, s[0]))
        .when(k == 3, F.array(s[0], s[1], s[1], s[0])).when(k == 4, F.array(s[0], s[1], s[0]))
        .when(k == 5, F.slice(s, 1, 0)).otherwise(s)
    )
    p = X.polygons(spark, sf).select("poly_idx", ring.alias("r"))
    return p.select(
        "poly_idx", G.ring_problem(F.col("r")).alias("problem"), G.ring_problem(G.repair_ring(F.col("r"))).alias("after_repair")
    )
