"""The whole product plans, checked by what has to hold for any placing, and the catalog of what they write."""

from __future__ import annotations

from pyspark.sql import functions as F

from conformance import fixtures as X
from conformance.queries.matching import INSIDE
from conformance.queries.raster import BIG, INNER, SIZE, component_sql
from conformance.queries.raster import tiles as pixel_tiles
from conformance.queries.tables import registry
from conformance.registry import query
from deslinde import constants as C
from deslinde.functions import coords as M
from deslinde.operators import enrich as E
from deslinde.operators import metrics as A
from deslinde.operators import planning as L
from deslinde.operators import raster as R8
from deslinde.plans import product as D
from deslinde.session import cut, scratch_path
from deslinde.sources import tables as R

TABLES = ["fx_parcels", "fx_polygons", "fx_registry", "fx_anchors", "fx_number_reads"]
# coordinates after the merge: of parcels without, those of the first with the same address in the block
FILLED = """fx_donor AS (SELECT comuna, manzana, addr_expected, arg_min(x_u, (manzana, predio)) AS dx, arg_min(y_u, (manzana, predio)) AS dy
      FROM fx_parcels WHERE x_u IS NOT NULL AND addr_expected IS NOT NULL GROUP BY ALL),
  fx_filled AS (SELECT p.ok, p.comuna, coalesce(p.x_u, dx) AS x, coalesce(p.y_u, dy) AS y
      FROM fx_parcels p LEFT JOIN fx_donor USING (comuna, manzana, addr_expected))"""
ONLY = """fx_only AS (SELECT r.* FROM fx_registry r ANTI JOIN fx_parcels x ON TRY_CAST(r.comuna AS INT) = x.comuna
      AND TRY_CAST(r.manzana AS BIGINT) = CAST(x.manzana AS BIGINT) AND TRY_CAST(CAST(r.predio AS DOUBLE) AS BIGINT) = x.num)"""


def answers(spark, sf):
    p = X.parcels(spark, sf).withColumn("direccion_sii", F.col("address")).drop("address", "num")
    return p.withColumn("nombreComuna", F.concat(F.lit("Comuna "), F.col("comuna").cast("string")))


def facts(product):
    """Lines (fact, n) that do not depend on how ties fell."""
    kind = F.when(F.col("match_method") == "catastro_only", "registry_only").when(
        F.col("match_method") == "unmatched_polygon", "orphans").otherwise("parcels")
    rows = cut(product.select("comuna", "manzana", "predio", "poly_idx", "match_method", "dc_avaluo_fiscal", F.col("shell").isNotNull().alias("drawn"), kind.alias("kind")))
    line = lambda name, n: F.struct(F.lit(name).alias("fact"), n.cast("bigint").alias("n"))
    key = F.struct("comuna", "manzana", "predio")
    polygon = F.struct("comuna", "poly_idx")
    sums = rows.agg(
        F.array(
            line("parcels", F.countDistinct(F.when(F.col("kind") == "parcels", key))),
            line("parcel_rows", F.count_if(F.col("kind") == "parcels")),
            line("registry_only", F.count_if(F.col("kind") == "registry_only")),
            line("polygons", F.countDistinct(F.when(F.col("poly_idx").isNotNull(), polygon))),
            line("drawn", F.countDistinct(F.when(F.col("drawn"), polygon))),
            line("orphans_used", F.count_if(F.col("poly_idx").isNotNull() & ~F.col("drawn"))),
            line("inside", F.count_if(F.col("match_method").isin("point_in_polygon", "1_contains"))),
            line("valued", F.count_if((F.col("kind") == "parcels") & F.col("dc_avaluo_fiscal").isNotNull())),
        ).alias("l")
    )
    return sums.select(F.explode("l").alias("l")).select("l.*")


def facts_sql(places: str) -> str:
    return f"""SELECT 'parcels' AS fact, count(*) AS n FROM fx_parcels UNION ALL SELECT 'parcel_rows', count(*) FROM fx_parcels
    UNION ALL SELECT 'registry_only', count(*) FROM fx_only UNION ALL SELECT 'polygons', count(*) FROM fx_polygons
    UNION ALL SELECT 'drawn', count(*) FROM fx_polygons UNION ALL SELECT 'orphans_used', 0
    UNION ALL SELECT 'inside', count(DISTINCT ok) FROM ({places}) p JOIN fx_polygons g USING (comuna) WHERE {INSIDE}
    UNION ALL SELECT 'valued', count(*) FROM fx_parcels x SEMI JOIN fx_registry r ON TRY_CAST(r.comuna AS INT) = x.comuna
      AND TRY_CAST(r.manzana AS BIGINT) = CAST(x.manzana AS BIGINT) AND TRY_CAST(CAST(r.predio AS DOUBLE) AS BIGINT) = x.num"""


def product_v3(spark, sf):
    rows = registry(spark, sf).drop("dc_direccion")
    return D.product_v3(answers(spark, sf), X.polygons(spark, sf), rows, ["rank"], X.table(spark, sf, "fx_number_reads"))


@query("product_v3", f"WITH {FILLED}, {ONLY} {facts_sql('SELECT * FROM fx_filled')}", TABLES)
def product_v3_facts(spark, sf):
    return facts(product_v3(spark, sf))


@query("product_v1", f"WITH {ONLY} {facts_sql('SELECT ok, comuna, x_u AS x, y_u AS y FROM fx_parcels')}", TABLES)
def product_v1_facts(spark, sf):
    return facts(D.product_v1(answers(spark, sf), X.polygons(spark, sf), registry(spark, sf), ["rank"], X.table(spark, sf, "fx_anchors")))


@query("product_catalog", f"""
    WITH {ONLY}, c AS (SELECT comuna, count(*) AS parcels FROM fx_parcels GROUP BY comuna),
    o AS (SELECT TRY_CAST(comuna AS INT) AS comuna, count(*) AS only_registry FROM fx_only GROUP BY 1)
    SELECT CAST(comuna AS VARCHAR) AS codigo, 'Comuna ' || comuna AS nombre, CAST(parcels + coalesce(only_registry, 0) AS BIGINT) AS with_key,
           'geometry/comuna=' || comuna AS geometry_key, true AS sized FROM c LEFT JOIN o USING (comuna)""", TABLES)
def product_catalog(spark, sf):
    """The catalog document of the written product, read back."""
    rows = registry(spark, sf)
    doc = D.write_product(cut(product_v3(spark, sf)), rows.drop("rank"), scratch_path(spark, "product"), "second semester")
    part = "struct<key:string,tamano_mb:double>"
    entries = F.try_variant_get(
        F.parse_json("document"), "$.comunas",
        f"array<struct<codigo:string,nombre:string,predios:struct<con_datos_y_poligono:bigint,catastro_only:bigint>,archivos:struct<gpkg:{part},csv:{part},csv_raw:{part}>>>",
    )
    e = doc.select(F.explode(entries).alias("e")).select("e.*")
    return e.select(
        "codigo", "nombre", (F.col("predios.con_datos_y_poligono") + F.col("predios.catastro_only")).alias("with_key"),
        F.col("archivos.gpkg.key").alias("geometry_key"), (F.col("archivos.csv.tamano_mb") >= 0).alias("sized"),
    )


@query("append_registry_only", f"""WITH {ONLY} SELECT 'parcel' AS kind, count(*) AS n, count(address) AS addressed FROM fx_parcels
    UNION ALL SELECT 'catastro_only', count(*), 0 FROM fx_only""", TABLES)
def append_registry_only(spark, sf):
    parcels = X.parcels(spark, sf).withColumn("match_method", F.lit(None).cast("string"))
    whole = E.append_registry_only(parcels, registry(spark, sf))
    return whole.groupBy(F.coalesce("match_method", F.lit("parcel")).alias("kind")).agg(F.count("*").alias("n"), F.count("address").alias("addressed"))


@query("merge_metrics", """
    SELECT comuna, count(*) AS total, count(*) FILTER (WHERE ok % 5 < 3) AS ok, count(*) FILTER (WHERE ok % 10 <> 0) AS con_dc_direccion,
           count(*) FILTER (WHERE y_u IS NOT NULL AND ok % 9 <> 2) AS con_coords, count(*) FILTER (WHERE ok % 3 = 0) AS con_predio_publicado,
           count(*) FILTER (WHERE ok % 4 = 1) AS heredados FROM fx_parcels GROUP BY comuna""", ["fx_parcels"])
def merge_metrics(spark, sf):
    rows = X.parcels(spark, sf).select(
        "comuna", F.when(F.col("ok") % 5 < 3, "True").otherwise("False").alias("_ok"), F.when(F.col("ok") % 10 != 0, "x").alias("dc_direccion"),
        F.when(F.col("ok") % 9 == 2, "None").otherwise(F.col("lat").cast("string")).alias("lat"),
        F.when(F.col("ok") % 3 == 0, "1").alias("predioPublicado_predio"), (F.col("ok") % 4 == 1).alias("inherited"),
    )
    return A.merge_metrics(rows)


OVERRIDES = ", ".join(f"({code}, '{name.replace(chr(39), chr(39) * 2)}')" for code, name in C.LAYER_NAME_OVERRIDES.items())


@query("layer_names", f"""
    WITH o(comuna, layer) AS (VALUES {OVERRIDES}), b AS (SELECT CAST(2000 + p_partkey AS INTEGER) AS comuna, 'LAYER_' || p_partkey AS layer FROM part)
    SELECT comuna, coalesce(o.layer, b.layer) AS layer FROM b FULL JOIN o USING (comuna)""")
def layer_names(spark, sf):
    """The tab-separated names with a heading and a blank line, under the published exceptions."""
    path = scratch_path(spark, "names")
    line = F.concat_ws("\t", (F.col("p_partkey") + 2000).cast("string"), F.concat(F.lit("LAYER_"), F.col("p_partkey").cast("string")))
    rows = X.source(spark, sf, "part").select(line.alias("value"))
    rows.unionByName(spark.createDataFrame([("cod\tnombre",), ("",), ("77",)], "value string")).write.text(path)
    return L.layer_names(R.read_layer_names(spark, path))


@query("distinct_names", """SELECT DISTINCT CAST(comuna AS VARCHAR) AS cod, 'C' || manzana AS nombre FROM fx_parcels WHERE address IS NOT NULL""", ["fx_parcels"])
def distinct_names(spark, sf):
    name = F.when(F.col("address").isNotNull(), F.concat(F.lit("C"), F.col("manzana")))
    return A.distinct_names(X.parcels(spark, sf).withColumn("comuna_nombre", name))


@query("product_tiles", component_sql(INNER) + f""", fx_kept AS (SELECT label, cls, a, row_number() OVER (ORDER BY cls <> 'urban', label) - 1 AS poly_idx FROM {BIG}),
    fx_runs_in AS (SELECT label, count(*) AS runs FROM fx_labelled GROUP BY label)
    SELECT poly_idx, CASE cls WHEN 'urban' THEN 'urban' ELSE 'agri' END AS layer, runs AS parcels FROM fx_kept JOIN fx_runs_in USING (label)""", ["fx_pixels"])
def product_tiles(spark, sf):
    """Rasters to product: a parcel in the middle of every run of interior pixels lies in the polygon of its region."""
    east, south = 38000, 75000  # tiles of 320 metres, so that the plane lies where coordinates are accepted
    own = cut(pixel_tiles(spark, sf))
    plane = own.withColumn("comuna", F.lit(13101)).withColumn("tx", F.col("tx") + east).withColumn("ty", F.col("ty") + south)
    layer = cut(D.layer_from_tiles(plane, SIZE, 20.0))
    runs = R8.interior_runs(R8.pixel_runs(own), SIZE)
    parcels = runs.select(
        F.lit(13101).alias("comuna"), F.lpad(F.col("y").cast("string"), 5, "0").alias("manzana"), F.lpad(F.col("x0").cast("string"), 5, "0").alias("predio"),
        M.lon_of((F.col("x0") + F.col("x1") + 1) * 10.0 + east * 320.0 - C.MERCATOR_HALF).alias("lon"),
        M.lat_of(F.lit(C.MERCATOR_HALF) - (F.col("y") + 0.5) * 20.0 - south * 320.0).alias("lat"),
        F.lit(None).cast("string").alias("direccion_sii"),
    )
    whole = D.product_v3(parcels, layer)
    inside = whole.where("match_method = 'point_in_polygon'").groupBy("comuna", "poly_idx").agg(F.count("*").alias("parcels"))
    return inside.join(layer.select("comuna", "poly_idx", "layer"), ["comuna", "poly_idx"]).select("poly_idx", "layer", "parcels")
