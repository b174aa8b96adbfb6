"""The product as one plan: answers and registry to placed parcels, orphan polygons, registry-only rows, and their catalog."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deslinde.functions import keys as K
from deslinde.functions import text as T
from deslinde.operators import enrich as E
from deslinde.operators import inherit as I
from deslinde.operators import metrics as A
from deslinde.operators import overlap as V
from deslinde.operators import raster
from deslinde.operators.dedup import first_per_key
from deslinde.plans import cascade as P
from deslinde.session import cut, large
from deslinde.sources import sinks
from deslinde.sources import tables as R

UTM = ["ah_utm_x", "ah_utm_y", "csa_utm_x", "csa_utm_y"]
# What a parcel without coordinates takes from its address donor beside the coordinates.
DONATED = ["predioPublicado_predio", "predioPublicado_utm_x", "predioPublicado_utm_y"]


def _keyed(answers: DataFrame) -> DataFrame:
    """One row per padded key."""
    padded = answers.withColumn("manzana", K.zfill(F.col("manzana"))).withColumn("predio", K.zfill(F.col("predio")))
    rest = [c for c in ("attempt", "lat", "lon") if c in answers.columns]
    return first_per_key(padded, P.KEY, [*P.ORDER, *rest])


def merged(answers: DataFrame, registry: DataFrame | None, order: list[str | Column]) -> DataFrame:
    """Answers with the registry's columns, and coordinates for those that share an address with a parcel that has them.

    The address is the registry's if it comes with one, else the answer's. Registry columns that the
    answers have already get the suffix ``_cat``.
    """
    rows = _keyed(answers)
    if registry is not None:
        rows = E.enrich_registry(rows, registry, order, clash="_cat")
    address = F.col("dc_direccion" if "dc_direccion" in rows.columns else "direccion_sii")
    rows = rows.withColumn("address", address).withColumn("addr", T.address_base(address))
    return cut(I.fill_from_address_donors(rows, [c for c in DONATED if c in rows.columns], P.ORDER).drop("addr"))


def _on_key(left: DataFrame, right: DataFrame, how: str = "left") -> DataFrame:
    """Join by key; a null part is a value like any other, so no row is lost to it."""
    named = right.withColumnsRenamed({k: "_" + k for k in P.KEY})
    same = reduce(lambda a, b: a & b, [left[k].eqNullSafe(named["_" + k]) for k in P.KEY])
    return left.join(large(named), same, how).drop(*["_" + k for k in P.KEY])


def _finished(placed: DataFrame, rows: DataFrame, polygons: DataFrame, registry: DataFrame | None) -> DataFrame:
    """Placed keys with attributes, the polygons nobody has, what only the registry has; shapes come last.

    Orphans and registry-only rows are found from keys alone, and only rows that have a polygon shuffle with shapes.
    """
    placed = cut(placed.select(*P.KEY, *P.RESULT))
    has = F.col("poly_idx").isNotNull()
    used = placed.where(has).select("comuna", "poly_idx").distinct()
    orphans = polygons.select("comuna", "poly_idx").join(large(used), ["comuna", "poly_idx"], "left_anti").withColumn("match_method", F.lit("unmatched_polygon"))
    drawn = _on_key(rows, placed.where(has), "inner").unionByName(orphans, allowMissingColumns=True)
    whole = P.attach_geometry(drawn, polygons).unionByName(_on_key(rows, placed.where(~has), "inner"), allowMissingColumns=True)
    if registry is None:
        return whole
    extra = E.registry_only(rows.select(*P.KEY), registry).withColumn("comuna", F.col("comuna").cast(rows.schema["comuna"].dataType))
    return whole.unionByName(extra.select(*[c for c in extra.columns if c in whole.columns]), allowMissingColumns=True)


def product_v3(
    answers: DataFrame, polygons: DataFrame, registry: DataFrame | None = None, order: list[str | Column] = ("predio",),
    reads: DataFrame | None = None,
) -> DataFrame:
    """Current product: merge, match cascade, recovery, orphans, registry-only rows, thinner outlines.

    ``answers`` needs (comuna, manzana, predio, lat, lon, direccion_sii) and may hold the projected
    places (ah_utm_*, csa_utm_*); ``polygons`` is a layer in degrees; ``reads`` are numbers read in polygons.
    """
    rows = merged(answers, registry, list(order))
    matched = P.match_cascade_v3(rows, polygons)
    utm = rows.select(*P.KEY, *[F.col(c) if c in rows.columns else F.lit(None).cast("string").alias(c) for c in UTM])
    recovered = P.recover(_on_key(matched, utm), polygons, reads)
    return V.simplify_layer(_finished(recovered, rows, polygons, registry))


def layer_from_tiles(tiles: DataFrame, size: int, pixel_m: float, **limits) -> DataFrame:
    """Polygons (comuna, poly_idx, shell, holes, layer) of the tiles (comuna, tx, ty, size, rgba), as the product takes them.

    Agricultural polygons that urban ones cover for the most part go; the rest get one index, urban ones first.
    """
    made = cut(raster.vectorize_layers(tiles, size, pixel_m, **limits).select("comuna", "poly_idx", "cls", "shell", "holes"))
    urban, agri = (made.where(F.col("cls") == c).drop("cls") for c in ("urban", "agri"))
    return V.joint_index(V.overlap_dedup(urban, agri))


def product_from_tiles(
    tiles: DataFrame, answers: DataFrame, registry: DataFrame | None = None, order: list[str | Column] = ("predio",),
    size: int = 1024, pixel_m: float = raster.PIXEL_M, reads: DataFrame | None = None, **limits,
) -> DataFrame:
    """Tiles and answers to the current product: vectorised layers, overlap, joint index, then `product_v3`."""
    return product_v3(answers, cut(layer_from_tiles(tiles, size, pixel_m, **limits)), registry, order, reads)


def product_v1(
    answers: DataFrame, polygons: DataFrame, registry: DataFrame | None = None, order: list[str | Column] = ("predio",),
    anchors: DataFrame | None = None,
) -> DataFrame:
    """Legacy product: the legacy cascade over the answers, then registry columns, orphans and registry-only rows."""
    rows = cut(_keyed(answers).withColumn("address", F.col("direccion_sii")))
    placed = P.match_cascade_v1(rows, polygons, anchors)
    if registry is not None:
        rows = E.enrich_registry(rows, registry, list(order))
    return _finished(placed, rows, polygons, registry)


def write_product(product: DataFrame, registry: DataFrame, folder: str, title: str) -> DataFrame:
    """Write the three outputs under ``folder``; one row with the catalog document of what was written."""
    paths = sinks.write_products(product, registry, folder)
    flat = product.sparkSession.read.option("header", True).csv(paths["csv"])
    return A.catalog_json(flat, title, files=R.output_sizes(product.sparkSession, paths))
