"""The match cascade: every parcel gets a polygon from the first stage that has one for it.

A stage sees only the rows the earlier ones left. Its answer is written once to the
checkpoint folder; the rows it placed are set aside as donors for later stages and the
rest go on. Only the key, the place, the address and the number travel; geometry and
attributes are attached at the end by ``attach_geometry``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deslinde import constants as C
from deslinde.functions import coords as M
from deslinde.functions import geometry as G
from deslinde.functions import keys as K
from deslinde.functions import text as T
from deslinde.operators import inherit as I
from deslinde.operators import spatial as S
from deslinde.session import cut, large

KEY = ["comuna", "manzana", "predio"]
ORDER = ["manzana", "predio"]
RESULT = ["poly_idx", "match_method", "match_dist_m"]


class Cascade:
    """Rows still to place and the rows placed so far."""

    def __init__(self, rows: DataFrame):
        self.columns = rows.columns
        self.open = rows
        self.done: list[DataFrame] = []

    def stage(self, place: Callable[[DataFrame], DataFrame]) -> None:
        """``place`` returns its input rows plus the three result columns, null where it failed."""
        tried = cut(place(self.open).select(*self.columns, *RESULT))
        self.done.append(tried.where("poly_idx is not null"))
        self.open = tried.where("poly_idx is null").select(*self.columns)

    def placed(self) -> DataFrame:
        return reduce(DataFrame.unionByName, self.done)

    def result(self, otherwise: str | None = None) -> DataFrame:
        rest = self.open.select(
            "*", F.lit(None).cast("bigint").alias("poly_idx"),
            F.lit(otherwise).cast("string").alias("match_method"), F.lit(None).cast("double").alias("match_dist_m"),
        )
        return self.placed().unionByName(rest)


def _result(df: DataFrame, method: Column | str, dist: Column | None = None) -> DataFrame:
    label = F.lit(method) if isinstance(method, str) else method
    return df.withColumn("match_method", F.when(F.col("poly_idx").isNotNull(), label)).withColumn(
        "match_dist_m", (F.lit(None) if dist is None else dist).cast("double")
    )


def _place_stage(
    rows: DataFrame, polygons: DataFrame, metric: S.Metric, within_m: float, inside: str, near: Column, same: str
) -> DataFrame:
    """Containment, then nearest within a radius, then equal coordinate, all on distinct places.

    The three are decided per place and spread over its parcels in one join.
    """
    places = rows.where("x is not null and y is not null").groupBy("comuna", "x", "y").agg(
        F.min(F.struct(*ORDER)).alias("first"), F.min("kx").alias("kx"), F.min("ky").alias("ky")
    )
    located = S.locate_sites(places.select("comuna", "x", "y"), polygons, metric, within_m)
    known = cut(places.join(large(located), ["comuna", "x", "y"], "left"))
    donors = I.first_donor(known.where("poly_idx is not null"), ["comuna", "kx", "ky"], ["poly_idx"], ["first"])
    donors = donors.withColumnRenamed("poly_idx", "_same")
    metres = metric.metres_of(F.col("dist_q"))
    decided = (
        known.join(large(donors), ["comuna", "kx", "ky"], "left")
        .withColumn("match_dist_m", F.when(F.col("inside"), 0.0).when(F.col("poly_idx").isNotNull(), metres))
        .withColumn(
            "match_method",
            F.when(F.col("inside"), inside).when(F.col("poly_idx").isNotNull(), near).when(F.col("_same").isNotNull(), same),
        )
        .withColumn("poly_idx", F.coalesce("poly_idx", "_same"))
        .select("comuna", "x", "y", *RESULT)
    )
    return rows.join(large(decided), ["comuna", "x", "y"], "left")


def match_rows(parcels: DataFrame, legacy: bool = False) -> DataFrame:
    """Narrow parcels to what the cascade carries.

    Needs (comuna, manzana, predio, lat, lon, address). Coordinates outside the
    national box are dropped; the legacy form works in Mercator metres.
    """
    lat, lon = F.col("lat").try_cast("double"), F.col("lon").try_cast("double")
    ok = M.valid_coord(lat, lon, legacy)
    x, y = (M.mercator_x(lon), M.mercator_y(lat)) if legacy else (lon, lat)
    return parcels.select(
        "comuna", K.zfill(F.col("manzana")).alias("manzana"), K.zfill(F.col("predio")).alias("predio"),
        F.when(ok, x).alias("x"), F.when(ok, y).alias("y"),
        F.when(ok, K.coord_key(lon)).alias("kx"), F.when(ok, K.coord_key(lat)).alias("ky"),
        T.address_base(F.col("address")).alias("addr"), K.key_int(F.col("predio")).alias("num"),
    )


def match_cascade_v3(parcels: DataFrame, polygons: DataFrame, within_m: float = C.NEAREST_M) -> DataFrame:
    """Containment, nearest, same coordinate, same address; one row per parcel."""
    cascade = Cascade(match_rows(parcels))
    cascade.stage(
        lambda rows: _place_stage(
            rows, polygons, S.DEGREES, within_m,
            "point_in_polygon", F.lit(f"nearest_{within_m:g}m"), "coord_inheritance",
        )
    )
    cascade.stage(lambda rows: _result(I.inherit_address(rows, cascade.placed(), ORDER, "left"), "address_inheritance"))
    return cascade.result()


def to_mercator(polygons: DataFrame) -> DataFrame:
    ring = lambda r: G.reproject(r, M.mercator_x, M.mercator_y)
    return polygons.select(
        "comuna", "poly_idx", ring(F.col("shell")).alias("shell"), F.transform("holes", ring).alias("holes")
    )


def match_cascade_v1(
    parcels: DataFrame,
    polygons: DataFrame,
    anchors: DataFrame | None = None,
    within_m: float = C.NEAREST_M,
    fallback_m: float | None = None,
) -> DataFrame:
    """Containment, nearest, same coordinate, neighbour number, anchors, anyone in the block.

    ``polygons`` in degrees; distances are Mercator metres. ``anchors`` is (comuna,
    poly_idx, rol) and counts only where its polygon is still unused. ``fallback_m``
    switches on the capped nearest fallback.
    """
    flat = S.with_bounds(to_mercator(polygons))
    cascade = Cascade(match_rows(parcels, legacy=True))
    near = F.format_string("2_nearest_%.1fm", S.MERCATOR.metres_of(F.col("dist_q")))
    cascade.stage(
        lambda rows: _place_stage(rows, flat, S.MERCATOR, within_m, "1_contains", near, "3_coord_inherit")
    )
    placed_by_place = cascade.placed()
    numbered = placed_by_place.where("num is not null").select("comuna", "manzana", "num", "poly_idx", "predio")
    cascade.stage(
        lambda rows: _result(
            I.asof_neighbor(rows, numbered, how="left"), F.format_string("4_manzana_d%d", F.col("diff"))
        )
    )
    if anchors is not None:
        lacking = I.blocks_without_match(cascade.open, cascade.placed()).select("comuna").distinct()
        unused = anchors.join(large(cascade.placed().select("comuna", "poly_idx").distinct()), ["comuna", "poly_idx"], "left_anti")
        usable = unused.join(lacking, "comuna", "left_semi")
        cascade.stage(
            lambda rows: _result(
                I.asof_anchor(rows, usable, how="left"), F.format_string("5_fi_manzana_d%d", F.col("diff"))
            )
        )
    if fallback_m is not None:
        cascade.stage(lambda rows: _nearest_stage(rows, flat, fallback_m))
    cascade.stage(
        lambda rows: _result(I.inherit_block_any(rows, numbered, ["num", "predio"], "left"), "6_manzana_any")
    )
    return cascade.result()


def _nearest_stage(rows: DataFrame, polygons: DataFrame, metres: float) -> DataFrame:
    located = S.nearest_capped_sites(S.sites_of(rows), polygons, metres, S.MERCATOR)
    return _result(rows.join(large(located), ["comuna", "x", "y"], "left"), "6_fallback_nearest")


def utm_source(rows: DataFrame) -> DataFrame:
    """Place from the projected coordinates: the market area's first, else the soil class's."""
    ah, csa = T.present(F.col("ah_utm_x")), T.present(F.col("csa_utm_x"))
    pick = lambda axis: F.when(ah, F.col(f"ah_utm_{axis}")).when(csa, F.col(f"csa_utm_{axis}")).try_cast("double")
    ll = M.utm_to_lonlat(pick("x"), pick("y"))
    return rows.withColumn("utm_source", F.when(ah, "ah").when(csa, "csa")).withColumn("_ll", ll).withColumn(
        "x", F.col("_ll.lon")
    ).withColumn("y", F.col("_ll.lat")).drop("_ll")


def utm_fallback(rows: DataFrame, polygons: DataFrame, how: str = "inner") -> DataFrame:
    """Containing polygon of the projected place, else the nearest however far."""
    placed = cut(utm_source(rows.drop("x", "y")))
    located = S.nearest_sites(S.sites_of(placed), polygons)
    out = placed.join(large(located), ["comuna", "x", "y"], how)
    label = F.concat(F.col("utm_source"), F.when(F.col("inside"), "_utm_pip").otherwise("_utm_nearest"))
    return _result(out, label, S.DEGREES.metres_of(F.col("dist_q"))).drop("inside", "dist_q")


def centroid_points(polygons: DataFrame, *also: Column) -> DataFrame:
    c = G.centroid(F.col("shell"), F.col("holes"))
    return polygons.select("comuna", "poly_idx", c.alias("_c"), *also).select(
        "comuna", "poly_idx", "_c.x", "_c.y", *[F.col(a) for a in polygons.select(*also).columns]
    )


def number_read_match(
    reads: DataFrame, polygons: DataFrame, placed: DataFrame, unmatched: DataFrame,
    min_area_m2: float = C.NUMBER_READ_MIN_AREA_M2,
) -> DataFrame:
    """Unused polygons with a number read in them name a parcel of the nearest placed block.

    Returns (comuna, manzana, predio, poly_idx), a parcel claimed by its lowest polygon.
    """
    big = M.degree_area_m2(G.area(F.col("shell"), F.col("holes"))) >= min_area_m2
    home = cut(I.first_donor(placed, ["comuna", "poly_idx"], ["manzana"], ORDER))
    centres = cut(centroid_points(polygons, big.alias("big")))
    read = reads.where(F.col("number").between(1, C.NUMBER_READ_LAST))
    asking = centres.where("big").join(large(home), ["comuna", "poly_idx"], "left_anti").join(large(read), ["comuna", "poly_idx"])
    # nearest placed centroid, as polygons that have shrunk to one point
    point = F.struct("x", "y")
    spots = centres.join(large(home), ["comuna", "poly_idx"], "left_semi").select(
        "comuna", "poly_idx", F.array(point, point).alias("shell"), G.no_holes().alias("holes")
    )
    located = S.nearest_sites(S.sites_of(asking), spots).select(
        "comuna", "x", "y", F.col("poly_idx").alias("_near")
    )
    named = (
        asking.join(large(located), ["comuna", "x", "y"])
        .join(large(home.withColumnRenamed("poly_idx", "_near")), ["comuna", "_near"])
        .select("comuna", "manzana", K.zfill(F.col("number").cast("string")).alias("predio"), "poly_idx")
    )
    return named.groupBy(*KEY).agg(F.min("poly_idx").alias("poly_idx")).join(large(unmatched.select(*KEY)), KEY, "left_semi")


def recover(matched: DataFrame, polygons: DataFrame, reads: DataFrame | None = None) -> DataFrame:
    """Later stages for the rows a cascade left: projected place, nearest however far, number
    read, same address; what is left is labelled ``sin_resultado``.

    ``matched`` is a cascade result with the ``ah_utm_*`` and ``csa_utm_*`` columns joined on.
    """
    before = cut(matched)
    cascade = Cascade(before.where("poly_idx is null").drop(*RESULT))
    cascade.columns = [c for c in matched.columns if c not in RESULT]
    cascade.done.append(before.where("poly_idx is not null").select(*cascade.columns, *RESULT))

    def by_utm(rows: DataFrame) -> DataFrame:
        kept = rows.withColumnsRenamed({"x": "_x", "y": "_y"})
        return utm_fallback(kept, polygons, "left").drop("x", "y").withColumnsRenamed({"_x": "x", "_y": "y"})

    def by_place(rows: DataFrame) -> DataFrame:
        located = S.nearest_sites(S.sites_of(rows), polygons)
        return _result(
            rows.join(large(located), ["comuna", "x", "y"], "left"), "nearest_unlimited", S.DEGREES.metres_of(F.col("dist_q"))
        )

    def by_number(rows: DataFrame) -> DataFrame:
        named = number_read_match(reads, polygons, cascade.placed(), rows)
        return _result(rows.join(large(named), KEY, "left"), "ocr_orphan")

    cascade.stage(by_utm)
    cascade.stage(by_place)
    if reads is not None:
        cascade.stage(by_number)
    cascade.stage(lambda rows: _result(I.inherit_address(rows, cascade.placed(), ORDER, "left"), "address_inheritance"))
    return cascade.result("sin_resultado")


def attach_geometry(matched: DataFrame, polygons: DataFrame) -> DataFrame:
    """Polygon shape and area by index, last, so that only narrow rows shuffle before it."""
    shapes = polygons.select(
        "comuna", "poly_idx", "shell", "holes",
        M.degree_area_m2(G.area(F.col("shell"), F.col("holes"))).alias("pol_area_m2"),
    )
    return matched.join(large(shapes), ["comuna", "poly_idx"], "left")


def orphan_polygons(matched: DataFrame, polygons: DataFrame) -> DataFrame:
    """Polygons no parcel uses."""
    used = matched.where("poly_idx is not null").select("comuna", "poly_idx").distinct()
    return polygons.join(large(used), ["comuna", "poly_idx"], "left_anti")


def append_orphans(matched: DataFrame, polygons: DataFrame, label: str = "unmatched_polygon") -> DataFrame:
    """The matched rows plus one attribute-less row per unclaimed polygon."""
    extra = attach_geometry(orphan_polygons(matched, polygons).select("comuna", "poly_idx"), polygons).withColumn(
        "match_method", F.lit(label)
    )
    return matched.unionByName(extra, allowMissingColumns=True)
