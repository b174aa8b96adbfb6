"""Polygon-on-polygon joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deslinde import constants as C
from deslinde.functions import geometry as G
from deslinde.functions.shapes import intersection_area, simplify
from deslinde.operators import spatial as S
from deslinde.session import large

BOX = ["minx", "miny", "maxx", "maxy"]


def _leveled(boxed: DataFrame, metric: S.Metric) -> DataFrame:
    width = F.greatest(F.col("maxx") - F.col("minx"), F.col("maxy") - F.col("miny"))
    return boxed.withColumn("_own", S.box_level(width, metric.cell))


def _levels(df: DataFrame) -> list[int]:
    return S.levels_in_use(df.select(F.col("_own").alias("_level")))


def _celled(df: DataFrame, others: list[int], metric: S.Metric) -> DataFrame:
    """Cells at the own level and at the coarser levels the other side uses."""
    coarser = F.filter(F.array(*[F.lit(v) for v in others]).cast("array<int>"), lambda v: v > F.col("_own"))
    at = df.withColumn("_at", F.explode(F.concat(F.array("_own"), coarser)))
    return S.explode_cells(at, F.col("_at"), 0.0, metric.cell).drop("_at")


def box_pairs(a: DataFrame, b: DataFrame, metric: S.Metric = S.DEGREES) -> DataFrame:
    """Pairs whose boxes share area, each once: a's columns as ``a_*``, b's as ``b_*``.

    A pair meets at the coarser of the two levels, in the cell of the lower left corner of
    the common box.
    """
    la, lb = _leveled(S.with_bounds(a), metric), _leveled(S.with_bounds(b), metric)
    side = lambda df, p, others: _celled(df, others, metric).select(
        "comuna", "_level", "_cx", "_cy", *[F.col(c).alias(p + c) for c in ("_own", "poly_idx", "shell", "holes", *BOX)]
    )
    pairs = side(la, "a_", _levels(lb)).join(large(side(lb, "b_", _levels(la))), ["comuna", "_level", "_cx", "_cy"])
    x, y = F.greatest("a_minx", "b_minx"), F.greatest("a_miny", "b_miny")
    lv = F.col("_level")
    return pairs.where(
        (lv == F.greatest("a__own", "b__own"))
        & (x < F.least("a_maxx", "b_maxx")) & (y < F.least("a_maxy", "b_maxy"))
        & (F.col("_cx") == S.cell_of(x, lv, metric.cell)) & (F.col("_cy") == S.cell_of(y, lv, metric.cell))
    ).drop("_level", "_cx", "_cy", "a__own", "b__own")


def _share() -> Column:
    """Part of polygon a that b covers. Rounded, so that exactly a half stays a half."""
    shells = [F.col(c) for c in ("a_shell", "a_holes", "b_shell", "b_holes")]
    whole = G.area(F.col("a_shell"), F.col("a_holes"))
    return F.round(intersection_area(*shells) / F.greatest(whole, F.lit(1e-12)), 9)


def overlap_shares(a: DataFrame, b: DataFrame, metric: S.Metric = S.DEGREES) -> DataFrame:
    """(comuna, a_idx, b_idx, share) of all pairs with a common area."""
    shares = box_pairs(a, b, metric).select(
        "comuna", F.col("a_poly_idx").alias("a_idx"), F.col("b_poly_idx").alias("b_idx"), _share().alias("share")
    )
    return shares.where("share > 0")


def overlap_dedup(urban: DataFrame, agri: DataFrame, limit: float = C.OVERLAP_DROP) -> DataFrame:
    """All urban polygons and the agricultural ones none of them covers by more than ``limit``."""
    covered = overlap_shares(agri, urban).where(F.col("share") > limit).select(
        "comuna", F.col("a_idx").alias("poly_idx")
    ).distinct()
    kept = agri.join(large(covered), ["comuna", "poly_idx"], "left_anti")
    return urban.withColumn("layer", F.lit("urban")).unionByName(kept.withColumn("layer", F.lit("agri")))


def joint_index(layers: DataFrame) -> DataFrame:
    """Rows (layer, comuna, poly_idx, ...) under one index a commune: urban polygons from 0 in their order, then the others.

    Only keys are sorted; shapes are joined by them.
    """
    keys = layers.select("comuna", "layer", F.col("poly_idx").alias("_old"))
    order = Window.partitionBy("comuna").orderBy(F.col("layer") != "urban", "layer", "_old")
    keys = keys.withColumn("_new", (F.row_number().over(order) - 1).cast(layers.schema["poly_idx"].dataType))
    joined = layers.withColumnRenamed("poly_idx", "_old").join(large(keys), ["comuna", "layer", "_old"])
    return joined.drop("_old").withColumnRenamed("_new", "poly_idx")


def overlap_used(placed: DataFrame, polygons: DataFrame, limit: float = C.OVERLAP_USED) -> DataFrame:
    """Polygons that a placed shape, by its centroid, fills by more than ``limit``: (comuna, poly_idx).

    The lowest such polygon of each shape counts.
    """
    c = G.centroid(F.col("shell"), F.col("holes"))
    shapes = placed.select(
        "comuna", F.col("poly_idx").alias("a_poly_idx"), F.col("shell").alias("a_shell"), F.col("holes").alias("a_holes"),
        c.alias("_c"),
    ).select("comuna", "a_poly_idx", "a_shell", "a_holes", F.col("_c.x").alias("x"), F.col("_c.y").alias("y"))
    pairs = S.candidates(shapes, polygons, S.DEGREES).withColumnsRenamed({"shell": "b_shell", "holes": "b_holes"})
    filled = pairs.withColumn("share", _share()).where(F.col("share") > limit)
    return filled.groupBy("comuna", "a_poly_idx").agg(F.min("poly_idx").alias("poly_idx")).select("comuna", "poly_idx").distinct()


def simplify_layer(rows: DataFrame) -> DataFrame:
    """Thin out the outlines, orphans more than matched ones, and flag what is not sound after."""
    orphan = F.coalesce(F.col("match_method") == "unmatched_polygon", F.lit(False))
    tolerance = F.when(orphan, C.SIMPLIFY_ORPHAN_DEGREES).otherwise(C.SIMPLIFY_MATCHED_DEGREES)
    thin = rows.withColumn(
        "_s", F.when(G.has_geometry(F.col("shell")), simplify(F.col("shell"), F.col("holes"), tolerance))
    )
    return (
        thin.withColumn("shell", F.col("_s.shell")).withColumn("holes", F.col("_s.holes")).drop("_s")
        .withColumn("problem", F.when(F.col("shell").isNotNull(), G.ring_problem(F.col("shell"))))
    )
