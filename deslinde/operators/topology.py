"""Simplification that keeps neighbours together.

Rings are cut at nodes, where other than two edges meet, into arcs; an arc shared by neighbours is one row, is
simplified once and goes back into the rings of both, so no gap or overlap can come between them. Polygons that
would not be sound afterwards get the arcs they had, and so do their neighbours there.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from deslinde import constants as C
from deslinde.functions import geometry as G
from deslinde.functions.shapes import simplify_line
from deslinde.functions.validity import unsound
from deslinde.session import cut, large

KEY = ["comuna", "poly_idx"]


@F.pandas_udf(ArrayType(DoubleType()))
def _line_udf(lines: pd.Series, tolerance: pd.Series) -> pd.Series:
    return pd.Series([simplify_line(np.asarray(p, dtype=float).reshape(-1, 2), t).ravel() for p, t in zip(lines, tolerance)])


_line_udf = _line_udf.asNondeterministic()


def _nodes(rings: DataFrame) -> DataFrame:
    """(comuna, p): vertices where other than two different edges meet."""
    one = lambda e, a: F.struct(e[a + "x"].alias("x"), e[a + "y"].alias("y"))
    ends = F.transform(G.edges(F.col("pts")), lambda e: F.array_sort(F.array(one(e, "a"), one(e, "b"))))
    edges = rings.select("comuna", F.explode(ends).alias("e")).distinct()
    return edges.select("comuna", F.explode("e").alias("p")).groupBy("comuna", "p").count().where(F.col("count") != 2).select("comuna", "p")


def _arcs_of(points: Column, nodes: Column) -> Column:
    """Arcs of a ring (its vertices without the last) between the places ``nodes``; without any, all of it from its least vertex."""
    n, twice = F.size(points), F.concat(points, points)
    starts = F.when(F.size(nodes) > 0, nodes).otherwise(F.array((F.array_position(points, F.array_min(points)) - 1).cast("int")))
    ends = F.concat(F.slice(starts, F.lit(2), F.size(starts) - 1), F.array(starts[0] + n))
    return F.zip_with(starts, ends, lambda a, b: F.slice(twice, a + 1, b - a + 1))


def shared_arcs(polygons: DataFrame) -> DataFrame:
    """(comuna, poly_idx, ring, at, turned, arc, pts): the arcs of every ring in order; ``arc`` is the same wherever it is used.

    ``pts`` runs in the arc's own direction, ``turned`` tells whether the ring takes it the other way. ``polygons`` is
    (comuna, poly_idx, shell, holes).
    """
    rings = polygons.where(G.has_geometry(F.col("shell"))).select(
        *KEY, F.posexplode(F.concat(F.array("shell"), F.coalesce("holes", G.no_holes()))).alias("ring", "pts")
    )
    rings = cut(rings.where(F.size("pts") > 3))
    vertices = rings.select(*KEY, "ring", F.posexplode(F.slice("pts", F.lit(1), F.size("pts") - 1)).alias("pos", "p"))
    at_nodes = vertices.join(large(_nodes(rings)), ["comuna", "p"]).groupBy(*KEY, "ring").agg(F.array_sort(F.collect_list("pos")).alias("_nodes"))
    joined = rings.join(large(at_nodes), [*KEY, "ring"], "left").withColumn("_nodes", F.coalesce("_nodes", F.array().cast("array<int>")))
    arcs = joined.select(*KEY, "ring", F.posexplode(_arcs_of(F.slice("pts", F.lit(1), F.size("pts") - 1), F.col("_nodes"))).alias("at", "_p"))
    first, last = F.struct(F.col("_p")[0].alias("a"), F.col("_p")[1].alias("b")), F.struct(F.element_at("_p", -1).alias("a"), F.element_at("_p", -2).alias("b"))
    arcs = arcs.withColumn("turned", last < first)
    return arcs.select(*KEY, "ring", "at", "turned", F.least(first, last).alias("arc"), F.when(F.col("turned"), F.reverse("_p")).otherwise(F.col("_p")).alias("pts"))


def _assembled(uses: DataFrame, arcs: DataFrame) -> DataFrame:
    """(comuna, poly_idx, shell, holes) from the arcs that rings use."""
    met = uses.join(large(arcs), ["comuna", "arc"])
    taken = F.when(F.col("turned"), F.reverse("pts")).otherwise(F.col("pts"))
    rings = met.groupBy(*KEY, "ring").agg(F.array_sort(F.collect_list(F.struct("at", F.slice(taken, F.lit(1), F.size("pts") - 1).alias("p")))).alias("_a"))
    open_ = F.flatten(F.transform("_a", lambda a: a["p"]))
    rings = rings.select(*KEY, "ring", F.concat(open_, F.slice(open_, 1, 1)).alias("r"))
    made = rings.groupBy(*KEY).agg(F.array_sort(F.collect_list(F.struct("ring", "r"))).alias("_r"))
    return made.select(*KEY, F.col("_r")[0]["r"].alias("shell"), F.transform(F.slice("_r", F.lit(2), F.size("_r") - 1), lambda r: r["r"]).alias("holes"))


def simplify_topology(rows: DataFrame, tolerance: Column | None = None) -> DataFrame:
    """Rows (comuna, poly_idx, shell, holes, ...) with thinner outlines: neighbours keep their common borders, holes stay inside.

    A shared arc goes by the finer tolerance of its users; by default orphans are thinned more than matched polygons. A key
    is unique; rows without a shell stay as they are. What was sound stays sound: a polygon that would not be takes its arcs
    as they were, which its neighbours then do too, until all are.
    """
    if tolerance is None:
        orphan = F.coalesce(F.col("match_method") == "unmatched_polygon", F.lit(False))
        tolerance = F.when(orphan, C.SIMPLIFY_ORPHAN_DEGREES).otherwise(C.SIMPLIFY_MATCHED_DEGREES)
    shapes = rows.select(*KEY, "shell", "holes", tolerance.alias("_t"))
    uses = cut(shared_arcs(shapes))
    limits = uses.join(large(shapes.select(*KEY, "_t")), KEY).groupBy("comuna", "arc").agg(F.min("_t").alias("t"), F.first("pts").alias("old"))
    flat = F.flatten(F.transform("old", lambda p: F.array(p["x"], p["y"])))
    thin = limits.withColumn("_l", _line_udf(flat, F.col("t")))
    pairs = F.transform(F.sequence(F.lit(0), (F.size("_l") / 2).cast("int") - 1), lambda i: F.struct(F.col("_l")[i * 2].alias("x"), F.col("_l")[i * 2 + 1].alias("y")))
    arcs = cut(thin.select("comuna", "arc", "old", pairs.alias("pts"), F.lit(False).alias("exact")))
    uses = cut(uses.drop("pts"))
    done, pending = None, uses
    while True:
        made = cut(_assembled(pending, arcs.select("comuna", "arc", "pts")).withColumn("_bad", unsound(F.col("shell"), F.col("holes"))))
        bad = uses.join(large(made.where("_bad").select(*KEY)), KEY).select("comuna", "arc").distinct()
        again = cut(bad.join(large(arcs.where("not exact").select("comuna", "arc")), ["comuna", "arc"]).withColumn("_again", F.lit(True)))
        touched = cut(uses.join(large(again), ["comuna", "arc"], "left_semi").select(*KEY).distinct())
        done = made.drop("_bad") if done is None else done.join(large(made.select(*KEY)), KEY, "left_anti").unionByName(made.drop("_bad"))
        if not again.take(1):
            break
        arcs = cut(
            arcs.join(large(again), ["comuna", "arc"], "left")
            .withColumn("pts", F.when(F.col("_again"), F.col("old")).otherwise(F.col("pts")))
            .withColumn("exact", F.col("exact") | F.col("_again").isNotNull()).drop("_again")
        )
        pending = uses.join(large(touched), KEY, "left_semi")
    thinned = done.withColumnsRenamed({"shell": "_shell", "holes": "_holes"})
    return (
        rows.join(large(thinned), KEY, "left").withColumn("shell", F.coalesce("_shell", "shell"))
        .withColumn("holes", F.when(F.col("_shell").isNotNull(), F.col("_holes")).otherwise(F.col("holes"))).drop("_shell", "_holes")
    )
