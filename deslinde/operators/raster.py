"""Raster tiles to parcel regions, worked on runs of pixels.

A tile is (tx, ty, size, rgba): ``size`` x ``size`` RGBA bytes whose pixel (0, 0) is pixel
(tx * size, ty * size) of one global grid. Reading the bytes is the only Python step; it
turns a tile into runs (cls, tile_x, y, x0, x1), and everything after is joins on runs.
Since the grid is global, nothing has to be mosaicked and no seam has to be merged.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deslinde import constants as C
from deslinde.functions import coords as M
from deslinde.functions import geometry as G
from deslinde.functions import intervals as I
from deslinde.operators.graph import connected_components
from deslinde.session import cut, large

RUN = "cls string, tile_x bigint, y bigint, x0 bigint, x1 bigint"
PIXEL_M = M.TILE_M / C.TILE_PX


def class_masks(rgba: np.ndarray) -> dict[str, np.ndarray]:
    """Boolean masks per pixel class of a stack of images (n, h, w, 4)."""
    red, alpha = rgba[..., 0], rgba[..., 3]
    opaque = alpha == C.OPAQUE
    return {
        "urban_fill": (red >= C.URBAN_RED_MIN) & (red <= C.URBAN_RED_MAX) & opaque,
        "urban_border": (red < C.URBAN_RED_MIN) & opaque,
        "agri_fill": alpha == C.AGRI_ALPHA,
        "agri_border": alpha > C.AGRI_ALPHA,
        "exact_fill": red == C.EXACT_RED,
        "visible": alpha > 0,
    }


def mask_runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Image, row, first and last column of the horizontal runs of a stack of masks (n, h, w)."""
    padded = np.zeros((*mask.shape[:2], mask.shape[2] + 2), dtype=np.int8)
    padded[:, :, 1:-1] = mask
    step = np.diff(padded, axis=2)
    image, y, start = np.nonzero(step == 1)
    return image, y, start, np.nonzero(step == -1)[2] - 1


PIXELS_AT_ONCE = 4_000_000


def _stack_runs(tiles: pd.DataFrame, size: int) -> Iterator[pd.DataFrame]:
    """Runs of tiles of one size, a few million pixels at a time."""
    at_once = max(1, PIXELS_AT_ONCE // (size * size))
    for i in range(0, len(tiles), at_once):
        part = tiles.iloc[i : i + at_once]
        images = np.frombuffer(b"".join(part.rgba), dtype=np.uint8).reshape(len(part), size, size, 4)
        tx, ty = part.tx.to_numpy(), part.ty.to_numpy()
        for cls, mask in class_masks(images).items():
            n, y, a, b = mask_runs(mask)
            yield pd.DataFrame({
                "cls": cls, "tile_x": tx[n], "y": y + ty[n] * size, "x0": a + tx[n] * size, "x1": b + tx[n] * size
            })


def _tile_runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for size, tiles in batch.groupby("size"):
            yield from _stack_runs(tiles, int(size))


def pixel_runs(tiles: DataFrame) -> DataFrame:
    """Runs of every pixel class; a run never leaves its tile."""
    return tiles.select("tx", "ty", "size", "rgba").mapInPandas(_tile_runs, RUN)


# --- blocks -------------------------------------------------------------------------------


def block_ids(at: Column, origin: Column, block: int, step: int) -> Column:
    """Starts of the overlapping blocks, ``step`` apart from ``origin``, that hold position ``at``."""
    last = F.floor((at - origin) / step)
    first = F.greatest(F.lit(0), F.floor((at - origin - block) / step) + 1)
    return F.transform(F.sequence(first, last), lambda i: origin + i * step)


def blocks_in(size: int) -> tuple[int, int]:
    """The side of a block and the step to the next one, in images of ``size`` pixels."""
    return max(1, C.BLOCK_TILES * C.TILE_PX // size), max(1, C.BLOCK_STEP_TILES * C.TILE_PX // size)


def assign_blocks(
    cells: DataFrame, block: int = C.BLOCK_TILES, step: int = C.BLOCK_STEP_TILES, origin: tuple[Column, Column] | None = None
) -> DataFrame:
    """One row per (cell, block) for cells (sc_x, sc_y); up to four blocks hold a cell.

    Blocks start from ``origin``, or else from the smallest cell of the set, one row the join with it adds to all.
    """
    if origin is not None:
        ids = lambda c, o: F.explode(block_ids(F.col(c), o, block, step))
        return cells.withColumn("bx", ids("sc_x", origin[0])).withColumn("by", ids("sc_y", origin[1]))
    low = cells.agg(F.min("sc_x").alias("x"), F.min("sc_y").alias("y")).first()
    if low is None or low.x is None:
        return cells.select("*", F.lit(0).cast("bigint").alias("bx"), F.lit(0).cast("bigint").alias("by")).limit(0)
    ids = lambda c, origin: F.explode(block_ids(F.col(c), F.lit(origin), block, step))
    return cells.withColumn("bx", ids("sc_x", low.x)).withColumn("by", ids("sc_y", low.y))


def raster_windows(sizes: DataFrame, block: int = 16384, overlap: int = 128, least: int = 256) -> DataFrame:
    """Block windows (col, row, w, h) of rasters (raster, width, height); slivers are left out.

    One narrow step. Starts end where a sliver would begin, so no window is made and dropped, and rasters are wide: the
    columns, which are many, are the inner list and the rows the outer one.
    """
    step = block - overlap
    count = lambda c: F.col(c).cast("bigint")
    starts = lambda c: F.explode(F.sequence(F.lit(0).cast("bigint"), count(c) - max(least, 1), F.lit(step).cast("bigint")))
    wins = sizes.where((count("width") >= max(least, 1)) & (count("height") >= max(least, 1))).where(F.lit(block >= least))
    wins = wins.withColumn("row", starts("height")).withColumn("h", F.least(F.lit(block), F.col("height") - F.col("row")))
    return wins.withColumn("col", starts("width")).withColumn("w", F.least(F.lit(block), F.col("width") - F.col("col"))).select(
        *sizes.columns, "col", "row", "w", "h"
    )


def block_gates(
    runs: DataFrame, size: int, block: int | None = None, step: int | None = None, origin: tuple[Column, Column] | None = None
) -> DataFrame:
    """Pixel counts per block and which classes it is worth vectorising; blocks are measured in images of ``size``."""
    block, step = block or blocks_in(size)[0], step or blocks_in(size)[1]
    tiles = runs.groupBy("tile_x", F.floor(F.col("y") / size).alias("tile_y")).agg(
        *[F.sum(F.when(F.col("cls") == c, F.col("x1") - F.col("x0") + 1).otherwise(0)).alias(c)
          for c in ("visible", "urban_fill", "agri_fill", "agri_border")]
    )
    placed = assign_blocks(tiles.withColumnsRenamed({"tile_x": "sc_x", "tile_y": "sc_y"}), block, step, origin)
    sums = placed.groupBy("bx", "by").agg(*[F.sum(c).alias(c) for c in ("visible", "urban_fill", "agri_fill", "agri_border")])
    seen = F.col("visible") >= C.GATE_OPAQUE_PX
    return sums.withColumn("urban_ok", seen & (F.col("urban_fill") > C.GATE_URBAN_FILL_PX)).withColumn(
        "agri_ok", seen & (F.col("agri_fill") > C.GATE_AGRI_FILL_PX) & (F.col("agri_border") > C.GATE_AGRI_BORDER_PX)
    )


# --- interiors ----------------------------------------------------------------------------


def _grown(border: DataFrame, steps: int, size: int) -> DataFrame:
    """Border runs grown by ``steps`` 4-neighbour dilations, cut again at tile edges."""
    dy = F.sequence(F.lit(-steps), F.lit(steps))
    rows = border.withColumn("_dy", F.explode(dy)).withColumn("_r", F.lit(steps) - F.abs("_dy"))
    rows = rows.select((F.col("y") + F.col("_dy")).alias("y"), (F.col("x0") - F.col("_r")).alias("a"), (F.col("x1") + F.col("_r")).alias("b"))
    tiled = rows.withColumn("tile_x", F.explode(F.sequence(F.floor(F.col("a") / size), F.floor(F.col("b") / size))))
    return tiled.select(
        "tile_x", "y", F.greatest("a", F.col("tile_x") * size).alias("a"),
        F.least("b", (F.col("tile_x") + 1) * size - 1).alias("b"),
    )


def subtract_runs(fill: DataFrame, cut_out: DataFrame) -> DataFrame:
    """Fill runs (tile_x, y, x0, x1) without the intervals (tile_x, y, a, b).

    The intervals gathered per key are those of one pixel row of one tile.
    """
    holes = cut_out.groupBy("tile_x", "y").agg(F.array_sort(F.collect_set(F.struct("a", "b"))).alias("_h"))
    joined = fill.join(large(holes), ["tile_x", "y"], "left")
    left = I.pieces_left(F.col("x0"), F.col("x1"), F.coalesce(F.col("_h"), I.none()))
    return joined.select("tile_x", "y", F.explode(left).alias("_p")).select(
        "tile_x", "y", F.col("_p.a").alias("x0"), F.col("_p.b").alias("x1")
    )


def interior_runs(runs: DataFrame, size: int, urban_steps: int = C.URBAN_DILATION, agri_steps: int = C.AGRI_DILATION) -> DataFrame:
    """Fill minus dilated border, per kind: the pixels that become parcels."""
    out = None
    for kind, steps in (("urban", urban_steps), ("agri", agri_steps)):
        fill = runs.where(F.col("cls") == f"{kind}_fill").drop("cls")
        border = runs.where(F.col("cls") == f"{kind}_border")
        left = subtract_runs(fill, _grown(border, steps, size)).select(F.lit(kind).alias("cls"), "tile_x", "y", "x0", "x1")
        out = left if out is None else out.unionByName(left)
    return out


# --- components -----------------------------------------------------------------------------


def with_run_id(runs: DataFrame) -> DataFrame:
    """A run's id is its first pixel's place on the grid (28 bits per axis) and its class."""
    kind = F.when(F.col("cls") == "urban", 0).otherwise(1)
    return runs.withColumn("id", F.shiftleft(F.shiftleft(F.col("y"), 28).bitwiseOR(F.col("x0")), 1).bitwiseOR(kind.cast("bigint")))


def run_edges(runs: DataFrame) -> DataFrame:
    """Pairs (u, v) of touching runs: one above the other inside a tile, or side by side at a tile edge."""
    below = runs.select("cls", "tile_x", (F.col("y") - 1).alias("y"), F.col("x0").alias("bx0"), F.col("x1").alias("bx1"), F.col("id").alias("v"))
    stacked = runs.join(large(below), ["cls", "tile_x", "y"]).where("x0 <= bx1 and bx0 <= x1")
    right = runs.select("cls", "y", (F.col("x0") - 1).alias("x1"), F.col("id").alias("v"))
    beside = runs.join(large(right), ["cls", "y", "x1"])
    return stacked.select(F.col("id").alias("u"), "v").unionByName(beside.select(F.col("id").alias("u"), "v"))


SQUARE_PX = 1024  # tiles smaller than this go together into one Python step


def _tile_roots(tiles: pd.DataFrame, size: int) -> pd.DataFrame:
    """The runs of one class and some tiles, with the smallest id of the region they form inside their tile."""
    tiles = tiles.assign(_ty=tiles.y // size).sort_values(["_ty", "tile_x", "y", "x0"], ignore_index=True)
    tx, ty, y, x0, x1, ids = (tiles[c].to_numpy() for c in ("tile_x", "_ty", "y", "x0", "x1", "id"))
    nth = np.cumsum(np.r_[0, (np.diff(tx) != 0) | (np.diff(ty) != 0)])
    row, width = nth * (size + 1) + y - ty * size, size + 2  # an empty row between tiles
    first, last = row * width + x0 - tx * size, row * width + x1 - tx * size  # both ascend, as runs of a row are apart
    low = np.searchsorted(last, first + width, "left")
    high = np.searchsorted(first, last + width, "right")
    times = np.maximum(high - low, 0)
    u = np.repeat(np.arange(len(tiles)), times)
    v = np.repeat(low, times) + np.arange(len(u)) - np.repeat(np.cumsum(times) - times, times)
    root = np.arange(len(tiles))  # rows of a tile ascend with ids, so the smallest place is the smallest id
    while True:
        small = np.minimum(root[u], root[v])
        before = root.copy()
        np.minimum.at(root, root[u], small)
        np.minimum.at(root, root[v], small)
        while (root[root] != root).any():
            root = root[root]
        if (root == before).all():
            return tiles.drop(columns="_ty").assign(root=ids[root])


def label_components(runs: DataFrame, size: int | None = None) -> DataFrame:
    """Runs with the ``label`` of their 4-connected region: the id of its first run.

    With the tile's ``size`` regions are found inside each tile first, a square of small tiles at a time,
    and only what touches across tile edges is contracted over the whole plane: work there follows
    the seams and not the area.
    """
    ided = with_run_id(runs)
    if size is None:
        labels = connected_components(run_edges(ided))
        return ided.join(large(labels), "id", "left").withColumn("label", F.coalesce("label", "id"))
    fields = "cls string, tile_x bigint, y bigint, x0 bigint, x1 bigint, id bigint, root bigint"
    side_px = max(1, SQUARE_PX // size) * size
    square = [F.floor(F.col("tile_x") * size / side_px).alias("_sx"), F.floor(F.col("y") / side_px).alias("_sy")]
    rooted = cut(
        ided.select("cls", "tile_x", "y", "x0", "x1", "id").groupBy("cls", *square)
        .applyInPandas(lambda tiles: _tile_roots(tiles, size), fields)
    )
    edge = lambda c, side: F.col(c) % size == side
    upper = rooted.where(edge("y", size - 1)).select("cls", "tile_x", (F.col("y") + 1).alias("y"), F.col("x0").alias("a"), F.col("x1").alias("b"), F.col("root").alias("u"))
    lower = rooted.where(edge("y", 0)).select("cls", "tile_x", "y", "x0", "x1", F.col("root").alias("v"))
    over = upper.join(large(lower), ["cls", "tile_x", "y"]).where("a <= x1 and x0 <= b").select("u", "v")
    west = rooted.where(edge("x1", size - 1)).select("cls", "y", (F.col("x1") + 1).alias("x"), F.col("root").alias("u"))
    east = rooted.where(edge("x0", 0)).select("cls", "y", F.col("x0").alias("x"), F.col("root").alias("v"))
    seams = over.unionByName(west.join(large(east), ["cls", "y", "x"]).select("u", "v")).distinct()
    labels = connected_components(seams).withColumnRenamed("id", "root")
    return rooted.join(large(labels), "root", "left").withColumn("label", F.coalesce("label", "root")).drop("root")


def component_measures(labelled: DataFrame, pixel_m: float = PIXEL_M) -> DataFrame:
    """Size and box of every region."""
    return labelled.groupBy("label", "cls").agg(
        F.sum(F.col("x1") - F.col("x0") + 1).alias("pixels"), F.min("x0").alias("px0"), F.min("y").alias("py0"),
        F.max("x1").alias("px1"), F.max("y").alias("py1"),
    ).withColumn("area_m2", F.col("pixels") * float(pixel_m) * float(pixel_m))


def in_area_band(measures: DataFrame, min_final: float | None = None) -> DataFrame:
    """Regions of a size their kind allows; ``min_final`` adds the floor of the finished layer."""
    a, urban = F.col("area_m2"), F.col("cls") == "urban"
    kept = measures.where((urban & a.between(*C.URBAN_AREA_M2)) | (~urban & (a >= C.AGRI_MIN_AREA_M2)))
    return kept if min_final is None else kept.where(a >= min_final)


# --- outlines --------------------------------------------------------------------------------

CHAIN_PX = 512  # corners are chained inside squares of this side before chains are linked


def outline_corners(labelled: DataFrame) -> DataFrame:
    """Corners of the outlines of regions and what follows each: (label, id, x, y, nxt), region on the right.

    A corner is where the borders between pixels of the row above and of the row below differ; run ends that meet at
    a tile edge cancel. On a line the corners are ends of sides in turn, so the partner of each is beside it. Where two
    pixels of a region touch by their corners, each has a corner of its own there.
    """
    runs = labelled.select("label", "y", "x0", "x1")
    side = lambda x, way: F.struct(x.alias("x"), F.lit(way).alias("way"))
    ends = runs.select("label", "y", F.explode(F.array(side(F.col("x0"), 1), side(F.col("x1") + 1, -1))).alias("s"))
    ends = ends.select("label", "s.x", "s.way", F.explode(F.array(F.struct("y", F.lit(False).alias("up")), F.struct((F.col("y") + 1).alias("y"), F.lit(True).alias("up")))).alias("e"))
    total = lambda up: F.sum(F.when(F.col("e.up") == up, F.col("way")).otherwise(0))
    met = ends.groupBy("label", "e.y", "x").agg(total(True).alias("a"), total(False).alias("b")).where("a <> b")
    a, b = F.col("a"), F.col("b")
    corner = lambda k, up: F.struct(F.lit(k).alias("k"), up.alias("up"), F.when(up, a).otherwise(b).alias("way"))
    both = F.array(corner(0, a < 0), corner(1, a > 0))
    corners = met.withColumn("c", F.explode(F.when((a != 0) & (b != 0), both).otherwise(F.array(corner(0, a != 0)))))
    place = F.shiftleft(F.shiftleft(F.col("y"), 28).bitwiseOR(F.col("x")), 1).bitwiseOR(F.col("c.k").cast("bigint"))
    corners = corners.select("label", place.alias("id"), "x", "y", "c.up", "c.way")
    row, column = Window.partitionBy("label", "y").orderBy("id"), Window.partitionBy("label", "x").orderBy("y", F.desc("up"))
    along = F.when(F.row_number().over(row) % 2 == 1, F.lead("id").over(row)).otherwise(F.lag("id").over(row))
    across = F.when(F.col("up"), F.lag("id").over(column)).otherwise(F.lead("id").over(column))
    nxt = F.when(F.col("up") == (F.col("way") < 0), F.col("_along")).otherwise(F.col("_across"))
    return corners.withColumn("_along", along).withColumn("_across", across).select("label", "id", "x", "y", nxt.alias("nxt"))


def _ahead(nxt: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By pointer doubling over places (-1: none follows): the last place reached, the steps to it, the least place on the way."""
    low, to, steps = np.arange(len(nxt)), np.where(nxt < 0, np.arange(len(nxt)), nxt), (nxt >= 0).astype(np.int64)
    for _ in range(len(nxt).bit_length()):
        low, steps, to = np.minimum(low, low[to]), steps + steps[to], to[to]
    return to, steps, low


def _chains(square: pd.DataFrame) -> pd.DataFrame:
    """Corners of one square with the chain each is on (named by its first corner), its place there, and what follows the chain."""
    keys = pd.MultiIndex.from_arrays([square.label, square.id])
    nxt = keys.get_indexer(pd.MultiIndex.from_arrays([square.label, square.nxt]))
    last, _, low = _ahead(nxt)
    closed = nxt[last] >= 0  # a ring inside the square; it is opened before its first corner
    last, steps, _ = _ahead(np.where(closed & (nxt == low), -1, nxt))
    length = np.bincount(last, minlength=len(nxt))[last]
    pos, heads = length - 1 - steps, np.empty(len(nxt), np.int64)
    heads[last[pos == 0]] = np.flatnonzero(pos == 0)
    after = pd.Series(square.nxt.to_numpy()[last], dtype="Int64").mask(closed)
    return pd.DataFrame({
        "label": square.label, "chain": square.id.to_numpy()[heads[last]], "pos": pos, "n": length,
        "x": square.x, "y": square.y, "after": after.to_numpy(),
    }).astype({"after": "Int64"})


def rank_chains(chains: DataFrame) -> DataFrame:
    """Chains (label, chain, n, after) that form rings, with the ring and the corners that come before: (label, chain, ring, before).

    Pointer doubling: every chain knows the least chain among the 2^k ahead of it and the corners up to there. Once no least
    chain changes in a round, each is that of the whole ring, so rounds are logarithmic in the longest ring.
    """
    state = cut(chains.select("label", "chain", F.col("after").alias("to"), F.col("n").alias("span"), F.col("chain").alias("ring"), F.lit(0).cast("bigint").alias("ahead")))
    while True:
        other = state.select("label", F.col("chain").alias("to"), *[F.col(c).alias("_" + c) for c in ("to", "span", "ring", "ahead")])
        nearer = F.col("ring") <= F.col("_ring")
        state = cut(state.join(large(other), ["label", "to"]).select(
            "label", "chain", F.col("_to").alias("to"), (F.col("span") + F.col("_span")).alias("span"), F.least("ring", "_ring").alias("ring"),
            F.when(nearer, F.col("ahead")).otherwise(F.col("span") + F.col("_ahead")).alias("ahead"), (F.col("_ring") < F.col("ring")).alias("changed"),
        ))
        if not state.where("changed").take(1):
            break
        state = state.drop("changed")
    sizes = chains.join(large(state), ["label", "chain"]).groupBy("label", "ring").agg(F.sum("n").alias("_all"))
    placed = state.join(large(sizes), ["label", "ring"])
    return placed.select("label", "chain", "ring", F.when(F.col("ahead") == 0, 0).otherwise(F.col("_all") - F.col("ahead")).alias("before"))


def outline_rings(labelled: DataFrame) -> DataFrame:
    """Rings (label, ring, corners): the corners of each outline in order, as pixel positions, from the first one on.

    Corners are chained inside squares of the plane; chains that leave a square are linked across. No task sees a region:
    only a finished ring becomes a row.
    """
    corners = outline_corners(labelled)
    square = [F.floor(F.col(c) / CHAIN_PX).alias("_s" + c) for c in "xy"]
    fields = "label bigint, chain bigint, pos bigint, n bigint, x bigint, y bigint, after bigint"
    chained = cut(corners.groupBy(*square).applyInPandas(_chains, fields))
    open_ = chained.where("pos = 0 and after is not null").select("label", "chain", "n", "after")
    whole = chained.where("after is null").select("label", F.col("chain").alias("ring"), "pos", "x", "y")
    linked = chained.where("after is not null").join(large(rank_chains(open_)), ["label", "chain"])
    linked = linked.select("label", "ring", (F.col("before") + F.col("pos")).alias("pos"), "x", "y")
    rings = whole.unionByName(linked).groupBy("label", "ring").agg(F.array_sort(F.collect_list(F.struct("pos", "x", "y"))).alias("c"))
    return rings.select("label", "ring", F.transform("c", lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"))).alias("corners"))


def trace_outlines(labelled: DataFrame, pixel_m: float = PIXEL_M) -> DataFrame:
    """Polygon per region: (label, shell, holes) in Mercator metres; holes from the first one on."""
    half = C.MERCATOR_HALF
    point = lambda p: F.struct((p["x"] * pixel_m - half).alias("x"), (F.lit(half) - p["y"] * pixel_m).alias("y"))
    closed = F.concat("corners", F.slice("corners", 1, 1))
    # the region lies to the right, so its shell turns the other way than its holes
    twice = F.aggregate(
        G.edges(closed), F.lit(0).cast("bigint"), lambda acc, e: acc + e["ax"] * e["by"] - e["bx"] * e["ay"],
    )
    rings = outline_rings(labelled).select("label", "ring", (twice > 0).alias("outer"), F.transform(closed, point).alias("r"))
    made = rings.groupBy("label").agg(
        F.first(F.when(F.col("outer"), F.col("r")), ignorenulls=True).alias("shell"),
        F.array_sort(F.collect_list(F.when(~F.col("outer"), F.struct("ring", "r")))).alias("_h"),
    )
    return made.select("label", "shell", F.transform("_h", lambda h: h["r"]).alias("holes"))


def vectorize(tiles: DataFrame, size: int = C.CELL_TILES * C.TILE_PX, pixel_m: float = PIXEL_M,
              min_final: float = C.FINAL_MIN_AREA_M2, origin: tuple[Callable, Callable] | None = None) -> DataFrame:
    """Tiles to finished polygons (label, cls, area_m2, shell, holes): gates, interiors, regions, outlines.

    The bands of a kind hold for the region as it is; then its small holes are filled, and the floor
    ``min_final`` of the finished layer holds for what that leaves. ``origin`` gives the first cell of
    the blocks that hold a cell, from its columns.
    """
    runs = cut(pixel_runs(tiles))
    block, step = blocks_in(size)
    start = None if origin is None else (origin[0]("sc_x"), origin[1]("sc_y"))
    blocks = block_gates(runs, size, block, step, start)
    located = assign_blocks(runs.select("tile_x", F.floor(F.col("y") / size).alias("tile_y")).distinct()
                            .withColumnsRenamed({"tile_x": "sc_x", "tile_y": "sc_y"}), block, step, start)
    gates = located.join(large(blocks.select("bx", "by", "urban_ok", "agri_ok")), ["bx", "by"]).groupBy("sc_x", "sc_y").agg(
        F.bool_or("urban_ok").alias("urban"), F.bool_or("agri_ok").alias("agri")
    ).select(F.col("sc_x").alias("tile_x"), F.col("sc_y").alias("_ty"), "urban", "agri")
    inner = interior_runs(runs, size).withColumn("_ty", F.floor(F.col("y") / size)).join(large(gates), ["tile_x", "_ty"])
    open_runs = inner.where(F.when(F.col("cls") == "urban", F.col("urban")).otherwise(F.col("agri"))).select(
        "cls", "tile_x", "y", "x0", "x1"
    )
    labelled = cut(label_components(open_runs, size))
    kept = in_area_band(component_measures(labelled, pixel_m))
    outlines = trace_outlines(labelled.join(large(kept.select("label")), "label", "left_semi"), pixel_m).join(large(kept.select("label", "cls")), "label")
    return finish_layer(outlines, min_final)


def finish_layer(outlines: DataFrame, min_final: float = C.FINAL_MIN_AREA_M2) -> DataFrame:
    """Outlines (label, cls, shell, holes) as the layer has them: holes filled by kind, the floor, the last filling."""
    limit = F.when(F.col("cls") == "urban", C.HOLE_FILL_URBAN_M2).otherwise(C.HOLE_FILL_AGRI_M2)
    filled = outlines.withColumn("holes", G.fill_holes(F.col("holes"), limit))
    large = filled.where(G.area(F.col("shell"), F.col("holes")) >= min_final)
    done = large.withColumn("holes", G.fill_holes(F.col("holes"), F.lit(C.HOLE_FILL_AGRI_M2)))
    return done.select("label", "cls", "shell", "holes").withColumn("area_m2", G.area(F.col("shell"), F.col("holes")))


# Communes (or rasters) are worked on together, each on a strip of its own of one plane: this many pixel rows high.
STRIP_PX = 1 << 22


ROWS_PX = 1 << 34  # what the ids of runs and corners leave for pixel rows


def _strips(tiles: DataFrame, key: str, size: int, grow: bool = False) -> tuple[DataFrame, DataFrame]:
    """Tiles moved to the strip of their ``key``, and per key its strip, first tile and size in pixels.

    ``_px`` is the height of all strips and ``_top`` the first pixel row of one. With ``grow`` the tallest plane, and a row
    of tiles that stays empty below it, sets the height where the usual one is too small.
    """
    high = STRIP_PX // size
    boxes = tiles.groupBy(key).agg(
        F.min("tx").alias("_tx"), F.min("ty").alias("_ty"),
        ((F.max("tx") - F.min("tx") + 1) * size).alias("_width"), ((F.max("ty") - F.min("ty") + 1) * size).alias("_height"),
    )
    boxes = cut(boxes.withColumn("_strip", F.dense_rank().over(Window.orderBy(key)) - 1))  # a row per key
    tallest, strips = boxes.agg(F.max("_height"), F.count("*")).first()
    if grow and tallest is not None:
        high = max(high, tallest // size + 1)
    if tallest is not None and tallest > high * size:
        raise ValueError(f"a plane of {tallest} pixel rows does not fit a strip of {high * size}")
    if strips * high * size > ROWS_PX:
        raise ValueError(f"{strips} strips of {high * size} pixel rows do not fit a plane of {ROWS_PX}")
    boxes = boxes.withColumn("_px", F.lit(high * size).cast("bigint")).withColumn("_top", F.col("_strip") * F.col("_px"))
    moved = tiles.join(boxes, key).select(
        (F.col("tx") - F.col("_tx")).alias("tx"), (F.col("ty") - F.col("_ty") + F.col("_strip") * high).alias("ty"), "size", "rgba"
    )
    return moved, boxes


def in_strips(rows: DataFrame, boxes: DataFrame, y: str = "y") -> DataFrame:
    """Rows with the box of the strip their pixel row ``y`` lies in."""
    one = boxes.select("_px").first()
    return rows.withColumn("_strip", F.floor(F.col(y) / (one._px if one else STRIP_PX)).cast("int")).join(boxes, "_strip")


def _strip_of(y: Column, size: int) -> Column:
    return F.floor(y / (STRIP_PX // size * size)).cast("int")


def _row_of(label: Column) -> Column:
    """The pixel row of a region's first run."""
    return F.shiftright(label, 29)


def vectorize_layers(tiles: DataFrame, size: int = C.CELL_TILES * C.TILE_PX, pixel_m: float = PIXEL_M,
                     min_final: float = C.FINAL_MIN_AREA_M2) -> DataFrame:
    """Tiles (comuna, tx, ty, size, rgba) to the layers the match cascade takes: (comuna, poly_idx, cls, area_m2, shell, holes) in degrees.

    Every commune's blocks start at its own first tile, and no region leaves its commune, even where
    the tiles of two overlap. poly_idx counts the polygons of a commune from 0, in order of their first pixel;
    the numbering sorts labels alone.
    """
    moved, boxes = _strips(tiles, "comuna", size)
    high = STRIP_PX // size
    first = (lambda c: F.lit(0).cast("bigint"), lambda c: F.floor(F.col(c) / high) * high)
    polys = cut(vectorize(moved, size, pixel_m, min_final, first))
    named = polys.select("label", _strip_of(_row_of(F.col("label")), size).alias("_strip")).join(boxes, "_strip")
    named = named.withColumn("poly_idx", (F.row_number().over(Window.partitionBy("comuna").orderBy("label")) - 1).cast("bigint"))
    east, south = F.col("_tx") * size * pixel_m, (F.col("_ty") - F.col("_strip") * high) * size * pixel_m
    degrees = lambda ring: F.transform(ring, lambda p: F.struct(M.lon_of(p["x"] + east).alias("x"), M.lat_of(p["y"] - south).alias("y")))
    return polys.join(large(named), "label").select(
        "comuna", "poly_idx", "cls", "area_m2", degrees(F.col("shell")).alias("shell"), F.transform("holes", degrees).alias("holes"),
    )


# --- legacy plan -------------------------------------------------------------------------------


def repair_windows(
    regions: DataFrame, pixel_m: float = PIXEL_M, max_area: float = C.LEGACY_AREA_M2[1],
    pad_m: float = C.REPAIR_PAD_M, metres_per_px: tuple[float, ...] = C.REPAIR_METRES_PER_PX,
) -> DataFrame:
    """Images to ask for where a region is too large: (raster, label, res, x0, y0, x1, y1, w, h).

    ``regions`` is (raster, label, px0, py0, px1, py1, area_m2, width, height), in pixels of the raster, whose size is
    (width, height). An image of w x h pixels, one for each resolution, covers the pixels from (x0, y0) up to
    (x1, y1) exclusive.
    """
    pad = pad_m / pixel_m
    big = regions.where(F.col("area_m2") > max_area).withColumn("res", F.explode(F.array(*[F.lit(float(r)) for r in metres_per_px])))
    side = lambda lo, hi: F.greatest(
        F.lit(C.REPAIR_MIN_SIDE_PX), F.floor(((F.col(hi) + 1 - F.col(lo)) * float(pixel_m) + 2 * pad_m) / F.col("res"))
    ).cast("int")
    low = lambda c: F.greatest(F.lit(0), F.floor(F.col(c) - pad)).cast("bigint")
    high = lambda c, end: F.least(F.col(end), F.floor(F.col(c) + 1 + pad)).cast("bigint")
    return big.select(
        "raster", "label", "res", low("px0").alias("x0"), low("py0").alias("y0"), high("px1", "width").alias("x1"), high("py1", "height").alias("y1"),
        side("px0", "px1").alias("w"), side("py0", "py1").alias("h"),
    ).where("x0 < x1 and y0 < y1")


def _border_runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for part in batch.itertuples(index=False):
            image = np.frombuffer(part.rgba, np.uint8).reshape(1, -1, part.w, 4)
            _, y, a, b = mask_runs((image[..., 0] != C.EXACT_RED) & (image[..., 3] > 0))
            yield pd.DataFrame({"raster": part.raster, "label": part.label, "res": part.res, "cy": y + part.row0, "a": a, "b": b})


def burnt_intervals(windows: DataFrame, images: DataFrame, least: int = C.REPAIR_MIN_BORDER_PX) -> DataFrame:
    """Intervals (raster, y, a, b) of fine pixels that lie under the border of coarse images.

    ``images`` holds whole rows of the images of ``windows``: (raster, label, res, row0, rgba), from row ``row0`` on. An
    image with fewer than ``least`` border pixels says nothing. A run of border pixels becomes the interval of the fine
    pixels nearest to it, in each of the fine rows nearest to its row: no pixel becomes a row.
    """
    key = ["raster", "label", "res"]
    raster = windows.schema["raster"].dataType.simpleString()
    rows = images.join(large(windows.select(*key, "w")), key).select(*key, "w", "row0", "rgba")
    runs = rows.mapInPandas(_border_runs, f"raster {raster}, label bigint, res double, cy bigint, a bigint, b bigint")
    telling = runs.groupBy(*key).agg(F.sum(F.col("b") - F.col("a") + 1).alias("_n")).where(F.col("_n") >= least)
    placed = runs.join(large(windows.join(large(telling), key, "left_semi")), key)

    def nearest(c: Column, lo: str, hi: str, n: str) -> Column:
        """The first fine pixel whose middle lies at or after the beginning of coarse pixel ``c``."""
        return F.col(lo) + F.ceil(c * (F.col(hi) - F.col(lo)) / F.col(n) - 0.5)

    first, last = nearest(F.col("cy"), "y0", "y1", "h"), nearest(F.col("cy") + 1, "y0", "y1", "h") - 1
    a, b = nearest(F.col("a"), "x0", "x1", "w"), nearest(F.col("b") + 1, "x0", "x1", "w") - 1
    spans = placed.select("raster", a.alias("a"), b.alias("b"), first.alias("_f"), last.alias("_l")).where("a <= b and _f <= _l")
    return spans.select("raster", F.explode(F.sequence("_f", "_l")).alias("y"), "a", "b").distinct()


def burn_runs(runs: DataFrame, intervals: DataFrame, size: int) -> DataFrame:
    """Runs (tile_x, y, x0, x1) without the intervals (y, a, b) of the same plane."""
    tiled = intervals.withColumn("tile_x", F.explode(F.sequence(F.floor(F.col("a") / size), F.floor(F.col("b") / size))))
    return subtract_runs(runs, tiled.select(
        "tile_x", "y", F.greatest("a", F.col("tile_x") * size).alias("a"), F.least("b", (F.col("tile_x") + 1) * size - 1).alias("b"),
    ))


def legacy_regions(runs: DataFrame, boxes: DataFrame, size: int, pixel_m: float) -> tuple[DataFrame, DataFrame]:
    """Labelled runs of the exact class, and their regions in pixels of their raster."""
    labelled = cut(label_components(runs.select(F.lit("exact").alias("cls"), "tile_x", "y", "x0", "x1"), size))
    regions, top = in_strips(component_measures(labelled, pixel_m), boxes, "py0"), F.col("_top")
    return labelled, regions.withColumn("py0", F.col("py0") - top).withColumn("py1", F.col("py1") - top).withColumnsRenamed(
        {"_width": "width", "_height": "height"}
    )


def legacy_runs(
    tiles: DataFrame, images: Callable[[DataFrame], DataFrame] | None = None, size: int = C.CELL_TILES * C.TILE_PX,
    pixel_m: float = PIXEL_M, max_area: float = C.LEGACY_AREA_M2[1],
) -> tuple[DataFrame, DataFrame]:
    """Runs of the exact class of all rasters after the repair, and the rasters' places.

    ``tiles`` is (raster, tx, ty, size, rgba); ``images`` gives for a table of `repair_windows` the rows of their images. A
    repair only takes pixels away, so the passes of the three resolutions are one union.
    """
    moved, boxes = _strips(tiles, "raster", size, grow=True)
    runs = cut(pixel_runs(moved).where(F.col("cls") == "exact_fill").drop("cls"))
    if images is None:
        return runs, boxes
    _, regions = legacy_regions(runs, boxes, size, pixel_m)
    windows = cut(repair_windows(regions, pixel_m, max_area))
    burnt = burnt_intervals(windows, images(windows)).join(boxes.select("raster", "_top"), "raster")
    placed = burnt.select((F.col("y") + F.col("_top")).alias("y"), "a", "b")
    return cut(burn_runs(runs, placed, size)), boxes


def vectorize_legacy(
    tiles: DataFrame, images: Callable[[DataFrame], DataFrame] | None = None, size: int = C.CELL_TILES * C.TILE_PX,
    pixel_m: float = PIXEL_M, area: tuple[float, float] = C.LEGACY_AREA_M2, max_hole: float = C.HOLE_FILL_COMPACT_M2,
) -> DataFrame:
    """The legacy layer of each raster: (raster, label, area_m2, holes_filled, holes_kept, shell, holes) in Mercator metres.

    Regions of the exact class, cut apart by coarse borders where they are too large; small round holes are filled,
    then the area has to lie in the band.
    """
    runs, boxes = legacy_runs(tiles, images, size, pixel_m, area[1])
    labelled, regions = legacy_regions(runs, boxes, size, pixel_m)
    # filling only adds, so what is too large before is dropped before it is traced
    kept = cut(regions.where(F.col("area_m2") <= area[1]).select("label", "raster", "_top", "_tx", "_ty"))
    traced = trace_outlines(labelled.join(large(kept.select("label")), "label", "left_semi"), pixel_m)
    filled = traced.withColumn("_left", G.fill_compact_holes(F.col("holes"), max_hole)).withColumn("_area", G.area(F.col("shell"), F.col("_left")))
    rows = filled.where(F.col("_area").between(*area)).join(large(kept), "label")
    east, south = F.col("_tx") * size * pixel_m, (F.col("_ty") * size - F.col("_top")) * pixel_m
    place = lambda ring: F.transform(ring, lambda p: F.struct((p["x"] + east).alias("x"), (p["y"] - south).alias("y")))
    return rows.select(
        "raster", "label", F.round("_area", 1).alias("area_m2"), (F.size("holes") - F.size("_left")).alias("holes_filled"),
        F.size("_left").alias("holes_kept"), place(F.col("shell")).alias("shell"), F.transform("_left", place).alias("holes"),
    )


# --- repair ------------------------------------------------------------------------------------


def burn_border(fine: DataFrame, windows: DataFrame, coarse: DataFrame, fill_red: int = C.EXACT_RED) -> DataFrame:
    """Black out fine pixels (x, y, r) under border pixels of coarse images.

    ``windows`` (win, x0, y0, x1, y1, w, h) places a w x h image over the fine pixels from
    (x0, y0) up to (x1, y1) exclusive; ``coarse`` is (win, cx, cy, r, a). An image with fewer
    than ten border pixels says nothing. A border pixel yields the fine pixels nearest to it.
    """
    border = coarse.where((F.col("r") != fill_red) & (F.col("a") > 0)).select("win", "cx", "cy")
    telling = border.groupBy("win").agg(F.count("*").alias("_n")).where(F.col("_n") >= C.REPAIR_MIN_BORDER_PX)
    placed = border.join(large(windows.join(large(telling), "win", "left_semi")), "win")

    def fine_range(c: str, lo: str, hi: str, n: str) -> Column:
        scale = (F.col(hi) - F.col(lo)) / F.col(n)
        first = F.ceil(F.col(c) * scale - 0.5)
        last = F.ceil((F.col(c) + 1) * scale - 0.5) - 1
        return F.when(first <= last, F.sequence(F.col(lo) + first, F.col(lo) + last))

    hit = placed.withColumn("x", F.explode(fine_range("cx", "x0", "x1", "w"))).withColumn(
        "y", F.explode(fine_range("cy", "y0", "y1", "h"))
    ).select("x", "y").distinct().withColumn("_hit", F.lit(True))
    return fine.join(large(hit), ["x", "y"], "left").withColumn("r", F.when(F.col("_hit"), 0).otherwise(F.col("r"))).drop("_hit")
