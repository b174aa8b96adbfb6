"""Which tiles to cover, under which names, in which order."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from deslinde import constants as C
from deslinde.functions import coords as M
from deslinde.functions import geometry as G
from deslinde.functions import intervals as I
from deslinde.functions import text as T
from deslinde.operators.dedup import first_per_key


# --- names ------------------------------------------------------------------------------


def lookup_with_overrides(base: DataFrame, overrides: DataFrame, key: str) -> DataFrame:
    """Union of two lookups; an override wins over the base row of its key."""
    both = base.withColumn("_p", F.lit(1)).unionByName(overrides.withColumn("_p", F.lit(0)))
    rest = [c for c in base.columns if c != key]
    return first_per_key(both, [key], ["_p", *rest]).drop("_p")


def layer_overrides(spark) -> DataFrame:
    """The published exceptions to layer names."""
    return spark.createDataFrame(sorted(C.LAYER_NAME_OVERRIDES.items()), "comuna int, layer string")


def layer_names(base: DataFrame) -> DataFrame:
    """(comuna, layer): names as read, the published exceptions over them."""
    return lookup_with_overrides(base, layer_overrides(base.sparkSession), "comuna")


def commune_dimension(paths: DataFrame) -> DataFrame:
    """Communes from file paths ``{code}_{name}.csv``: code, name, normal name, layer word, path."""
    name = F.element_at(F.split(F.col("path"), "/"), -1)
    parts = paths.withColumn("_f", name).where(F.col("_f").endswith(".csv"))
    code, label = F.regexp_extract("_f", r"^([^_]*)_(.*)\.csv$", 1), F.regexp_extract("_f", r"^([^_]*)_(.*)\.csv$", 2)
    return parts.where(F.col("_f").rlike(r"^[^_]*_.*\.csv$")).select(
        code.alias("cod"), label.alias("nombre"), T.normal_name(label).alias("nombre_normalizado"),
        F.coalesce(
            F.try_element_at(F.create_map(*[F.lit(str(x)) for kv in C.LAYER_NAME_EXCEPTIONS.items() for x in kv]), code),
            T.normal_name(label),
        ).alias("nombre_wms"), F.col("path"),
    )


def _only(tries: DataFrame, keys: list[str]) -> DataFrame:
    """Best tier per key; ``matches`` says how many hits share it, of which a row of ``tries`` stands for ``n``."""
    best = tries.groupBy(*keys, "tier").agg(F.sum("n").alias("matches"), F.min("cod").alias("cod"))
    return best.groupBy(*keys).agg(F.min(F.struct("tier", "matches", "cod")).alias("b")).select(*keys, "b.*")


def resolve_name(asked: DataFrame, dim: DataFrame) -> DataFrame:
    """Find ``asked`` (comuna, layer) in ``dim`` (cod, name): accents aside by full name, by its
    first word, by the code as it is, by the padded code.

    The first way that hits decides; several hits on it leave the name unresolved. Hits are counted per name before
    the join, so a name that many share is one row and not as many as ask for it times as many as bear it.
    """
    names = dim.select("cod", T.ascii_name(F.col("name")).alias("_n"), F.trim(F.col("cod")).alias("_c"))
    search = T.ascii_name(F.replace(F.col("layer"), F.lit("_"), F.lit(" ")))
    rows = asked.withColumn("_s", search)
    word = F.when(F.col("_s").contains(" "), F.split("_s", " ")[0])
    code = F.col("comuna").cast("string")
    ways = [
        (1, F.when(F.col("_s") != "", F.col("_s")), "_n"), (2, word, "_n"), (3, code, "_c"),
        (4, F.when(F.length(code) < 5, F.lpad(code, 5, "0")), "_c"),
    ]
    tries = reduce(DataFrame.unionByName, [
        rows.select("comuna", "layer", value.alias(by)).join(names.groupBy(by).agg(F.count("*").alias("n"), F.min("cod").alias("cod")), by)
        .select("comuna", "layer", F.lit(tier).alias("tier"), "n", "cod") for tier, value, by in ways
    ])
    found = _only(tries, ["comuna", "layer"])
    return asked.join(found, ["comuna", "layer"], "left").select(
        "comuna", "layer", F.when(F.col("matches") == 1, F.col("cod")).alias("cod"),
        F.when(F.col("matches").isNull(), "not_found").when(F.col("matches") > 1, "ambiguous").otherwise("found").alias("status"),
    )


def list_communes(dim: DataFrame, wanted: str | None = None) -> DataFrame:
    """Communes (cod, name) in code order, those whose normal name holds ``wanted`` if given."""
    rows = dim
    if wanted:
        rows = dim.where(T.normal_name(F.col("name")).contains(T.normal_name(F.lit(wanted))))
    return rows.orderBy("cod")


def _pieces(text: Column, lengths: Column) -> Column:
    """All distinct substrings of the given lengths."""
    return F.array_distinct(F.flatten(F.transform(
        lengths,
        lambda n: F.when(
            n <= F.length(text),
            F.transform(F.sequence(F.lit(1), F.length(text) - n + 1), lambda i: F.substring(text, i, n)),
        ).otherwise(F.array().cast("array<string>")),
    )))


def fuzzy_lookup(asked: DataFrame, dim: DataFrame) -> DataFrame:
    """Find communes of ``dim`` (cod, name) by a typed ``q``: exact code, exact name, either text
    inside the other, every word inside the name.

    ``contains`` is turned into equality: the short dimension is spread over the substrings of
    its names once, and a query over its substrings as long as some name, so no step pairs
    every query with every commune. Several hits are ambiguous; all are listed, with their number.
    """
    names = dim.select("cod", T.normal_name(F.col("name")).alias("_n"))
    texts = asked.select("q").distinct().withColumn("_t", T.strip(F.col("q"))).withColumn(
        "_q", F.replace(T.normal_name(F.col("_t")), F.lit(" "), F.lit("_"))
    )
    lengths = sorted(r[0] for r in names.select(F.length("_n")).distinct().collect())  # name lengths, a few dozen
    inner = names.withColumn("_k", F.explode(F.array_union(
        _pieces(F.col("_n"), F.sequence(F.lit(1), F.greatest(F.length("_n"), F.lit(1)))), F.array(F.lit(""))
    )))
    pick = lambda df, tier: df.select("q", F.lit(tier).alias("tier"), "cod").distinct()
    by_code = pick(texts.join(names, texts["_t"] == names["cod"]), 1)
    exact = texts.join(names, texts["_q"] == names["_n"]).groupBy("q").agg(F.min("cod").alias("cod"))
    inside = pick(texts.join(inner, texts["_q"] == inner["_k"]), 3)
    spread = texts.withColumn("_k", F.explode(_pieces(F.col("_q"), F.array(*[F.lit(n) for n in lengths]))))
    around = pick(spread.join(names, spread["_k"] == names["_n"]), 3)
    words = F.array_distinct(F.filter(F.split(F.replace(F.col("_q"), F.lit("_"), F.lit(" ")), r"\s+"), lambda w: w != ""))
    split = texts.withColumn("_w", words)
    each = split.withColumn("_k", F.explode("_w"))
    all_words = pick(
        each.join(inner.where("_k <> ''"), "_k").groupBy("q", "cod").agg(
            F.count("*").alias("n"), F.max(F.size("_w")).alias("m")
        ).where("n = m"), 4)
    tries = by_code.unionByName(pick(exact, 2)).unionByName(inside.unionByName(around).distinct()).unionByName(all_words)
    best = tries.groupBy("q").agg(F.min("tier").alias("tier"))
    hits = tries.join(best, ["q", "tier"]).groupBy("q", "tier").agg(F.array_sort(F.collect_set("cod")).alias("cods"))
    return asked.join(hits, "q", "left").select(
        *asked.columns, F.when(F.size("cods") == 1, F.col("cods")[0]).alias("cod"),
        F.when(F.col("cods").isNull(), "not_found").when(F.size("cods") > 1, "ambiguous").otherwise("found").alias("status"),
        F.when(F.size("cods") > 1, F.col("cods")).alias("options"), F.coalesce(F.size("cods"), F.lit(0)).alias("hits"),
    )


# --- tiles -----------------------------------------------------------------------------


def tile_plan(tiers: DataFrame, own: DataFrame, data: DataFrame, names: DataFrame) -> DataFrame:
    """Box, source, tile counts and raster size per commune.

    ``tiers`` (cod, tier), ``own`` (cod, nombre, min_lon, min_lat, max_lon, max_lat), ``data``
    (cod, lat_min, lat_max, lon_min, lon_max), ``names`` (cod, nombre). A commune's own box is
    used up to the large-tile limit, else the padded box of its data, else its own after all.
    """
    box = ["min_lon", "min_lat", "max_lon", "max_lat"]
    own_r = own.select("cod", F.col("nombre").alias("_own_name"), *[F.col(c).alias(f"_own_{c}") for c in box])
    pad = C.BBOX_PAD_DEGREES
    data_r = data.where("lat_min is not null and lon_min is not null").select(
        "cod", (F.col("lon_min") - pad).alias("_d_min_lon"), (F.col("lat_min") - pad).alias("_d_min_lat"),
        (F.col("lon_max") + pad).alias("_d_max_lon"), (F.col("lat_max") + pad).alias("_d_max_lat"),
    )
    rows = (
        tiers.join(own_r, "cod", "left").join(data_r, "cod", "left")
        .join(names.select("cod", F.col("nombre").alias("_data_name")), "cod", "left")
    )
    count = lambda t: (t["x1"] - t["x0"] + 1) * (t["y1"] - t["y0"] + 1)
    own_t = M.tile_range(*[F.col(f"_own_{c}") for c in box])
    has_own, has_data = F.col("_own_min_lon").isNotNull(), F.col("_d_min_lon").isNotNull()
    source = (
        F.when(has_own & (count(own_t) <= C.LARGE_TILE_COUNT), "own").when(has_data, "data").when(has_own, "own_large")
    )
    rows = rows.withColumn("source", source).where("source is not null")
    from_data = F.col("source") == "data"
    for c in box:
        rows = rows.withColumn(c, F.when(from_data, F.col(f"_d_{c}")).otherwise(F.col(f"_own_{c}")))
    own_name, data_name = F.nullif(F.col("_own_name"), F.lit("")), F.nullif(F.col("_data_name"), F.lit(""))
    name = F.when(from_data, F.coalesce(data_name, own_name)).otherwise(F.coalesce(own_name, data_name))
    rows = rows.withColumn("_t", M.tile_range(*[F.col(c) for c in box])).withColumn("_name", name).where("_name is not null")
    tx, ty = F.col("_t.x1") - F.col("_t.x0") + 1, F.col("_t.y1") - F.col("_t.y0") + 1
    return rows.select(
        "cod", T.layer_name(F.col("cod"), F.col("_name")).alias("nombre_wms"),
        F.format_string("%.6f,%.6f,%.6f,%.6f", *box).alias("bbox"), "tier", tx.alias("tiles_x"), ty.alias("tiles_y"),
        (tx * ty).alias("tiles_total"), M.raster_gb(tx, ty).alias("ram_gb"), "source",
    ).withColumn("large", F.col("tiles_total") > C.LARGE_TILE_COUNT)


def queue_order(plan: DataFrame) -> DataFrame:
    """Tier A before B, small jobs first; other tiers are left out."""
    return plan.where(F.col("tier").isin("A", "B")).orderBy("tier", "tiles_total", "cod")


def tier_totals(plan: DataFrame) -> DataFrame:
    return plan.where(F.col("tier").isin("A", "B")).groupBy("tier").agg(
        F.count("*").alias("communes"), F.sum("tiles_total").alias("tiles"),
        F.count_if(F.col("tiles_total") > C.LARGE_TILE_COUNT).alias("large"),
    )


def cells_of_range(ranges: DataFrame) -> DataFrame:
    """4 x 4 cells covering a tile range (x0, x1, y0, y1), with the tiles of each inside the range."""
    step = C.CELL_TILES
    cells = ranges.withColumn("scx", F.explode(F.sequence(M.align(F.col("x0")), F.col("x1"), F.lit(step)))).withColumn(
        "scy", F.explode(F.sequence(M.align(F.col("y0")), F.col("y1"), F.lit(step)))
    )
    span = lambda s, lo, hi: F.least(F.col(s) + step - 1, F.col(hi)) - F.greatest(F.col(s), F.col(lo)) + 1
    return cells.withColumn("n_tiles", span("scx", "x0", "x1") * span("scy", "y0", "y1"))


def split_cells(cells: DataFrame) -> DataFrame:
    """One row per tile of a cell that lies in the range, with its place in the cell."""
    tiles = cells.withColumn("dx", F.explode(F.sequence(F.lit(0), F.lit(C.CELL_TILES - 1)))).withColumn(
        "dy", F.explode(F.sequence(F.lit(0), F.lit(C.CELL_TILES - 1)))
    )
    tiles = tiles.withColumn("tx", F.col("scx") + F.col("dx")).withColumn("ty", F.col("scy") + F.col("dy"))
    return tiles.where(F.col("tx").between(F.col("x0"), F.col("x1")) & F.col("ty").between(F.col("y0"), F.col("y1")))


def _cover_runs(size: float, half: float, reach: float):
    """Arrow step: (cod, r, a, b) of the cells near the polygons of a batch, one run where runs of a cod touch."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        from deslinde.functions import cover

        for batch in batches:
            cods = batch.column("cod").dictionary_encode(null_encoding="encode")
            made = cover.covered(
                *cover.rings_of(batch.column("shell"), batch.column("holes")), cods.indices.to_numpy(zero_copy_only=False).astype(np.int64), size, half, reach
            )
            cod = pa.DictionaryArray.from_arrays(pa.array(made[0]), cods.dictionary).dictionary_decode()
            yield pa.RecordBatch.from_arrays([cod, *[pa.array(m) for m in made[1:]]], names=["cod", "r", "a", "b"])

    return run


def grid_cover(areas: DataFrame, buffer_m: float = C.GRID_BUFFER_M) -> DataFrame:
    """Cells (cod, scx, scy) within ``buffer_m`` of a Mercator polygon.

    Worked in runs of cells: each polygon's boundary and inside become runs in one narrow step, the runs of a cod's row are
    merged where several polygons give some, and only then written out as cells.
    """
    size, half = M.TILE_M * C.CELL_TILES, C.MERCATOR_HALF
    polygons = areas.where(F.col("shell").isNotNull()).select(
        "cod", F.col("shell").cast(G.RING).alias("shell"), F.coalesce(F.col("holes").cast(f"array<{G.RING}>"), G.no_holes()).alias("holes")
    )
    schema = StructType([StructField("cod", areas.schema["cod"].dataType), *[StructField(c, LongType()) for c in ("r", "a", "b")]])
    runs = polygons.mapInArrow(_cover_runs(size, half, float(buffer_m)), schema)
    rows = runs.groupBy("cod", "r").agg(F.collect_list(I.interval(F.col("a"), F.col("b"))).alias("_s"))
    whole = F.when(F.size("_s") == 1, F.col("_s")).otherwise(I.merged(F.array_sort("_s")))
    cells = rows.select("cod", "r", F.explode(whole).alias("_s")).select("cod", "r", F.explode(F.sequence("_s.a", "_s.b")).alias("c"))
    return cells.select("cod", (F.col("c") * C.CELL_TILES).alias("scx"), (F.col("r") * C.CELL_TILES).alias("scy"))


def complete_communes(tables: DataFrame, cells: DataFrame, published: DataFrame) -> DataFrame:
    """Communes with their table and more than a hundred cells that are not published yet."""
    enough = cells.groupBy("comuna").agg(F.count("*").alias("n_cells")).where(F.col("n_cells") > C.MIN_CELLS_EXCLUSIVE)
    return enough.join(tables.select("comuna").distinct(), "comuna", "left_semi").join(
        published.select("comuna").distinct(), "comuna", "left_anti"
    )
