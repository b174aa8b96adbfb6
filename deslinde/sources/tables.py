"""Registry, answers, polygons, listings: everything but the roll."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as St

from deslinde import constants as C
from deslinde.functions import coords as M
from deslinde.functions import geometry as G

REGISTRY_COLUMNS = [*C.REGISTRY_KEY, *C.REGISTRY_OWN, *C.REGISTRY_ADDED]


def text_schema(columns: Sequence[str]) -> St.StructType:
    return St.StructType([St.StructField(c, St.StringType()) for c in columns])


def read_registry(
    spark: SparkSession, path: str, columns: Sequence[str] = REGISTRY_COLUMNS, comuna: int | None = None,
    file_columns: Sequence[str] = REGISTRY_COLUMNS,
) -> DataFrame:
    """Registry CSV as text under a declared schema; the parser skips columns not selected."""
    rows = spark.read.schema(text_schema(file_columns)).option("header", True).csv(path)
    if comuna is not None:
        rows = rows.where(F.col("comuna").try_cast("int") == comuna)
    return rows.select(*columns)


def read_pipe_csv(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    return spark.read.schema(text_schema(columns)).option("header", True).option("sep", "|").csv(path)


def read_csv_lenient(spark: SparkSession, path: str, columns: Sequence[str], header: bool = True) -> DataFrame:
    """CSV whose broken lines are skipped; ``_lat`` and ``_lon`` are null outside the legacy box."""
    rows = (
        spark.read.schema(text_schema(columns)).option("header", header).option("mode", "DROPMALFORMED").csv(path)
    )
    lat, lon = F.col("lat").try_cast("double"), F.col("lon").try_cast("double")
    ok = M.valid_coord(lat, lon, legacy=True)
    return rows.withColumn("_lat", F.when(ok, lat)).withColumn("_lon", F.when(ok, lon))


def read_answers(spark: SparkSession, path: str, whole_files: bool = True) -> tuple[DataFrame, DataFrame]:
    """(readable, unreadable) JSON texts with their paths, one per file or one per line."""
    files = spark.read.option("wholetext", whole_files).text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("json")
    )
    good = F.try_parse_json("json").isNotNull()
    return files.where(good), files.where(~good)


def scan_polygons(
    layers: Sequence[DataFrame], min_hole_area: float = C.HOLE_FILL_JOIN_M2, mercator_in: bool = False,
) -> DataFrame:
    """Polygon layers in degrees with small holes filled and area and box computed.

    Layers bring their own ``poly_idx``; to be concatenated they have to be disjoint.
    """
    rows = layers[0]
    for more in layers[1:]:
        rows = rows.unionByName(more, allowMissingColumns=True)
    # other names than those of the result: measured and reprojected shapes are not to be mixed up
    rows = rows.withColumnsRenamed({"shell": "_shell", "holes": "_holes"})
    shell, holes = F.col("_shell"), F.col("_holes")
    if mercator_in:
        ring = lambda r: G.reproject(r, M.lon_of, M.lat_of)
        kept = G.fill_holes(holes, min_hole_area)
        area = G.area(shell, kept)
        shell, holes = ring(shell), F.transform(kept, ring)
    else:
        unit = float(C.METRES_PER_DEGREE) ** 2
        holes = G.fill_holes(holes, min_hole_area / unit)
        area = M.degree_area_m2(G.area(shell, holes))
    out = rows.select("poly_idx", "comuna", shell.alias("shell"), holes.alias("holes"), area.alias("area_m2"))
    return out.withColumn("_b", G.bounds(F.col("shell"))).select("*", "_b.*").drop("_b")


def read_layer_names(spark: SparkSession, path: str) -> DataFrame:
    """(comuna, layer) of tab-separated lines; blank lines, a heading and lines of one field are left out."""
    parts = F.split(F.trim("value"), "\t")
    lines = spark.read.text(path).where(~F.trim("value").startswith("cod") & (F.size(parts) >= 2))
    return lines.select(F.try_element_at(parts, F.lit(1)).try_cast("int").alias("comuna"), F.try_element_at(parts, F.lit(2)).alias("layer"))


def list_partitions(spark: SparkSession, path: str) -> DataFrame:
    """Communes present under a partitioned folder, from the names in its listing; no file is opened, so the cost follows the files."""
    code = F.regexp_extract("path", r"/comuna=([^/]+)/", 1)
    return _listing(spark, path).select(code.try_cast("int").alias("comuna")).where("comuna is not null").distinct()


def _listing(spark: SparkSession, path: str) -> DataFrame:
    """(path, length) of the files below a folder; their contents are not read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length")


def parse_tile_listing(files: DataFrame) -> DataFrame:
    """(sc_x, sc_y, path, length) of cell images in a listing (path, length), tiny files left out."""
    name = F.element_at(F.split("path", "/"), -1)
    part = lambda i: F.regexp_extract(name, r"^sc_(\d+)_(\d+)\.png$", i).try_cast("bigint")
    return files.where(F.col("length") >= C.MIN_IMAGE_BYTES).select(
        part(1).alias("sc_x"), part(2).alias("sc_y"), "path", "length"
    ).where("sc_x is not null")


def list_tiles(spark: SparkSession, path: str) -> DataFrame:
    """Cell images under a folder; their contents are not read."""
    return parse_tile_listing(_listing(spark, path))


def output_sizes(spark: SparkSession, folders: dict[str, str]) -> DataFrame:
    """(comuna, kind, key, files, bytes, mb) per commune and kind of output, from the file listing."""
    parts = None
    for kind, path in folders.items():
        code = F.regexp_extract("path", r"comuna=([^/.]+)", 1)
        rows = _listing(spark, path).select(code.alias("comuna"), F.lit(kind).alias("kind"), "length")
        parts = rows if parts is None else parts.unionByName(rows)
    return parts.where("comuna <> ''").groupBy("comuna", "kind").agg(
        F.count("*").alias("files"), F.sum("length").alias("bytes"), F.round(F.sum("length") / 1048576, 1).alias("mb")
    ).withColumn("key", F.concat("kind", F.lit("/comuna="), "comuna"))


# --- progress lines ----------------------------------------------------------------------


def parse_progress(lines: DataFrame) -> DataFrame:
    """Counters of PROGRESS and DONE lines; other lines are dropped."""
    number = lambda name: F.regexp_extract("line", rf"\b{name}=(\d+)", 1).try_cast("bigint")
    kept = lines.where(F.col("line").rlike(r"PROGRESS|DONE"))
    return kept.withColumns({n: number(n) for n in ("chunk", "ok", "fail", "total")})


def progress_last(lines: DataFrame) -> DataFrame:
    """Last reported counters per worker."""
    parsed = parse_progress(lines)
    best = parsed.groupBy("worker").agg(F.max_by(F.struct("chunk", "ok", "fail", "total"), F.struct("ts", "event_id")).alias("b"))
    return best.select("worker", "b.*")


def progress_totals(last: DataFrame, elapsed_s: float) -> DataFrame:
    """Sums over workers, rate per second and minutes left."""
    sums = last.agg(F.sum("ok").alias("ok"), F.sum("fail").alias("fail"), F.sum("total").alias("total"))
    rate = F.col("ok") / F.lit(float(elapsed_s))
    return sums.select(
        "*", F.round(F.when(F.lit(elapsed_s) > 0, rate).otherwise(0.0), 1).alias("rate"),
        F.round(F.coalesce(F.try_divide(F.col("total") - F.col("ok"), rate) / 60, F.lit(0.0)), 1).alias("eta_min"),
    )


def busiest_worker(last: DataFrame, more_than: int = C.STEAL_MIN_REMAINING) -> DataFrame:
    """The worker with most tiles left, if it has enough to share; ties to the lowest worker."""
    left = F.col("total") - F.col("ok")
    best = last.where(left > more_than).agg(F.max_by(F.struct("worker", left.alias("remaining")), F.struct(left, -F.col("worker"))).alias("b"))
    return best.where("b is not null").select("b.*")
