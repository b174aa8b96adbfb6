"""Coverage metrics, catalogs and summaries; all are combinable aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deslinde import constants as C
from deslinde.functions import geometry as G
from deslinde.functions import text as T
from deslinde.session import large


def _pct(part: Column, whole: Column) -> Column:
    return F.round(F.try_divide(part * F.lit(100.0), whole), 2)


def match_metrics(matched: DataFrame, polygons: DataFrame) -> DataFrame:
    """Counts per method, with and without coordinates, coverage and unclaimed polygons, per commune."""
    method = lambda m: F.count_if(F.col("match_method") == m)
    placed = F.count_if(F.col("poly_idx").isNotNull())
    coords = F.count_if(F.col("x").isNotNull())
    rows = matched.groupBy("comuna").agg(
        F.count("*").alias("total"), coords.alias("predios_con_coords"),
        method("point_in_polygon").alias("metodo_pip"), method("nearest_10m").alias("metodo_nearest_10m"),
        method("coord_inheritance").alias("metodo_coord_inherit"),
        method("address_inheritance").alias("metodo_addr_inherit"), placed.alias("total_matched"),
    )
    used = matched.where("poly_idx is not null").select("comuna", "poly_idx").distinct().withColumn("_used", F.lit(1))
    layers = polygons.select("comuna", "poly_idx").join(large(used), ["comuna", "poly_idx"], "left").groupBy("comuna").agg(
        F.count("*").alias("poligonos_disponibles"), F.count_if(F.col("_used").isNull()).alias("poligonos_huerfanos")
    )
    return rows.join(layers, "comuna", "left").select(
        "comuna", F.coalesce("poligonos_disponibles", F.lit(0)).alias("poligonos_disponibles"),
        F.coalesce("poligonos_huerfanos", F.lit(0)).alias("poligonos_huerfanos"),
        "predios_con_coords", "metodo_pip", "metodo_nearest_10m", "metodo_coord_inherit", "metodo_addr_inherit",
        "total_matched", (F.col("total") - F.col("total_matched")).alias("sin_match"),
        (F.col("total") - F.col("predios_con_coords")).alias("sin_coords"),
        _pct(F.col("total_matched"), F.col("total")).alias("cobertura_pct"),
    )


def merge_metrics(rows: DataFrame) -> DataFrame:
    """What the merge of answers and registry brought, per commune: rows, good ones, with an address, with coordinates, inherited."""
    told = lambda c: F.count_if(F.col(c).isNotNull() & (F.col(c).cast("string") != "None"))
    return rows.groupBy("comuna").agg(
        F.count("*").alias("total"), F.count_if(F.lower(F.col("_ok").cast("string")) == "true").alias("ok"),
        told("dc_direccion").alias("con_dc_direccion"), told("lat").alias("con_coords"),
        told("predioPublicado_predio").alias("con_predio_publicado"), F.count_if("inherited").alias("heredados"),
    )


def fetch_metrics(requested: DataFrame, answers: DataFrame) -> DataFrame:
    """What a download brought, per commune."""
    told = lambda c: F.count_if(F.col(c).isNotNull() & (F.col(c) != "None"))
    got = answers.groupBy("comuna").agg(
        F.count("*").alias("descargados"), told("lat").alias("con_coords"),
        told("predioPublicado_predio").alias("con_predio_publicado"),
        F.count_if(F.coalesce(F.col("_error"), F.lit("")) != "").alias("errores_red"),
    )
    wanted = requested.groupBy("comuna").agg(F.count("*").alias("total_predios"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return wanted.join(got, "comuna", "left").select(
        "comuna", "total_predios", zero("descargados"), zero("con_coords"),
        F.coalesce(F.col("descargados") - F.col("con_coords"), F.lit(0)).alias("sin_coords"),
        zero("con_predio_publicado"), zero("errores_red"),
    )


def coverage(rows: DataFrame) -> DataFrame:
    """Share of parcels with a polygon, urban ones and all, orphan polygons left out."""
    parcels = rows.where(~F.coalesce(F.col("match_method").isin("orphan_polygon", "unmatched_polygon"), F.lit(False)))
    urban = F.coalesce(F.col("ubicacion").contains("URBANA"), F.lit(False))
    has = F.col("poly_idx").isNotNull()
    sums = parcels.agg(
        F.count_if(urban & has).alias("urbana_con"), F.count_if(urban).alias("urbana"),
        F.count_if(has).alias("total_con"), F.count("*").alias("total"),
    )
    return sums.select(
        "*", F.round(F.try_divide(F.col("urbana_con") * 100.0, "urbana"), 1).alias("urbana_pct"),
        F.round(F.try_divide(F.col("total_con") * 100.0, "total"), 1).alias("total_pct"),
    )


def method_topk(matched: DataFrame, k: int = 15) -> DataFrame:
    """The ``k`` commonest methods, how many more there are and the rows these hold, and the rows without one.

    Ties go to the name that sorts first.
    """
    counts = matched.groupBy("match_method").agg(F.count("*").alias("n"))
    named = counts.where("match_method is not null")
    top = named.orderBy(F.desc("n"), "match_method").limit(k).select(F.lit("method").alias("line"), "match_method", "n")
    rest = named.join(top.select("match_method"), "match_method", "left_anti")
    sums = rest.agg(F.count("*").alias("m"), F.sum("n").alias("rows")).where("m > 0")
    line = lambda name, n: F.struct(F.lit(name).alias("line"), F.lit(None).cast("string").alias("match_method"), n.alias("n"))
    more = sums.select(F.explode(F.array(
        line("more_methods", F.col("m")), line("rows_of_more", F.col("rows"))
    )).alias("l")).select("l.*")
    none = counts.where("match_method is null").select(F.lit("unmatched").alias("line"), "match_method", "n")
    return top.unionByName(more).unionByName(none)


def recovery_metrics(before: DataFrame, after: DataFrame) -> DataFrame:
    """Recovered rows per method and coverage before and after, per commune.

    Orphan polygons are not parcels and do not count.
    """
    key = ["comuna", "manzana", "predio"]
    open_rows = before.where("poly_idx is null").select(*key).withColumn("_open", F.lit(1))
    joined = after.join(open_rows, key, "left")
    won = F.col("_open").isNotNull() & F.col("poly_idx").isNotNull()
    method = lambda m: F.count_if(won & (F.col("match_method") == m)).alias(m)
    labels = ["ah_utm_pip", "ah_utm_nearest", "csa_utm_pip", "csa_utm_nearest", "nearest_unlimited", "ocr_orphan",
              "address_inheritance"]
    sums = joined.groupBy("comuna").agg(
        *[method(m) for m in labels], F.count_if(won).alias("total_recovered"),
        F.count_if(F.col("_open").isNull()).alias("_before"),
        F.count_if(F.col("poly_idx").isNotNull()).alias("_after"), F.count("*").alias("_n"),
    )
    return sums.select(
        "comuna", *labels, "total_recovered", _pct(F.col("_before"), F.col("_n")).alias("cobertura_antes"),
        _pct(F.col("_after"), F.col("_n")).alias("cobertura_post_recovery"),
    )


def distinct_names(rows: DataFrame) -> DataFrame:
    """Distinct (cod, nombre) of rows that have a name."""
    return rows.where("comuna_nombre is not null").select(F.col("comuna").cast("string").alias("cod"), F.col("comuna_nombre").alias("nombre")).distinct()


# --- catalog ---------------------------------------------------------------------------

COUNTS = ["total_csv", "total_poligonos", "con_datos_y_poligono", "solo_poligono", "catastro_only", "con_latlon"]


def _catalog_counts() -> list[Column]:
    has_rol, has_lat = T.present(F.col("manzana")), T.present(F.col("lat"))
    has_poly = T.present(F.col("pol_area_m2"))
    return [
        F.count("*").alias("total_csv"), F.count_if(has_poly).alias("total_poligonos"),
        F.count_if(has_rol & has_poly).alias("con_datos_y_poligono"), F.count_if(has_poly & ~has_rol).alias("solo_poligono"),
        F.count_if(has_rol & ~has_poly).alias("catastro_only"), F.count_if(has_lat).alias("con_latlon"),
    ]


def catalog(rows: DataFrame) -> DataFrame:
    """One line per commune; its name is the first one written in it, else its code."""
    text = rows.select("comuna", "manzana", "predio", *[F.col(c).cast("string").alias(c) for c in ("lat", "pol_area_m2", "nombreComuna")])
    named = F.when(T.present(F.col("nombreComuna")), F.struct(
        F.col("manzana").isNull().alias("z"), "manzana", "predio", "nombreComuna"))
    out = text.groupBy("comuna").agg(*_catalog_counts(), F.min(named).alias("_n"))
    return out.select(
        F.col("comuna").cast("string").alias("codigo"),
        F.coalesce(F.col("_n.nombreComuna"), F.col("comuna").cast("string")).alias("nombre"), *COUNTS,
    )


def catalog_rollup(rows: DataFrame) -> DataFrame:
    """The counts per commune and, on one ``total`` line, over all."""
    text = rows.select("comuna", "manzana", *[F.col(c).cast("string").alias(c) for c in ("lat", "pol_area_m2")])
    out = text.rollup("comuna").agg(*_catalog_counts(), F.grouping_id().alias("_g"))
    return out.select(
        F.when(F.col("_g") == 0, F.col("comuna").cast("string")).otherwise("total").alias("codigo"), *COUNTS
    )


def catalog_json(rows: DataFrame, title: str, stamp: Column | None = None, files: DataFrame | None = None) -> DataFrame:
    """The catalog as one JSON document: header, one entry per commune, totals.

    ``files`` (comuna, kind, key, mb), as `sources.tables.output_sizes` lists them, adds to each entry the
    key and size of its products; a commune without a product has 0.0. The only collected group is
    the list of communes, one entry each.
    """
    lines, parts = catalog(rows), ["codigo", "nombre", F.struct(*COUNTS).alias("predios")]
    if files is not None:
        kinds = [("gpkg", "geometry"), ("csv", "csv"), ("csv_raw", "csv_raw")]
        own = lambda c, kind: F.max(F.when(F.col("kind") == kind, F.col(c)))
        listed = files.groupBy(F.col("comuna").cast("string").alias("codigo")).agg(
            *[own(c, kind).alias(f"_{name}_{c}") for name, kind in kinds for c in ("key", "mb")]
        )
        lines = lines.join(listed, "codigo", "left")
        parts.append(F.struct(*[
            F.struct(F.col(f"_{name}_key").alias("key"), F.coalesce(f"_{name}_mb", F.lit(0.0)).alias("tamano_mb")).alias(name) for name, _ in kinds
        ]).alias("archivos"))
    entry = F.struct(*parts)
    doc = lines.agg(
        F.count("*").alias("n"), F.array_sort(F.collect_list(entry)).alias("comunas"),
        *[F.sum(c).alias(c) for c in COUNTS],
    )
    when = F.current_timestamp() if stamp is None else stamp
    return doc.select(
        F.to_json(
            F.struct(
                F.lit(title).alias("fuente"), F.date_format(when, "yyyy-MM-dd'T'HH:mm:ssXXX").alias("timestamp"),
                F.col("n").alias("total_comunas"), "comunas", F.struct(*COUNTS).alias("totales"),
            )
        ).alias("document")
    )


# --- metrics documents --------------------------------------------------------------------


def merge_sections(existing: DataFrame, fresh: DataFrame) -> DataFrame:
    """Metric lines (comuna, section, name, value): a fresh section replaces the old one whole."""
    kept = existing.join(fresh.select("comuna", "section").distinct(), ["comuna", "section"], "left_anti")
    return kept.unionByName(fresh)


def metrics_json(lines: DataFrame) -> DataFrame:
    """One JSON document per commune: sections, each a map of name to value, in name order."""
    entries = lambda k, v: F.map_from_entries(F.array_sort(F.collect_list(F.struct(k, v))))
    sections = lines.groupBy("comuna", "section").agg(F.to_json(entries("name", "value")).alias("body"))
    parts = sections.groupBy("comuna").agg(F.array_sort(F.collect_list(F.struct("section", "body"))).alias("s"))
    text = F.transform("s", lambda p: F.concat(F.lit('"'), p["section"], F.lit('":'), p["body"]))
    return parts.select("comuna", F.concat(F.lit("{"), F.array_join(text, ","), F.lit("}")).alias("document"))


# --- boxes ---------------------------------------------------------------------------------


def exact_percentiles(values: DataFrame, keys: list[str], fractions: list[float], bin_width: float) -> DataFrame:
    """Interpolated percentiles of ``v`` per key: (keys, fraction, v).

    Counts per bin find the bins that hold the wanted ranks; only the values in those are
    looked at again, as distinct values with counts. No key's values meet in one task.
    """
    rows = values.where("v is not null").withColumn("_bin", F.floor(F.col("v") / bin_width))
    bins = rows.groupBy(*keys, "_bin").agg(F.count("*").alias("_n"))
    run = Window.partitionBy(*keys).orderBy("_bin").rowsBetween(Window.unboundedPreceding, 0)
    ranked = bins.withColumn("_end", F.sum("_n").over(run)).withColumn("_total", F.sum("_n").over(Window.partitionBy(*keys)))
    wanted = F.array(*[
        F.struct(
            F.lit(f).alias("fraction"), ((F.col("_total") - 1) * F.lit(f)).alias("pos"), at((F.col("_total") - 1) * F.lit(f)).alias("idx"), F.lit(side).alias("side"),
        ) for f in fractions for side, at in (("lo", F.floor), ("hi", F.ceil))
    ])
    hits = ranked.withColumn("_w", F.explode(wanted)).where(
        (F.col("_w.idx") >= F.col("_end") - F.col("_n")) & (F.col("_w.idx") < F.col("_end"))
    ).select(*keys, "_bin", "_w.*", (F.col("_w.idx") - (F.col("_end") - F.col("_n"))).alias("offset"))
    inside = rows.join(hits.select(*keys, "_bin").distinct(), [*keys, "_bin"], "left_semi").groupBy(*keys, "_bin", "v").agg(
        F.count("*").alias("_c")
    )
    within = Window.partitionBy(*keys, "_bin").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    inside = inside.withColumn("_to", F.sum("_c").over(within))
    found = inside.join(hits, [*keys, "_bin"]).where(
        (F.col("offset") >= F.col("_to") - F.col("_c")) & (F.col("offset") < F.col("_to"))
    )
    side = lambda s: F.max(F.when(F.col("side") == s, F.col("v")))
    return found.groupBy(*keys, "fraction").agg(
        side("lo").alias("_lo"), side("hi").alias("_hi"), F.max(F.col("pos") - F.floor("pos")).alias("_f")
    ).select(*keys, "fraction", (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_f")).alias("v"))


def iqr_bbox(points: DataFrame, fence: float = 3.0, bin_width: float = 0.001) -> DataFrame:
    """Box of each commune's points inside the quartile fences, axis by axis.

    ``points`` holds (comuna, lat, lon); nulls and zeros do not count.
    """
    rows = points.where("lat is not null and lat <> 0 and lon <> 0").select("comuna", "lat", "lon")
    long = rows.select("comuna", F.explode(F.array(
        F.struct(F.lit("lat").alias("axis"), F.col("lat").alias("v")), F.struct(F.lit("lon").alias("axis"), F.col("lon").alias("v"))
    )).alias("s")).select("comuna", "s.axis", "s.v")
    quart = exact_percentiles(long, ["comuna", "axis"], [0.25, 0.75], bin_width)
    pick = lambda axis, f: F.max(F.when((F.col("axis") == axis) & (F.col("fraction") == f), F.col("v")))
    stats = quart.groupBy("comuna").agg(
        pick("lat", 0.25).alias("a1"), pick("lat", 0.75).alias("a3"), pick("lon", 0.25).alias("o1"), pick("lon", 0.75).alias("o3")
    )
    fenced = lambda c, q1, q3: F.col(c).between(
        F.col(q1) - fence * (F.col(q3) - F.col(q1)), F.col(q3) + fence * (F.col(q3) - F.col(q1))
    )
    lat_in, lon_in = fenced("lat", "a1", "a3"), fenced("lon", "o1", "o3")
    return rows.join(stats, "comuna").groupBy("comuna").agg(
        F.min(F.when(lat_in, F.col("lat"))).alias("lat_min"), F.max(F.when(lat_in, F.col("lat"))).alias("lat_max"),
        F.min(F.when(lon_in, F.col("lon"))).alias("lon_min"), F.max(F.when(lon_in, F.col("lon"))).alias("lon_max"),
        F.count_if(lat_in).alias("count"),
    )


def simple_bbox(points: DataFrame, pad: float = C.BBOX_PAD_DEGREES) -> DataFrame:
    """Padded box of each commune's points; nulls and zeros do not count."""
    rows = points.where("lat is not null and lon is not null and lat <> 0 and lon <> 0")
    return rows.groupBy("comuna").agg(
        (F.min("lon") - pad).alias("min_lon"), (F.min("lat") - pad).alias("min_lat"),
        (F.max("lon") + pad).alias("max_lon"), (F.max("lat") + pad).alias("max_lat"),
    )


def area_histogram(areas: DataFrame) -> DataFrame:
    """Polygons per area bin; values outside the bins are not counted."""
    a, label = F.col("area_m2"), None
    for lo, hi in C.AREA_BINS:
        cond, name = (a >= lo) & (a < hi), f"{lo}-{hi}"
        label = F.when(cond, name) if label is None else label.when(cond, name)
    return areas.select(label.alias("bin")).where("bin is not null").groupBy("bin").agg(F.count("*").alias("n"))


def hole_counts(polygons: DataFrame, min_area: float) -> DataFrame:
    """Holes before and after filling, per commune."""
    kept = F.size(G.fill_holes(F.col("holes"), min_area))
    return polygons.groupBy("comuna").agg(
        F.sum(F.size("holes")).alias("before"), F.sum(kept).alias("kept"), F.sum(F.size("holes") - kept).alias("filled")
    )
