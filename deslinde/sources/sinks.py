"""Writers, and the projections they need."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deslinde import constants as C
from deslinde.operators.spatial import with_bounds
from deslinde.session import cut


def write_pipe_csv(df: DataFrame, path: str) -> None:
    """Pipe-separated text, one folder per commune; a commune's rows come from few tasks, so it has few files."""
    ranged = df.repartitionByRange("comuna", *[c for c in ("manzana", "predio") if c in df.columns])
    ranged.write.mode("overwrite").partitionBy("comuna").option("header", True).option("sep", "|").csv(path)


def write_quoted_csv(df: DataFrame, path: str, mode: str = "append") -> None:
    ranged = df.repartitionByRange("comuna", *[c for c in ("manzana", "predio") if c in df.columns])
    ranged.write.mode(mode).partitionBy("comuna").option("header", True).option("quoteAll", True).csv(path)


def write_geometry(df: DataFrame, path: str, rows_per_file: int = 2_000_000) -> None:
    """Parquet per commune, with box columns so that row groups can be skipped.

    Ranging by commune and box gives every commune a few files, a large one several, and
    keeps neighbours in the same row groups.
    """
    boxed = with_bounds(df)
    boxed.repartitionByRange("comuna", "miny").sortWithinPartitions("comuna", "miny", "minx").write.mode("overwrite").option(
        "maxRecordsPerFile", rows_per_file
    ).partitionBy("comuna").parquet(path)


def write_products(rows: DataFrame, registry: DataFrame, folder: str) -> dict[str, str]:
    """The three products: shapes, attributes without shapes, the raw registry slice. ``rows`` are worked out once."""
    rows = cut(rows)
    paths = {"geometry": f"{folder}/geometry", "csv": f"{folder}/csv", "csv_raw": f"{folder}/csv_raw"}
    write_geometry(rows.where("shell is not null"), paths["geometry"])
    attributes = rows.drop("shell", "holes").repartitionByRange("comuna", *[c for c in ("manzana", "predio") if c in rows.columns])
    attributes.write.mode("overwrite").option("header", True).partitionBy("comuna").csv(paths["csv"])
    registry.repartitionByRange("comuna", "manzana").write.mode("overwrite").option("header", True).partitionBy("comuna").csv(paths["csv_raw"])
    return paths


def header_for(columns: list[str]) -> list[str]:
    """Preferred columns first, the rest in name order, the overflow column always there."""
    have = {*columns, "_extra_json"}
    first = [c for c in C.PREFERRED_ORDER if c in have]
    return first + sorted(have - set(first))


def _sorted_json(m: Column) -> Column:
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(m))))


def project_to_header(rows: DataFrame, header: list[str], attrs: str = "attrs") -> DataFrame:
    """Rows in the order of a fixed header.

    Open attributes named in the header become columns; the others, and what an earlier
    ``_extra_json`` held, go into ``_extra_json``.
    """
    inside = F.array(*[F.lit(h) for h in header])
    unknown = F.map_filter(F.col(attrs), lambda k, _: ~F.array_contains(inside, k) & (k != "_extra_json"))
    extra_columns = [c for c in rows.columns if c not in header and c != attrs]
    pairs = [x for c in extra_columns for x in (F.lit(c), F.col(c).cast("string"))]
    unknown = F.map_concat(unknown, F.create_map(*pairs)) if pairs else unknown
    before = F.col("_extra_json") if "_extra_json" in rows.columns else F.lit(None).cast("string")
    earlier = F.coalesce(F.from_json(before, "map<string,string>"), F.create_map().cast("map<string,string>"))
    merged = F.map_concat(F.map_filter(earlier, lambda k, _: ~F.array_contains(F.map_keys(unknown), k)), unknown)
    extra = F.when(F.size(merged) > 0, _sorted_json(merged)).otherwise(F.coalesce(before, F.lit("")))

    def column(h: str) -> Column:
        if h == "_extra_json":
            return extra.alias(h)
        if h in rows.columns:
            return F.col(h)
        return F.try_element_at(F.col(attrs), F.lit(h)).alias(h)

    return rows.select(*[column(h) for h in header])


def consolidate(parts: list[DataFrame]) -> DataFrame:
    """All parts, the columns of any of them, missing values null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
