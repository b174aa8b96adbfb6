"""Parcel-shaped tables derived from the given ones by whole-number arithmetic.

Each table is one SELECT that Spark and DuckDB both run (``//`` becomes ``div`` for
Spark), over every row of its source table. Coordinates are whole micro-degrees, so
the two engines hold exactly the same places.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from deslinde.functions import geometry as G
from deslinde.functions import keys as K
from deslinde.session import spread

TABLES = {
    "fx_polygons": """
        SELECT p_partkey AS poly_idx, CAST(13101 + p_partkey % 5 AS INT) AS comuna,
               -70700000 + (p_partkey % 100) * 400 AS x0_u, -33500000 + (p_partkey // 100) * 400 AS y0_u,
               CAST(200 + (p_size % 10) * 10 AS BIGINT) AS w_u,
               p_partkey % 6 = 0 AS has_hole, p_partkey % 9 = 0 AS has_slit
        FROM part""",
    "fx_keyed_orders": """
        SELECT o_orderkey AS ok, o_orderkey % (SELECT count(*) FROM part) AS h,
               o_orderkey // (SELECT count(*) FROM part) AS u, o_totalprice
        FROM orders""",
    "fx_parcels": """
        SELECT ok, h, CAST(13101 + h % 5 AS INT) AS comuna, lpad(CAST(h // 10 AS STRING), 5, '0') AS manzana,
               (h % 10) * 12 + u AS num, lpad(CAST((h % 10) * 12 + u AS STRING), 5, '0') AS predio,
               CASE WHEN ok % 11 = 0 THEN NULL ELSE -70700000 + (h % 100) * 400
                    + (h * 37 + (u // 2) * 130) % 500 - 150 + CASE WHEN ok % 7 = 0 THEN 1 ELSE 0 END END AS x_u,
               CASE WHEN ok % 11 = 0 THEN NULL ELSE -33500000 + (h // 100) * 400
                    + (h * 53 + (u // 2) * 70) % 500 - 150 END AS y_u,
               CASE WHEN ok % 13 = 0 THEN NULL ELSE 'Calle ' || CAST(h % 50 AS STRING) || ' ' || CAST(h AS STRING)
                    || CASE ok % 4 WHEN 0 THEN '' WHEN 1 THEN ' DP 301' WHEN 2 THEN ' BX 2' ELSE ' BDP  12 T' END
               END AS address,
               CASE WHEN ok % 13 = 0 THEN NULL ELSE 'CALLE ' || CAST(h % 50 AS STRING) || ' ' || CAST(h AS STRING)
               END AS addr_expected,
               CASE WHEN ok % 3 <> 0 THEN 'URBANA' ELSE 'RURAL' END AS ubicacion, o_totalprice AS valor_total
        FROM fx_keyed_orders""",
    "fx_utm": """
        SELECT p_partkey AS poly_idx, 340000 + (p_partkey % 100) * 40 AS ux, 6290000 + (p_partkey // 100) * 40 AS uy
        FROM part""",
}
DEPENDS = {
    "fx_polygons": ["part"], "fx_keyed_orders": ["orders", "part"], "fx_parcels": ["fx_keyed_orders"],
    "fx_utm": ["part"],
}


def add_table(name: str, sql: str, depends: list[str]) -> None:
    TABLES[name] = sql
    DEPENDS[name] = depends


def source(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf}/{name}.parquet"))


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A given table or a derived one, as a lazy DataFrame."""
    if name not in TABLES:
        return source(spark, sf, name)
    parents = {d: table(spark, sf, d) for d in DEPENDS[name]}
    sql = TABLES[name].replace("//", " div ").replace("{", "{{").replace("}", "}}")
    for d in parents:
        sql = _word(sql, d, "{" + d + "}")
    return spark.sql(sql, **parents)


def _word(sql: str, word: str, by: str) -> str:
    import re

    return re.sub(rf"\b{word}\b", by, sql)


def with_tables(names: list[str], sql: str) -> str:
    """Oracle text: the derived tables as common table expressions before ``sql``."""
    ordered: list[str] = []

    def visit(n: str) -> None:
        if n in TABLES and n not in ordered:
            for d in DEPENDS[n]:
                visit(d)
            ordered.append(n)

    for n in names:
        visit(n)
    if not ordered:
        return sql
    ctes = ", ".join(f"{n} AS ({TABLES[n]})" for n in ordered)
    body = sql.strip()
    if body.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {ctes}, {body[15:]}"
    if body.upper().startswith("WITH "):
        return f"WITH {ctes}, {body[5:]}"
    return f"WITH {ctes} {body}"


def box(x0, y0, x1, y1):
    return G.box_ring(x0 / 1e6, y0 / 1e6, x1 / 1e6, y1 / 1e6)


def polygons(spark: SparkSession, sf: str) -> DataFrame:
    """Polygon layer in degrees: a square, a square hole in some, a slit in others."""
    x0, y0, w = F.col("x0_u"), F.col("y0_u"), F.col("w_u")
    hole, slit = box(x0 + 50, y0 + 50, x0 + 90, y0 + 90), box(x0 + 120, y0 + 50, x0 + 124, y0 + 110)
    holes = F.array_compact(F.array(F.when(F.col("has_hole"), hole), F.when(F.col("has_slit"), slit)))
    return table(spark, sf, "fx_polygons").select(
        "poly_idx", "comuna", box(x0, y0, x0 + w, y0 + w).alias("shell"), holes.alias("holes")
    )


def parcels(spark: SparkSession, sf: str, block: Column | None = None) -> DataFrame:
    return table(spark, sf, "fx_parcels").select(
        "ok", "comuna", (F.col("manzana") if block is None else block).alias("manzana"), "predio", "num",
        (F.col("y_u") / 1e6).alias("lat"), (F.col("x_u") / 1e6).alias("lon"),
        "address", "ubicacion", F.col("valor_total").alias("valorTotal"),
    )


def whole_block() -> Column:
    """The block as a key has it, from ``h``. The tables write it in five columns, which from block 100,000 on takes several for one."""
    return K.zfill(F.expr("cast(h div 10 as string)"))


def in_columns(block: str = "manzana") -> Column:
    """A whole block as the tables write it."""
    return F.substring(block, 1, 5)


def whole_parcels(spark: SparkSession, sf: str) -> DataFrame:
    """Parcels under their whole keys, no two of which are the same."""
    return parcels(spark, sf, whole_block())


def points(spark: SparkSession, sf: str) -> DataFrame:
    """Parcels that have coordinates, as places."""
    return parcels(spark, sf).where("lat is not null").select(
        "ok", "comuna", "manzana", "predio", "num", F.col("lon").alias("x"), F.col("lat").alias("y")
    )
