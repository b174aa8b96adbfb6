"""Inheritance joins: a row without a polygon takes it from a relative.

Donors are reduced to one row per key before the shuffle, so the join is against a
unique side whatever the size of a group; a hot receiver key is split by AQE.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deslinde import constants as C
from deslinde.functions import keys as K
from deslinde.session import cut, large

NUMBER_BUCKET = 256


def first_donor(donors: DataFrame, keys: list[str], values: list[str], order: list[str | Column]) -> DataFrame:
    """One row per key holding the values of its first donor."""
    usable = donors
    for k in keys:
        usable = usable.where(F.col(k).isNotNull())
    best = usable.groupBy(*keys).agg(F.min_by(F.struct(*values), F.struct(*order)).alias("_d"))
    return best.select(*keys, *[F.col("_d")[v].alias(v) for v in values])


def inherit_by_key(
    targets: DataFrame, donors: DataFrame, keys: list[str], order: list[str | Column], how: str = "inner"
) -> DataFrame:
    """Targets that find a donor with equal ``keys``; they get its ``poly_idx``.

    With ``how="left"`` the others stay, with a null.
    """
    return targets.join(large(first_donor(donors, keys, ["poly_idx"], order)), keys, how)


def with_coord_key(df: DataFrame) -> DataFrame:
    return df.withColumn("kx", K.coord_key(F.col("x"))).withColumn("ky", K.coord_key(F.col("y")))


def inherit_coord(
    targets: DataFrame, donors: DataFrame, order: list[str | Column], how: str = "inner"
) -> DataFrame:
    """Same coordinate to six decimals."""
    return inherit_by_key(with_coord_key(targets), with_coord_key(donors), ["comuna", "kx", "ky"], order, how).drop("kx", "ky")


def inherit_address(
    targets: DataFrame, donors: DataFrame, order: list[str | Column], how: str = "inner"
) -> DataFrame:
    """Same block and address base."""
    return inherit_by_key(targets, donors, ["comuna", "manzana", "addr"], order, how)


def inherit_block_any(
    targets: DataFrame, donors: DataFrame, order: list[str | Column], how: str = "inner"
) -> DataFrame:
    """Same block, first matched parcel."""
    return inherit_by_key(targets, donors, ["comuna", "manzana"], order, how)


def asof_neighbor(
    targets: DataFrame, donors: DataFrame, tolerance: int | None = C.NEIGHBOUR_TOLERANCE, how: str = "inner"
) -> DataFrame:
    """Nearest number within the block: targets plus ``poly_idx`` and ``diff``.

    Both sides need (comuna, manzana, num). A tie goes to the lower number. Numbers are
    reduced to the distinct ones and cut into buckets of ``NUMBER_BUCKET``: a first
    window runs inside a bucket, so it never sees more than that many rows, and a
    second one carries the last donor over from the buckets before and after it.
    Parcel numbers have five digits, which bounds the second by a few hundred rows.
    """
    keys = ["comuna", "manzana"]
    given = first_donor(donors, [*keys, "num"], ["poly_idx"], ["poly_idx"])
    asked = targets.where(F.col("num").isNotNull()).select(*keys, "num").distinct().withColumn(
        "poly_idx", F.lit(None).cast("bigint")
    )
    marks = (
        given.withColumn("_ask", F.lit(0)).unionByName(asked.withColumn("_ask", F.lit(1)))
        .groupBy(*keys, "num").agg(F.max("poly_idx").alias("poly_idx"), F.max("_ask").alias("_ask"))
        .withColumn("_b", F.floor(F.col("num") / NUMBER_BUCKET))
        .withColumn("_m", F.when(F.col("poly_idx").isNotNull(), F.struct("num", "poly_idx")))
    )
    inner = Window.partitionBy(*keys, "_b").orderBy("num")
    whole = Window.partitionBy(*keys, "_b").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    back, ahead = (Window.unboundedPreceding, Window.currentRow), (Window.currentRow, Window.unboundedFollowing)
    local = (
        marks.withColumn("_low", F.last("_m", ignorenulls=True).over(inner.rowsBetween(*back)))
        .withColumn("_high", F.first("_m", ignorenulls=True).over(inner.rowsBetween(*ahead)))
        .withColumn("_bmin", F.min("_m").over(whole))
        .withColumn("_bmax", F.max("_m").over(whole))
    )
    local = cut(local)  # read twice below
    buckets = local.groupBy(*keys, "_b").agg(F.first("_bmin").alias("_bmin"), F.first("_bmax").alias("_bmax"))
    over = Window.partitionBy(*keys).orderBy("_b")
    carried = buckets.select(
        *keys, "_b",
        F.last("_bmax", ignorenulls=True).over(over.rowsBetween(Window.unboundedPreceding, -1)).alias("_before"),
        F.first("_bmin", ignorenulls=True).over(over.rowsBetween(1, Window.unboundedFollowing)).alias("_after"),
    )
    low, high = F.coalesce("_low", "_before"), F.coalesce("_high", "_after")

    def rank(m: Column) -> Column:
        return F.when(
            m.isNotNull(),
            F.struct(F.abs(m["num"] - F.col("num")).alias("diff"), m["num"].alias("n"), m["poly_idx"].alias("poly_idx")),
        )

    answered = (
        local.where("_ask = 1").join(large(carried), [*keys, "_b"])
        .select(*keys, "num", F.array_min(F.array_compact(F.array(rank(low), rank(high)))).alias("_r"))
        .where("_r is not null")
        .select(*keys, "num", F.col("_r.poly_idx").alias("poly_idx"), F.col("_r.diff").alias("diff"))
    )
    if tolerance is not None:
        answered = answered.where(F.col("diff") <= tolerance)
    return targets.join(large(answered), [*keys, "num"], how)


def asof_anchor(targets: DataFrame, anchors: DataFrame, how: str = "inner") -> DataFrame:
    """Nearest number in the block among supplied anchors (comuna, poly_idx, rol), without tolerance."""
    parts = F.split(F.col("rol"), "-")
    donors = anchors.where(F.size(parts) == 2).select(
        "comuna", parts[0].alias("manzana"), parts[1].try_cast("bigint").alias("num"), "poly_idx"
    )
    return asof_neighbor(targets, donors.where("num is not null"), None, how)


def blocks_without_match(unmatched: DataFrame, matched: DataFrame) -> DataFrame:
    """Distinct (comuna, manzana) with a parcel to place and none placed."""
    keys = ["comuna", "manzana"]
    return unmatched.where("manzana is not null").select(*keys).distinct().join(
        large(matched.select(*keys).distinct()), keys, "left_anti"
    )


def fill_from_address_donors(rows: DataFrame, fields: list[str], order: list[str | Column]) -> DataFrame:
    """Fill ``lat``, ``lon`` and ``fields`` of rows without coordinates from the first row
    with the same block and address base that has them, each only where it is null."""
    from deslinde.functions.text import present

    has = present(F.col("lat"))
    values = ["lat", "lon", *fields]
    donors = first_donor(rows.where(has & F.col("addr").isNotNull()), ["comuna", "manzana", "addr"], values, order)
    given = donors.select("comuna", "manzana", "addr", *[F.col(v).alias(f"_d_{v}") for v in values])
    joined = rows.join(large(given), ["comuna", "manzana", "addr"], "left")
    # a coordinate written as a null word counts as missing but is not overwritten field by field
    return joined.select(
        *[
            F.when(has, F.col(c)).otherwise(F.coalesce(F.col(c), F.col(f"_d_{c}"))).alias(c) if c in values else F.col(c)
            for c in rows.columns
        ],
        (~has & F.col("_d_lat").isNotNull()).alias("inherited"),
    )


def address_backfill(rows: DataFrame, order: list[str | Column]) -> DataFrame:
    """Give parcels without an address the first address seen in the same polygon."""
    known = first_donor(rows.where("address is not null"), ["poly_idx"], ["address"], order)
    given = known.withColumnRenamed("address", "_given")
    return rows.join(large(given), "poly_idx", "left").withColumn("address", F.coalesce("address", "_given")).drop("_given")
