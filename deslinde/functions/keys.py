"""Parcel keys in their padded, integer and composed forms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from deslinde.functions import text as T


def zfill(col: Column, width: int = 5) -> Column:
    """Left-pad with zeros; longer text is left alone (``lpad`` alone would cut it)."""
    text = T.strip(col)
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def key_int(col: Column) -> Column:
    """Integer form of a key part, null when it is not a whole number; ``12.0`` is 12, as a table read as numbers writes it."""
    text = T.strip(col)
    number = text.try_cast("double")
    whole = (number == F.floor(number)) & (F.abs(number) < float(2**53))
    return F.coalesce(text.try_cast("bigint"), F.when(whole, number.cast("bigint")))


def compose_v(comuna: Column, manzana: Column, predio: Column) -> Column:
    """``commune|block|parcel``; null when a part is null."""
    return F.concat(comuna.cast("string"), F.lit("|"), manzana, F.lit("|"), predio)


def rol(manzana: Column, predio: Column) -> Column:
    return F.concat(manzana, F.lit("-"), predio)


def parse_v(v: Column) -> Column:
    """Struct of the three parts and ``valid``; malformed text is flagged, not guessed at."""
    parts = F.split(v, r"\|")
    comuna = F.try_element_at(parts, F.lit(1)).try_cast("int")
    valid = F.coalesce((F.size(parts) == 3) & comuna.isNotNull(), F.lit(False))
    return F.struct(
        F.when(valid, comuna).alias("comuna"),
        F.when(valid, T.strip(F.try_element_at(parts, F.lit(2)))).alias("manzana"),
        F.when(valid, T.strip(F.try_element_at(parts, F.lit(3)))).alias("predio"),
        valid.alias("valid"),
    )


def parse_v_strict(v: Column) -> Column:
    """As :func:`parse_v`, failing the job on a malformed key."""
    parsed = parse_v(v)
    return F.when(parsed["valid"], parsed).otherwise(
        F.raise_error(F.concat(F.lit("malformed parcel key: "), F.coalesce(v, F.lit("null"))))
    )


def coord_key(col: Column) -> Column:
    """Coordinate rounded half-even to six decimals, as an integer join key."""
    return F.rint(col * 1e6).cast("bigint")
