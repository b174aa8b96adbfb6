"""Request bodies as a manifest column. Nothing is sent from here."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from deslinde import constants as C


def services(comuna: Column, mode: str = "default", layer_word: Column | None = None) -> Column:
    """Service list of a mode; a layer word puts the commune's own map layer first."""

    def one(layer: Column, style: str, eac: int, year: int) -> Column:
        return F.struct(
            comuna.cast("int").alias("comuna"), layer.alias("layer"), F.lit(style).alias("style"),
            F.lit(eac).alias("eac"), F.lit(year).alias("eacano"),
        )

    listed = F.array(*[one(F.lit(layer), style, eac, year) for layer, style, eac, year in C.SERVICES[mode]])
    if layer_word is None:
        return listed
    own = one(F.format_string(C.LAYER_NAME, layer_word), C.PARCEL_LAYER_STYLE, 0, 0)
    return F.when(F.coalesce(layer_word, F.lit("")) != "", F.concat(F.array(own), listed)).otherwise(listed)


def parcel_request(
    comuna: Column, manzana: Column, predio: Column, mode: str = "default", layer_word: Column | None = None
) -> Column:
    """JSON body asking for one parcel, numbers without padding."""
    plain = lambda c: c.cast("bigint").cast("string")
    return F.to_json(
        F.struct(
            F.struct(
                F.struct(
                    plain(comuna).alias("comuna"), plain(manzana).alias("manzana"), plain(predio).alias("predio")
                ).alias("predio"),
                services(comuna, mode, layer_word).alias("servicios"),
            ).alias("data")
        )
    )


def click_box(lat: Column, lon: Column) -> Column:
    """Box around a point for a point query."""
    return F.struct(
        (lat - C.CLICK_HALF_LAT).alias("southwestx"), (lon - C.CLICK_HALF_LON).alias("southwesty"),
        (lat + C.CLICK_HALF_LAT).alias("northeastx"), (lon + C.CLICK_HALF_LON).alias("northeasty"),
    )
