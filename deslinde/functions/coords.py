"""Coordinate checks, tile arithmetic and projections as closed-form columns."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from deslinde import constants as C

TILE_M = 2 * C.MERCATOR_HALF / 2**C.ZOOM


def valid_coord(lat: Column, lon: Column, legacy: bool = False) -> Column:
    """True inside the national box; nulls are false."""
    top = C.LAT_MAX_LEGACY if legacy else C.LAT_MAX
    return F.coalesce(
        lat.between(C.LAT_MIN, top) & lon.between(C.LON_MIN, C.LON_MAX), F.lit(False)
    )


def tile_x(lon: Column, zoom: int = C.ZOOM) -> Column:
    return ((lon + 180.0) / 360.0 * 2**zoom).cast("bigint")


def tile_y(lat: Column, zoom: int = C.ZOOM) -> Column:
    return ((1.0 - F.asinh(F.tan(F.radians(lat))) / math.pi) / 2.0 * 2**zoom).cast("bigint")


def tile_range(min_lon: Column, min_lat: Column, max_lon: Column, max_lat: Column) -> Column:
    """Struct of first and last tile in x and y for a box."""
    xa, xb = tile_x(min_lon), tile_x(max_lon)
    ya, yb = tile_y(max_lat), tile_y(min_lat)
    return F.struct(
        F.least(xa, xb).alias("x0"), F.greatest(xa, xb).alias("x1"),
        F.least(ya, yb).alias("y0"), F.greatest(ya, yb).alias("y1"),
    )


def raster_gb(tiles_x: Column, tiles_y: Column) -> Column:
    """Size in GiB of the RGBA raster over that many tiles, one decimal."""
    raw = tiles_x.cast("double") * tiles_y.cast("double") * (C.TILE_PX**2 * 4) / float(1024**3)
    return F.round(raw, 1)


def tile_box(x: Column, y: Column, tiles: int = 1, zoom: int = C.ZOOM) -> Column:
    """Mercator box of ``tiles`` x ``tiles`` tiles whose top left is (x, y)."""
    size = 2 * C.MERCATOR_HALF / 2**zoom
    left = x * F.lit(size) - C.MERCATOR_HALF
    top = F.lit(C.MERCATOR_HALF) - y * F.lit(size)
    return F.struct(
        left.alias("minx"), (top - tiles * size).alias("miny"),
        (left + tiles * size).alias("maxx"), top.alias("maxy"),
    )


def align(tile: Column, step: int = C.CELL_TILES) -> Column:
    return tile - F.pmod(tile, F.lit(step))


def mercator_x(lon: Column) -> Column:
    return F.radians(lon) * C.EARTH_RADIUS


def mercator_y(lat: Column) -> Column:
    return F.log(F.tan(F.lit(math.pi / 4) + F.radians(lat) / 2.0)) * C.EARTH_RADIUS


def lon_of(x: Column) -> Column:
    return F.degrees(x / C.EARTH_RADIUS)


def lat_of(y: Column) -> Column:
    return F.degrees(F.atan(F.exp(y / C.EARTH_RADIUS)) * 2.0 - math.pi / 2)


def utm_to_lonlat(east: Column, north: Column, zone: int = 19, south: bool = True) -> Column:
    """UTM to WGS84 by the inverse Krueger series in the third flattening."""
    flat = 1 / 298.257223563
    n = flat / (2 - flat)
    rectifying = C.EARTH_RADIUS / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    beta = (n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96, n**2 / 48 + n**3 / 15, 17 * n**3 / 480)
    delta = (2 * n - 2 * n**2 / 3 - 2 * n**3, 7 * n**2 / 3 - 8 * n**3 / 5, 56 * n**3 / 15)
    scale = 0.9996 * rectifying

    def footpoint(p: Column) -> Column:
        xi, eta = p["xi"], p["eta"]
        for j, b in enumerate(beta, start=1):
            xi = xi - F.sin(p["xi"] * (2 * j)) * F.cosh(p["eta"] * (2 * j)) * b
            eta = eta - F.cos(p["xi"] * (2 * j)) * F.sinh(p["eta"] * (2 * j)) * b
        return F.struct(xi.alias("xi"), eta.alias("eta"))

    def conformal(p: Column) -> Column:
        return F.struct(
            F.asin(F.sin(p["xi"]) / F.cosh(p["eta"])).alias("chi"), F.atan2(F.sinh(p["eta"]), F.cos(p["xi"])).alias("lam")
        )

    def geodetic(p: Column) -> Column:
        lat = p["chi"]
        for j, d in enumerate(delta, start=1):
            lat = lat + F.sin(p["chi"] * (2 * j)) * d
        return F.struct(
            F.degrees(p["lam"] + math.radians(zone * 6 - 183)).alias("lon"), F.degrees(lat).alias("lat")
        )

    # one-element arrays name the intermediate values; written out, the series would repeat them a hundred times
    given = F.struct(
        ((north - (10000000.0 if south else 0.0)) / scale).alias("xi"), ((east - 500000.0) / scale).alias("eta")
    )
    steps = F.array(given)
    for step in (footpoint, conformal, geodetic):
        steps = F.transform(steps, step)
    return steps[0]


def degree_metres(deg: Column) -> Column:
    """Metres by the flat degree rule (no cosine), as the match labels use it."""
    return deg * C.METRES_PER_DEGREE


def degree_area_m2(area: Column) -> Column:
    return area * float(C.METRES_PER_DEGREE) * float(C.METRES_PER_DEGREE)


def true_area_m2(area: Column, lat: Column) -> Column:
    """Ground area of a small degree-unit area at ``lat``."""
    per_degree = math.pi * C.EARTH_RADIUS / 180.0
    return area * per_degree * per_degree * F.cos(F.radians(lat))
