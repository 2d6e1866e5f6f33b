"""Tile geometry as column expressions: Web-Mercator tiles, y downwards.

Tile coordinates are single-precision, as they are stored; the arithmetic behind them is double.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import ZOOMS

#: Metres; the sphere on which distances are taken, at an altitude of 5280 miles above it.
EARTH_RADIUS = 6_378_137.0
ALTITUDE = 5280 * 1609.344
#: Part of a tile by which elements reach over its edge.
BORDER = 1 / 16
#: Longest segment, in tile units, that is kept undivided.
LONGEST = 8000.0


def _col(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def _pow2(zoom) -> Column:
    return F.shiftleft(F.lit(1).cast("long"), zoom) if isinstance(zoom, int) else F.pow(F.lit(2.0), _col(zoom))


def tile_x(lon: Column, zoom) -> Column:
    return ((lon + 180.0) / 360.0 * _pow2(zoom)).cast("float")


def tile_y(lat: Column, zoom) -> Column:
    r = F.radians(lat)
    return ((1.0 - F.log(F.tan(r) + 1.0 / F.cos(r)) / math.pi) / 2.0 * _pow2(zoom)).cast("float")


def tile_lon(x: Column, zoom) -> Column:
    return x / _pow2(zoom) * 360.0 - 180.0


def tile_lat(y: Column, zoom) -> Column:
    return F.degrees(F.atan(F.sinh(math.pi * (1.0 - 2.0 * y / _pow2(zoom)))))


def tile_bounds(zoom: Column, x: Column, y: Column) -> dict[str, Column]:
    """The tile's latT, lonL, latB and lonR."""
    return {"latT": tile_lat(y, zoom), "lonL": tile_lon(x, zoom), "latB": tile_lat(y + 1, zoom), "lonR": tile_lon(x + 1, zoom)}


def geo_xyz(lat: Column, lon: Column) -> tuple[Column, Column, Column]:
    """Position above the sphere."""
    a, b, r = F.radians(lat), F.radians(lon), EARTH_RADIUS + ALTITUDE
    return r * F.cos(a) * F.cos(b), r * F.cos(a) * F.sin(b), r * F.sin(a)


def min_distance(zoom: Column, x: Column, y: Column) -> Column:
    """Distance below which a way's next point is dropped in the tile."""
    b = tile_bounds(zoom, x, y)
    p, q = geo_xyz(b["latT"], b["lonL"]), geo_xyz(b["latB"], b["lonR"])
    d = F.sqrt(sum((u - v) * (u - v) for u, v in zip(p, q, strict=True)))
    return (F.when(zoom == 15, 8 / 32).otherwise(8 / 2) * d / math.sqrt(2 * 256 * 256)).cast("float")


def served(min_zoom: Column) -> Column:
    """The stored zooms at which a feature from ``min_zoom`` on is placed."""
    return F.filter(F.array(*map(F.lit, ZOOMS)), lambda z: min_zoom <= z + 1)


def point_tiles(lat: Column, lon: Column, min_zoom: Column) -> Column:
    """The tiles (zoom, x, y) that hold a point. Not clamped: a point beyond the map's edge keeps its number."""
    return F.transform(
        served(min_zoom), lambda z: F.struct(z.alias("zoom"), tile_x(lon, z).cast("int").alias("x"), tile_y(lat, z).cast("int").alias("y"))
    )


def box_span(latT: Column, lonL: Column, latB: Column, lonR: Column, zoom: Column, center: Column) -> Column:
    """The tiles of a zoom that a box touches, with a border, as (x0, x1, y0, y1); with ``center`` only its middle's."""
    middle = lambda whole, a, b: F.when(center, (a + b) / 2.0).otherwise(whole)
    border = F.when(center, 0.0).otherwise(BORDER).cast("float")
    last = F.pow(F.lit(2.0), zoom).cast("int") - 1
    inside = lambda v: F.least(F.greatest(v.cast("int"), F.lit(0)), last)
    return F.struct(
        inside(tile_x(middle(lonL, lonL, lonR), zoom) - border).alias("x0"), inside(tile_x(middle(lonR, lonL, lonR), zoom) + border).alias("x1"),
        inside(tile_y(middle(latT, latT, latB), zoom) - border).alias("y0"), inside(tile_y(middle(latB, latT, latB), zoom) + border).alias("y1"),
    )


def local_xy(lat: Column, lon: Column, zoom: Column, x: Column, y: Column) -> tuple[Column, Column]:
    """Position within a tile: -16384 to 16383 from left to right and bottom to top, single precision."""
    scale, shift, one = F.lit(32767.0).cast("float"), F.lit(16384.0).cast("float"), F.lit(1.0).cast("float")
    u = tile_x(lon, zoom) - x.cast("float")
    v = one - (tile_y(lat, zoom) - y.cast("float"))
    return (scale * u - shift).cast("float"), (scale * v - shift).cast("float")


def to_short(v: Column) -> Column:
    """Truncated to the range of a short."""
    return F.least(F.greatest(v, F.lit(-32768.0).cast("float")), F.lit(32767.0).cast("float")).cast("int").cast("short")


def point(lat: Column, lon: Column, zoom: Column, x: Column, y: Column) -> Column:
    px, py = local_xy(lat, lon, zoom, x, y)
    return F.struct(to_short(px).alias("x"), to_short(py).alias("y"))


def densify(points: Column) -> Column:
    """Local points (x, y) with more between those that are further apart than LONGEST."""

    def after(p: Column, i: Column) -> Column:
        q = F.get(points, i - 1)
        dx, dy = p["x"] - q["x"], p["y"] - q["y"]
        d = F.sqrt(dx * dx + dy * dy)
        n = (d / LONGEST).cast("int")
        between = F.transform(
            F.when(n >= 2, F.sequence(F.lit(1), n - 1)).otherwise(F.array().cast("array<int>")),
            lambda k: F.struct((q["x"] + dx / d * k * LONGEST).cast("float").alias("x"), (q["y"] + dy / d * k * LONGEST).cast("float").alias("y")),
        )
        here = F.array(F.struct(p["x"].cast("float").alias("x"), p["y"].cast("float").alias("y")))
        return F.when((i > 0) & (d > 0), F.concat(between, here)).otherwise(here)

    return F.flatten(F.transform(points, after))


def drop_repeats(points: Column) -> Column:
    """Points without those that equal the one before."""
    return F.filter(points, lambda p, i: (i == 0) | ~p.eqNullSafe(F.get(points, i - 1)))


def sub_range(zoom: Column, x: Column, y: Column) -> Column:
    """Where a tile of any zoom lies in the stored tile that serves it, in local units: t, l, b, r."""
    stored = F.when(zoom >= 15, 15).when((zoom > 3) & (zoom % 2 == 0), zoom - 1).otherwise(zoom)
    n = F.pow(F.lit(2.0), zoom - stored).cast("int")
    s = (F.lit(32768) / n).cast("int")
    j, i = F.pmod(x, n), F.pmod(y, n)
    return F.struct(
        (16383 - i * s).alias("t"), (-16384 + j * s).alias("l"), (-16384 + (n - 1 - i) * s).alias("b"), (16383 - (n - 1 - j) * s).alias("r")
    )


def stored_tile(zoom: Column, x: Column, y: Column) -> Column:
    """The stored tile (zoom, x, y) that serves a tile of any zoom."""
    stored = F.when(zoom >= 15, 15).when((zoom > 3) & (zoom % 2 == 0), zoom - 1).otherwise(zoom)
    n = F.pow(F.lit(2.0), zoom - stored).cast("int")
    return F.struct(stored.cast("int").alias("zoom"), (x / n).cast("int").alias("x"), (y / n).cast("int").alias("y"))


def overlaps(zoom: Column, x: Column, y: Column, region: tuple[float, float, float, float]) -> Column:
    """Whether a tile and a region (latT, lonL, latB, lonR) touch."""
    b, (latT, lonL, latB, lonR) = tile_bounds(zoom, x, y), region
    return ~((b["latT"] < latB) | (b["lonL"] > lonR) | (b["latB"] > latT) | (b["lonR"] < lonL))


def parse_request(text: Column) -> Column:
    """"/name/zoom/x/y" as (zoom, x, y); null where it isn't a request."""
    form = r"^/[A-Za-z0-9]+/(\d{1,9})/(\d{1,9})/(\d{1,9})"
    part = lambda k: F.regexp_extract(text, form, k).try_cast("int")
    parts = F.struct(part(1).alias("zoom"), part(2).alias("x"), part(3).alias("y"))
    return F.when(text.rlike(form), parts)
