"""Geometry as nested arrays: polygons -> rings -> points(x, y).

The first ring of a polygon is its shell, further rings are holes. Rings are
closed. Everything here is a column expression, so it stays in the JVM.
"""

from math import pi

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import EARTH_RADIUS_M, MAX_MERCATOR_LAT


def point(x: Column, y: Column) -> Column:
    return F.struct(x.alias("x"), y.alias("y"))


def let(value: Column, fn) -> Column:
    """fn(value) with `value` evaluated once, however often `fn` refers to it."""
    return F.element_at(F.transform(F.array(value), fn), 1)


def map_points(geom: Column, fn) -> Column:
    """Apply a point -> point expression to every vertex."""
    return F.transform(geom, lambda poly: F.transform(poly, lambda ring: F.transform(ring, fn)))


def vertices(geom: Column) -> Column:
    return F.flatten(F.flatten(geom))


def bounds(geom: Column) -> list[Column]:
    """minx, miny, maxx, maxy of a feature."""
    pts = vertices(geom)
    xs = F.transform(pts, lambda p: p["x"])
    ys = F.transform(pts, lambda p: p["y"])
    return [
        F.array_min(xs).alias("minx"),
        F.array_min(ys).alias("miny"),
        F.array_max(xs).alias("maxx"),
        F.array_max(ys).alias("maxy"),
    ]


def unwrapped(ring: Column) -> Column:
    """A ring whose longitudes go on past +-180 instead of jumping to the other side."""

    def turn(acc, p):
        jump = p["x"] - acc["last"]
        offset = acc["offset"] + F.when(jump > 180, -360.0).when(jump < -180, 360.0).otherwise(0.0)
        pts = F.concat(acc["pts"], F.array(point(p["x"] + offset, p["y"])))
        return F.struct(p["x"].alias("last"), offset.alias("offset"), pts.alias("pts"))

    start = F.struct(
        F.element_at(ring, 1)["x"].alias("last"),
        F.lit(0.0).alias("offset"),
        F.array().cast("array<struct<x:double,y:double>>").alias("pts"),
    )
    jumps = F.exists(
        F.sequence(F.lit(2), F.greatest(F.size(ring), F.lit(2))),
        lambda i: F.abs(F.get(ring, i - 1)["x"] - F.get(ring, i - 2)["x"]) > 180,
    )
    return F.when(jumps, F.aggregate(ring, start, turn)["pts"]).otherwise(ring)


def segments(ring: Column) -> Column:
    """Array of (a, b) vertex pairs of a closed ring."""

    def pairs(r):
        n = F.greatest(F.size(r) - 1, F.lit(0))
        return F.zip_with(
            F.slice(r, F.lit(1), n),
            F.slice(r, F.lit(2), n),
            lambda a, b: F.struct(a.alias("a"), b.alias("b")),
        )

    return let(ring, pairs)


def signed_area(ring: Column) -> Column:
    """Shoelace area of a closed ring, positive when counter-clockwise.

    Coordinates are taken relative to the first vertex: far from the origin the
    products of full coordinates would lose the small differences.
    """

    def shoelace(r):
        o = F.element_at(r, 1)

        def cross(s):
            ax, ay = s["a"]["x"] - o["x"], s["a"]["y"] - o["y"]
            bx, by = s["b"]["x"] - o["x"], s["b"]["y"] - o["y"]
            return ax * by - bx * ay

        terms = F.transform(segments(r), lambda s: cross(s).cast("double"))
        return F.aggregate(terms, F.lit(0.0), lambda acc, t: acc + t) / 2

    return let(ring, shoelace)


def area(geom: Column) -> Column:
    """Sum over polygons of the shell minus its holes, whatever their direction."""
    ring_areas = F.transform(
        geom, lambda poly: F.transform(poly, lambda ring: F.abs(signed_area(ring)))
    )
    return F.aggregate(
        ring_areas,
        F.lit(0.0),
        lambda acc, rings: acc
        + F.coalesce(2 * F.element_at(rings, 1), F.lit(0.0))
        - F.aggregate(rings, F.lit(0.0), lambda s, r: s + r),
    )


def clamp_lat(lat: Column) -> Column:
    return F.greatest(F.least(lat, F.lit(MAX_MERCATOR_LAT)), F.lit(-MAX_MERCATOR_LAT))


def mercator(p: Column) -> Column:
    """Degrees to spherical Web-Mercator metres."""
    return point(
        F.radians(p["x"]) * EARTH_RADIUS_M,
        F.ln(F.tan(F.lit(pi / 4) + F.radians(p["y"]) / 2)) * EARTH_RADIUS_M,
    )


def world_x(lon: Column) -> Column:
    """Longitude as a fraction of the world's width, 0 at -180."""
    return (lon + 180.0) / 360.0


def world_y(lat: Column) -> Column:
    """Latitude as a fraction of the square world's height, 0 at the top."""
    r = F.radians(clamp_lat(lat))
    return (1.0 - F.ln(F.tan(r) + 1.0 / F.cos(r)) / pi) / 2.0


def bbox_text(minx: Column, miny: Column, maxx: Column, maxy: Column) -> Column:
    """[minx, miny, maxx, maxy] as text."""
    return F.concat(F.lit("["), F.concat_ws(", ", minx, miny, maxx, maxy), F.lit("]"))


def bbox_decimal(minx: Column, miny: Column, maxx: Column, maxy: Column) -> Column:
    """Bounding box as ARRAY<DECIMAL(10,7)>."""
    return F.array(minx, miny, maxx, maxy).cast("array<decimal(10,7)>")
