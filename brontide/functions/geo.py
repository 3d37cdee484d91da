"""Coordinates: guards, transverse Mercator to geographic, and points in polygons."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The box that a coordinate must lie in, as longitude and latitude.
BOX = (124.0, 132.0, 33.0, 43.0)
#: The box of the city that projected coordinates must lie in.
CITY = (126.6, 127.3, 37.3, 37.75)
#: Fixed values of the projection: GRS80, central meridian and latitude, scale, false origin.
AXIS, FLATTENING = 6378137.0, 1 / 298.257222101
CENTRE_LON, CENTRE_LAT, SCALE, EAST, NORTH = 127.0, 38.0, 1.0, 200_000.0, 500_000.0


def guarded(value: Column, low: float, high: float) -> Column:
    """A number within bounds, else null."""
    n = value.try_cast("double")
    return F.when(n.between(low, high), n)


def longitude(value: Column) -> Column:
    return guarded(value, BOX[0], BOX[1])


def latitude(value: Column) -> Column:
    return guarded(value, BOX[2], BOX[3])


def _meridian(lat: float, e2: float) -> float:
    """Arc from the equator, by the usual series in e2."""
    a = 1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256
    b = 3 * e2 / 8 + 3 * e2**2 / 32 + 45 * e2**3 / 1024
    c = 15 * e2**2 / 256 + 45 * e2**3 / 1024
    d = 35 * e2**3 / 3072
    return AXIS * (a * lat - b * math.sin(2 * lat) + c * math.sin(4 * lat) - d * math.sin(6 * lat))


def with_geographic(df: DataFrame, x: str, y: str, lon: str = "longitude", lat: str = "latitude", box: tuple[float, float, float, float] = CITY) -> DataFrame:
    """df with longitude and latitude of projected metres (x east, y north); null out of the box.

    The inverse series goes in layers of named columns, so that no expression repeats another.
    """
    e2 = FLATTENING * (2 - FLATTENING)
    ep2 = e2 / (1 - e2)
    e1 = (1 - math.sqrt(1 - e2)) / (1 + math.sqrt(1 - e2))
    origin = _meridian(math.radians(CENTRE_LAT), e2)
    arc = AXIS * (1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256)
    c = F.col
    out = df.withColumn("_mu", (origin + (c(y).try_cast("double") - NORTH) / SCALE) / arc)
    mu = c("_mu")
    out = out.withColumn(
        "_phi",
        mu + (3 * e1 / 2 - 27 * e1**3 / 32) * F.sin(2 * mu) + (21 * e1**2 / 16 - 55 * e1**4 / 32) * F.sin(4 * mu) + (151 * e1**3 / 96) * F.sin(6 * mu) + (1097 * e1**4 / 512) * F.sin(8 * mu),
    )
    out = out.withColumns({"_sin": F.sin("_phi"), "_cos": F.cos("_phi"), "_tan": F.tan("_phi")})
    out = out.withColumns({"_c": ep2 * c("_cos") * c("_cos"), "_t": c("_tan") * c("_tan"), "_w": F.sqrt(1 - e2 * c("_sin") * c("_sin"))})
    out = out.withColumns({"_n": AXIS / c("_w"), "_r": AXIS * (1 - e2) / F.pow("_w", F.lit(3.0))})
    out = out.withColumn("_d", (c(x).try_cast("double") - EAST) / (c("_n") * SCALE))
    d, t, cc = c("_d"), c("_t"), c("_c")
    d2 = d * d
    lat_terms = d2 / 2 - (5 + 3 * t + 10 * cc - 4 * cc * cc - 9 * ep2) * d2 * d2 / 24 + (61 + 90 * t + 298 * cc + 45 * t * t - 252 * ep2 - 3 * cc * cc) * d2 * d2 * d2 / 720
    lon_terms = d - (1 + 2 * t + cc) * d2 * d / 6 + (5 - 2 * cc + 28 * t - 3 * cc * cc + 8 * ep2 + 24 * t * t) * d2 * d2 * d / 120
    out = out.withColumns({"_lat": F.degrees(c("_phi") - c("_n") * c("_tan") / c("_r") * lat_terms), "_lon": CENTRE_LON + F.degrees(lon_terms / c("_cos"))})
    out = out.withColumns({lon: guarded(c("_lon"), box[0], box[1]), lat: guarded(c("_lat"), box[2], box[3])})
    return out.drop("_mu", "_phi", "_sin", "_cos", "_tan", "_c", "_t", "_w", "_n", "_r", "_d", "_lat", "_lon")


def ring_of(wkt: Column) -> Column:
    """The outer ring of a POLYGON text as array of (x, y)."""
    body = F.regexp_extract(wkt, r"\(\(([^)]*)\)", 1)
    points = F.filter(F.split(body, ","), lambda p: F.trim(p) != "")
    number = lambda p, i: F.try_element_at(F.split(F.trim(p), r"\s+"), F.lit(i)).try_cast("double")
    return F.transform(points, lambda p: F.struct(number(p, 1).alias("x"), number(p, 2).alias("y")))


def inside(x: Column, y: Column, ring: Column) -> Column:
    """Even-odd rule: how often a ray to the right crosses the ring's edges."""
    n = F.size(ring)

    def crossed(i: Column) -> Column:
        a, b = F.get(ring, i), F.get(ring, F.pmod(i + 1, n))
        spans = (a["y"] > y) != (b["y"] > y)
        at = a["x"] + (b["x"] - a["x"]) * (y - a["y"]) / F.nullif(b["y"] - a["y"], F.lit(0.0))
        return F.when(spans & (x < at), 1).otherwise(0)

    return F.aggregate(F.transform(F.sequence(F.lit(0), n - 1), crossed), F.lit(0), lambda s, v: s + v) % 2 == 1


def points_in_polygons(points: DataFrame, shapes: DataFrame, x: str, y: str, ring: str, cell: float = 0.05) -> DataFrame:
    """Every point with every shape that holds it.

    Shapes are spread over the cells of their bounding box and points over their own cell; an
    equi-join on cells leaves few pairs for the ray test, and no pair meets twice.
    """
    at = lambda v: F.floor(v / cell).cast("long")
    xs, ys = F.transform(ring, lambda p: p["x"]), F.transform(ring, lambda p: p["y"])
    boxed = shapes.where(F.size(ring) >= 3)
    boxed = boxed.withColumn("_cx", F.explode(F.sequence(at(F.array_min(xs)), at(F.array_max(xs)))))
    boxed = boxed.withColumn("_cy", F.explode(F.sequence(at(F.array_min(ys)), at(F.array_max(ys)))))
    placed = points.withColumns({"_cx": at(F.col(x)), "_cy": at(F.col(y))})
    return placed.join(boxed, ["_cx", "_cy"]).where(inside(F.col(x), F.col(y), F.col(ring))).drop("_cx", "_cy")
