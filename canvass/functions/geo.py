"""Planar geometry on points and polygon rings, as native column expressions.

A polygon is an array of rings, a ring an array of ``struct<x, y>``. Holes and
multi-polygons need no special case: "inside" is decided by the even-odd rule over all
rings, and the distance is taken to the nearest edge of any ring.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canvass.functions.columns import ColumnLike, as_column

# WGS 84 ellipsoid and the UTM grid.
SEMI_MAJOR = 6378137.0
FLATTENING = 1 / 298.257223563
SCALE = 0.9996
FALSE_EASTING = 500000.0
FALSE_NORTHING_SOUTH = 10000000.0

_N = FLATTENING / (2 - FLATTENING)
_RECTIFYING_RADIUS = SEMI_MAJOR / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
_KRUGER = (
    _N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16,
    13 * _N**2 / 48 - 3 * _N**3 / 5,
    61 * _N**3 / 240,
)


def with_utm(
    df: DataFrame,
    longitude: ColumnLike,
    latitude: ColumnLike,
    zone: int,
    *,
    south: bool = True,
    x: str = "utm_x",
    y: str = "utm_y",
) -> DataFrame:
    """Add easting and northing in metres (Krüger's series to third order).

    The series is laid out in steps, each a column of its own, so that nothing is worked
    out twice and the expressions stay small.
    """
    k = 2 * math.sqrt(_N) / (1 + _N)
    lam, phi, t, xi, eta = (F.col(f"__{n}") for n in ("lam", "phi", "t", "xi", "eta"))
    steps = [
        {
            "__lam": F.radians(as_column(longitude)) - F.lit(math.radians(zone * 6 - 183)),
            "__phi": F.sin(F.radians(as_column(latitude))),
        },
        {"__t": F.sinh(F.atanh(phi) - k * F.atanh(k * phi))},
        {
            "__xi": F.atan2(t, F.cos(lam)),
            "__eta": F.atanh(F.sin(lam) / F.sqrt(1 + t * t)),
        },
    ]
    east, north = eta, xi
    for j, a in enumerate(_KRUGER, start=1):
        east = east + a * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        north = north + a * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    radius = SCALE * _RECTIFYING_RADIUS
    steps.append(
        {
            x: FALSE_EASTING + radius * east,
            y: (FALSE_NORTHING_SOUTH if south else 0.0) + radius * north,
        }
    )
    for step in steps:
        df = df.withColumns(step)
    return df.drop("__lam", "__phi", "__t", "__xi", "__eta")


def rings_from_wkt(wkt: ColumnLike) -> Column:
    """Rings of a POLYGON or MULTIPOLYGON text; further ordinates (Z, M) are ignored."""

    def point(text: Column) -> Column:
        parts = F.split(F.trim(text), r"\s+")
        return F.struct(
            F.try_element_at(parts, F.lit(1)).try_cast("double").alias("x"),
            F.try_element_at(parts, F.lit(2)).try_cast("double").alias("y"),
        )

    rings = F.regexp_extract_all(as_column(wkt), F.lit(r"\(([^()]+)\)"), F.lit(1))
    return F.transform(rings, lambda ring: F.transform(F.split(ring, ","), point))


def segments(rings: ColumnLike) -> Column:
    """All edges of all rings: start, direction, and what the distance needs of both.

    ``inv`` is the inverse squared length (0 for a point), ``slope`` the change of x per y
    (unused for a horizontal edge). They are worked out once per polygon.
    """

    def edge(a: Column, b: Column) -> Column:
        dx, dy = b["x"] - a["x"], b["y"] - a["y"]
        return F.struct(
            a["x"].alias("x"),
            a["y"].alias("y"),
            b["y"].alias("y2"),
            dx.alias("dx"),
            dy.alias("dy"),
            F.coalesce(F.try_divide(F.lit(1.0), dx * dx + dy * dy), F.lit(0.0)).alias("inv"),
            F.try_divide(dx, dy).alias("slope"),
        )

    def edges(ring: Column) -> Column:
        n = F.greatest(F.size(ring) - 1, F.lit(0))
        return F.zip_with(F.slice(ring, 1, n), F.slice(ring, 2, n), edge)

    return F.flatten(F.transform(as_column(rings), edges))


def distance_to_polygon(x: ColumnLike, y: ColumnLike, edges: ColumnLike) -> Column:
    """Distance from a point to a polygon given by its edges: 0 inside, NULL without one.

    ``x`` and ``y`` should be stored columns: they are read once per edge.
    """
    px, py, arr = as_column(x), as_column(y), as_column(edges)

    def crossed(e: Column) -> Column:
        """A ray from the point to the right crosses the edge."""
        return ((e["y"] > py) != (e["y2"] > py)) & (px < e["x"] + (py - e["y"]) * e["slope"])

    def nearest_point(e: Column) -> Column:
        along = ((px - e["x"]) * e["dx"] + (py - e["y"]) * e["dy"]) * e["inv"]
        return F.struct(
            (px - e["x"]).alias("ax"),
            (py - e["y"]).alias("ay"),
            e["dx"].alias("dx"),
            e["dy"].alias("dy"),
            F.greatest(F.lit(0.0), F.least(F.lit(1.0), along)).alias("t"),
        )

    def squared(n: Column) -> Column:
        return F.pow(n["ax"] - n["t"] * n["dx"], F.lit(2.0)) + F.pow(
            n["ay"] - n["t"] * n["dy"], F.lit(2.0)
        )

    inside = F.size(F.filter(arr, crossed)) % 2 == 1
    nearest = F.sqrt(F.array_min(F.transform(F.transform(arr, nearest_point), squared)))
    known = px.isNotNull() & py.isNotNull() & (F.size(arr) > 0)
    return F.when(~F.coalesce(known, F.lit(False)), None).when(inside, F.lit(0.0)).otherwise(nearest)
