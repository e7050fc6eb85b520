"""Distance of an interview's position from the polygon of its own unit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canvass.functions.columns import as_column, compute_once
from canvass.functions.geo import distance_to_polygon, rings_from_wkt, segments, with_utm
from canvass.functions.numbers import number

# Texts of the position alert.
OUTSIDE, OK = "REVISAR: Fuera de rango", "OK"


def polygon_edges(polygons: DataFrame, unit: str, wkt: str) -> DataFrame:
    """Polygons as ``(unit, edges)``: text is parsed once per polygon, not per interview."""
    return polygons.filter(as_column(wkt).isNotNull()).select(
        as_column(unit).cast("string").alias("__unit"),
        segments(rings_from_wkt(wkt)).alias("__edges"),
    )


def project_points(
    df: DataFrame,
    longitude: str,
    latitude: str,
    *,
    zone: int = 21,
    south: bool = True,
    keep_ungeolocated: bool = False,
    x: str = "utm_x",
    y: str = "utm_y",
) -> DataFrame:
    """Add UTM coordinates; rows without a position go unless asked to stay."""
    lon, lat = number(longitude), number(latitude)
    rows = df if keep_ungeolocated else df.filter(lon.isNotNull() & lat.isNotNull())
    return with_utm(rows, lon, lat, zone, south=south, x=x, y=y)


def geofence(
    df: DataFrame,
    edges: DataFrame,
    unit: str,
    *,
    x: str = "utm_x",
    y: str = "utm_y",
    max_metres: float = 15,
) -> DataFrame:
    """Distance to the unit's polygon (0 inside) and the alert; NULL without a polygon.

    ``edges`` comes from :func:`polygon_edges`. It grows with the number of units, so it is
    not hinted: Spark broadcasts it when it is small and otherwise joins by unit, splitting
    a unit with too many interviews.
    """
    joined = df.join(edges, as_column(unit).cast("string").eqNullSafe(F.col("__unit")), "left")
    distance = distance_to_polygon(x, y, F.col("__edges"))
    with_distance = compute_once(joined, {"distance_m": distance}).drop("__unit", "__edges")
    far = F.col("distance_m") > max_metres
    label = F.when(far.isNull(), None).when(far, OUTSIDE).otherwise(OK)
    return with_distance.withColumn("alert_geo", label)
