"""Projection, distance to the own polygon, geofence alert."""

from __future__ import annotations

from pyspark.sql import functions as F

from canvass.catalog.registry import query, table
from canvass.functions.geo import with_utm
from canvass.functions.text import squish
from canvass.operators import geofence
from canvass.operators.summaries import describe_number

ZONE = 21
HALF = 10  # half the side of a unit's box, in metres


def _points(spark, sf_dir):
    """Events as interviews near the place of their user; every 17th has no position."""
    user = F.col("user_id")
    lon = -56.1 + (user % 50) * 0.001 + (F.col("value") - 50) * 0.000003
    lat = -34.85 + F.floor(user / 50) * 0.001 + (F.col("event_id") % 100 - 50) * 0.000003
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("key"),
        user.alias("unit"),
        F.when(F.col("event_id") % 17 != 0, lon.cast("string")).alias("longitude"),
        F.when(F.col("event_id") % 17 != 0, lat.cast("string")).alias("latitude"),
    )


def _polygons(spark, sf_dir):
    """A box around the place of each user, as text; some have none."""
    user = F.col("user_id")
    users = table(spark, sf_dir, "events").select("user_id").distinct().filter(user % 13 != 0)
    users = with_utm(users, -56.1 + (user % 50) * 0.001, -34.85 + F.floor(user / 50) * 0.001, ZONE)
    x, y = F.round("utm_x").cast("bigint"), F.round("utm_y").cast("bigint")
    corner = F.format_string(
        "POLYGON ((%d %d, %d %d, %d %d, %d %d, %d %d))",
        x - HALF, y - HALF, x + HALF, y - HALF, x + HALF, y + HALF, x - HALF, y + HALF,
        x - HALF, y - HALF,
    )
    return users.select(
        user.alias("padron"), F.when(user % 10 != 0, squish(corner)).alias("wkt_geom")
    )


def _utm_sql(lon: str, lat: str) -> str:
    """Easting and northing by the same series, as a lateral subquery."""
    return f"""
      SELECT 500000 + A * (eta + a1 * cos(2 * xi) * sinh(2 * eta) + a2 * cos(4 * xi) * sinh(4 * eta)
                           + a3 * cos(6 * xi) * sinh(6 * eta)) AS x,
             10000000 + A * (xi + a1 * sin(2 * xi) * cosh(2 * eta) + a2 * sin(4 * xi) * cosh(4 * eta)
                           + a3 * sin(6 * xi) * cosh(6 * eta)) AS y
      FROM (SELECT *, atan2(t, cos(lam)) AS xi, atanh(sin(lam) / sqrt(1 + t * t)) AS eta
        FROM (SELECT *, sinh(atanh(sin(phi)) - k * atanh(k * sin(phi))) AS t
          FROM (SELECT radians(({lon}) + 57) AS lam, radians({lat}) AS phi, 2 * sqrt(n) / (1 + n) AS k,
                       0.9996 * 6378137.0 / (1 + n) * (1 + n ** 2 / 4 + n ** 4 / 64) AS A,
                       n / 2 - 2 * n ** 2 / 3 + 5 * n ** 3 / 16 AS a1,
                       13 * n ** 2 / 48 - 3 * n ** 3 / 5 AS a2, 61 * n ** 3 / 240 AS a3
            FROM (SELECT (1 / 298.257223563) / (2 - 1 / 298.257223563) AS n))))"""


_LON = "-56.1 + (user_id % 50) * 0.001 + (value - 50) * 0.000003"
_LAT = "-34.85 + floor(user_id / 50) * 0.001 + (event_id % 100 - 50) * 0.000003"
_POINTS = f"""p AS (SELECT event_id AS key, user_id AS unit, u.x, u.y FROM events, LATERAL ({_utm_sql(_LON, _LAT)}) u
                    WHERE event_id % 17 <> 0)"""
_BOXES = f"""users AS (SELECT DISTINCT user_id FROM events WHERE user_id % 13 <> 0 AND user_id % 10 <> 0),
    b AS (SELECT user_id, round(u.x) AS cx, round(u.y) AS cy
          FROM users, LATERAL ({_utm_sql('-56.1 + (user_id % 50) * 0.001', '-34.85 + floor(user_id / 50) * 0.001')}) u)"""
_FENCE = f"""WITH {_POINTS}, {_BOXES},
    d AS (SELECT key, unit,
                 CASE WHEN cx IS NOT NULL THEN
                   sqrt(greatest(abs(x - cx) - {HALF}, 0) ** 2 + greatest(abs(y - cy) - {HALF}, 0) ** 2) END AS distance
          FROM p LEFT JOIN b ON unit = user_id)"""


@query("utm_project", f"WITH {_POINTS} SELECT key, round(x, 3) AS x, round(y, 3) AS y FROM p")
def utm_project(spark, sf_dir):
    out = geofence.project_points(_points(spark, sf_dir), "longitude", "latitude", zone=ZONE)
    return out.select("key", F.round("utm_x", 3).alias("x"), F.round("utm_y", 3).alias("y"))


def _fenced(spark, sf_dir):
    edges = geofence.polygon_edges(_polygons(spark, sf_dir), "padron", "wkt_geom")
    points = geofence.project_points(_points(spark, sf_dir), "longitude", "latitude", zone=ZONE)
    return geofence.geofence(points, edges, "unit")


@query(
    "geofence",
    f"""{_FENCE} SELECT key, unit, round(distance, 3) AS distance_m,
        CASE WHEN distance > 15 THEN 'REVISAR: Fuera de rango' WHEN distance IS NOT NULL THEN 'OK' END AS alert_geo
        FROM d""",
)
def geofence_query(spark, sf_dir):
    out = _fenced(spark, sf_dir)
    return out.select("key", "unit", F.round("distance_m", 3).alias("distance_m"), "alert_geo")


@query("geofence_alerts", f"{_FENCE} SELECT key, round(distance, 3) AS distance_m FROM d WHERE distance > 15")
def geofence_alerts(spark, sf_dir):
    out = _fenced(spark, sf_dir).filter(F.col("alert_geo") == geofence.OUTSIDE)
    return out.select("key", F.round("distance_m", 3).alias("distance_m"))


@query(
    "distance_summary",
    f"""{_FENCE} SELECT round(min(distance), 3) AS minimum, round(quantile_cont(distance, 0.25), 3) AS q1,
        round(median(distance), 3) AS median, round(avg(distance), 3) AS mean,
        round(quantile_cont(distance, 0.75), 3) AS q3, round(max(distance), 3) AS maximum,
        CAST(count(*) - count(distance) AS BIGINT) AS nulls FROM d""",
)
def distance_summary(spark, sf_dir):
    out = describe_number(_fenced(spark, sf_dir), "distance_m")
    return out.select(*[F.round(c, 3).alias(c) for c in out.columns if c != "nulls"], "nulls")


@query(
    "price_summary",
    """SELECT min(o_totalprice) AS minimum, round(quantile_cont(o_totalprice, 0.25), 6) AS q1,
        round(median(o_totalprice), 6) AS median, round(avg(o_totalprice), 3) AS mean,
        round(quantile_cont(o_totalprice, 0.75), 6) AS q3, max(o_totalprice) AS maximum,
        CAST(0 AS BIGINT) AS nulls FROM orders""",
)
def price_summary(spark, sf_dir):
    out = describe_number(table(spark, sf_dir, "orders"), "o_totalprice")
    return out.select(
        "minimum", "maximum", "nulls", F.round("mean", 3).alias("mean"),
        *[F.round(c, 6).alias(c) for c in ("q1", "median", "q3")],
    )
