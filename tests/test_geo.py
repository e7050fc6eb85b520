"""Distances that can be worked out by hand, and the projection against another series."""

import math

import pytest
from pyspark.sql import functions as F

from canvass.functions.geo import distance_to_polygon, rings_from_wkt, segments, with_utm
from canvass.operators import geofence
from canvass.operators.summaries import describe_number, describe_number_approx

BOX = "POLYGON ((0 0, 10 0, 10 10, 0 10, 0 0))"
HOLE = "POLYGON((0 0,10 0,10 10,0 10,0 0),(4 4,6 4,6 6,4 6,4 4))"
MULTI = "MULTIPOLYGON (((0 0, 1 0, 1 1, 0 1, 0 0)), ((10 0, 11 0, 11 1, 10 1, 10 0)))"
HIGH = "POLYGON Z ((0 0 5, 10 0 5, 10 10 5, 0 10 5, 0 0 5))"


@pytest.mark.parametrize(
    "wkt, x, y, expected",
    [
        (BOX, 5, 5, 0), (BOX, 13, 14, 5), (BOX, 5, 12, 2), (BOX, -3, 5, 3), (BOX, 10, 5, 0),
        (BOX, 5, -1, 1), (HOLE, 5, 5, 1), (HOLE, 2, 2, 0), (HOLE, 4.5, 5, 0.5),
        (MULTI, 5, 0.5, 4), (MULTI, 10.5, 0.5, 0), (HIGH, 13, 14, 5), (None, 1, 1, None),
        (BOX, None, 1, None), ("POINT EMPTY", 1, 1, None),
        ("POLYGON ((-1e1 0, 0 0, 0 1.5e0, -10 1.5, -1e1 0))", 3, 1, 3),
    ],
)
def test_distance(spark, wkt, x, y, expected):
    row = spark.createDataFrame([(wkt, x and float(x), y and float(y))], "w string, x double, y double")
    edges = row.withColumn("e", segments(rings_from_wkt("w")))
    got = edges.select(distance_to_polygon("x", "y", "e").alias("d")).collect()[0]["d"]
    assert got == expected if expected is None else got == pytest.approx(expected)


def snyder(lon, lat, zone):
    """UTM by Snyder's series (USGS professional paper 1395), south of the equator."""
    a, f, k0 = 6378137.0, 1 / 298.257223563, 0.9996
    e2 = f * (2 - f)
    ep2 = e2 / (1 - e2)
    phi, lam = math.radians(lat), math.radians(lon - (zone * 6 - 183))
    n = a / math.sqrt(1 - e2 * math.sin(phi) ** 2)
    t, c, aa = math.tan(phi) ** 2, ep2 * math.cos(phi) ** 2, lam * math.cos(phi)
    m = a * (
        (1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256) * phi
        - (3 * e2 / 8 + 3 * e2**2 / 32 + 45 * e2**3 / 1024) * math.sin(2 * phi)
        + (15 * e2**2 / 256 + 45 * e2**3 / 1024) * math.sin(4 * phi)
        - 35 * e2**3 / 3072 * math.sin(6 * phi)
    )
    x = k0 * n * (aa + (1 - t + c) * aa**3 / 6 + (5 - 18 * t + t * t + 72 * c - 58 * ep2) * aa**5 / 120)
    y = k0 * (
        m + n * math.tan(phi) * (aa**2 / 2 + (5 - t + 9 * c + 4 * c * c) * aa**4 / 24
        + (61 - 58 * t + t * t + 600 * c - 330 * ep2) * aa**6 / 720)
    )
    return x + 500000, y + 10000000


def test_projection_agrees_with_another_series(spark):
    points = [(-57.0, -30.0), (-56.16, -34.85), (-58.4, -34.8), (-55.0, -10.0), (-57.2, 0.0)]
    df = with_utm(spark.createDataFrame(points, "lon double, lat double"), "lon", "lat", 21)
    for row, (lon, lat) in zip(df.collect(), points):
        x, y = snyder(lon, lat, 21)
        assert row["utm_x"] == pytest.approx(x, abs=1e-3)
        assert row["utm_y"] == pytest.approx(y, abs=1e-3)


def test_geofence_rows(spark):
    polygons = spark.createDataFrame([("1", BOX), ("2", None)], "padron string, wkt_geom string")
    rows = [("in", 1, 5.0, 5.0), ("near", 1, 24.0, 5.0), ("far", 1, 26.0, 5.0), ("none", 2, 1.0, 1.0), ("new", 3, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "key string, unit long, utm_x double, utm_y double")
    out = geofence.geofence(df, geofence.polygon_edges(polygons, "padron", "wkt_geom"), "unit")
    got = {r["key"]: (r["distance_m"], r["alert_geo"]) for r in out.collect()}
    assert got == {
        "in": (0.0, "OK"), "near": (14.0, "OK"), "far": (16.0, "REVISAR: Fuera de rango"),
        "none": (None, None), "new": (None, None),
    }


def test_rows_without_position_go_by_default(spark):
    df = spark.createDataFrame([("a", "-56.1", "-34.8"), ("b", None, "-34.8"), ("c", "x", "1")], "key string, lon string, lat string")
    assert [r["key"] for r in geofence.project_points(df, "lon", "lat").collect()] == ["a"]
    kept = geofence.project_points(df, "lon", "lat", keep_ungeolocated=True)
    assert kept.count() == 3


def quantile(values, q):
    values = sorted(values)
    h = q * (len(values) - 1)
    low, high = values[int(h)], values[min(int(h) + 1, len(values) - 1)]
    return low + (high - low) * (h - int(h))


@pytest.mark.parametrize("n, accuracy", [(1, 100), (2, 100), (3, 100), (4, 100), (101, 100_000), (5000, 200), (5001, 100)])
def test_quartiles_are_exact(spark, n, accuracy):
    """With more rows than the accuracy the interval method is at work."""
    data = [(float((i * 7919) % 1009) if i % 3 else 0.0,) for i in range(n)]
    df = spark.createDataFrame(data + [(None,)], "v double")
    row = describe_number(df, "v", accuracy=accuracy).collect()[0]
    values = [v for (v,) in data]
    for name, q in (("q1", 0.25), ("median", 0.5), ("q3", 0.75)):
        assert row[name] == pytest.approx(quantile(values, q))
    assert (row["minimum"], row["maximum"], row["nulls"]) == (min(values), max(values), 1)
    near = describe_number_approx(df, "v").collect()[0]
    assert near["median"] in values


def test_describe_nothing(spark):
    row = describe_number(spark.createDataFrame([(None,)], "v double"), "v").collect()[0]
    assert (row["minimum"], row["median"], row["nulls"]) == (None, None, 1)


def test_polygons_are_parsed_once_per_polygon(spark):
    polygons = spark.createDataFrame([("1", BOX)], "padron string, wkt_geom string")
    edges = geofence.polygon_edges(polygons, "padron", "wkt_geom")
    assert edges.select(F.size("__edges").alias("n")).collect()[0]["n"] == 4
