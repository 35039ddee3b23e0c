"""Geometry functions on literal edge cases."""

import math

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from terrahaz.functions import geometry as G
from terrahaz.functions import grid

SQUARE = '{"type":"Polygon","coordinates":[[[0,0],[4,0],[4,4],[0,4],[0,0]]]}'
UNCLOSED = '{"type":"Polygon","coordinates":[[[0,0],[4,0],[4,4],[0,4]]]}'
HOLED = '{"type":"Polygon","coordinates":[[[0,0],[4,0],[4,4],[0,4],[0,0]],[[1,1],[3,1],[3,3],[1,3],[1,1]]]}'
TWO = (
    '{"type":"MultiPolygon","coordinates":[[[[0,0],[1,0],[1,1],[0,1],[0,0]]],[[[5,5],[6,5],[6,6],[5,6],[5,5]]]]}'
)
RING = '{"type":"Polygon","coordinates":[[[-74.02,40.70],[-73.97,40.74],[-73.94,40.80],[-73.97,40.83],[-74.02,40.70]]]}'


def _tests(spark, shape, points):
    df = spark.createDataFrame([(float(x), float(y)) for x, y in points], "x double, y double")
    df = df.withColumn("p", G.st_point("x", "y")).withColumn("g", G.polygon_from_geojson(F.lit(shape)))
    out = df.select("x", "y", G.st_within("p", "g").alias("w"), G.st_intersects("p", "g").alias("i")).collect()
    return {(r.x, r.y): (r.w, r.i) for r in out}


def test_boundary_is_outside_within_but_intersects(spark):
    got = _tests(spark, SQUARE, [(2, 2), (0, 0), (4, 4), (2, 0), (0, 2), (4, 2), (2, 4), (5, 2), (-1, 0), (2, 4.0001)])
    assert got[(2, 2)] == (True, True)
    for spot in [(0, 0), (4, 4), (2, 0), (0, 2), (4, 2), (2, 4)]:
        assert got[spot] == (False, True)
    for spot in [(5, 2), (-1, 0), (2, 4.0001)]:
        assert got[spot] == (False, False)


def test_hole(spark):
    got = _tests(spark, HOLED, [(2, 2), (0.5, 0.5), (1, 2), (3, 3)])
    assert got[(2, 2)] == (False, False)
    assert got[(0.5, 0.5)] == (True, True)
    assert got[(1, 2)] == (False, True)


def test_multipolygon_and_unclosed_ring(spark):
    got = _tests(spark, TWO, [(0.5, 0.5), (5.5, 5.5), (3, 3)])
    assert [got[k][0] for k in [(0.5, 0.5), (5.5, 5.5), (3, 3)]] == [True, True, False]
    assert _tests(spark, UNCLOSED, [(2, 2), (0, 2)]) == {(2, 2): (True, True), (0, 2): (False, True)}


def test_known_ring(spark):
    got = _tests(spark, RING, [(-73.98, 40.76), (0, 0)])
    assert got[(-73.98, 40.76)][0] and not got[(0, 0)][0]


def test_geojson_parsing(spark):
    texts = ['{"type":"Point","coordinates":[-74,40]}', SQUARE, "not_json", None, '{"type":"LineString","coordinates":[[0,0],[1,1]]}',
             '{"type":"Feature","geometry":' + SQUARE + "}", '{"type":"MultiPolygon","coordinates":[]}', '{"type":"Polygon","coordinates":"x"}']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r for r in df.select("i", G.st_from_geojson("t").alias("g"), G.st_envelope(G.polygon_from_geojson("t")).alias("b")).collect()}
    assert got[0].g.kind == "Point" and (got[0].g.point.lon, got[0].g.point.lat) == (-74.0, 40.0)
    assert got[1].g.polygons[0][0][1] == [4.0, 0.0]
    assert got[2].g is None and got[3].g is None and got[4].g is None and got[7].g is None
    assert got[5].g.polygons == got[1].g.polygons
    assert got[6].b is None


def test_area_validity_envelope_text(spark):
    df = spark.createDataFrame([(SQUARE,), (HOLED,), (TWO,), (UNCLOSED,)], "t string").withColumn("g", G.polygon_from_geojson("t"))
    assert [r[0] for r in df.select(G.st_area("g")).collect()] == [16.0, 12.0, 2.0, 16.0]
    assert [r[0] for r in df.select(G.st_is_valid("g")).collect()] == [True, True, True, False]
    assert df.select(G.st_envelope("g").alias("b")).first().b.asDict() == {"min_x": 0.0, "min_y": 0.0, "max_x": 4.0, "max_y": 4.0}
    assert df.select(G.polygon_as_text("g")).first()[0] == "MULTIPOLYGON (((0.0 0.0, 4.0 0.0, 4.0 4.0, 0.0 4.0, 0.0 0.0)))"
    back = df.select(G.polygon_from_geojson(G.polygon_as_geojson("g")).alias("g")).first().g
    assert back == df.select("g").first().g


def test_distance_and_projection(spark):
    df = spark.range(1).select(G.st_point(F.lit(0.0), F.lit(0.0)).alias("a"), G.st_point(F.lit(1.0), F.lit(0.0)).alias("b"))
    r = df.select(G.st_distance_m("a", "b").alias("m"), G.st_distance("a", "b").alias("d")).first()
    assert math.isclose(r.m, 6_371_000 * math.pi / 180, rel_tol=1e-12) and r.d == 1.0
    with pytest.raises(ValueError):
        G.transform_crs("a", 4326, 2263)
    assert df.select(G.transform_crs("a", 4326, 4326)["lon"]).first()[0] == 0.0


def test_null_point(spark):
    df = spark.createDataFrame([(None, 1.0), (1.0, None)], "x double, y double")
    assert [r[0] for r in df.select(G.st_point("x", "y")).collect()] == [None, None]


def test_service_area_is_closed(spark):
    ring = spark.range(1).select(G.service_area(G.st_point(F.lit(-74.0), F.lit(40.7)), 500.0).alias("g")).first().g[0][0]
    assert ring[0] == ring[-1] and len(ring) == 33


def test_quad_cells_wrap(spark):
    df = spark.createDataFrame([(179.999, 0.0), (-179.999, 0.0)], "x double, y double")
    near = [set(r[0]) for r in df.select(grid.quad_neighbourhood("x", "y", 12)).collect()]
    own = [r[0] for r in df.select(grid.quad_cell("x", "y", 12)).collect()]
    assert own[1] in near[0] and own[0] in near[1]
    assert rows(df.select(F.size(grid.quad_neighbourhood("x", "y", 0)).alias("n"))) == [(3,), (3,)]
