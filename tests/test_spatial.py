"""Spatial joins: both ways of planning them against brute force, on awkward shapes."""

import json
import math
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from terrahaz.functions import geometry as G
from terrahaz.operators import spatial as S

BOTH = pytest.mark.parametrize("max_bytes", [None, 0], ids=["lookup", "shuffle"])


@pytest.fixture(scope="module")
def shapes(spark):
    """Polygons from a street to a continent, overlapping, one with a hole, one in two parts."""
    rng = random.Random(5)
    out = []
    for i in range(40):
        size = [0.002, 0.05, 1.0, 20.0][i % 4]
        cx, cy = rng.uniform(-75, -73), rng.uniform(40, 42)
        ring = [[cx - size, cy - size], [cx + size, cy - size / 2], [cx + size / 2, cy + size], [cx - size / 3, cy + size / 2]]
        ring.append(ring[0])
        out.append((i, f'{{"type":"Polygon","coordinates":[{ring}]}}'))
    out.append((40, '{"type":"Polygon","coordinates":[[[-74,41],[-73,41],[-73,42],[-74,42],[-74,41]],[[-73.8,41.2],[-73.2,41.2],[-73.2,41.8],[-73.8,41.8],[-73.8,41.2]]]}'))
    out.append((41, '{"type":"MultiPolygon","coordinates":[[[[-74,40],[-73.9,40],[-73.9,40.1],[-74,40.1],[-74,40]]],[[[100,10],[101,10],[101,11],[100,11],[100,10]]]]}'))
    out.append((42, '{"type":"MultiPolygon","coordinates":[]}'))
    df = spark.createDataFrame(out, "neighborhood_id int, t string")
    return df.withColumn("geometry", G.polygon_from_geojson("t")).drop("t").cache()


@pytest.fixture(scope="module")
def points(spark):
    """Random points, a hot location holding a third of the rows, corners, nulls and NaN."""
    rng = random.Random(6)
    data = [(i, rng.uniform(-75.5, -72.5), rng.uniform(39.5, 42.5)) for i in range(600)]
    data += [(1000 + i, -73.5, 41.1) for i in range(300)]
    data += [(2000, -74.0, 41.0), (2001, -73.5, 41.0), (2002, -73.8, 41.5), (2003, 100.5, 10.5), (2004, -73.95, 40.0)]
    data += [(3000, None, 40.0), (3001, -74.0, None), (3002, float("nan"), 40.0), (3003, 181.0, 95.0)]
    return spark.createDataFrame(data, "id int, longitude double, latitude double").repartition(4).cache()


def _brute(points, shapes, test):
    hit = points.crossJoin(F.broadcast(shapes)).where(test(G.st_point("longitude", "latitude"), F.col("geometry")))
    return hit.select("id", "neighborhood_id")


@BOTH
def test_masks(spark, points, shapes, max_bytes):
    pairs = rows(_brute(points, shapes, G.st_within))
    inside = {i for i, _ in pairs}
    assert len(inside) < 909 and len(pairs) > len(inside)
    kept = S.land_mask(points, shapes, max_bytes=max_bytes, rows_per_task=50)
    off = S.off_land(points, shapes, max_bytes=max_bytes, rows_per_task=50)
    kept_ids, off_ids = [r[0] for r in rows(kept, "id")], [r[0] for r in rows(off, "id")]
    assert sorted(kept_ids) == sorted(inside)
    assert sorted(kept_ids + off_ids) == sorted(r.id for r in points.collect())
    assert {3000, 3001, 3002, 3003} <= set(off_ids)


@BOTH
def test_inner_and_attach(spark, points, shapes, max_bytes):
    touching = rows(_brute(points, shapes, G.st_intersects))
    inner = S.land_mask_inner(points, shapes, max_bytes=max_bytes, rows_per_task=50)
    assert rows(inner, "id", "land_neighborhood_id") == touching
    first = {}
    for i, n in rows(_brute(points, shapes, G.st_within)):
        first[i] = min(n, first.get(i, n))
    attached = S.attach_polygon(points, shapes, max_bytes=max_bytes, rows_per_task=50)
    got = {r.id: r.neighborhood_id for r in attached.collect()}
    assert len(got) == attached.count() == points.count()
    assert got == {r.id: first.get(r.id) for r in points.collect()}


def test_index_uses_several_levels_and_full_cells(shapes):
    index = S.polygon_index(shapes, "neighborhood_id", "geometry")
    assert len(index.levels) >= 3
    assert index.entries.where("full").count() > 0


def _winding(n: int, seed: int, cx: float, cy: float, r: float) -> list[list[float]]:
    """A closed ring of ``n`` corners that goes once around a centre, in and out as it likes."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        far, angle = r * rng.uniform(0.2, 1.0), 2 * math.pi * i / n
        out.append([cx + far * math.cos(angle), cy + far * math.sin(angle)])
    return [*out, out[0]]


@BOTH
def test_rings_of_many_corners(spark, max_bytes):
    """Cells are divided until they keep few edges, and answer like the whole polygon."""
    rings = {1: [_winding(3000, 1, -74.0, 41.0, 0.3)], 2: [_winding(400, 2, -73.9, 41.1, 1e-4)],
             3: [_winding(500, 3, -73.5, 41.0, 0.4), [[-73.51, 40.99], [-73.49, 40.99], [-73.49, 41.01], [-73.51, 41.01], [-73.51, 40.99]]],
             4: [[[-74, 41], [-73.5, 41], [-73.5, 41.25], [-74, 41.25], [-74, 41]]]}
    text = [(i, json.dumps({"type": "Polygon", "coordinates": r})) for i, r in rings.items()]
    many = spark.createDataFrame(text, "neighborhood_id int, t string").withColumn("geometry", G.polygon_from_geojson("t")).drop("t").cache()
    rng = random.Random(9)
    at = [(rng.uniform(-74.4, -73.0), rng.uniform(40.5, 41.5)) for _ in range(1500)]
    at += [(rng.uniform(-73.9002, -73.8998), rng.uniform(41.0998, 41.1002)) for _ in range(300)]
    at += [tuple(p) for r in rings.values() for p in r[0][::40]] + [(-74.0, 41.1), (-73.5, 41.2), (-73.75, 41.0), (-73.49, 41.0), (-73.5, 41.0)]
    at += [((a[0] + b[0]) / 2, (a[1] + b[1]) / 2) for a, b in zip(rings[3][0][::7], rings[3][0][1::7])]
    points = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(at)], "id int, longitude double, latitude double").cache()
    index = S.polygon_index(many, "neighborhood_id", "geometry", (), max_bytes)
    crowded = index.entries.where(F.size("edges") > S.MAX_EDGES)
    assert len(index.levels) > 2 and index.largest < 40 and crowded.where(F.col("level") < S.FINEST).count() == 0
    for predicate, test in (("within", G.st_within), ("intersects", G.st_intersects)):
        got = S.land_mask_inner(points, many, predicate=predicate, max_bytes=max_bytes, index=index)
        assert rows(got, "id", "land_neighborhood_id") == rows(_brute(points, many, test))


def test_edges_that_meet_in_one_corner_share_a_cell(spark):
    """Where no division helps, the finest level keeps them all."""
    star = []
    for i in range(60):
        star += [[0.0, 0.0], [math.cos(i / 10), math.sin(i / 10)], [math.cos(i / 10 + 0.04), math.sin(i / 10 + 0.04)]]
    text = json.dumps({"type": "Polygon", "coordinates": [[*star, star[0]]]})
    df = spark.createDataFrame([(1, text)], "neighborhood_id int, t string").withColumn("geometry", G.polygon_from_geojson("t"))
    index = S.polygon_index(df, "neighborhood_id", "geometry")
    assert index.largest == 121 and max(index.levels) == S.FINEST


def test_index_is_written_once_and_opened(spark, points, shapes, tmp_path):
    first = S.polygon_index(shapes, "neighborhood_id", "geometry")
    assert S.polygon_index(shapes.orderBy(F.rand(3)), "neighborhood_id", "geometry").path == first.path
    fewer = S.polygon_index(shapes.where("neighborhood_id > 0"), "neighborhood_id", "geometry")
    assert fewer.path != first.path
    S.write_polygon_index(shapes, str(tmp_path / "own"))
    opened = S.open_polygon_index(spark, str(tmp_path / "own"))
    assert (opened.rows, opened.levels, opened.bytes) == (first.rows, first.levels, first.bytes) and opened.small
    assert not S.open_polygon_index(spark, str(tmp_path / "own"), 10).small
    none = shapes.where("false")
    for op in (S.land_mask, S.off_land, S.land_mask_inner, S.attach_polygon):
        assert op(points, none, index=opened).count() == op(points, shapes).count()


def test_no_polygons(points, shapes):
    none = shapes.where("false")
    assert S.land_mask(points, none).count() == 0
    assert S.off_land(points, none).count() == points.count()
    assert S.attach_polygon(points, none).where("neighborhood_id is not null").count() == 0


def test_polygon_over_the_antimeridian_is_refused(spark, points):
    wide = '{"type":"Polygon","coordinates":[[[179,0],[181,0],[181,1],[179,0]]]}'
    bad = spark.createDataFrame([(1, wide)], "neighborhood_id int, t string").withColumn("geometry", G.polygon_from_geojson("t"))
    with pytest.raises(Exception, match="antimeridian"):
        S.land_mask(points, bad).count()


@pytest.fixture(scope="module")
def facilities(spark):
    """A dense town, copies of one site, lone sites far away, one across the antimeridian."""
    rng = random.Random(7)
    data = [(100 + i, rng.uniform(-74.1, -73.9), rng.uniform(40.6, 40.8)) for i in range(80)]
    data += [(500 + i, -74.05, 40.65) for i in range(60)]
    data += [(1, 10.0, 60.0), (2, 179.9, 0.0), (3, 0.0, 89.9), (4, -120.0, -50.0), (9, None, 1.0)]
    return spark.createDataFrame(data, "infrastructure_id int, longitude double, latitude double").cache()


@pytest.fixture(scope="module")
def callers(spark):
    rng = random.Random(8)
    data = [(i, rng.uniform(-74.2, -73.8), rng.uniform(40.5, 40.9)) for i in range(200)]
    data += [(1000 + i, rng.uniform(-180, 180), rng.uniform(-90, 90)) for i in range(200)]
    data += [(2000 + i, -74.05, 40.65) for i in range(150)]
    data += [(3000, -179.9, 0.0), (3001, 180.0, 89.99), (3002, 45.0, -90.0), (3003, None, 1.0)]
    return spark.createDataFrame(data, "id int, longitude double, latitude double").repartition(4).cache()


def _distances(callers, facilities):
    far = facilities.where("longitude is not null").select("infrastructure_id", F.col("longitude").alias("fx"), F.col("latitude").alias("fy"))
    pairs = callers.where("longitude is not null").crossJoin(F.broadcast(far))
    return pairs.withColumn("m", F.round(G.haversine_m("longitude", "latitude", "fx", "fy"), 3))


@BOTH
def test_nearest(callers, facilities, max_bytes):
    best = _distances(callers, facilities).groupBy("id").agg(F.min(F.struct("m", "infrastructure_id")).alias("b"))
    want = {r.id: (r.b.infrastructure_id, r.b.m) for r in best.collect()}
    found = S.nearest_facility(callers, facilities, max_bytes=max_bytes, rows_per_task=20)
    got = {r.id: (r.nearest_id, r.nearest_m) for r in found.collect()}
    assert got.pop(3003) == (None, None)
    assert got == want
    assert got[2000][0] == 500 and got[3000][0] == 2


@pytest.fixture(scope="module")
def city(spark):
    """Crowded sites of one city and callers all over the world."""
    rng = random.Random(11)
    sites = [(i, -74.0 + rng.gauss(0, 0.05), 40.7 + rng.gauss(0, 0.05)) for i in range(3000)]
    calls = [(i, rng.uniform(-180, 180), rng.uniform(-90, 90)) for i in range(300)] + [(300, 106.0, -40.7), (301, -74.0, 40.7)]
    return (spark.createDataFrame(calls, "id int, longitude double, latitude double").cache(),
            spark.createDataFrame(sites, "infrastructure_id int, longitude double, latitude double").cache())


@BOTH
def test_far_callers_do_not_meet_every_site(city, max_bytes, monkeypatch):
    callers, sites = city
    met = []
    plain = S._meet

    def counted(asking, cells, *more):
        out = plain(asking, cells, *more)
        met.append(out.count())
        return out

    monkeypatch.setattr(S, "_meet", counted)
    want = {r.id: (r.b.infrastructure_id, r.b.m) for r in _distances(callers, sites).groupBy("id").agg(
        F.min(F.struct("m", "infrastructure_id")).alias("b")).collect()}
    found = S.nearest_facility(callers, sites, max_bytes=max_bytes)
    assert {r.id: (r.nearest_id, r.nearest_m) for r in found.collect()} == want
    assert sum(met) < 302 * 3000 / 10  # all levels together, against all pairs


def test_dense_discs_count_by_cell(city, monkeypatch):
    callers, sites = city
    met = []
    plain = S._meet
    monkeypatch.setattr(S, "_meet", lambda *a: met.append(plain(*a)) or met[-1])
    near = _distances(callers.where("id = 301"), sites).where(F.col("m") <= 12_000)
    want = near.count()
    got = S.within_distance(callers, sites, 12_000.0, max_bytes=0).collect()
    assert [(r.id, r.facilities_within) for r in got if r.id == 301] == [(301, want)]
    assert max(m.count() for m in met) < want


@BOTH
def test_nearest_without_facilities(callers, facilities, max_bytes):
    found = S.nearest_facility(callers, facilities.where("false"), max_bytes=max_bytes)
    assert found.count() == callers.count() and found.where("nearest_id is not null").count() == 0


@BOTH
@pytest.mark.parametrize("radius", [300.0, 25_000.0, 3_000_000.0])
def test_within_distance(callers, facilities, radius, max_bytes):
    near = _distances(callers, facilities).where(F.col("m") <= radius)
    want = rows(near.groupBy("id").agg(F.count("*").alias("k"), F.min("m").alias("m")))
    got = S.within_distance(callers, facilities, radius, max_bytes=max_bytes, rows_per_task=20)
    assert rows(got, "id", "facilities_within", "nearest_m") == want


def test_polygons_over_one_another_leave_few_entries(spark, points, monkeypatch):
    """An index too large to broadcast keeps, for joins that want any polygon or the first, what can decide."""
    monkeypatch.setattr(S, "MAX_BROADCAST_BYTES", 10_000)
    rng = random.Random(8)
    data = []
    for i in range(120):
        x, y = -75.5 + rng.uniform(0, 2), 39 + rng.uniform(0, 2)
        data.append((i, json.dumps({"type": "Polygon", "coordinates": [[[x, y], [x + 4, y], [x + 4, y + 4], [x, y + 4], [x, y]]]})))
    stack = spark.createDataFrame(data, "neighborhood_id int, t string").select("neighborhood_id", G.polygon_from_geojson("t").alias("geometry"))
    index = S.polygon_index(stack, "neighborhood_id", "geometry")
    assert index.dictionary is None and index.deciding.rows * 3 < index.rows
    pairs = rows(_brute(points, stack, G.st_within))
    first = {}
    for point, polygon in pairs:
        first[point] = min(polygon, first.get(point, polygon))
    placed = {r.id: r.neighborhood_id for r in S.attach_polygon(points, stack).collect()}
    assert {k: v for k, v in placed.items() if v is not None} == first and len(placed) == points.select("id").distinct().count()
    assert {r.id for r in S.land_mask(points, stack).collect()} == set(first)
    assert not {r.id for r in S.off_land(points, stack).collect()} & set(first)
    inner = S.land_mask_inner(points, stack, predicate="within").select("id", "land_neighborhood_id")
    assert sorted(rows(inner)) == sorted(pairs)


def test_polygons_of_few_edges_are_indexed_in_place(spark, shapes, monkeypatch):
    """Without a shuffled round, and to the same entries as with them."""

    def entries():
        made = S.polygon_entries(shapes, "neighborhood_id", "geometry")
        edge = F.array_sort(F.transform("edges", lambda e: F.struct(e["x1"], e["y1"], e["x2"], e["y2"])))
        return sorted(map(str, rows(made.select("level", "cell", "item.neighborhood_id", "full", "base", edge.alias("edges")))))

    rounds, whole = [], S.divided
    monkeypatch.setattr(S, "divided", lambda *a: rounds.append(1) or whole(*a))
    placed = entries()
    assert not rounds
    # as if every polygon had too many edges for it, while a cell keeps as many as before
    many = shapes.select("neighborhood_id", "geometry", G.polygon_edges("geometry").alias("edges")).where(F.size("edges") > 0)
    many = many.select(F.monotonically_increasing_id().alias("pid"), "neighborhood_id", "edges", G.edges_envelope(F.col("edges")).alias("box"))
    many = many.withColumn("level", S._level_of_box(F.col("box"))).cache()
    cells, held = next(whole(many.select("pid", "box", "level"), S.exploded_edges(many)))
    assert len(placed) == cells.where("n > 0 or odd").count()
    assert sum(len(x) for x in (r.edges for r in S.polygon_entries(shapes, "neighborhood_id", "geometry").collect())) == held.count()
