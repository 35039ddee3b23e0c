"""Geometry as plain nested data and native column expressions.

* point        ``struct<lon double, lat double, srid int>``
* multipolygon ``array<array<array<array<double>>>>`` (polygon > ring > [x, y])
* edges        ``array<struct<x1, y1, x2, y2>>``: all rings of a multipolygon

Axis order is always lon (x), lat (y). No Python runs on the row path.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6_371_000.0
WGS84 = 4326
WEB_MERCATOR = 3857
MERCATOR_RADIUS_M = 6_378_137.0

_POINT_JSON = "coordinates array<double>"
_POLYGON_JSON = "coordinates array<array<array<double>>>"
_MULTI_JSON = "coordinates array<array<array<array<double>>>>"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- constructors


def st_point(lon, lat, srid: int = WGS84) -> Column:
    """Point from lon, lat; null when either coordinate is null."""
    lon, lat = _col(lon).cast("double"), _col(lat).cast("double")
    point = F.struct(lon.alias("lon"), lat.alias("lat"), F.lit(srid).alias("srid"))
    return F.when(lon.isNotNull() & lat.isNotNull(), point)


def st_set_srid(point, srid: int) -> Column:
    """Attach another SRID; coordinates are not touched."""
    return _col(point).withField("srid", F.lit(srid))


def st_x(point) -> Column:
    return _col(point).getField("lon")


def st_y(point) -> Column:
    return _col(point).getField("lat")


def _geometry_text(text: Column) -> Column:
    """Unwrap a GeoJSON Feature to its geometry object."""
    kind = F.get_json_object(text, "$.type")
    return F.when(kind == "Feature", F.get_json_object(text, "$.geometry")).otherwise(text)


def point_from_geojson(text, srid: int = WGS84) -> Column:
    """GeoJSON Point text to a point; anything else is null."""
    geom = _geometry_text(_col(text))
    xy = F.from_json(geom, _POINT_JSON).getField("coordinates")
    is_point = F.get_json_object(geom, "$.type") == "Point"
    return F.when(is_point, st_point(F.get(xy, 0), F.get(xy, 1), srid))


def polygon_from_geojson(text) -> Column:
    """GeoJSON Polygon or MultiPolygon text to a multipolygon; else null."""
    geom = _geometry_text(_col(text))
    kind = F.get_json_object(geom, "$.type")
    single = F.from_json(geom, _POLYGON_JSON).getField("coordinates")
    multi = F.from_json(geom, _MULTI_JSON).getField("coordinates")
    return F.when((kind == "Polygon") & single.isNotNull(), F.array(single)).when(
        kind == "MultiPolygon", multi
    )


def st_from_geojson(text, srid: int = WGS84) -> Column:
    """Any supported GeoJSON to ``struct<kind, point, polygons, srid>``; null if unsupported."""
    text = _col(text)
    point = point_from_geojson(text, srid)
    polygons = polygon_from_geojson(text)
    kind = F.get_json_object(_geometry_text(text), "$.type")
    whole = F.struct(
        kind.alias("kind"),
        point.alias("point"),
        polygons.alias("polygons"),
        F.lit(srid).alias("srid"),
    )
    return F.when(point.isNotNull() | polygons.isNotNull(), whole)


# -------------------------------------------------------------------- polygons


def ring_edges(ring: Column) -> Column:
    """Edges of one ring; an unclosed ring is closed by its last edge."""

    def edge(p, i):
        q = F.get(ring, (i + 1) % F.size(ring))
        return F.struct(
            F.get(p, 0).alias("x1"),
            F.get(p, 1).alias("y1"),
            F.get(q, 0).alias("x2"),
            F.get(q, 1).alias("y2"),
        )

    return F.transform(ring, edge)


def polygon_edges(polygons) -> Column:
    """All edges of a multipolygon, holes included, as one flat array."""
    per_ring = F.transform(F.flatten(_col(polygons)), ring_edges)
    return F.flatten(per_ring)


def side(e: Column, x: Column, y: Column) -> Column:
    """Sign tells which side of the edge the point is on; zero is on its line."""
    return (e["x2"] - e["x1"]) * (y - e["y1"]) - (x - e["x1"]) * (e["y2"] - e["y1"])


def crosses_right(e: Column, x: Column, y: Column) -> Column:
    """Does a ray from the point towards +x cross the edge? Division-free."""
    straddles = (e["y1"] > y) != (e["y2"] > y)
    return straddles & ((side(e, x, y) > 0) == (e["y2"] > e["y1"]))


def crosses_up(e: Column, x: Column, y: Column) -> Column:
    """Does a ray from the point towards +y cross the edge?"""
    straddles = (e["x1"] > x) != (e["x2"] > x)
    return straddles & ((side(e, x, y) < 0) == (e["x2"] > e["x1"]))


def on_edge(e: Column, x: Column, y: Column) -> Column:
    return (
        (side(e, x, y) == 0)
        & x.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"]))
        & y.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"]))
    )


def is_number(c: Column) -> Column:
    return ~F.isnan(c)


def edges_parity(edges: Column, x: Column, y: Column) -> Column:
    """Even-odd rule over all rings, so holes need no special case."""
    return F.aggregate(edges, F.lit(False), lambda inside, e: inside != crosses_right(e, x, y))


def edges_boundary(edges: Column, x: Column, y: Column) -> Column:
    return F.exists(edges, lambda e: on_edge(e, x, y))


def edges_within(edges: Column, x: Column, y: Column) -> Column:
    """Strict interior; NaN, which orders above every number, is nowhere."""
    return is_number(x) & is_number(y) & edges_parity(edges, x, y) & ~edges_boundary(edges, x, y)


def edges_intersects(edges: Column, x: Column, y: Column) -> Column:
    """Interior or boundary."""
    return is_number(x) & is_number(y) & (edges_parity(edges, x, y) | edges_boundary(edges, x, y))


def st_within(point, polygons) -> Column:
    """Point strictly inside the multipolygon; null when either is null."""
    p, edges = _col(point), polygon_edges(polygons)
    return edges_within(edges, p["lon"], p["lat"])


def st_contains(polygons, point) -> Column:
    return st_within(point, polygons)


def st_intersects(point, polygons) -> Column:
    p, edges = _col(point), polygon_edges(polygons)
    return edges_intersects(edges, p["lon"], p["lat"])


def edges_envelope(edges: Column) -> Column:
    xs = F.transform(edges, lambda e: e["x1"])
    ys = F.transform(edges, lambda e: e["y1"])
    box = F.struct(
        F.array_min(xs).alias("min_x"),
        F.array_min(ys).alias("min_y"),
        F.array_max(xs).alias("max_x"),
        F.array_max(ys).alias("max_y"),
    )
    return F.when(F.size(edges) > 0, box)


def st_envelope(polygons) -> Column:
    """Bounding box; null for an empty multipolygon."""
    return edges_envelope(polygon_edges(polygons))


def _ring_area(ring: Column) -> Column:
    doubled = F.aggregate(
        ring_edges(ring),
        F.lit(0.0),
        lambda s, e: s + (e["x1"] * e["y2"] - e["x2"] * e["y1"]),
    )
    return F.abs(doubled) / F.lit(2.0)


def st_area(polygons) -> Column:
    """Planar area in squared coordinate units: outer rings minus holes."""

    def polygon_area(rings):
        outer = _ring_area(F.get(rings, 0))
        return F.aggregate(
            F.slice(rings, 2, F.greatest(F.size(rings), F.lit(1))),
            outer,
            lambda s, hole: s - _ring_area(hole),
        )

    parts = F.filter(_col(polygons), lambda rings: F.size(rings) > 0)
    return F.aggregate(F.transform(parts, polygon_area), F.lit(0.0), lambda s, a: s + a)


def st_is_valid(polygons) -> Column:
    """Structure only: rings closed, at least 4 positions, coordinates in range."""

    def ring_ok(ring):
        first, last = F.get(ring, 0), F.get(ring, F.size(ring) - 1)
        in_range = F.forall(
            ring,
            lambda p: F.get(p, 0).between(-180.0, 180.0) & F.get(p, 1).between(-90.0, 90.0),
        )
        closed = (F.get(first, 0) == F.get(last, 0)) & (F.get(first, 1) == F.get(last, 1))
        return (F.size(ring) >= 4) & closed & in_range

    polygons = _col(polygons)
    rings = F.flatten(polygons)
    ok = (F.size(rings) > 0) & F.forall(rings, ring_ok)
    return F.when(polygons.isNull(), F.lit(False)).otherwise(F.coalesce(ok, F.lit(False)))


# ------------------------------------------------------------------- distances


def haversine_m(lon1, lat1, lon2, lat2) -> Column:
    """Great-circle distance in metres."""
    lon1, lat1, lon2, lat2 = (_col(c) for c in (lon1, lat1, lon2, lat2))
    half_dlat = F.sin(F.radians(lat2 - lat1) / 2)
    half_dlon = F.sin(F.radians(lon2 - lon1) / 2)
    h = half_dlat * half_dlat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_dlon * half_dlon
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def unit_vector(lon, lat) -> Column:
    """Point on the unit sphere. Cosines between such vectors order like distances."""
    lam, phi = F.radians(_col(lon)), F.radians(_col(lat))
    return F.struct(
        (F.cos(phi) * F.cos(lam)).alias("ux"), (F.cos(phi) * F.sin(lam)).alias("uy"), F.sin(phi).alias("uz")
    )


def cosine(a: Column, b: Column) -> Column:
    """Cosine of the angle between two unit vectors."""
    return a["ux"] * b["ux"] + a["uy"] * b["uy"] + a["uz"] * b["uz"]


def st_distance_m(a, b) -> Column:
    a, b = _col(a), _col(b)
    return haversine_m(a["lon"], a["lat"], b["lon"], b["lat"])


def st_distance(a, b) -> Column:
    """Planar distance in coordinate units."""
    a, b = _col(a), _col(b)
    dx, dy = a["lon"] - b["lon"], a["lat"] - b["lat"]
    return F.sqrt(dx * dx + dy * dy)


def st_buffer_contains(center, radius_m: float, point) -> Column:
    """Is the point inside the service area of the given radius?"""
    return st_distance_m(center, point) <= F.lit(float(radius_m))


def service_area(center, radius_m: float, corners: int = 32) -> Column:
    """The service area as a closed N-gon (multipolygon)."""
    c = _col(center)
    dlat = F.degrees(F.lit(radius_m / EARTH_RADIUS_M))
    dlon = dlat / F.cos(F.radians(c["lat"]))

    def corner(i):
        # the last position repeats the first exactly, so the ring is closed
        angle = F.radians((i % corners).cast("double") * F.lit(360.0 / corners))
        return F.array(c["lon"] + dlon * F.cos(angle), c["lat"] + dlat * F.sin(angle))

    ring = F.transform(F.sequence(F.lit(0), F.lit(corners)), corner)
    return F.when(c.isNotNull(), F.array(F.array(ring)))


def to_local_xy(lon, lat, ref_lon: float, ref_lat: float, alt=None) -> Column:
    """Metres east and north of a reference point (equirectangular)."""
    lon, lat = _col(lon), _col(lat)
    scale = F.lit(EARTH_RADIUS_M)
    x = scale * F.radians(lon - F.lit(ref_lon)) * F.cos(F.radians(F.lit(ref_lat)))
    y = scale * F.radians(lat - F.lit(ref_lat))
    z = F.lit(0.0) if alt is None else _col(alt).cast("double")
    return F.struct(x.alias("x"), y.alias("y"), z.alias("z"))


def transform_crs(point, source: int, target: int) -> Column:
    """Reproject a point between 4326 and 3857; other pairs are an error."""
    p = _col(point)
    if source == target:
        return p
    if (source, target) == (WGS84, WEB_MERCATOR):
        x = F.radians(p["lon"]) * MERCATOR_RADIUS_M
        y = F.log(F.tan(F.radians(p["lat"]) / 2 + F.pi() / 4)) * MERCATOR_RADIUS_M
    elif (source, target) == (WEB_MERCATOR, WGS84):
        x = F.degrees(p["lon"] / MERCATOR_RADIUS_M)
        y = F.degrees(2 * F.atan(F.exp(p["lat"] / MERCATOR_RADIUS_M)) - F.pi() / 2)
    else:
        raise ValueError(f"no transform from EPSG:{source} to EPSG:{target}")
    moved = F.struct(x.alias("lon"), y.alias("lat"), F.lit(target).alias("srid"))
    return F.when(p.isNotNull(), moved)


# ------------------------------------------------------------------------ text


def st_as_text(point) -> Column:
    """WKT of a point."""
    p = _col(point)
    return F.concat(
        F.lit("POINT ("), p["lon"].cast("string"), F.lit(" "), p["lat"].cast("string"), F.lit(")")
    )


def polygon_as_text(polygons) -> Column:
    """WKT of a multipolygon."""

    def ring_text(ring):
        positions = F.transform(
            ring, lambda p: F.concat_ws(" ", F.get(p, 0).cast("string"), F.get(p, 1).cast("string"))
        )
        return F.concat(F.lit("("), F.array_join(positions, ", "), F.lit(")"))

    def polygon_text(rings):
        return F.concat(F.lit("("), F.array_join(F.transform(rings, ring_text), ", "), F.lit(")"))

    body = F.array_join(F.transform(_col(polygons), polygon_text), ", ")
    return F.concat(F.lit("MULTIPOLYGON ("), body, F.lit(")"))


def point_geojson_struct(point) -> Column:
    p = _col(point)
    return F.struct(F.lit("Point").alias("type"), F.array(p["lon"], p["lat"]).alias("coordinates"))


def st_as_geojson(point) -> Column:
    """GeoJSON geometry text of a point; null stays null."""
    p = _col(point)
    return F.when(p.isNotNull(), F.to_json(point_geojson_struct(p)))


def polygon_as_geojson(polygons) -> Column:
    g = _col(polygons)
    body = F.struct(F.lit("MultiPolygon").alias("type"), g.alias("coordinates"))
    return F.when(g.isNotNull(), F.to_json(body))
