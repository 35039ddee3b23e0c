"""End-to-end flows: files to silver, silver to gold, layers as SQL views."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from terrahaz.functions import geometry as G
from terrahaz.functions import grid
from terrahaz.operators import aggregate as A
from terrahaz.operators import clean as P
from terrahaz.operators import spatial as S
from terrahaz.plans import gold
from terrahaz.sources import feeds, readers, sinks


def silver_flow(
    spark: SparkSession,
    input_format: str,
    input_path: str,
    source: str,
    out_path: str | None = None,
    land: DataFrame | None = None,
    schema: str | None = None,
) -> DataFrame:
    """Read, resolve columns, cast, validate, add the point, mask, add lineage, write.

    One scan of the input and no count jobs, given a schema (CSV and JSON without one are read
    once more to infer it). Returns the silver table.
    """
    raw = readers.read_layer(spark, input_format, input_path, schema=schema)
    lat, lon = P.resolve_column(raw.columns, "latitude"), P.resolve_column(raw.columns, "longitude")
    located = P.valid_wgs84(P.cast_coordinates(raw, lat, lon))
    located = located.withColumn("geometry", G.st_point("longitude", "latitude"))
    if land is not None:
        located = S.land_mask(located, land)
    silver = P.add_lineage(located, source)
    if out_path is None:
        return silver
    sinks.write_table(silver, out_path)
    return spark.read.parquet(out_path)


#: Sources kept to land; quakes are worldwide.
MASKED = ("us_accidents", "nyc_311", "osm_infrastructure")


def silver_masked(tables: dict[str, DataFrame], land: DataFrame, out_path: str | None = None) -> dict[str, DataFrame]:
    """Per source: mask where it applies, and write if a path is given."""
    out = {}
    for name, df in tables.items():
        kept = S.land_mask(df, land, predicate="intersects") if name in MASKED else df
        if out_path is not None:
            sinks.write_table(kept, f"{out_path}/{name}_silver")
            kept = df.sparkSession.read.parquet(f"{out_path}/{name}_silver")
        out[name] = kept
    return out


def heatmap_export(fact: DataFrame, path: str | None = None) -> DataFrame:
    """Fact to GeoJSON features; written by all tasks if a path is given."""
    features = sinks.features_as_json(sinks.heatmap_features(fact))
    if path is not None:
        sinks.export_geojson(features, path)
    return features


def bronze_to_map(
    quakes: DataFrame, requests: DataFrame, elements: DataFrame, land: DataFrame | None = None, path: str | None = None
) -> DataFrame:
    """Raw payloads of the three event feeds to map features: flatten, silver, mask, fact, GeoJSON.

    One plan from the payloads to the features; written by all tasks if a path is given.
    """
    silver = {
        "usgs_earthquakes": gold.silver_quakes(feeds.flatten_quakes(quakes)),
        "nyc_311": gold.silver_311(feeds.flatten_311(requests)),
        "osm_infrastructure": gold.silver_osm(feeds.flatten_osm(elements)),
    }
    if land is not None:
        silver = silver_masked(silver, land)
    fact = A.fact_union(silver["usgs_earthquakes"], silver["nyc_311"], silver["osm_infrastructure"])
    return heatmap_export(fact, path)


def sql_views(tables: dict[str, DataFrame]) -> None:
    """Every layer table as a temporary view."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Spatial functions for SQL text. They are SQL expressions, so Catalyst sees through them.

    ``st_cell(point, level)`` and ``st_cover(shape, level)`` make a spatial join in SQL an equi-join: explode the
    cover of the shapes in a lateral view, equate it with the cell of the points and add the predicate. A
    cell of level n is 360 / 2**n degrees wide; a cover has the cells of the shape's box. ``st_level(shape)`` is the
    level (one of ``st_levels()``) at which that is a handful of cells, so shapes of any size can be covered by
    cells of their own size and points asked at each level.
    """
    point = "STRUCT<lon: DOUBLE, lat: DOUBLE, srid: INT>"
    edges = "ARRAY<STRUCT<x1: DOUBLE, y1: DOUBLE, x2: DOUBLE, y2: DOUBLE>>"
    shape = "ARRAY<ARRAY<ARRAY<ARRAY<DOUBLE>>>>"
    side = "(e.x2 - e.x1) * (st_y(p) - e.y1) - (st_x(p) - e.x1) * (e.y2 - e.y1)"
    ray = f"((e.y1 > st_y(p)) != (e.y2 > st_y(p))) AND (({side} > 0) = (e.y2 > e.y1))"
    on = (
        f"{side} = 0 AND st_x(p) BETWEEN least(e.x1, e.x2) AND greatest(e.x1, e.x2) "
        "AND st_y(p) BETWEEN least(e.y1, e.y2) AND greatest(e.y1, e.y2)"
    )
    # one pass over the corners, each with the one before it: an array of edges would be made anew for every pair
    ray, on = (x.replace("e.x1", "s.f[0]").replace("e.y1", "s.f[1]").replace("e.x2", "q[0]").replace("e.y2", "q[1]") for x in (ray, on))
    ring = (
        "aggregate(r, struct(acc.i AS i, acc.o AS o, get(r, size(r) - 1) AS f), "
        f"(s, q) -> struct(s.i != ({ray}) AS i, s.o OR ({on}) AS o, q AS f), s -> struct(s.i AS i, s.o AS o))"
    )
    met = f"aggregate(flatten(g), struct(false AS i, false AS o), (acc, r) -> {ring}, acc -> {{asked}})"
    edge = (
        "transform(r, (q, i) -> struct(q[0] AS x1, q[1] AS y1, "
        "get(get(r, (i + 1) % size(r)), 0) AS x2, get(get(r, (i + 1) % size(r)), 1) AS y2))"
    )
    radius = G.EARTH_RADIUS_M
    half = "pow(sin(radians(st_y(b) - st_y(a)) / 2), 2)"
    wide = "cos(radians(st_y(a))) * cos(radians(st_y(b))) * pow(sin(radians(st_x(b) - st_x(a)) / 2), 2)"
    size = "(360D / pow(2D, n))"
    column, row = f"cast(floor(({{x}} + 180D) / {size}) AS BIGINT)", f"cast(floor(({{y}} + 90D) / {size}) AS BIGINT)"
    packed = "(shiftleft({row}, n) | pmod({column}, shiftleft(1L, n)))"
    cell = packed.format(row=row.format(y="st_y(p)"), column=column.format(x="st_x(p)"))
    ends = ", ".join(f"array_{f}(transform(s, e -> e.{c}1)) AS {c}_{f}" for c in "xy" for f in ("min", "max"))
    box = f"get(transform(array(st_edges(g)), s -> struct(size(s) AS n, {ends})), 0)"
    columns = f"sequence({column.format(x='b.x_min')}, {column.format(x='b.x_max')})"
    rows = f"sequence({row.format(y='b.y_min')}, {row.format(y='b.y_max')})"
    beyond = " OR ".join(f"b.{c}_max - b.{c}_min > {{size}}D" for c in "xy")
    fitting = " ".join(f"WHEN NOT ({beyond.format(size=S.MAX_SPAN * grid.quad_size(n))}) THEN {n}" for n in S.START_LEVELS[:-1])
    level = f"get(transform(array({box}), b -> CASE WHEN b.n > 0 THEN CASE {fitting} ELSE {S.START_LEVELS[-1]} END END), 0)"
    cells = f"flatten(transform(a.columns, c -> transform(a.rows, r -> {packed.format(row='r', column='c')})))"
    # the optimizer writes arguments into bodies, also inside lambdas: each is evaluated once, into a struct
    n_bound = re.compile(r"\bn\b")
    columns, rows, cells = (n_bound.sub("a.n", x).replace("b.", "a.b.") for x in (columns, rows, cells))
    ranged = f"transform(array(struct({box} AS b, n AS n)), a -> CASE WHEN a.b.n > 0 THEN struct(a.n AS n, {columns} AS columns, {rows} AS rows) END)"
    cover = f"get(transform({ranged}, a -> CASE WHEN a IS NOT NULL THEN {cells} END), 0)"
    bodies = {
        "st_point": ("lon DOUBLE, lat DOUBLE", point,
                     "CASE WHEN lon IS NOT NULL AND lat IS NOT NULL THEN struct(lon AS lon, lat AS lat, 4326 AS srid) END"),
        "st_set_srid": (f"p {point}, s INT", point, "CASE WHEN p IS NOT NULL THEN struct(p.lon AS lon, p.lat AS lat, s AS srid) END"),
        "st_x": (f"p {point}", "DOUBLE", "p.lon"),
        "st_y": (f"p {point}", "DOUBLE", "p.lat"),
        "st_polygon": ("t STRING", shape,
                       "CASE get_json_object(t, '$.type') "
                       "WHEN 'Polygon' THEN array(from_json(t, 'coordinates array<array<array<double>>>').coordinates) "
                       "WHEN 'MultiPolygon' THEN from_json(t, 'coordinates array<array<array<array<double>>>>').coordinates END"),
        "st_edges": (f"g {shape}", edges, f"flatten(transform(flatten(g), r -> {edge}))"),
        "st_cell": (f"p {point}, n INT", "BIGINT", f"CASE WHEN NOT isnan(st_x(p)) AND NOT isnan(st_y(p)) THEN {cell} END"),
        "st_level": (f"g {shape}", "INT", level),
        "st_levels": ("", "ARRAY<INT>", f"array({', '.join(map(str, S.START_LEVELS))})"),
        "st_cover": (f"g {shape}, n INT", "ARRAY<BIGINT>", cover),
        "st_within": (f"p {point}, g {shape}", "BOOLEAN", met.format(asked="acc.i AND NOT acc.o")),
        "st_contains": (f"g {shape}, p {point}", "BOOLEAN", "st_within(p, g)"),
        "st_intersects": (f"p {point}, g {shape}", "BOOLEAN", met.format(asked="acc.i OR acc.o")),
        "st_distance": (f"a {point}, b {point}", "DOUBLE",
                        "sqrt(pow(st_x(a) - st_x(b), 2) + pow(st_y(a) - st_y(b), 2))"),
        "st_distance_m": (f"a {point}, b {point}", "DOUBLE",
                          f"2 * {radius}D * asin(sqrt(least({half} + {wide}, 1D)))"),
        "st_buffer_contains": (f"a {point}, r DOUBLE, b {point}", "BOOLEAN", "st_distance_m(a, b) <= r"),
    }
    for name, (args, returns, body) in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({args}) RETURNS {returns} RETURN {body}")
    return list(bodies)


