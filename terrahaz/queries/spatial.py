"""Spatial functions and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from terrahaz.functions import geometry as G
from terrahaz.functions import grid
from terrahaz.functions.classify import lookup
from terrahaz.operators import ordered as W
from terrahaz.operators import spatial as S
from terrahaz.operators.sizing import join_dim, materialize
from terrahaz.operators.stations import nearest_reading
from terrahaz.operators.validity import validity
from terrahaz.plans import flows, gold
from terrahaz.queries import views as V
from terrahaz.queries.registry import query

REF_LON, REF_LAT = -73.9855, 40.758


def _pt(df, lon="Start_Lng", lat="Start_Lat"):
    return df.withColumn("p", G.st_point(lon, lat))


@query("st_point", "SELECT request_id, longitude AS lon, latitude AS lat, 4326 AS srid FROM fx_311 WHERE latitude IS NOT NULL")
def st_point(spark, sf):
    df = _pt(V.view(spark, sf, "fx_311"), "longitude", "latitude")
    return df.where(F.col("p").isNotNull()).select("request_id", "p.lon", "p.lat", "p.srid")


@query("st_set_srid", "SELECT ID, 3857 AS srid, Start_Lng AS lon FROM fx_accidents")
def st_set_srid(spark, sf):
    df = _pt(V.view(spark, sf, "fx_accidents")).withColumn("q", G.st_set_srid("p", 3857))
    return df.select("ID", "q.srid", "q.lon")


@query(
    "st_from_geojson",
    "SELECT neighborhood_id, 'Polygon' AS kind, 5 AS n_positions, x0 AS first_x, y0 AS first_y FROM fx_nbhd",
)
def st_from_geojson(spark, sf):
    g = V.neighborhoods(spark, sf).withColumn("g", G.st_from_geojson("geometry"))
    ring = F.col("g.polygons")[0][0]
    return g.select(
        "neighborhood_id", "g.kind", F.size(ring).alias("n_positions"),
        ring[0][0].alias("first_x"), ring[0][1].alias("first_y"),
    )


@query("st_xy", "SELECT ID, Start_Lng AS x, Start_Lat AS y FROM fx_accidents")
def st_xy(spark, sf):
    df = _pt(V.view(spark, sf, "fx_accidents"))
    return df.select("ID", G.st_x("p").alias("x"), G.st_y("p").alias("y"))


def _candidate(lat: str, lon: str) -> str:
    """The neighborhood whose slot of the layout holds the point."""
    return (
        f"cast(floor(({lat}-cast(40.5 as double))/cast(0.0385 as double))*15"
        f"+floor(({lon}+cast(74.3 as double))/cast(0.04 as double)) as bigint)"
    )


def _with_candidate(spark, sf):
    df = _pt(V.view(spark, sf, "fx_accidents"))
    df = df.withColumn("neighborhood_id", F.expr(_candidate("Start_Lat", "Start_Lng")))
    return join_dim(df, V.land(spark, sf).select("neighborhood_id", "geometry"), ["neighborhood_id"])


def _candidate_sql(columns: str) -> str:
    return (
        f"SELECT a.ID AS ID, n.neighborhood_id AS neighborhood_id, {columns} FROM fx_accidents a "
        f"JOIN fx_nbhd n ON n.neighborhood_id={_candidate('a.Start_Lat', 'a.Start_Lng')}"
    )


_IN = V.inside_sql("a.Start_Lng", "a.Start_Lat", "n")
_TOUCH = V.inside_sql("a.Start_Lng", "a.Start_Lat", "n", strict=False)


@query("st_within", _candidate_sql(f"{_IN} AS is_within"))
def st_within(spark, sf):
    df = _with_candidate(spark, sf)
    return df.select("ID", "neighborhood_id", G.st_within("p", "geometry").alias("is_within"))


@query("st_contains", _candidate_sql(f"{_IN} AS does_contain"))
def st_contains(spark, sf):
    df = _with_candidate(spark, sf)
    return df.select("ID", "neighborhood_id", G.st_contains("geometry", "p").alias("does_contain"))


@query("st_intersects", _candidate_sql(f"{_TOUCH} AS does_intersect"))
def st_intersects(spark, sf):
    df = _with_candidate(spark, sf)
    return df.select("ID", "neighborhood_id", G.st_intersects("p", "geometry").alias("does_intersect"))


@query(
    "st_distance",
    f"""SELECT ID, {V.haversine_sql('Start_Lng', 'Start_Lat', V._d(REF_LON), V._d(REF_LAT))} AS metres,
    round(sqrt(power(Start_Lng-{V._d(REF_LON)},2)+power(Start_Lat-{V._d(REF_LAT)},2)),9) AS degrees FROM fx_accidents""",
)
def st_distance(spark, sf):
    df = _pt(V.view(spark, sf, "fx_accidents")).withColumn("r", G.st_point(F.lit(REF_LON), F.lit(REF_LAT)))
    return df.select(
        "ID", F.round(G.st_distance_m("p", "r"), 3).alias("metres"), F.round(G.st_distance("p", "r"), 9).alias("degrees")
    )


@query(
    "st_buffer_contains",
    f"SELECT ID, {V.haversine_sql('Start_Lng', 'Start_Lat', V._d(REF_LON), V._d(REF_LAT))} <= 5000 AS covered FROM fx_accidents",
)
def st_buffer_contains(spark, sf):
    df = _pt(V.view(spark, sf, "fx_accidents"))
    return df.select("ID", G.st_buffer_contains(G.st_point(F.lit(REF_LON), F.lit(REF_LAT)), 5000.0, F.col("p")).alias("covered"))


@query(
    "service_area",
    f"""SELECT osm_id, 33 AS n_positions,
    round(latitude+degrees({V._d(1000)}/{V._d(6371000)}),9) AS north,
    round(latitude-degrees({V._d(1000)}/{V._d(6371000)}),9) AS south FROM fx_osm WHERE facility_type='hospital'""",
)
def service_area(spark, sf):
    df = V.facilities(spark, sf, "hospital").withColumn("a", G.service_area(G.st_point("longitude", "latitude"), 1000.0))
    ys = F.transform(F.col("a")[0][0], lambda p: p[1])
    return df.select(
        F.col("infrastructure_id").alias("osm_id"), F.size(F.col("a")[0][0]).alias("n_positions"),
        F.round(F.array_max(ys), 9).alias("north"), F.round(F.array_min(ys), 9).alias("south"),
    )


@query(
    "to_local_xy",
    f"""SELECT ID, round({V._d(6371000)}*radians(Start_Lng-{V._d(REF_LON)})*cos(radians({V._d(REF_LAT)})),3) AS x,
    round({V._d(6371000)}*radians(Start_Lat-{V._d(REF_LAT)}),3) AS y, {V._d(0)} AS z FROM fx_accidents""",
)
def to_local_xy(spark, sf):
    df = V.view(spark, sf, "fx_accidents").withColumn("l", G.to_local_xy("Start_Lng", "Start_Lat", REF_LON, REF_LAT))
    return df.select("ID", F.round("l.x", 3).alias("x"), F.round("l.y", 3).alias("y"), "l.z")


@query(
    "transform_crs",
    f"""SELECT ID, round(Start_Lng*pi()/180*{V._d(6378137)},3) AS x,
    round(ln(tan(pi()/4+Start_Lat*pi()/360))*{V._d(6378137)},3) AS y,
    round(Start_Lng,9) AS back_lon, round(Start_Lat,9) AS back_lat FROM fx_accidents""",
)
def transform_crs(spark, sf):
    df = _pt(V.view(spark, sf, "fx_accidents")).withColumn("m", G.transform_crs("p", 4326, 3857))
    df = df.withColumn("b", G.transform_crs("m", 3857, 4326))
    return df.select(
        "ID", F.round("m.lon", 3).alias("x"), F.round("m.lat", 3).alias("y"),
        F.round("b.lon", 9).alias("back_lon"), F.round("b.lat", 9).alias("back_lat"),
    )


_R4 = "round(Start_Lng,4)", "round(Start_Lat,4)"


@query("st_as_text", f"SELECT ID, 'POINT ('||{_R4[0]}||' '||{_R4[1]}||')' AS wkt FROM fx_accidents")
def st_as_text(spark, sf):
    p = G.st_point(F.round("Start_Lng", 4), F.round("Start_Lat", 4))
    return V.view(spark, sf, "fx_accidents").select("ID", G.st_as_text(p).alias("wkt"))


@query(
    "st_as_geojson",
    f"""SELECT ID, '{{"type":"Point","coordinates":['||{_R4[0]}||','||{_R4[1]}||']}}' AS geojson FROM fx_accidents""",
)
def st_as_geojson(spark, sf):
    p = G.st_point(F.round("Start_Lng", 4), F.round("Start_Lat", 4))
    return V.view(spark, sf, "fx_accidents").select("ID", G.st_as_geojson(p).alias("geojson"))


@query(
    "st_area",
    # shoelace sum of the corners (0,0) (5,1) (4,4) (1,3) in hundredths, times the polygon's size
    """SELECT neighborhood_id, round((5*4-4*1+4*3-1*4)/2/10000.0::double*sz*sz,9)::double AS area FROM fx_nbhd""",
)
def st_area(spark, sf):
    return V.land(spark, sf).select("neighborhood_id", F.round(G.st_area("geometry"), 9).alias("area"))


@query("st_is_valid", "SELECT neighborhood_id, true AS is_valid FROM fx_nbhd")
def st_is_valid(spark, sf):
    return V.land(spark, sf).select("neighborhood_id", G.st_is_valid("geometry").alias("is_valid"))


#: Four corners strewn about a place, so that some rings cross themselves, and a small square hole.
_CORNERS = [(31, 57), (83, 19), (45, 97), (11, 71)]


def _strewn(k: str) -> list[tuple[str, str]]:
    return [(f"({V._d(-74)}+(({k}*{7919 * a})%100003)/{V._d(1000000)})", f"({V._d(40.7)}+(({k}*{6007 * b})%99991)/{V._d(1000000)})") for a, b in _CORNERS]


def _validity_sql() -> str:
    corners = ", ".join(f"{x} AS x{i}, {y} AS y{i}" for i, (x, y) in enumerate(_strewn("p_partkey")))
    half = V._d(0.002)

    def side(a, b, x, y):
        return f"((x{b}-x{a})*({y}-y{a})-({x}-x{a})*(y{b}-y{a}))"

    def apart(a, b, c, d):
        s = [side(a, b, f"x{c}", f"y{c}"), side(a, b, f"x{d}", f"y{d}"), side(c, d, f"x{a}", f"y{a}"), side(c, d, f"x{b}", f"y{b}")]
        return f"NOT (({s[0]}>0)!=({s[1]}>0) AND ({s[2]}>0)!=({s[3]}>0))"

    def inside(x, y):
        rays = [f"CAST((y{i}>{y})!=(y{(i + 1) % 4}>{y}) AND ({side(i, (i + 1) % 4, x, y)}>0)=(y{(i + 1) % 4}>y{i}) AS INT)" for i in range(4)]
        return f"(({'+'.join(rays)})%2=1)"

    held = " AND ".join(inside(f"(hx{a}{half})", f"(hy{b}{half})") for a in "-+" for b in "-+")
    clear = " AND ".join(f"NOT (abs(x{i}-hx)<={half} AND abs(y{i}-hy)<={half})" for i in range(4))
    return f"""WITH c AS (SELECT p_partkey, {corners} FROM part),
    h AS (SELECT *, (x0+x2)/2 AS hx, (y0+y2)/2 AS hy FROM c)
    SELECT p_partkey AS shape_id, {apart(0, 1, 2, 3)} AND {apart(1, 2, 3, 0)} AND {held} AND {clear} AS is_valid FROM h"""


@query("polygon_validity", _validity_sql())
def polygon_validity(spark, sf):
    """Rings that cross themselves, holes that leave their shell."""
    corners = [F.array(F.expr(x), F.expr(y)) for x, y in _strewn("p_partkey")]
    c = [F.col("c")[i] for i in range(4)]
    hx, hy = (c[0][0] + c[2][0]) / 2, (c[0][1] + c[2][1]) / 2
    hole = [F.array(hx + dx * 0.002, hy + dy * 0.002) for dx, dy in ((-1, -1), (1, -1), (1, 1), (-1, 1))]
    shapes = V.table(spark, sf, "part").select(F.col("p_partkey").alias("shape_id"), F.array(*corners).alias("c"))
    shape = F.array(F.array(F.array(*c, c[0]), F.array(*hole, hole[0])))
    return validity(shapes.select("shape_id", shape.alias("shape")), "shape_id", "shape").select("shape_id", "is_valid")


@query(
    "st_envelope",
    "SELECT neighborhood_id, x0 AS min_x, y0 AS min_y, x0+cast(0.05 as double)*sz AS max_x, y0+cast(0.04 as double)*sz AS max_y FROM fx_nbhd",
)
def st_envelope(spark, sf):
    df = V.land(spark, sf).withColumn("b", G.st_envelope("geometry"))
    return df.select("neighborhood_id", "b.min_x", "b.min_y", "b.max_x", "b.max_y")


@query(
    "grid_cell",
    """SELECT cast(floor(Start_Lng/cast(0.05 as double)) as bigint) AS cx, cast(floor(Start_Lat/cast(0.05 as double)) as bigint) AS cy,
    count(*) AS n FROM fx_accidents GROUP BY 1,2""",
)
def grid_cell(spark, sf):
    cell = grid.grid_cell("Start_Lng", "Start_Lat", 0.05)
    return V.view(spark, sf, "fx_accidents").groupBy(cell["cx"].alias("cx"), cell["cy"].alias("cy")).agg(F.count("*").alias("n"))


@query(
    "grid_cover",
    """WITH b AS (SELECT neighborhood_id, floor(x0/cast(0.02 as double)) AS a, floor((x0+cast(0.05 as double)*sz)/cast(0.02 as double)) AS b,
    floor(y0/cast(0.02 as double)) AS c, floor((y0+cast(0.04 as double)*sz)/cast(0.02 as double)) AS d FROM fx_nbhd)
    SELECT neighborhood_id, cast((b-a+1)*(d-c+1) as bigint) AS cells FROM b""",
)
def grid_cover(spark, sf):
    boxes = V.land(spark, sf).withColumn("box", G.st_envelope("geometry"))
    cells = boxes.select("neighborhood_id", F.explode(grid.cells_of_box("box", 0.02)).alias("c"))
    return cells.groupBy("neighborhood_id").agg(F.countDistinct("c").alias("cells"))


@query(
    "sql_spatial_functions",
    f"""SELECT a.ID AS ID, {_IN} AS inside, {_TOUCH} AS touching,
    {V.haversine_sql('a.Start_Lng', 'a.Start_Lat', V._d(REF_LON), V._d(REF_LAT))} AS metres
    FROM fx_accidents a JOIN fx_nbhd n ON n.neighborhood_id={_candidate('a.Start_Lat', 'a.Start_Lng')}""",
)
def sql_spatial_functions(spark, sf):
    """The same functions, called from SQL text."""
    flows.register_sql_functions(spark)
    flows.sql_views({"fn_accidents": V.view(spark, sf, "fx_accidents"), "fn_shapes": V.neighborhoods(spark, sf)})
    return spark.sql(
        f"""SELECT a.ID, st_within(st_point(a.Start_Lng, a.Start_Lat), st_polygon(n.geometry)) AS inside,
        st_intersects(st_point(a.Start_Lng, a.Start_Lat), st_polygon(n.geometry)) AS touching,
        round(st_distance_m(st_point(a.Start_Lng, a.Start_Lat), st_point({REF_LON}D, {REF_LAT}D)), 3) AS metres
        FROM fn_accidents a JOIN fn_shapes n ON n.neighborhood_id = {_candidate('a.Start_Lat', 'a.Start_Lng')}"""
    )


@query(
    "sql_spatial_join",
    f"SELECT a.ID AS ID, n.neighborhood_id AS neighborhood_id FROM fx_accidents a JOIN fx_nbhd n ON {_IN}",
)
def sql_spatial_join(spark, sf):
    """A spatial join written in SQL: the cover of a polygon, in cells of its own size, met by the cells of a point."""
    flows.register_sql_functions(spark)
    # a few bytes a row, but all of its cells are made from it: rows of one small file go to all tasks, and what the
    # optimizer asks of the cells is not to be asked before
    spread = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    flows.sql_views({"sj_accidents": V.view(spark, sf, "fx_accidents").repartition(spread), "sj_shapes": materialize(V.neighborhoods(spark, sf).repartition(spread), "sql-shapes")})
    return spark.sql(
        """WITH shapes AS (SELECT neighborhood_id, st_polygon(geometry) AS shape FROM sj_shapes),
        levelled AS (SELECT neighborhood_id, shape, st_level(shape) AS level FROM shapes),
        covers AS (SELECT neighborhood_id, shape, level, st_cover(shape, level) AS cells FROM levelled),
        covered AS (SELECT neighborhood_id, shape, level, cell FROM covers LATERAL VIEW explode(cells) AS cell),
        points AS (SELECT ID, st_point(Start_Lng, Start_Lat) AS place, st_levels() AS levels FROM sj_accidents),
        asked AS (SELECT ID, place, level FROM points LATERAL VIEW explode(levels) AS level),
        probes AS (SELECT ID, place, level, st_cell(place, level) AS cell FROM asked)
        SELECT p.ID, c.neighborhood_id FROM probes p JOIN covered c
        ON p.level = c.level AND p.cell = c.cell AND st_within(p.place, c.shape)"""
    )


# ---------------------------------------------------------------------- joins


@query("land_mask", "SELECT ID, Severity FROM fx_accidents WHERE ID IN (SELECT ID FROM fx_hits)")
def land_mask(spark, sf):
    return S.land_mask(V.points(spark, sf), V.land(spark, sf)).select("ID", "Severity")


@query(
    "land_mask_inner",
    f"""SELECT a.ID AS ID, n.neighborhood_id AS land_neighborhood_id, n.name AS land_name
    FROM fx_accidents a JOIN fx_nbhd n ON {_TOUCH}""",
)
def land_mask_inner(spark, sf):
    joined = S.land_mask_inner(V.points(spark, sf), V.land(spark, sf), attrs=("name",))
    return joined.select("ID", "land_neighborhood_id", "land_name")


@query("off_land", "SELECT request_id, borough FROM fx_311 WHERE request_id NOT IN (SELECT request_id FROM fx_hits_311)")
def off_land(spark, sf):
    return S.off_land(V.view(spark, sf, "fx_311"), V.land(spark, sf)).select("request_id", "borough")


@query(
    "event_neighborhood",
    """SELECT a.ID AS ID, f.neighborhood_id AS neighborhood_id, n.name AS name FROM fx_accidents a
    LEFT JOIN fx_first f ON a.ID=f.ID LEFT JOIN fx_nbhd n ON n.neighborhood_id=f.neighborhood_id""",
)
def event_neighborhood(spark, sf):
    joined = S.attach_polygon(V.points(spark, sf), V.land(spark, sf), attrs=("name",))
    return joined.select("ID", "neighborhood_id", "name")


_NEAREST = """SELECT ID, osm_id AS nearest_id, m AS nearest_m FROM (
 SELECT a.ID AS ID, o.osm_id AS osm_id, {d} AS m,
 row_number() OVER (PARTITION BY a.ID ORDER BY {d}, o.osm_id) AS r
 FROM fx_accidents a CROSS JOIN (SELECT * FROM fx_osm WHERE facility_type='{kind}') o) WHERE r=1"""
_HAV = V.haversine_sql("a.Start_Lng", "a.Start_Lat", "o.longitude", "o.latitude")


@query("nearest_facility", _NEAREST.format(d=_HAV, kind="hospital"))
def nearest_facility(spark, sf):
    found = S.nearest_facility(V.points(spark, sf), V.facilities(spark, sf, "hospital"))
    return found.select("ID", "nearest_id", "nearest_m")


@query(
    "nearest_of_each",
    f"""SELECT h.ID AS ID, h.nearest_id AS hospital_id, h.nearest_m AS hospital_m, f.nearest_id AS fire_station_id, f.nearest_m AS fire_station_m
    FROM ({_NEAREST.format(d=_HAV, kind="hospital")}) h JOIN ({_NEAREST.format(d=_HAV, kind="fire_station")}) f ON h.ID = f.ID""",
)
def nearest_of_each(spark, sf):
    """Nearest hospital and nearest fire station from one search."""
    dim = V.view(spark, sf, "fx_osm").withColumnsRenamed({"osm_id": "infrastructure_id", "facility_type": "facility_category"})
    names = {c: (f"{c}_id", f"{c}_m") for c in gold.DIM_CATEGORIES}
    return S.nearest_of_each(V.points(spark, sf), dim, names).select("ID", *[c for pair in names.values() for c in pair])


@query(
    "near_facility",
    f"""SELECT ID, cast(count(*) as bigint) AS facilities_within, min(m) AS nearest_m FROM (
    SELECT a.ID AS ID, {_HAV} AS m FROM fx_accidents a CROSS JOIN (SELECT * FROM fx_osm WHERE facility_type='hospital') o)
    WHERE m<=1000 GROUP BY ID""",
)
def near_facility(spark, sf):
    reach = S.within_distance(V.points(spark, sf), V.facilities(spark, sf, "hospital"), 1000.0)
    return reach.select("ID", "facilities_within", "nearest_m")


@query(
    "fact_dim",
    """SELECT f.ID AS ID, n.name AS neighborhood_name, d.sk AS neighborhood_sk FROM fx_first f
    JOIN fx_nbhd n ON n.neighborhood_id=f.neighborhood_id
    JOIN (SELECT neighborhood_id, row_number() OVER (ORDER BY neighborhood_id) AS sk FROM fx_nbhd) d
    ON d.neighborhood_id=f.neighborhood_id""",
)
def fact_dim(spark, sf):
    fact = S.attach_polygon(V.points(spark, sf), V.land(spark, sf))
    dim = gold.dim_neighborhoods(V.land(spark, sf))
    joined = join_dim(fact, dim.select("neighborhood_id", "neighborhood_name", "neighborhood_sk"), ["neighborhood_id"])
    return joined.select("ID", "neighborhood_name", "neighborhood_sk")


@query(
    "flight_weather",
    """SELECT f.flight_id AS flight_id, f.borough AS borough, w.temperature_f AS temperature_f, w.wind_speed_mph AS wind_speed_mph
    FROM fx_flights f ASOF LEFT JOIN fx_weather w ON f.borough=w.borough AND f.ts>=w.ts""",
)
def flight_weather(spark, sf):
    joined = W.asof_join(
        V.view(spark, sf, "fx_flights"), V.view(spark, sf, "fx_weather"), ["borough"], "ts", "ts",
        ["temperature_f", "wind_speed_mph"],
    )
    return joined.select("flight_id", "borough", "temperature_f", "wind_speed_mph")


V.SQL_VIEWS["fx_stations"] = (
    f"SELECT s_suppkey AS station_id, {V._lat('s_suppkey', 61)} AS latitude, {V._lon('s_suppkey', 67)} AS longitude FROM supplier"
)
V.SQL_VIEWS["fx_readings"] = (
    "SELECT cast(1+event_id%70 as bigint) AS station_id, ts, value AS temperature_f, event_id AS reading_id "
    "FROM events WHERE event_type='signup'"
)
_SM = V.haversine_sql("f.longitude", "f.latitude", "s.longitude", "s.latitude")


def _station_sql(fresh: str = "true") -> str:
    return f"""WITH heard AS (
      SELECT p.flight_id, p.station_id, p.m, p.ts, w.temperature_f, w.reading_id, w.ts AS heard_at
      FROM (SELECT f.flight_id, f.ts, s.station_id, {_SM} AS m FROM fx_flights f CROSS JOIN fx_stations s) p
      ASOF JOIN (SELECT station_id, ts, max(temperature_f) AS temperature_f, arg_max(reading_id, temperature_f) AS reading_id
                 FROM fx_readings GROUP BY 1, 2) w ON p.station_id=w.station_id AND p.ts>=w.ts
    ), ranked AS (
      SELECT *, row_number() OVER (PARTITION BY flight_id ORDER BY m, station_id) AS r FROM heard WHERE {fresh}
    ) SELECT f.flight_id AS flight_id, r.station_id AS station_id, r.m AS station_m, r.temperature_f AS temperature_f, r.reading_id AS reading_id
    FROM fx_flights f LEFT JOIN (SELECT * FROM ranked WHERE r=1) r ON f.flight_id=r.flight_id"""


def _with_station(spark, sf, max_age_s=None):
    stations = V.table(spark, sf, "supplier").selectExpr(
        "s_suppkey AS station_id", f"{V._lat('s_suppkey', 61)} AS latitude", f"{V._lon('s_suppkey', 67)} AS longitude")
    readings = V.table(spark, sf, "events").where("event_type='signup'").selectExpr(
        "cast(1+event_id%70 as bigint) AS station_id", "ts", "value AS temperature_f", "event_id AS reading_id")
    found = nearest_reading(V.view(spark, sf, "fx_flights"), stations, readings, ["temperature_f", "reading_id"], max_age_s=max_age_s)
    return found.select("flight_id", "station_id", "station_m", "temperature_f", "reading_id")


@query("flight_weather_station", _station_sql())
def flight_weather_station(spark, sf):
    """Weather of the nearest station that has reported by then; most stations never do."""
    return _with_station(spark, sf)


@query("flight_weather_fresh", _station_sql("epoch_us(ts)-epoch_us(heard_at) <= 3600000000"))
def flight_weather_fresh(spark, sf):
    """The same with readings of at most an hour, so stations fall silent in between."""
    return _with_station(spark, sf, 3600.0)


@query(
    "lookup_map",
    """SELECT request_id, CASE upper(borough) WHEN 'MANHATTAN' THEN 0 WHEN 'BROOKLYN' THEN 1 WHEN 'QUEENS' THEN 2
    WHEN 'BRONX' THEN 3 WHEN 'STATEN ISLAND' THEN 4 ELSE 0 END AS borough_code FROM fx_311""",
)
def lookup_map(spark, sf):
    from terrahaz.functions.classify import BOROUGH_CODES

    code = lookup(F.upper("borough"), BOROUGH_CODES, 0)
    return V.view(spark, sf, "fx_311").select("request_id", code.alias("borough_code"))


V.SQL_VIEWS["fx_holed_hits"] = (
    "SELECT a.ID AS ID, n.neighborhood_id AS neighborhood_id FROM fx_accidents a JOIN fx_nbhd n"
    " ON a.Start_Lng BETWEEN n.x0 AND n.x0+0.09::double*n.sz AND a.Start_Lat BETWEEN n.y0 AND n.y0+0.04::double*n.sz"
    " JOIN fx_hole h ON h.neighborhood_id=n.neighborhood_id JOIN fx_islet i ON i.neighborhood_id=n.neighborhood_id"
    f" WHERE ({V.inside_sql('a.Start_Lng', 'a.Start_Lat', 'n')} AND NOT {V.inside_sql('a.Start_Lng', 'a.Start_Lat', 'h', strict=False)})"
    f" OR {V.inside_sql('a.Start_Lng', 'a.Start_Lat', 'i')}"
)


@query(
    "holed_neighborhood",
    """SELECT a.ID AS ID, min(h.neighborhood_id) AS neighborhood_id FROM fx_accidents a
    LEFT JOIN fx_holed_hits h ON h.ID=a.ID GROUP BY a.ID""",
)
def holed_neighborhood(spark, sf):
    """Polygons with a hole and a second part, from the whole table."""
    placed = S.attach_polygon(V.points(spark, sf), V.holed_land(spark, sf))
    return placed.select("ID", "neighborhood_id")


@query(
    "holed_off_land",
    "SELECT ID FROM fx_accidents WHERE ID NOT IN (SELECT ID FROM fx_holed_hits)",
)
def holed_off_land(spark, sf):
    """The same beyond the broadcast limit, so that it shuffles on the cell."""
    return S.off_land(V.points(spark, sf), V.holed_land(spark, sf), max_bytes=0).select("ID")
