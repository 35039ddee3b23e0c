"""The feeds' shapes derived from the driver tables.

One list of expressions per view serves Spark (``selectExpr``) and the SQL oracles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrahaz.functions import geometry as G


def _d(x) -> str:
    return f"cast({x} as double)"


def _lat(k: str, o: int) -> str:
    return f"{_d(40.45)}+(({k}*7919+{o})%6000)/{_d(10000)}"


def _lon(k: str, o: int) -> str:
    return f"{_d(-74.35)}+(({k}*104729+{o})%7000)/{_d(10000)}"


def _text(expr: str) -> str:
    return f"cast({expr} as varchar(20))"


def _pick(selector: str, values: list[str]) -> str:
    """Choose by remainder."""
    cases = " ".join(f"when {i} then '{v}'" for i, v in enumerate(values[:-1]))
    return f"case {selector}%{len(values)} {cases} else '{values[-1]}' end"


COMPLAINTS = ["Noise - Residential", "Illegal Parking", "Street Condition", "Fire Safety Complaint", "Water Leak"]
REQUEST_BOROUGHS = ["MANHATTAN", "Brooklyn", "QUEENS", "BRONX", "STATEN ISLAND", "UNKNOWN"]
WEATHER_BOROUGHS = ["Manhattan", "Brooklyn", "Queens", "Bronx", "Staten Island"]
FACILITIES = ["hospital", "fire_station", "clinic", "pharmacy", "police"]
CARRIERS = ["AAL", "UAL", "DAL", "JBU", "SWA", "ZZZ"]
LAYERS = ["bronze", "silver", "gold"]

# view -> (table, filter, [(column, expression)])
VIEWS: dict[str, tuple[str, str | None, list[tuple[str, str]]]] = {
    "fx_accidents": ("orders", None, [
        ("ID", f"concat('A-', {_text('o_orderkey')})"),
        ("Start_Lat", _lat("o_orderkey", 0)),
        ("Start_Lng", _lon("o_orderkey", 0)),
        ("Start_Time", "o_orderdate"),
        ("Severity", "cast(1+o_orderkey%4 as int)"),
        ("Description", "o_orderpriority"),
    ]),
    "fx_quakes": ("events", "event_type='error'", [
        ("earthquake_id", f"concat('q', {_text('event_id')})"),
        ("magnitude", f"case when event_id%97=0 then null else value/{_d(100)} end"),
        ("place", f"concat('zone ', {_text('user_id')})"),
        ("time", "ts"),
        ("latitude", _lat("event_id", 11)),
        ("longitude", _lon("event_id", 17)),
        ("depth_km", _d("event_id%30")),
    ]),
    "fx_311": ("events", "event_type in ('click','view')", [
        ("request_id", _text("event_id")),
        ("complaint_type", _pick("event_id", COMPLAINTS)),
        ("descriptor", "event_type"),
        ("latitude", f"case when event_id%89=0 then null else {_lat('event_id', 23)} end"),
        ("longitude", _lon("event_id", 29)),
        ("borough", _pick("user_id", REQUEST_BOROUGHS)),
        ("created_date", "ts"),
    ]),
    "fx_osm": ("customer", None, [
        ("osm_id", "c_custkey"),
        ("facility_type", _pick("c_custkey", FACILITIES)),
        ("name", "c_name"),
        ("latitude", _lat("c_custkey", 31)),
        ("longitude", _lon("c_custkey", 37)),
        ("operator", "c_mktsegment"),
    ]),
    # one overlapping polygon per part, every fortieth ten times as wide; corners lie off the grid of
    # the points, so no point falls on an edge by rounding
    "fx_nbhd": ("part", None, [
        ("neighborhood_id", "p_partkey"),
        ("name", "p_name"),
        ("x0", f"{_d(-74.29997)}+((p_partkey*7919)%6000)/{_d(10000)}"),
        ("y0", f"{_d(40.50007)}+((p_partkey*104729)%5000)/{_d(10000)}"),
        ("sz", f"case when p_partkey%40=0 then {_d(1)} else {_d(0.1)} end"),
    ]),
    "fx_weather": ("events", "event_type='signup'", [
        ("obs_id", "event_id"),
        ("borough", _pick("user_id", WEATHER_BOROUGHS)),
        ("ts", "ts"),
        ("temperature_f", f"value/{_d(5)}"),
        ("humidity_pct", _d("event_id%100")),
        ("wind_speed_mph", _d("event_id%30")),
        ("wind_direction_deg", _d("event_id%360")),
        ("visibility_miles", f"(event_id%100)/{_d(10)}"),
        ("ceiling_ft", _d("100+event_id%12000")),
        ("precipitation_in", f"(event_id%50)/{_d(100)}"),
    ]),
    "fx_flights": ("events", "event_type='purchase'", [
        ("flight_id", "event_id"),
        ("callsign", f"concat({_pick('event_id', CARRIERS)}, {_text('100+event_id%900')})"),
        ("ts", "ts"),
        ("latitude", _lat("event_id", 41)),
        ("longitude", _lon("event_id", 43)),
        ("distance_nm", _d("100+event_id%2000")),
        ("velocity_mps", "value"),
        ("borough", _pick("user_id", WEATHER_BOROUGHS)),
    ]),
    # run metrics: every event is one sample of one layer
    "fx_metrics": ("events", None, [
        ("sample_id", "event_id"),
        ("ts", "ts"),
        ("layer", _pick("user_id", LAYERS)),
        ("source", _pick("event_id", ["usgs", "nyc_311", "osm"])),
        ("operation", "event_type"),
        ("records", "cast(1+event_id%50 as bigint)"),
        ("errors", "cast(case when event_type='error' then 1+event_id%3 else 0 end as bigint)"),
        ("seconds", f"value/{_d(10)}"),
        ("counter", _d("(event_id*7)%1000")),
        ("up", "cast(case when event_id%11=0 then 0 else 1 end as bigint)"),
    ]),
    "fx_reports": ("documents", None, [
        ("incident_id", "doc_id"),
        ("incident_narrative", "text"),
        ("origin", "source"),
    ]),
    # model replies of every kind the parsers must survive
    "fx_replies": ("orders", None, [
        ("reply_id", "o_orderkey"),
        ("reply", "case o_orderkey%10"
                  " when 0 then concat('{\"severity\": ', cast(o_orderkey%15 as varchar(20)), ', \"hazard_type\": \"traffic\"}')"
                  " when 1 then 'not_json'"
                  " when 2 then '{\"severity\": \"high\", \"hazard_type\": \"fire\"}'"
                  " when 3 then '{\"severity\": 15, \"hazard_type\": \"fire\"}'"
                  " when 4 then '{\"severity\": 0, \"hazard_type\": \"medical\"}'"
                  " when 5 then '{\"hazard_type\": \"crime\"}'"
                  " when 6 then '{\"severity\": 4}'"
                  " when 7 then null"
                  " when 8 then '{\"severity\": 6.7, \"hazard_type\": \"weather\"}'"
                  " else '' end"),
        ("array_reply", "case o_orderkey%8"
                        " when 0 then concat('[{\"hazard_type\": \"weather\", \"description\": \"d', cast(o_orderkey as varchar(20)), '\", \"severity\": \"high\"}]')"
                        " when 1 then concat('Here it is: [{\"hazard_type\": \"fire\", \"description\": \"x', cast(o_orderkey as varchar(20)), '\", \"severity\": \"low\"}, {\"hazard_type\": \"crime\", \"description\": \"y\", \"severity\": \"low\"}] done')"
                        " when 2 then '{\"hazard_type\": \"fire\"}'"
                        " when 3 then '[]'"
                        " when 4 then null"
                        " when 5 then 'nothing found'"
                        " when 6 then ''"
                        " else '[{\"hazard_type\": \"medical\", \"description\": \"m\", \"severity\": \"medium\", \"location\": \"gate 3\", \"timestamp\": \"09:30\"}, {\"hazard_type\": \"weather\", \"description\": \"w\", \"severity\": \"low\"}]' end"),
        ("judge_reply", "case o_orderkey%5"
                        " when 0 then concat('{\"score\": ', cast(o_orderkey%6 as varchar(20)), ', \"reasoning\": \"because\"}')"
                        " when 1 then concat('I say \"score\": 0.', cast(o_orderkey%10 as varchar(20)), ' overall')"
                        " when 2 then '{\"reasoning\": \"no score\"}'"
                        " when 3 then null"
                        " else '{\"score\": 2.5}' end"),
        ("extracted_ok", "o_orderkey%7<>0"),
        ("prompt_tokens", "case when o_orderkey%9=0 then null else o_orderkey%200 end"),
        ("completion_tokens", "case when o_orderkey%4=0 then null else o_orderkey%50 end"),
        ("category", "o_orderpriority"),
        ("source_severity", "cast(case when o_orderkey%6=0 then null else 1+o_orderkey%12 end as double)"),
    ]),
    # labels with predictions and scores, for the model metrics
    "fx_scored": ("lineitem", None, [
        ("row_id", "l_orderkey*10+l_linenumber"),
        ("category", "l_returnflag"),
        ("label", "cast(case when l_quantity>25 then 1 else 0 end as int)"),
        ("prediction", "cast(case when l_extendedprice>40000 then 1 else 0 end as int)"),
        ("score", f"round(l_extendedprice/{_d(1000)})"),
        ("target", "l_quantity"),
        ("estimate", f"l_extendedprice/{_d(1500)}"),
    ]),
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived view as a lazy DataFrame over the whole driver table."""
    table, condition, columns = VIEWS[name]
    df = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    if condition is not None:
        df = df.where(condition)
    return df.selectExpr(*[f"{expr} AS {column}" for column, expr in columns])


def _sql(name: str) -> str:
    table, condition, columns = VIEWS[name]
    body = ", ".join(f"{expr} AS {column}" for column, expr in columns)
    return f"SELECT {body} FROM {table}" + (f" WHERE {condition}" if condition else "")


SQL_VIEWS: dict[str, str] = {name: _sql(name) for name in VIEWS}

# corners of a neighborhood polygon, as offsets from (x0, y0) in units of sz
CORNERS = [(0.0, 0.0), (0.05, 0.01), (0.04, 0.04), (0.01, 0.03)]


def _corner(shape: str, i: int) -> tuple[str, str]:
    dx, dy = CORNERS[i % 4]
    x = f"{shape}x0" if dx == 0 else f"({shape}x0+{_d(dx)}*{shape}sz)"
    y = f"{shape}y0" if dy == 0 else f"({shape}y0+{_d(dy)}*{shape}sz)"
    return x, y


def inside_sql(px: str, py: str, alias: str, strict: bool = True) -> str:
    """The corners run counter-clockwise and the shape is convex, so inside means left of
    every edge. This is the oracle's own formulation, not the ray cast."""
    tests = []
    for i in range(4):
        (x1, y1), (x2, y2) = _corner(f"{alias}.", i), _corner(f"{alias}.", i + 1)
        tests.append(f"({x2}-{x1})*({py}-{y1})-({px}-{x1})*({y2}-{y1}) {'>' if strict else '>='} 0")
    n = alias
    box = (f"{px} between {n}.x0 and {n}.x0+{_d(0.05)}*{n}.sz and {py} between {n}.y0 and {n}.y0+{_d(0.04)}*{n}.sz")
    return f"({box} and {' and '.join(tests)})"


def ring_sql() -> str:
    """Closed ring of a shape as JSON text, for Spark."""
    spots = []
    for i in range(5):
        x, y = _corner("", i)
        spots.append(f"'[', {x}, ',', {y}, ']'")
    body = ", ',', ".join(spots)
    return f"concat('[', {body}, ']')"


def geojson_sql() -> str:
    """Polygon text of a neighborhood, for Spark."""
    return f"concat('{{\"type\":\"Polygon\",\"coordinates\":[', {ring_sql()}, ']}}')"


#: Shapes that go with a neighborhood: a hole about its centre and a second part beside it.
COMPANIONS = {
    "fx_hole": [f"x0+{_d(0.0175)}*sz AS x0", f"y0+{_d(0.014)}*sz AS y0", f"{_d(0.3)}*sz AS sz"],
    "fx_islet": [f"x0+{_d(0.0601)}*sz AS x0", f"y0+{_d(0.0103)}*sz AS y0", f"{_d(0.5)}*sz AS sz"],
}
for _name, _columns in COMPANIONS.items():
    SQL_VIEWS[_name] = f"SELECT neighborhood_id, {', '.join(_columns)} FROM fx_nbhd"


def holed_land(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every neighborhood as a MultiPolygon: its own shape with a hole, and the second part."""
    df = view(spark, sf_dir, "fx_nbhd").selectExpr("*", f"{ring_sql()} AS outer_ring")
    df = df.withColumnsRenamed({"x0": "ox", "y0": "oy", "sz": "oz"})
    for name, columns in COMPANIONS.items():
        moved = df.selectExpr("*", "ox AS x0", "oy AS y0", "oz AS sz").selectExpr(*df.columns, *columns)
        df = moved.selectExpr(*df.columns, f"{ring_sql()} AS {name}_ring")
    text = F.concat(F.lit('{"type":"MultiPolygon","coordinates":[['), "outer_ring", F.lit(","), "fx_hole_ring", F.lit("],["),
                    "fx_islet_ring", F.lit("]]}"))
    return df.select("neighborhood_id", "name", G.polygon_from_geojson(text).alias("geometry"))


def neighborhoods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``neighborhood_id, name, geometry`` with the geometry as GeoJSON text."""
    return view(spark, sf_dir, "fx_nbhd").selectExpr("neighborhood_id", "name", f"{geojson_sql()} AS geometry")


def land(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neighborhoods with parsed polygons."""
    shapes = neighborhoods(spark, sf_dir)
    return shapes.withColumn("geometry", G.polygon_from_geojson("geometry"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def haversine_sql(lon1: str, lat1: str, lon2: str, lat2: str) -> str:
    """Great-circle metres, rounded to millimetres, as SQL text."""
    a = (
        f"power(sin(radians({lat2}-{lat1})/2),2)"
        f"+cos(radians({lat1}))*cos(radians({lat2}))*power(sin(radians({lon2}-{lon1})/2),2)"
    )
    return f"round(2*{_d(6371000)}*asin(sqrt(least({a},{_d(1)}))),3)"


def micros(c: str):
    """Timestamp to microseconds."""
    return F.unix_micros(F.col(c).cast("timestamp"))

# located pairs for the oracles: accident or 311 request inside a neighborhood
SQL_VIEWS["fx_hits"] = (
    "SELECT a.ID AS ID, n.neighborhood_id AS neighborhood_id FROM fx_accidents a JOIN fx_nbhd n ON "
    + inside_sql("a.Start_Lng", "a.Start_Lat", "n")
)
SQL_VIEWS["fx_hits_311"] = (
    "SELECT a.request_id AS request_id, n.neighborhood_id AS neighborhood_id FROM fx_311 a JOIN fx_nbhd n ON "
    + inside_sql("a.longitude", "a.latitude", "n")
)
SQL_VIEWS["fx_first_311"] = "SELECT request_id, min(neighborhood_id) AS neighborhood_id FROM fx_hits_311 GROUP BY request_id"
SQL_VIEWS["fx_first"] = "SELECT ID, min(neighborhood_id) AS neighborhood_id FROM fx_hits GROUP BY ID"


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accidents under canonical coordinate names."""
    return view(spark, sf_dir, "fx_accidents").withColumnsRenamed({"Start_Lat": "latitude", "Start_Lng": "longitude"})


def facilities(spark: SparkSession, sf_dir: str, kind: str | None = None) -> DataFrame:
    osm = view(spark, sf_dir, "fx_osm").withColumnRenamed("osm_id", "infrastructure_id")
    return osm if kind is None else osm.where(F.col("facility_type") == kind)
