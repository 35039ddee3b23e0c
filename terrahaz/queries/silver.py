"""Cleaning operators and silver tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrahaz.functions import classify as C
from terrahaz.operators import clean as P
from terrahaz.plans import flows, gold
from terrahaz.queries import views as V
from terrahaz.queries.registry import query
from terrahaz.session import scratch


@query("resolve_columns", "SELECT ID, Start_Lat AS latitude, Start_Lng AS longitude, Description AS description FROM fx_accidents")
def resolve_columns(spark, sf):
    df = V.view(spark, sf, "fx_accidents").withColumnRenamed("Description", "event_desc")
    return P.resolve_columns(df, ["latitude", "longitude", "description"]).select("ID", "latitude", "longitude", "description")


_CANON = "SELECT '{s}' AS source, {i} AS source_id, {t} AS event_timestamp, {d} AS description, {v} AS severity, {la} AS latitude, {lo} AS longitude FROM {f}"


def _events(df):
    return df.select("source", "source_id", "event_timestamp", "description", "severity", "latitude", "longitude")


@query(
    "canonical_accidents",
    _CANON.format(s="us_accidents", i="ID", t="Start_Time", d="Description", v="Severity::double", la="Start_Lat", lo="Start_Lng", f="fx_accidents"),
)
def canonical_accidents(spark, sf):
    return _events(P.canonical_accidents(V.view(spark, sf, "fx_accidents")))


@query(
    "canonical_quakes",
    _CANON.format(s="usgs_earthquakes", i="earthquake_id", t="time", d="place", v="magnitude", la="latitude", lo="longitude", f="fx_quakes"),
)
def canonical_quakes(spark, sf):
    return _events(P.canonical_quakes(V.view(spark, sf, "fx_quakes")))


@query(
    "canonical_311",
    _CANON.format(s="nyc_311_requests", i="request_id", t="created_date", d="complaint_type||' - '||descriptor", v="5.0::double", la="latitude", lo="longitude",
                  f="fx_311 WHERE latitude IS NOT NULL"),
)
def canonical_311(spark, sf):
    return _events(P.canonical_311(V.view(spark, sf, "fx_311")))


@query(
    "canonical_infrastructure",
    "SELECT 'osm_infrastructure' AS source, cast(osm_id as varchar) AS source_id, facility_type, name AS facility_name, operator, latitude, longitude FROM fx_osm",
)
def canonical_infrastructure(spark, sf):
    df = P.canonical_infrastructure(V.view(spark, sf, "fx_osm"))
    return df.select("source", "source_id", "facility_type", "facility_name", "operator", "latitude", "longitude")


@query(
    "canonical_neighborhoods",
    "SELECT 'neighborhoods' AS source, cast(neighborhood_id as varchar) AS source_id, name AS neighborhood_name, 5 AS n_positions FROM fx_nbhd",
)
def canonical_neighborhoods(spark, sf):
    df = P.canonical_neighborhoods(V.neighborhoods(spark, sf))
    return df.select("source", "source_id", "neighborhood_name", F.size(F.col("geometry")[0][0]).alias("n_positions"))


_DIRTY = "case o_orderkey%6 when 0 then 'n/a' when 1 then null when 2 then '' else cast(o_orderkey%90 as varchar(20)) end"


@query(
    "cast_coordinates",
    f"SELECT o_orderkey, try_cast({_DIRTY} AS double) AS latitude, try_cast('-'||cast(o_orderkey%180 as varchar) AS double) AS longitude FROM orders",
)
def cast_coordinates(spark, sf):
    raw = V.table(spark, sf, "orders").selectExpr("o_orderkey", f"{_DIRTY} AS la", "concat('-', cast(o_orderkey%180 as string)) AS lo")
    return P.cast_coordinates(raw, "la", "lo").select("o_orderkey", "latitude", "longitude")


@query("drop_missing", "SELECT earthquake_id, magnitude FROM fx_quakes WHERE magnitude IS NOT NULL")
def drop_missing(spark, sf):
    return P.drop_missing(V.view(spark, sf, "fx_quakes"), ["latitude", "longitude", "magnitude"]).select("earthquake_id", "magnitude")


_WILD = "cast(o_orderkey%200-100 as double) AS latitude, cast(o_orderkey%400-200 as double) AS longitude"


@query("valid_wgs84", f"SELECT * FROM (SELECT o_orderkey, {_WILD} FROM orders) WHERE abs(latitude)<=90 AND abs(longitude)<=180")
def valid_wgs84(spark, sf):
    return P.valid_wgs84(V.table(spark, sf, "orders").selectExpr("o_orderkey", *_WILD.split(", ")))


@query(
    "in_bbox",
    "SELECT ID, Start_Lat, Start_Lng FROM fx_accidents WHERE Start_Lat>=40.5 AND Start_Lat<=41.0 AND Start_Lng>=-74.3 AND Start_Lng<=-73.7",
)
def in_bbox(spark, sf):
    return P.in_bbox(V.view(spark, sf, "fx_accidents"), lat="Start_Lat", lon="Start_Lng").select("ID", "Start_Lat", "Start_Lng")


@query("add_lineage", "SELECT request_id, 'nyc_311' AS source, 'validated' AS data_quality_flag, 'EPSG:4326' AS crs FROM fx_311")
def add_lineage(spark, sf):
    return P.add_lineage(V.view(spark, sf, "fx_311"), "nyc_311").select("request_id", "source", "data_quality_flag", "crs")


@query("surrogate_uuid", "SELECT request_id, sha256('7:nyc_311'||length(request_id)||':'||request_id) AS uid FROM fx_311")
def surrogate_uuid(spark, sf):
    return V.view(spark, sf, "fx_311").select("request_id", P.surrogate_uuid(F.lit("nyc_311"), "request_id").alias("uid"))


@query(
    "flag_quality",
    f"""SELECT o_orderkey, CASE WHEN latitude IS NULL THEN 'missing_coordinates' WHEN abs(latitude)>90 OR abs(longitude)>180 THEN 'out_of_range' ELSE 'validated' END AS data_quality_flag
    FROM (SELECT o_orderkey, CASE WHEN o_orderkey%23=0 THEN NULL ELSE latitude END AS latitude, longitude FROM (SELECT o_orderkey, {_WILD} FROM orders))""",
)
def flag_quality(spark, sf):
    wild = V.table(spark, sf, "orders").selectExpr("o_orderkey", *_WILD.split(", "))
    holed = wild.withColumn("latitude", F.when(F.col("o_orderkey") % 23 != 0, F.col("latitude")))
    return P.flag_quality(holed).select("o_orderkey", "data_quality_flag")


@query(
    "filter_categories",
    """SELECT request_id, category FROM (SELECT request_id, latitude, CASE WHEN contains(complaint_type,'Noise') THEN 'medical' WHEN contains(complaint_type,'Condition') THEN 'hazmat' ELSE 'rescue' END AS category FROM fx_311)
    WHERE category IN ('medical','hazmat') AND latitude IS NOT NULL""",
)
def filter_categories(spark, sf):
    df = V.view(spark, sf, "fx_311").withColumn("category", C.hazard_from_complaint("complaint_type"))
    return P.filter_categories(df, ["medical", "hazmat"]).select("request_id", "category")


@query("recent_events", "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate>=TIMESTAMP '1998-01-01'")
def recent_events(spark, sf):
    return P.recent_events(V.table(spark, sf, "orders"), "1998-01-01", "o_orderdate").select("o_orderkey", "o_orderdate")


@query(
    "numeric_columns",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem""",
)
def numeric_columns(spark, sf):
    df = V.table(spark, sf, "lineitem")
    return df.select(*P.numeric_columns(df, ["temperature_f", "humidity_pct", "wind_speed_mph"]))


@query(
    "enforce_schema",
    f"SELECT o_orderkey AS id, try_cast({_DIRTY} AS double) AS latitude, NULL::varchar AS note, ({_DIRTY} IS NOT NULL AND try_cast({_DIRTY} AS double) IS NULL)::int AS failed FROM orders",
)
def enforce_schema(spark, sf):
    raw = V.table(spark, sf, "orders").selectExpr("o_orderkey AS id", f"{_DIRTY} AS latitude", "o_orderstatus AS extra")
    schema = T.StructType().add("id", "long").add("latitude", "double").add("note", "string")
    return P.enforce_schema(raw, schema).withColumnRenamed("__failed_casts", "failed")


# ----------------------------------------------------------------- silver tables


@query("silver_quakes", "SELECT earthquake_id, longitude AS lon, 5 AS ai_severity, 'fire' AS ai_hazard_type FROM fx_quakes")
def silver_quakes(spark, sf):
    df = gold.silver_quakes(V.view(spark, sf, "fx_quakes"))
    return df.select("earthquake_id", "geometry.lon", "ai_severity", "ai_hazard_type")


@query(
    "silver_311",
    """SELECT request_id, longitude AS lon, 5 AS ai_severity, CASE WHEN contains(complaint_type,'Noise') THEN 'medical' WHEN contains(complaint_type,'Parking') THEN 'rescue'
    WHEN contains(complaint_type,'Condition') THEN 'hazmat' ELSE 'rescue' END AS ai_hazard_type FROM fx_311 WHERE latitude IS NOT NULL""",
)
def silver_311(spark, sf):
    df = gold.silver_311(V.view(spark, sf, "fx_311"))
    return df.select("request_id", "geometry.lon", "ai_severity", "ai_hazard_type")


@query(
    "silver_osm",
    """SELECT osm_id, latitude AS lat, 7 AS ai_severity, CASE facility_type WHEN 'fire_station' THEN 'fire' WHEN 'hospital' THEN 'medical' WHEN 'clinic' THEN 'hazmat' ELSE 'medical' END AS ai_hazard_type FROM fx_osm""",
)
def silver_osm(spark, sf):
    df = gold.silver_osm(V.view(spark, sf, "fx_osm"))
    return df.select("osm_id", "geometry.lat", "ai_severity", "ai_hazard_type")


@query("silver_neighborhoods", "SELECT neighborhood_id, name, x0+cast(0.04 as double)*sz AS third_x, y0+cast(0.04 as double)*sz AS third_y FROM fx_nbhd")
def silver_neighborhoods(spark, sf):
    df = gold.silver_neighborhoods(V.neighborhoods(spark, sf))
    corner = F.col("geometry")[0][0][2]
    return df.select("neighborhood_id", "name", corner[0].alias("third_x"), corner[1].alias("third_y"))


@query("silver_flow", "SELECT ID, Severity, 'us_accidents' AS source FROM fx_accidents WHERE ID IN (SELECT ID FROM fx_hits)")
def silver_flow(spark, sf):
    """CSV to a masked, located silver table on disk."""
    raw, out = scratch(spark, "raw"), scratch(spark, "silver")
    V.view(spark, sf, "fx_accidents").drop("Start_Time").write.option("header", "true").csv(raw)
    silver = flows.silver_flow(spark, "csv", raw, "us_accidents", out, V.land(spark, sf))
    return silver.select("ID", "Severity", "source")




def _masked_sql(name: str, fx: str, lon: str, lat: str) -> str:
    inside = V.inside_sql(f"p.{lon}", f"p.{lat}", "n", strict=False)
    return f"SELECT '{name}' AS source, count(*) AS n FROM {fx} p WHERE EXISTS (SELECT 1 FROM fx_nbhd n WHERE {inside})"


@query(
    "silver_masked",
    " UNION ALL ".join([
        _masked_sql("us_accidents", "fx_accidents", "Start_Lng", "Start_Lat"), _masked_sql("nyc_311", "fx_311", "longitude", "latitude"),
        _masked_sql("osm_infrastructure", "fx_osm", "longitude", "latitude"), "SELECT 'usgs_earthquakes', count(*) FROM fx_quakes",
    ]),
)
def silver_masked(spark, sf):
    tables = {
        "us_accidents": V.points(spark, sf), "nyc_311": V.view(spark, sf, "fx_311"),
        "osm_infrastructure": V.view(spark, sf, "fx_osm"), "usgs_earthquakes": V.view(spark, sf, "fx_quakes"),
    }
    masked = flows.silver_masked(tables, V.land(spark, sf), scratch(spark, "masked"))
    from terrahaz.operators.aggregate import table_counts

    return table_counts(masked).where("dataset <> 'TOTAL'").withColumnRenamed("dataset", "source")


@query(
    "sql_views",
    """SELECT borough, count(*) AS n, avg(length(complaint_type)) AS avg_length FROM fx_311 WHERE latitude IS NOT NULL GROUP BY 1""",
)
def sql_views(spark, sf):
    flows.sql_views({"silver_requests": gold.silver_311(V.view(spark, sf, "fx_311"))})
    return spark.sql("SELECT borough, count(*) AS n, avg(length(complaint_type)) AS avg_length FROM silver_requests GROUP BY borough")


