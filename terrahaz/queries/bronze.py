"""Sources: readers, feed flatteners, sinks and their round trips.

Raw payloads are built by Spark from the driver tables, about a hundred records a
document, flattened by the operator, and checked against the view they came from.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from terrahaz.functions import geometry as G
from terrahaz.operators import clean as P
from terrahaz.plans import flows, gold
from terrahaz.queries import views as V
from terrahaz.queries.registry import query
from terrahaz.session import scratch
from terrahaz.sources import feeds, readers, sinks

_ACC = "ID string, Start_Lat double, Start_Lng double, Start_Time timestamp_ntz, Severity int, Description string"
_ACC_SQL = "SELECT ID, Start_Lat, Start_Lng, Start_Time, Severity, Description FROM fx_accidents"


@query("scan_csv", _ACC_SQL)
def scan_csv(spark, sf):
    path = scratch(spark, "csv")
    V.view(spark, sf, "fx_accidents").write.option("header", "true").csv(path)
    return readers.scan_csv(spark, path, _ACC)


@query("scan_csv_inferred", "SELECT ID, Start_Lat, Start_Lng, Severity, Description FROM fx_accidents")
def scan_csv_inferred(spark, sf):
    path = scratch(spark, "csv")
    V.view(spark, sf, "fx_accidents").drop("Start_Time").write.option("header", "true").csv(path)
    return readers.scan_csv(spark, path)


@query("scan_json", _ACC_SQL)
def scan_json(spark, sf):
    path = scratch(spark, "json")
    V.view(spark, sf, "fx_accidents").write.json(path)
    return readers.scan_json(spark, path, _ACC)


@query("scan_parquet", _ACC_SQL)
def scan_parquet(spark, sf):
    path = scratch(spark, "parquet")
    V.view(spark, sf, "fx_accidents").write.parquet(path)
    return readers.scan_parquet(spark, path)


def _feature(properties, shape):
    return F.struct(F.lit("Feature").alias("type"), properties.alias("properties"), shape.alias("geometry"))


def _neighborhood_features(spark, sf):
    rows = V.neighborhoods(spark, sf)
    shape = F.from_json("geometry", "type string, coordinates array<array<array<double>>>")
    props = F.struct(F.col("neighborhood_id").cast("string").alias("id"), F.col("name"))
    return rows.select("neighborhood_id", _feature(props, shape).alias("f"))


def _collections(features, key: str, per_document: int = 100):
    """FeatureCollections of about ``per_document`` features."""
    grouped = features.groupBy(F.floor(F.col(key) / per_document).alias("doc")).agg(F.collect_list("f").alias("features"))
    return grouped.select(F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), "features")).alias("payload"))


@query("scan_geojson", "SELECT cast(neighborhood_id as varchar) AS id, name, 'Polygon' AS geometry_type, x0 AS first_x FROM fx_nbhd")
def scan_geojson(spark, sf):
    path = scratch(spark, "geojson")
    _collections(_neighborhood_features(spark, sf), "neighborhood_id").select(F.col("payload").alias("value")).write.option("maxRecordsPerFile", 1).text(path)
    rows = readers.scan_geojson(spark, path)
    ring = G.polygon_from_geojson("geometry")[0][0]
    return rows.select(
        F.col("properties")["id"].alias("id"), F.col("properties")["name"].alias("name"), "geometry_type", ring[0][0].alias("first_x")
    )


@query("scan_geojson_split", "SELECT osm_id AS id, longitude FROM fx_osm")
def scan_geojson_split(spark, sf):
    """Three documents written, each read back in as many pieces as it has splits."""
    path = scratch(spark, "geojsonsplit")
    text = sinks.feature_json(G.st_point("longitude", "latitude"), {"id": F.col("osm_id")})
    sinks.export_collections(V.view(spark, sf, "fx_osm").select(text.alias("value")), path, files=3)
    rows = readers.read_layer(spark, "geojsonsplit", path)
    return rows.select(F.col("properties")["id"].cast("bigint").alias("id"), G.point_from_geojson("geometry")["lon"].alias("longitude"))


@query("scan_geojson_seq", "SELECT cast(neighborhood_id as varchar) AS id, 'Polygon' AS geometry_type FROM fx_nbhd")
def scan_geojson_seq(spark, sf):
    path = scratch(spark, "geojsonseq")
    _neighborhood_features(spark, sf).select(F.to_json("f").alias("value")).write.text(path)
    rows = readers.read_layer(spark, "geojsonseq", path)
    return rows.select(F.col("properties")["id"].alias("id"), "geometry_type")


@query("read_layer", "SELECT ID, Severity FROM fx_accidents")
def read_layer(spark, sf):
    path = scratch(spark, "layer")
    V.view(spark, sf, "fx_accidents").select("ID", "Severity").write.parquet(path)
    return readers.read_layer(spark, "parquet", path)


# ----------------------------------------------------------------- flatteners


@query(
    "flatten_quakes",
    """SELECT earthquake_id, magnitude, place, date_trunc('millisecond', time) AS time, latitude, longitude,
    CASE WHEN cast(substr(earthquake_id,2) as bigint)%5=0 THEN NULL ELSE depth_km END AS depth_km, 'usgs' AS source
    FROM fx_quakes WHERE magnitude IS NOT NULL AND cast(substr(earthquake_id,2) as bigint)%7<>0""",
)
def flatten_quakes(spark, sf):
    rows = feeds.flatten_quakes(quake_payloads(spark, sf))
    return rows.drop("url").withColumn("time", F.col("time").cast("timestamp_ntz"))


def quake_payloads(spark, sf):
    q = V.view(spark, sf, "fx_quakes").withColumn("n", F.substring("earthquake_id", 2, 20).cast("bigint"))
    xyz = (
        F.when(F.col("n") % 7 == 0, F.array("longitude"))
        .when(F.col("n") % 5 == 0, F.array("longitude", "latitude"))
        .otherwise(F.array("longitude", "latitude", "depth_km"))
    )
    props = F.struct(
        F.col("magnitude").alias("mag"), "place", F.unix_millis(F.col("time").cast("timestamp")).alias("time"), F.lit("u").alias("url")
    )
    feature = F.struct(
        F.col("earthquake_id").alias("id"), props.alias("properties"), F.struct(xyz.alias("coordinates")).alias("geometry")
    )
    return _collections(q.select("n", feature.alias("f")), "n", 500)


@query(
    "flatten_311",
    """SELECT request_id, complaint_type, descriptor, latitude, longitude, CASE WHEN borough='UNKNOWN' THEN 'UNKNOWN' ELSE borough END AS borough, 'nyc_311' AS source
    FROM fx_311 WHERE latitude BETWEEN 40.5 AND 41.0 AND longitude BETWEEN -74.3 AND -73.7""",
)
def flatten_311(spark, sf):
    return feeds.flatten_311(request_payloads(spark, sf)).drop("created_date")


def request_payloads(spark, sf):
    r = V.view(spark, sf, "fx_311")
    row = F.struct(
        F.col("request_id").alias("unique_key"), "complaint_type", "descriptor",
        F.col("latitude").cast("string").alias("latitude"), F.col("longitude").cast("string").alias("longitude"),
        F.nullif(F.col("borough"), F.lit("UNKNOWN")).alias("borough"), F.col("created_date").cast("string").alias("created_date"),
    )
    grouped = r.select(F.floor(F.col("request_id").cast("bigint") / 250).alias("doc"), row.alias("r")).groupBy("doc").agg(F.collect_list("r").alias("rows"))
    return grouped.select(F.to_json("rows").alias("payload"))


@query(
    "flatten_osm",
    """SELECT osm_id, facility_type, name, latitude, longitude, operator, 'osm' AS source FROM fx_osm WHERE osm_id%11<>0 AND NOT (osm_id%3=1 AND osm_id%13=0)""",
)
def flatten_osm(spark, sf):
    return feeds.flatten_osm(element_payloads(spark, sf))


def element_payloads(spark, sf):
    o = V.view(spark, sf, "fx_osm")
    kind = F.when(F.col("osm_id") % 11 == 0, "relation").when(F.col("osm_id") % 3 == 1, "way").otherwise("node")
    is_node, no_center = F.col("type") == "node", F.col("osm_id") % 13 == 0
    o = o.withColumn("type", kind)
    tags = F.map_filter(
        F.create_map(
            F.lit("amenity"), F.when(F.col("osm_id") % 4 == 0, "").otherwise(F.col("facility_type")),
            F.lit("healthcare"), F.when(F.col("osm_id") % 4 == 0, F.col("facility_type")),
            F.lit("name"), F.col("name"), F.lit("operator"), F.col("operator"),
        ),
        lambda k, v: v.isNotNull(),
    )
    element = F.struct(
        "type", F.col("osm_id").alias("id"), F.when(is_node, F.col("latitude")).alias("lat"), F.when(is_node, F.col("longitude")).alias("lon"),
        F.when(~is_node & ~no_center, F.struct(F.col("latitude").alias("lat"), F.col("longitude").alias("lon"))).alias("center"), tags.alias("tags"),
    )
    grouped = o.select(F.floor(F.col("osm_id") / 100).alias("doc"), element.alias("e")).groupBy("doc").agg(F.collect_list("e").alias("elements"))
    return grouped.select(F.to_json(F.struct("elements")).alias("payload"))


@query(
    "flatten_boundaries",
    """SELECT CASE WHEN neighborhood_id%6=0 THEN NULL ELSE cast(neighborhood_id as varchar) END AS known_id,
    CASE neighborhood_id%4 WHEN 3 THEN 'NYC' ELSE name END AS name, 'Polygon' AS geometry_type, 'landmask' AS source FROM fx_nbhd""",
)
def flatten_boundaries(spark, sf):
    n, k = V.neighborhoods(spark, sf), F.col("neighborhood_id")
    shape = F.from_json("geometry", "type string, coordinates array<array<array<double>>>")
    props = F.struct(
        F.when(k % 6 != 0, k.cast("string")).alias("id"), F.when(k % 4 == 0, F.col("name")).when(k % 4 == 1, "").alias("name"),
        F.when(k % 4 == 1, F.col("name")).alias("BoroName"), F.when(k % 4 == 2, F.col("name")).alias("borough"),
    )
    docs = _collections(n.select("neighborhood_id", _feature(props, shape).alias("f")), "neighborhood_id", 50)
    rows = feeds.flatten_boundaries(docs)
    known = F.when(F.length("neighborhood_id") < 64, F.col("neighborhood_id"))
    return rows.select(known.alias("known_id"), "name", "geometry_type", "source")


@query(
    "flatten_states",
    """SELECT cast(flight_id as varchar) AS flight_id, callsign, latitude, longitude, velocity_mps, CASE WHEN flight_id%17=0 THEN NULL ELSE date_trunc('second', ts) END AS "timestamp"
    FROM fx_flights WHERE flight_id%19<>0 AND latitude BETWEEN 40.5 AND 41.0 AND longitude BETWEEN -74.3 AND -73.7""",
)
def flatten_states(spark, sf):
    f, k = V.view(spark, sf, "fx_flights"), F.col("flight_id")
    seconds = F.when(k % 17 != 0, F.unix_seconds(F.col("ts").cast("timestamp")))
    text = [
        k, F.concat(F.lit(" "), F.col("callsign"), F.lit("  ")), F.lit("United States"), seconds, seconds, F.col("longitude"), F.col("latitude"),
        F.col("velocity_mps"), F.lit(90.0), F.lit(0.5), F.lit("x"), F.lit("x"), F.lit("x"),
    ]
    state = F.array(*[c.cast("string") for c in text])
    state = F.when(k % 19 == 0, F.slice(state, 1, 12)).otherwise(state)
    grouped = f.select(F.floor(k / 400).alias("doc"), state.alias("s")).groupBy("doc").agg(F.collect_list("s").alias("states"))
    rows = feeds.flatten_states(grouped.select(F.to_json(F.struct("states")).alias("payload")))
    return rows.select("flight_id", "callsign", "latitude", "longitude", "velocity_mps", F.col("timestamp").cast("timestamp_ntz").alias("timestamp"))


@query(
    "flatten_weather",
    """SELECT cast(obs_id as varchar) AS station_id, borough, CASE WHEN obs_id%9=0 THEN NULL ELSE round(temperature_f*9/5+32,6) END AS temperature_f,
    round(wind_speed_mph*2.237::double,6) AS wind_speed_mph, humidity_pct, 'nws' AS source FROM fx_weather""",
)
def flatten_weather(spark, sf):
    w, k = V.view(spark, sf, "fx_weather"), F.col("obs_id")

    def value(c):
        return F.struct(c.alias("value"))

    props = F.struct(
        value(F.when(k % 9 != 0, F.col("temperature_f"))).alias("temperature"), value(F.col("wind_speed_mph")).alias("windSpeed"),
        value(F.col("humidity_pct")).alias("relativeHumidity"), F.lit("Clear").alias("textDescription"), F.col("ts").cast("string").alias("timestamp"),
    )
    docs = w.select(
        "borough", F.lit(40.7).alias("latitude"), F.lit(-74.0).alias("longitude"), k.cast("string").alias("station_id"),
        F.to_json(F.struct(props.alias("properties"))).alias("payload"),
    )
    rows = feeds.flatten_weather(docs)
    return rows.select(
        "station_id", "borough", F.round("temperature_f", 6).alias("temperature_f"), F.round("wind_speed_mph", 6).alias("wind_speed_mph"), "humidity_pct", "source"
    )


# ---------------------------------------------------------------------- sinks


@query("write_table", "SELECT ID, Severity FROM fx_accidents")
def write_table(spark, sf):
    path = scratch(spark, "table")
    sinks.write_table(V.view(spark, sf, "fx_accidents").select("ID", "Severity"), path)
    return spark.read.parquet(path)


@query(
    "write_partitioned",
    "SELECT data_quality_flag, count(*) AS n FROM (SELECT CASE WHEN latitude IS NULL THEN 'missing_coordinates' ELSE 'validated' END AS data_quality_flag FROM fx_311) GROUP BY 1",
)
def write_partitioned(spark, sf):
    path = scratch(spark, "partitioned")
    flagged = P.flag_quality(V.view(spark, sf, "fx_311"))
    sinks.write_partitioned(flagged, path, ["data_quality_flag"])
    return spark.read.parquet(path).groupBy("data_quality_flag").agg(F.count("*").alias("n"))


@query("write_versioned", "SELECT osm_id, facility_type FROM fx_osm")
def write_versioned(spark, sf):
    path = scratch(spark, "versioned")
    osm = V.view(spark, sf, "fx_osm").select("osm_id", "facility_type")
    sinks.write_versioned(osm, path)
    sinks.write_versioned(osm, path)
    return sinks.read_version(spark, path)


@query(
    "export_gold_parquet",
    "SELECT hazard_type, count(*) AS n FROM (SELECT CASE facility_type WHEN 'fire_station' THEN 'fire' WHEN 'hospital' THEN 'medical' WHEN 'clinic' THEN 'hazmat' ELSE 'medical' END AS hazard_type FROM fx_osm UNION ALL SELECT 'fire' FROM fx_quakes UNION ALL SELECT CASE WHEN contains(complaint_type,'Noise') THEN 'medical' WHEN contains(complaint_type,'Parking') THEN 'rescue' WHEN contains(complaint_type,'Condition') THEN 'hazmat' ELSE 'rescue' END FROM fx_311 WHERE latitude IS NOT NULL) GROUP BY 1",
)
def export_gold_parquet(spark, sf):
    from terrahaz.operators.aggregate import fact_union

    path = scratch(spark, "gold")
    fact = fact_union(gold.silver_quakes(V.view(spark, sf, "fx_quakes")), gold.silver_311(V.view(spark, sf, "fx_311")), gold.silver_osm(V.view(spark, sf, "fx_osm")))
    sinks.write_table(fact, path)
    return spark.read.parquet(path).groupBy("hazard_type").agg(F.count("*").alias("n"))


@query(
    "export_geojson",
    """SELECT osm_id AS id, CASE facility_type WHEN 'fire_station' THEN 'fire' WHEN 'hospital' THEN 'medical' WHEN 'clinic' THEN 'hazmat' ELSE 'medical' END AS category,
    0.7::double AS weight, longitude, latitude FROM fx_osm""",
)
def export_geojson(spark, sf):
    """Written as text, read back with the splittable GeoJSON reader."""
    path = scratch(spark, "heatmap")
    fact = gold.silver_osm(V.view(spark, sf, "fx_osm")).selectExpr(
        "cast(osm_id as string) AS event_id", "name AS event_description", "geometry AS event_geometry", "ai_severity AS severity", "ai_hazard_type AS hazard_type"
    )
    flows.heatmap_export(fact, path)
    rows = readers.scan_geojson_seq(spark, path).withColumn("p", G.point_from_geojson("geometry"))
    props = F.col("properties")
    return rows.select(
        props["id"].cast("bigint").alias("id"), props["category"].alias("category"), props["weight"].cast("double").alias("weight"),
        F.col("p.lon").alias("longitude"), F.col("p.lat").alias("latitude"),
    )


@query("export_collections", "SELECT osm_id AS id, longitude FROM fx_osm")
def export_collections(spark, sf):
    path = scratch(spark, "collections")
    text = sinks.feature_json(G.st_point("longitude", "latitude"), {"id": F.col("osm_id")})
    sinks.export_collections(V.view(spark, sf, "fx_osm").select(text.alias("value")), path)
    rows = readers.scan_geojson(spark, path)
    return rows.select(F.col("properties")["id"].cast("bigint").alias("id"), G.point_from_geojson("geometry")["lon"].alias("longitude"))


@query("write_run_metrics", "SELECT 'bronze' AS layer, 'records' AS name, count(*)::double AS value FROM fx_311 UNION ALL SELECT 'bronze', 'errors', sum((latitude IS NULL)::int)::double FROM fx_311")
def write_run_metrics(spark, sf):
    out, metrics = scratch(spark, "run"), scratch(spark, "run-metrics")
    sinks.write_run_metrics(V.view(spark, sf, "fx_311"), out, metrics, "bronze", F.col("latitude").isNull())
    return spark.read.parquet(metrics).where("name <> 'seconds'").select("layer", "name", "value")
