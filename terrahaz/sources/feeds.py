"""Feed flatteners: raw API documents (one JSON text per row) to bronze rows.

Each takes ``df`` with a text column ``payload`` and is one ``from_json`` + ``explode``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrahaz.functions import classify as C
from terrahaz.operators.clean import CITY_BOX, in_bbox

_QUAKES = """features array<struct<id string, properties struct<mag double, place string,
 time bigint, url string>, geometry struct<coordinates array<double>>>>"""
_REQUESTS = """array<struct<unique_key string, complaint_type string, descriptor string,
 latitude string, longitude string, borough string, created_date string>>"""
_ELEMENTS = """elements array<struct<type string, id bigint, lat double, lon double,
 center struct<lat double, lon double>, tags map<string, string>>>"""
_BOUNDARIES = "features array<struct<properties map<string, string>, geometry string>>"
_STATES = "states array<array<string>>"
_VALUE = "struct<value double>"
_OBSERVATION = f"""properties struct<temperature {_VALUE}, windSpeed {_VALUE}, relativeHumidity {_VALUE},
 windDirection {_VALUE}, barometricPressure {_VALUE}, visibility {_VALUE}, textDescription string,
 timestamp string>"""


def _parsed(df: DataFrame, schema: str, path: str | None) -> DataFrame:
    doc = F.from_json("payload", schema)
    return df.select(F.explode(doc if path is None else doc[path]).alias("r"))


#: What a document of each feed must hold: schema and the list in it (None: the document is the list).
SHAPES = {"quakes": (_QUAKES, "features"), "requests": (_REQUESTS, None), "osm": (_ELEMENTS, "elements"),
          "boundaries": (_BOUNDARIES, "features"), "states": (_STATES, "states")}


def rejected(df: DataFrame, feed: str) -> DataFrame:
    """The documents the flattener of ``feed`` can make nothing of, as they came, with a reason: the
    reject table that goes with its rows. An empty list is a good document."""
    schema, path = SHAPES[feed]
    doc = F.from_json("payload", schema)
    reason = (
        F.when(F.col("payload").isNull(), "no payload")
        .when(F.try_parse_json("payload").isNull(), "not JSON")
        .when((doc if path is None else doc[path]).isNull(), f"no list of {path or feed}")
    )
    return df.withColumn("reason", reason).where("reason is not null")


def flatten_quakes(df: DataFrame) -> DataFrame:
    r = _parsed(df, _QUAKES, "features")
    xyz = F.col("r.geometry.coordinates")
    rows = r.select(
        F.col("r.id").alias("earthquake_id"),
        F.col("r.properties.mag").alias("magnitude"),
        F.col("r.properties.place").alias("place"),
        C.epoch_ms_to_ts(F.col("r.properties.time")).alias("time"),
        F.col("r.properties.url").alias("url"),
        F.get(xyz, 1).alias("latitude"),
        F.get(xyz, 0).alias("longitude"),
        F.get(xyz, 2).alias("depth_km"),
        F.lit("usgs").alias("source"),
    )
    return rows.dropna(subset=["latitude", "longitude", "magnitude"])


def flatten_311(df: DataFrame, box=CITY_BOX) -> DataFrame:
    r = _parsed(df, _REQUESTS, None)
    rows = r.select(
        F.col("r.unique_key").alias("request_id"),
        "r.complaint_type",
        "r.descriptor",
        F.col("r.latitude").try_cast("double").alias("latitude"),
        F.col("r.longitude").try_cast("double").alias("longitude"),
        F.coalesce("r.borough", F.lit("UNKNOWN")).alias("borough"),
        "r.created_date",
        F.lit("nyc_311").alias("source"),
    )
    return in_bbox(rows, box)


def flatten_osm(df: DataFrame) -> DataFrame:
    r = _parsed(df, _ELEMENTS, "elements")
    kind = F.col("r.type")

    def coordinate(name: str) -> Column:
        return F.when(kind == "node", F.col(f"r.{name}")).when(kind == "way", F.col(f"r.center.{name}"))

    def tag(name: str) -> Column:
        return F.try_element_at(F.col("r.tags"), F.lit(name))

    rows = r.select(
        F.col("r.id").alias("osm_id"),
        C.first_of(tag("amenity"), tag("healthcare"), tag("emergency")).alias("facility_type"),
        tag("name").alias("name"),
        coordinate("lat").alias("latitude"),
        coordinate("lon").alias("longitude"),
        tag("operator").alias("operator"),
        F.lit("osm").alias("source"),
    )
    return rows.dropna(subset=["latitude", "longitude"])


def flatten_boundaries(df: DataFrame) -> DataFrame:
    r = _parsed(df, _BOUNDARIES, "features")

    def prop(name: str) -> Column:
        return F.try_element_at(F.col("r.properties"), F.lit(name))

    shape = F.col("r.geometry")
    return r.select(
        F.coalesce(prop("id"), F.sha2(shape, 256)).alias("neighborhood_id"),
        F.coalesce(C.first_of(prop("name"), prop("BoroName"), prop("borough")), F.lit("NYC")).alias("name"),
        F.get_json_object(shape, "$.type").alias("geometry_type"),
        shape.alias("geometry"),
        F.lit("landmask").alias("source"),
    )


def flatten_states(df: DataFrame, box=CITY_BOX) -> DataFrame:
    """Positional flight states; shorter than 13 items is not a state."""
    r = _parsed(df, _STATES, "states").where(F.size("r") >= 13)

    def item(i: int, kind: str = "double") -> Column:
        return F.get("r", i).try_cast(kind)

    rows = r.select(
        F.get("r", 0).alias("flight_id"),
        F.trim(F.get("r", 1)).alias("callsign"),
        F.get("r", 2).alias("origin_country"),
        item(6).alias("latitude"),
        item(5).alias("longitude"),
        item(7).alias("velocity_mps"),
        item(8).alias("heading_degrees"),
        item(9).alias("vertical_rate_mps"),
        C.epoch_s_to_ts(F.nullif(item(3, "bigint"), F.lit(0))).alias("timestamp"),
        F.lit("opensky").alias("source"),
    )
    return in_bbox(rows, box)


def flatten_weather(df: DataFrame) -> DataFrame:
    """Observations of known stations: ``payload`` plus borough, latitude, longitude, station_id."""
    o = F.from_json("payload", _OBSERVATION)["properties"]
    return df.select(
        "borough",
        "latitude",
        "longitude",
        "station_id",
        C.celsius_to_fahrenheit(o["temperature"]["value"]).alias("temperature_f"),
        o["relativeHumidity"]["value"].alias("humidity_pct"),
        C.mps_to_mph(o["windSpeed"]["value"]).alias("wind_speed_mph"),
        o["windDirection"]["value"].alias("wind_direction_deg"),
        o["barometricPressure"]["value"].alias("barometric_pressure"),
        o["visibility"]["value"].alias("visibility_m"),
        o["textDescription"].alias("conditions"),
        o["timestamp"].alias("timestamp"),
        F.lit("nws").alias("source"),
    )


def ingest_inventory(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per ingested table and the total; an empty table fails the query."""
    from terrahaz.operators.aggregate import table_counts

    counts = table_counts(tables)
    message = F.concat(F.lit("no rows ingested for "), F.col("dataset"))
    return counts.withColumn("n", F.when(F.col("n") > 0, F.col("n")).otherwise(F.raise_error(message).cast("bigint")))
