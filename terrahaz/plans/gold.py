"""Gold star schema: dimensions, the hazard fact, and what is read off them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrahaz.functions import classify as C
from terrahaz.functions import geometry as G
from terrahaz.operators import clean as P
from terrahaz.operators import ordered as W
from terrahaz.operators import spatial as S
from terrahaz.operators.enrich import final_severity

# Categories of the infrastructure dimension.
DIM_CATEGORIES = ["hospital", "fire_station"]


def dim_neighborhoods(silver: DataFrame, rows_per_range: int = W.ROWS_PER_RANGE) -> DataFrame:
    """Key, id, name, polygon. Accepts polygons or GeoJSON text."""
    shape = F.col("geometry")
    if silver.schema["geometry"].dataType.simpleString() == "string":
        shape = G.polygon_from_geojson("geometry")
    name = P.resolve_column(silver.columns, "name")
    base = silver.select(
        "neighborhood_id",
        F.col(name).alias("neighborhood_name"),
        shape.alias("geometry"),
        F.lit("neighborhoods").alias("source"),
        F.current_timestamp().alias("processing_timestamp"),
    )
    return W.surrogate_key(base, ["neighborhood_id"], "neighborhood_sk", rows_per_range)


def dim_infrastructure(
    silver: DataFrame, categories: list[str] | None = None, rows_per_range: int = W.ROWS_PER_RANGE
) -> DataFrame:
    """Facilities with a point. ``categories`` narrows to the documented two, or others."""
    key = "facility_id" if "facility_id" in silver.columns else "osm_id"
    kept = silver if categories is None else silver.where(F.col("facility_type").isin(categories))
    operator = F.col("operator") if "operator" in silver.columns else F.lit(None).cast("string")
    base = kept.select(
        F.col(key).alias("infrastructure_id"),
        F.col("facility_type").alias("facility_category"),
        F.col("name").alias("facility_name"),
        operator.alias("operator"),
        "latitude",
        "longitude",
        G.st_point("longitude", "latitude").alias("geometry"),
        F.lit("osm_infrastructure").alias("source"),
        F.current_timestamp().alias("processing_timestamp"),
    )
    return W.surrogate_key(base, ["infrastructure_id"], "infrastructure_sk", rows_per_range)


def dim_weather(observations: DataFrame, ts: str = "ts", key: str = "obs_id") -> DataFrame:
    """Latest observation per borough, with a key."""
    latest = W.latest_per_key(observations, ["borough"], [ts, key])
    return W.surrogate_key(latest, ["borough"], "weather_sk")


def fact_part(
    silver: DataFrame, source_system: str, event_id: str, description: str, event_time: str
) -> DataFrame:
    """One source's silver rows in the fact's shape."""
    return silver.select(
        F.lit(source_system).alias("source_system"),
        F.col(event_id).cast("string").alias("event_id"),
        F.col(event_time).cast("timestamp").alias("event_time"),
        F.col(description).alias("description"),
        F.col("ai_severity").cast("double").alias("severity"),
        F.col("ai_hazard_type").alias("hazard_type"),
        "latitude",
        "longitude",
    )


def fact_hazard_events(
    parts: list[DataFrame],
    neighborhoods: DataFrame | None = None,
    infrastructure: DataFrame | None = None,
    max_bytes: int | None = None,
    index: S.PolygonIndex | None = None,
) -> DataFrame:
    """Union of the sources with a stable key, severity, neighborhood and nearest facilities.

    ``event_sk`` is a digest of source and id, so it survives retries and late sources.
    The spatial steps look small dimensions up in place, so the fact is not shuffled.
    """
    fact = reduce(DataFrame.unionByName, parts)
    fact = fact.withColumns(
        {
            "event_sk": P.surrogate_uuid("source_system", "event_id"),
            "final_severity": final_severity(F.col("severity"), F.lit(None).cast("double")),
            "geometry": G.st_point("longitude", "latitude"),
        }
    )
    if neighborhoods is not None:
        fact = S.attach_polygon(
            fact, neighborhoods, attrs=("neighborhood_name",), max_bytes=max_bytes, index=index
        )
    if infrastructure is not None:
        names = {c: (f"nearest_{c}_id", f"nearest_{c}_distance_meters") for c in DIM_CATEGORIES}
        fact = S.nearest_of_each(fact, infrastructure, names, max_bytes=max_bytes)
    return fact


def neighborhood_risk(dim: DataFrame, fact: DataFrame) -> DataFrame:
    """Neighborhoods with a risk score: mean severity times ln(1 + events)."""
    grouped = fact.where(F.col("neighborhood_id").isNotNull()).groupBy("neighborhood_id").agg(
        F.count(F.lit(1)).alias("event_count"), F.avg("final_severity").alias("avg_severity")
    )
    joined = dim.join(grouped, "neighborhood_id", "left")
    count = F.coalesce("event_count", F.lit(0))
    score = F.coalesce(F.col("avg_severity"), F.lit(0.0)) * F.log1p(count.cast("double"))
    return joined.withColumn("event_count", count).withColumn("risk_score", score)


# --------------------------------------------------------------- silver tables


def _silver(df: DataFrame, severity: Column, hazard: Column) -> DataFrame:
    return df.withColumns(
        {
            "geometry": G.st_point("longitude", "latitude"),
            "ai_severity": severity,
            "ai_hazard_type": hazard,
        }
    )


def silver_quakes(bronze: DataFrame) -> DataFrame:
    return _silver(bronze, C.feed_severity("usgs_earthquakes"), F.lit(C.QUAKE_HAZARD))


def silver_311(bronze: DataFrame) -> DataFrame:
    located = bronze.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    return _silver(located, C.feed_severity("nyc_311"), C.hazard_from_complaint("complaint_type"))


def silver_osm(bronze: DataFrame) -> DataFrame:
    return _silver(bronze, C.feed_severity("osm_infrastructure"), C.hazard_from_facility("facility_type"))


def silver_neighborhoods(bronze: DataFrame) -> DataFrame:
    return bronze.withColumn("geometry", G.polygon_from_geojson("geometry"))
