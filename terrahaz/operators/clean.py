"""Projection, filtering and canonical shapes (bronze to silver)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrahaz.functions import geometry as G

# The city box.
CITY_BOX = (40.5, 41.0, -74.3, -73.7)

#: What a role's column may be called: exact names first, then a part of the name.
ALIASES = {
    "latitude": (["latitude", "lat", "start_lat"], ["lat"]),
    "longitude": (["longitude", "lon", "lng", "start_lng"], ["lng", "lon"]),
    "description": (["description", "descriptor"], ["desc"]),
    "name": (["name", "neighborhood_name"], ["name"]),
    "geometry": (["geometry", "geom", "the_geom"], []),
}


def resolve_column(columns: list[str], role: str, required: bool = True) -> str | None:
    """Find the column playing ``role``: exact alias, then substring; ambiguity is an error."""
    exact, parts = ALIASES[role]
    lowered = {c.lower(): c for c in columns}
    for alias in exact:
        if alias in lowered:
            return lowered[alias]
    for part in parts:
        hits = [c for c in columns if part in c.lower()]
        if len(hits) > 1:
            raise ValueError(f"{role} is ambiguous: {hits}")
        if hits:
            return hits[0]
    if required:
        raise ValueError(f"no {role} column among {columns}")
    return None


def resolve_columns(df: DataFrame, roles: list[str]) -> DataFrame:
    """Add the roles as columns under their canonical names."""
    return df.select("*", *[F.col(resolve_column(df.columns, r)).alias(f"{r}") for r in roles
                            if resolve_column(df.columns, r) != r])


def cast_coordinates(df: DataFrame, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Coordinates as doubles; unparsable text becomes null, not an error."""
    return df.withColumn("latitude", F.col(lat).try_cast("double")).withColumn(
        "longitude", F.col(lon).try_cast("double")
    )


def drop_missing(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.dropna(subset=columns)


def _finite(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c)


def is_wgs84(lat: str = "latitude", lon: str = "longitude") -> Column:
    y, x = F.col(lat), F.col(lon)
    return y.between(-90, 90) & x.between(-180, 180) & ~F.isnan(y) & ~F.isnan(x)


def valid_wgs84(df: DataFrame, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    return df.where(is_wgs84(lat, lon))


def in_bbox(df: DataFrame, box=CITY_BOX, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Inclusive box filter on plain columns, so it reaches the Parquet scan."""
    lat_min, lat_max, lon_min, lon_max = box
    return df.where(F.col(lat).between(lat_min, lat_max) & F.col(lon).between(lon_min, lon_max))


def add_lineage(df: DataFrame, source: str, crs: str = "EPSG:4326") -> DataFrame:
    return df.withColumns(
        {
            "source": F.lit(source),
            "processing_timestamp": F.current_timestamp(),
            "data_quality_flag": F.lit("validated"),
            "crs": F.lit(crs),
        }
    )


def surrogate_uuid(*columns) -> Column:
    """Stable row identity from the natural key; the same after a retry. Parts are written with
    their length and nulls as a dash, so different keys never read alike."""
    parts = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in columns]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.length(p).cast("string"), F.lit(":"), p), F.lit("-")) for p in parts]), 256)


def flag_quality(df: DataFrame, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Keep every row and say what is wrong with it."""
    y, x = F.col(lat), F.col(lon)
    flag = (
        F.when(y.isNull() | x.isNull(), "missing_coordinates")
        .when(F.isnan(y) | F.isnan(x), "not_a_number")
        .when(~y.between(-90, 90) | ~x.between(-180, 180), "out_of_range")
        .otherwise("validated")
    )
    return df.withColumn("data_quality_flag", flag)


def filter_categories(df: DataFrame, active: list[str], category: str = "category") -> DataFrame:
    located = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    return df.where(F.col(category).isin(active) & located)


def recent_events(df: DataFrame, since: str, column: str = "event_time") -> DataFrame:
    """Events at or after a date; the literal takes the column's type, so it is pushed down."""
    return df.where(F.col(column) >= F.lit(since).cast(df.schema[column].dataType))


def numeric_columns(df: DataFrame, wanted: list[str], minimum: int = 5) -> list[str]:
    """The wanted columns that exist; if they are too few, every numeric column."""
    present = [c for c in wanted if c in df.columns]
    if len(present) >= minimum:
        return present
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def enforce_schema(df: DataFrame, schema: T.StructType, extra: str = "drop") -> DataFrame:
    """Fixed order and types; ``__failed_casts`` counts values a cast turned to null."""
    unknown = [c for c in df.columns if c not in schema.names]
    if unknown and extra == "reject":
        raise ValueError(f"unexpected columns {unknown}")
    known = set(df.columns)
    out, failed = [], F.lit(0)
    for field in schema.fields:
        if field.name not in known:
            out.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        cast = F.col(field.name).try_cast(field.dataType)
        out.append(cast.alias(field.name))
        failed = failed + (F.col(field.name).isNotNull() & cast.isNull()).cast("int")
    return df.select(*out, failed.alias("__failed_casts"))


# ------------------------------------------------------------ canonical events


def _locate(df: DataFrame, lat: str, lon: str) -> DataFrame:
    """Cast, drop what is missing or off the globe, and add the point."""
    located = valid_wgs84(cast_coordinates(df, lat, lon))
    return located.withColumn("geometry", G.st_point("longitude", "latitude"))


def _canonical(df: DataFrame, source: str, **columns: Column) -> DataFrame:
    return df.select(
        F.lit(source).alias("source"),
        *[c.alias(name) for name, c in columns.items()],
        "latitude",
        "longitude",
        "geometry",
        F.current_timestamp().alias("processing_timestamp"),
    )


def canonical_accidents(df: DataFrame) -> DataFrame:
    lat, lon = resolve_column(df.columns, "latitude"), resolve_column(df.columns, "longitude")
    text = resolve_column(df.columns, "description", required=False)
    return _canonical(
        _locate(df, lat, lon),
        "us_accidents",
        source_id=F.col("ID").cast("string"),
        event_timestamp=F.col("Start_Time"),
        description=F.col(text) if text else F.lit(None).cast("string"),
        severity=F.col("Severity").cast("double"),
    )


def canonical_quakes(df: DataFrame) -> DataFrame:
    return _canonical(
        _locate(df, "latitude", "longitude"),
        "usgs_earthquakes",
        source_id=F.col("earthquake_id").cast("string"),
        event_timestamp=F.col("time"),
        description=F.col("place"),
        severity=F.col("magnitude").cast("double"),
    )


def canonical_311(df: DataFrame) -> DataFrame:
    return _canonical(
        _locate(df, "latitude", "longitude"),
        "nyc_311_requests",
        source_id=F.col("request_id").cast("string"),
        event_timestamp=F.col("created_date"),
        description=F.concat_ws(" - ", "complaint_type", "descriptor"),
        severity=F.lit(5.0),
    )


def canonical_infrastructure(df: DataFrame) -> DataFrame:
    return _canonical(
        _locate(df, "latitude", "longitude"),
        "osm_infrastructure",
        source_id=F.col("osm_id").cast("string"),
        facility_type=F.col("facility_type"),
        facility_name=F.col("name"),
        operator=F.col("operator"),
    )


def canonical_neighborhoods(df: DataFrame) -> DataFrame:
    geom = resolve_column(df.columns, "geometry")
    name = resolve_column(df.columns, "name", required=False)
    parsed = df.withColumn("__polygons", G.polygon_from_geojson(geom)).where(
        F.col("__polygons").isNotNull()
    )
    natural = F.col("neighborhood_id").cast("string") if "neighborhood_id" in df.columns else F.sha2(F.col(geom), 256)
    return parsed.select(
        F.lit("neighborhoods").alias("source"),
        natural.alias("source_id"),
        (F.col(name) if name else F.lit(None).cast("string")).alias("neighborhood_name"),
        F.col("__polygons").alias("geometry"),
        F.current_timestamp().alias("processing_timestamp"),
    )


