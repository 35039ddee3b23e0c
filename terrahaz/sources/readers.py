"""Readers: CSV, JSON, GeoJSON, Parquet and the layer dispatcher."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def scan_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    reader = spark.read.option("header", "true")
    if schema is None:
        return reader.option("inferSchema", "true").csv(path)
    return reader.schema(schema).csv(path)


def scan_json(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, multiline: bool = False
) -> DataFrame:
    reader = spark.read.option("multiLine", str(multiline).lower()).option("mode", "PERMISSIVE")
    return (reader.schema(schema) if schema is not None else reader).json(path)


_FEATURE = "struct<type string, properties map<string, string>, geometry string>"


def _feature_columns(feature: str) -> list:
    shape = F.col(f"{feature}.geometry")
    return [
        F.col(f"{feature}.properties").alias("properties"),
        F.get_json_object(shape, "$.type").alias("geometry_type"),
        shape.alias("geometry"),
    ]


def scan_geojson(spark: SparkSession, path: str) -> DataFrame:
    """FeatureCollection files, one row per feature. Each file is read by one task."""
    schema = f"type string, features array<{_FEATURE}>"
    docs = spark.read.schema(schema).option("multiLine", "true").json(path)
    return docs.select(F.explode("features").alias("f")).select(*_feature_columns("f"))


def scan_geojson_split(spark: SparkSession, path: str) -> DataFrame:
    """FeatureCollection files of any size, one row per feature, each file read by as many tasks as it has splits.

    The member that opens a feature, ``"type": "Feature"`` in the spacing of the first one, is taken as the line
    separator of a text file, so Spark cuts the document at feature borders wherever a split ends. Every feature
    must begin with that member, as writers have it; a file that does not keep to this is an error and not a
    loss, and ``scan_geojson`` reads it. White space and line breaks do not matter.
    """
    head = spark.read.option("lineSep", '"Feature"').text(path).select(
        F.regexp_extract("value", r'("type"\s*:\s*)$', 1).alias("opens")).where("opens <> ''").first()
    opens = '"type":' if head is None else head["opens"]
    pieces = spark.read.option("lineSep", f'{opens}"Feature"').text(path).withColumn("text", F.rtrim(F.regexp_replace("value", r"\s+$", "")))
    first = F.col("text").rlike(r'^\s*\{[^{}\[]*"type"\s*:\s*"FeatureCollection"') | (F.col("text") == "")
    refused = F.raise_error(F.lit("features do not all begin with the same member: use scan_geojson")).cast("string")
    strange = F.col("text").rlike(r'"type"\s*:\s*"Feature"') | ~F.col("text").rlike(r"[{}]$")
    feature = F.when(first, F.lit(None)).when(strange, refused).otherwise(F.concat(F.lit('{"type":"Feature"'), "text"))
    parsed = pieces.select(F.from_json(feature, _FEATURE[7:-1]).alias("f"))
    return parsed.where(F.col("f.type") == "Feature").select(*_feature_columns("f"))


def scan_geojson_seq(spark: SparkSession, path: str) -> DataFrame:
    """One feature per line, so large files split."""
    lines = spark.read.text(path).select(F.from_json("value", _FEATURE[7:-1]).alias("f"))
    return lines.where(F.col("f.type") == "Feature").select(*_feature_columns("f"))


def geojson_seq_rejects(spark: SparkSession, path: str) -> DataFrame:
    """The lines ``scan_geojson_seq`` makes no feature of, with their file; blank lines are none."""
    lines = spark.read.text(path).select(F.input_file_name().alias("file"), F.col("value").alias("line"))
    kind = F.from_json("line", _FEATURE[7:-1])["type"]
    return lines.where((F.trim("line") != "") & (F.coalesce(kind, F.lit("")) != "Feature"))


def geojson_rejects(spark: SparkSession, path: str) -> DataFrame:
    """The files ``scan_geojson`` finds no list of features in."""
    schema = f"type string, features array<{_FEATURE}>"
    docs = spark.read.schema(schema).option("multiLine", "true").json(path)
    return docs.where("features is null").select(F.input_file_name().alias("file"))


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


READERS = {
    "csv": scan_csv,
    "json": scan_json,
    "geojson": scan_geojson,
    "geojsonsplit": scan_geojson_split,
    "geojsonseq": scan_geojson_seq,
    "parquet": scan_parquet,
}


def read_layer(
    spark: SparkSession, input_format: str, path: str, observation: Observation | None = None,
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """Read by format name. Rows are counted by the action that uses the table, if asked. A schema
    saves CSV and JSON the pass that infers one; the other formats carry theirs."""
    if input_format not in READERS:
        raise ValueError(f"unsupported format {input_format}; one of {sorted(READERS)}")
    if schema is not None and input_format not in ("csv", "json"):
        raise ValueError(f"{input_format} carries its own schema")
    df = READERS[input_format](spark, path) if schema is None else READERS[input_format](spark, path, schema)
    if observation is not None:
        df = df.observe(observation, F.count(F.lit(1)).alias("rows"))
    return df
