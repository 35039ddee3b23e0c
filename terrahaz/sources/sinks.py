"""Sinks: Parquet tables, versions as partitions, GeoJSON, quarantine, run metrics."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from terrahaz.functions import classify as C
from terrahaz.functions import geometry as G


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> int:
    """Write Parquet; the row count comes from the write itself, not a second job."""
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    counted.write.mode(mode).option("compression", "snappy").parquet(path)
    return int(seen.get["rows"])


def write_partitioned(df: DataFrame, path: str, by: list[str], mode: str = "overwrite") -> int:
    """Write partitioned Parquet and check what reached the disk against what went in.

    The table is replaced as a whole (its schema may change). The rows going in are
    counted by the write itself; the rows found are counted from file footers.
    """
    before = _rows_at(df.sparkSession, path) if mode == "append" else 0
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    writer = counted.write.mode(mode).partitionBy(*by).option("compression", "snappy")
    writer.option("partitionOverwriteMode", "static").parquet(path)
    written, stored = int(seen.get["rows"]), df.sparkSession.read.parquet(path).count()
    if stored != before + written:
        raise RuntimeError(f"{path}: wrote {written} rows to {before}, found {stored}")
    return written


def _rows_at(spark: SparkSession, path: str) -> int:
    """Rows of a Parquet table, 0 where there is none yet."""
    try:
        return spark.read.parquet(path).count()
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return 0


#: Partition column that tells the versions of a table apart.
VERSION = "table_version"


def write_versioned(df: DataFrame, path: str, fmt: str = "parquet") -> int:
    """Keep history. Formats with their own log (``delta``) are passed through; a Parquet table gets
    every version as a partition of ``table_version``, numbered one above the largest there is. A version
    without rows leaves no trace. One writer at a time."""
    if fmt != "parquet":
        df.write.format(fmt).mode("overwrite").option("overwriteSchema", "true").save(path)
        return -1
    number = max(list_versions(df.sparkSession, path), default=0) + 1
    df.withColumn(VERSION, F.lit(number)).write.mode("append").partitionBy(VERSION).parquet(path)
    return number


def list_versions(spark: SparkSession, path: str) -> list[int]:
    """The version numbers of a table, read off its partitions."""
    if not _rows_at(spark, path):
        return []
    return sorted(r[0] for r in spark.read.parquet(path).select(VERSION).distinct().collect())


def read_version(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """One version (the latest), in the columns it was written with."""
    versions = list_versions(spark, path)
    if not versions:
        raise ValueError(f"no version under {path}")
    return spark.read.parquet(f"{path}/{VERSION}={versions[-1] if version is None else version}")


# -------------------------------------------------------------------- GeoJSON


def feature_json(point: Column, properties: dict[str, Column]) -> Column:
    """One GeoJSON Feature as text; null properties are written as null."""
    props = F.struct(*[c.alias(n) for n, c in properties.items()])
    feature = F.struct(
        F.lit("Feature").alias("type"), G.point_geojson_struct(point).alias("geometry"), props.alias("properties")
    )
    return F.to_json(feature, {"ignoreNullFields": "false"})


def heatmap_features(fact: DataFrame) -> DataFrame:
    """Fact rows as map features: category, label, weight = severity / 10."""
    category = C.map_category("hazard_type", "severity")
    return fact.withColumn("category", category).select(
        "event_id",
        "category",
        C.category_label(F.col("category")).alias("label"),
        (F.col("severity") / F.lit(10.0)).alias("weight"),
        "event_description",
        "event_geometry",
    )


def features_as_json(features: DataFrame) -> DataFrame:
    text = feature_json(
        F.col("event_geometry"),
        {
            "id": F.col("event_id"),
            "category": F.col("category"),
            "label": F.col("label"),
            "weight": F.col("weight"),
            "description": F.col("event_description"),
        },
    )
    return features.select(text.alias("value"))


def delay_features(scored: DataFrame) -> DataFrame:
    """Scored flights as features."""
    text = feature_json(
        G.st_point("longitude", "latitude"),
        {
            "flight_id": F.col("flight_id"),
            "callsign": F.col("callsign"),
            "delay_probability": F.round("delay_probability", 3),
            "estimated_delay_mins": F.col("estimated_delay_mins"),
            "delay_severity": F.col("delay_severity"),
        },
    )
    return scored.select(text.alias("value"))


def export_geojson(features: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One feature per line (GeoJSON text sequence), written by every task in parallel."""
    features.select("value").write.mode(mode).text(path)


#: Features of one document at most, unless the number of documents is stated: a reader takes each whole.
FEATURES_PER_DOCUMENT = 100_000


def export_collections(
    features: DataFrame, path: str, mode: str = "overwrite", files: int | None = None, per_document: int = FEATURES_PER_DOCUMENT
) -> None:
    """``files`` FeatureCollection documents; if not stated, one per partition as they are, or as many as
    ``per_document`` features each ask for if there are more features than that.

    A task writes its document feature by feature as its rows come by, so neither a document nor a batch is ever
    held as one text; nothing is gathered in one task unless one file is asked for. Spark's own text writer commits
    or drops them."""
    import pandas as pd

    def document(batches):
        yield pd.DataFrame({"value": ['{"type":"FeatureCollection","features":[']})
        lead = ""
        for batch in batches:
            lines = batch["value"].dropna().tolist()
            for i, line in enumerate(lines):
                lines[i] = lead + line
                lead = ","
            yield pd.DataFrame({"value": lines}, dtype=object)
        yield pd.DataFrame({"value": ["]}"]})

    rows = features.select("value")
    if files is None:
        count = rows.count()
        files = -(-count // per_document) if count > per_document else None
    (rows if files is None else rows.repartition(files)).mapInPandas(document, "value string").write.mode(mode).text(path)


# ----------------------------------------------------- quarantine and metrics


def quarantine_split(df: DataFrame, score: str, limit: float = 3.0) -> tuple[DataFrame, DataFrame]:
    """Rows judged good enough, and the rest; an unknown score is quarantined."""
    good = F.coalesce(F.col(score) >= limit, F.lit(False))
    return df.where(good), df.where(~good)


def write_quarantine(df: DataFrame, path: str, score: str, limit: float = 3.0) -> None:
    """Both sides from one evaluation: a single write partitioned by the verdict."""
    good = F.coalesce(F.col(score) >= limit, F.lit(False))
    verdict = F.when(good, "passed").otherwise("quarantined")
    writer = df.withColumn("verdict", verdict).write.mode("overwrite").partitionBy("verdict")
    writer.option("partitionOverwriteMode", "static").parquet(path)  # no side of an earlier run stays


def write_run_metrics(
    df: DataFrame, path: str, metrics_path: str, layer: str, is_error: Column, mode: str = "overwrite"
) -> dict:
    """Write a table and append its record, error and time figures to the metrics table."""
    import time

    spark, seen, started = df.sparkSession, Observation(), time.time()
    observed = df.observe(
        seen,
        F.count(F.lit(1)).alias("records"),
        F.coalesce(F.sum(F.when(is_error, 1).otherwise(0)), F.lit(0)).alias("errors"),
    )

    def record(figures: dict) -> dict:
        rows = [(layer, name, value) for name, value in figures.items()]
        table = spark.createDataFrame(rows, "layer string, name string, value double")
        table.withColumn("ts", F.current_timestamp()).coalesce(1).write.mode("append").parquet(metrics_path)
        return figures

    try:
        observed.write.mode(mode).parquet(path)
    except Exception:
        record({"failed": 1.0, "seconds": time.time() - started})
        raise
    figures = {"records": float(seen.get["records"]), "errors": float(seen.get["errors"])}
    return record(figures | {"seconds": time.time() - started})
