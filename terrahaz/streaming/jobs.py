"""The batch operators as Structured Streaming jobs.

Every stateful query has a watermark, every sink a checkpoint under the shared folder.
Sources are file streams with a declared schema; ``run_available`` drains what is there
and stops, which is also how a scheduled incremental run works.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from terrahaz.operators import clean as P
from terrahaz.operators import spatial as S
from terrahaz.functions import classify as C
from terrahaz.functions import geometry as G


def file_stream(
    spark: SparkSession, folder: str, schema, pattern: str | None = None, files_per_batch: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if pattern is not None:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def with_event_time(df: DataFrame, ts: str = "ts", delay: str = "10 minutes") -> DataFrame:
    """Event time as a zoned timestamp (watermarks refuse the other kind) with a watermark."""
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def run_available(df: DataFrame, path: str, checkpoint: str, mode: str = "append"):
    """Process everything available into Parquet, exactly once per input file."""
    query = (
        df.writeStream.format("parquet")
        .outputMode(mode)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


# ------------------------------------------------------------------ operators


def stream_silver(requests: DataFrame) -> DataFrame:
    """311 requests, raw to silver: the batch functions, unchanged."""
    located = P.valid_wgs84(P.cast_coordinates(requests))
    return located.withColumn("geometry", G.st_point("longitude", "latitude")).withColumn(
        "ai_hazard_type", C.hazard_from_complaint("complaint_type")
    )


def stream_dedupe(events: DataFrame, keys: list[str]) -> DataFrame:
    """Drop repeated keys that arrive within the watermark; state is bounded by it."""
    return events.dropDuplicatesWithinWatermark(keys)


def stream_tumbling(metrics: DataFrame, ts: str, width: str) -> DataFrame:
    """Records and errors per layer and window."""
    return (
        metrics.groupBy(F.window(ts, width).alias("w"), "layer")
        .agg(F.sum("records").alias("records"), F.sum("errors").alias("errors"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "layer", "records", "errors")
    )


def stream_sliding(metrics: DataFrame, ts: str, width: str, slide: str, seconds: float) -> DataFrame:
    """Records per second over a sliding window."""
    return (
        metrics.groupBy(F.window(ts, width, slide).alias("w"), "layer")
        .agg(F.sum("records").alias("records"))
        .select(
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            "layer",
            (F.col("records") / F.lit(seconds)).alias("rate"),
        )
    )


def stream_sessions(events: DataFrame, ts: str, key: str, gap: str) -> DataFrame:
    """Activity sessions; the gap between two of them is a no-data stretch.

    Sessions are merged before the shuffle too (see ``session.RECOMMENDED``), so a busy
    key sends sessions, not rows.
    """
    return (
        events.groupBy(F.session_window(ts, gap).alias("w"), key)
        .agg(F.count(F.lit(1)).alias("n_events"))
        .select(F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), key, "n_events")
    )


def stream_no_data(events: DataFrame, key: str, quiet_s: float, ts: str = "ts") -> DataFrame:
    """Alerts of keys that fell silent: ``key, since, fired_at``, one per absence of more than ``quiet_s`` seconds.

    ``events`` has a watermark. A timer per key fires when the watermark passes the end of the quiet time, so an
    absence is told whether or not anything follows; an event that comes late, but within the watermark,
    still prevents it. State: the runs of events that are not decided yet, a start and an end each, so it is
    bounded by the watermark's delay and not by the number of events. Events without a time are left out.
    """
    quiet = round(quiet_s * 1000)
    kind = events.schema[key].dataType.simpleString()
    timed = events.where(F.col(ts).isNotNull()).select(key, ts, F.unix_millis(ts).alias("ms"))

    def watch(name, batches, state: GroupState):
        starts, ends = state.get if state.exists else ([], [])
        runs = sorted(zip(starts, ends, strict=True))
        if not state.hasTimedOut:
            for b in batches:
                runs += [(t, t) for t in set(b["ms"].tolist())]
            runs.sort()
        joined: list[tuple[int, int]] = []
        for a, z in runs:
            if joined and a <= joined[-1][1] + quiet:
                joined[-1] = (joined[-1][0], max(z, joined[-1][1]))
            else:
                joined.append((a, z))
        now = state.getCurrentWatermarkMs()
        silent = []
        while joined and joined[0][1] + quiet < now:
            silent.append(joined.pop(0)[1])
        if joined:
            state.update(([a for a, _ in joined], [z for _, z in joined]))
            state.setTimeoutTimestamp(joined[0][1] + quiet)
        elif state.exists:
            state.remove()
        if silent:
            yield pd.DataFrame({key: [name[0]] * len(silent), "since": silent, "fired_at": [t + quiet for t in silent]})

    told = timed.groupBy(key).applyInPandasWithState(
        watch, f"{key} {kind}, since long, fired_at long", "starts array<long>, ends array<long>", "append", GroupStateTimeout.EventTimeTimeout)
    return told.select(key, F.timestamp_millis("since").alias("since"), F.timestamp_millis("fired_at").alias("fired_at"))


def stream_land_mask(points: DataFrame, polygons: DataFrame, index: S.PolygonIndex | None = None) -> DataFrame:
    """Stream-static spatial join against a mask small enough to look up in place.

    The index is opened if it is written already. A larger mask needs a shuffle per batch, which
    ``drain_land_mask`` does.
    """
    index = index or S.polygon_index(polygons, "neighborhood_id", "geometry")
    if not index.small:
        raise ValueError("this mask does not fit a broadcast: use drain_land_mask")
    return S.land_mask(points, polygons, index=index)


def drain_land_mask(
    points: DataFrame, polygons: DataFrame, path: str, checkpoint: str, max_bytes: int | None = None,
    index: S.PolygonIndex | None = None,
):
    """Mask what is available, with a mask of any size: the batch join on every batch.

    The index is opened if it is written already, else written once, before the first batch; a restarted
    query opens the same. A batch overwrites its own ``batch=N`` directory.
    """
    index = index or S.polygon_index(polygons, "neighborhood_id", "geometry", (), max_bytes)

    def write(batch: DataFrame, number: int) -> None:
        S.land_mask(batch, polygons, index=index).write.mode("overwrite").parquet(f"{path}/batch={number}")

    query = (
        points.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def count_late(query) -> int:
    """State rows the last progress reports of a query count as later than the watermark: a
    monitoring figure. Spark keeps few reports and counts after partial aggregation, so
    ``run_counts`` and ``late_events`` are the way to an exact number of events."""
    dropped = 0
    for progress in query.recentProgress:
        for operator in progress["stateOperators"]:
            dropped += operator["numRowsDroppedByWatermark"]
    return dropped


def run_counts(counts: DataFrame, path: str, checkpoint: str):
    """Drain grouped counts in update mode: each batch writes the groups it changed.

    A batch overwrites its own ``batch=N`` directory, so a repeated batch changes nothing.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    query = (
        counts.writeStream.outputMode("update").foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def newest_counts(spark: SparkSession, path: str, keys: list[str], n: str = "n") -> DataFrame:
    """What ``run_counts`` wrote, at its newest: a row per group, open groups included."""
    written = spark.read.option("basePath", path).parquet(path)
    return written.groupBy(*keys).agg(F.max_by(n, "batch").alias(n))


def late_events(spark: SparkSession, offered: DataFrame, path: str, keys: list[str], n: str = "n") -> DataFrame:
    """One row: events offered, counted in time, and dropped as late, however long the run was."""
    kept = newest_counts(spark, path, keys, n).agg(F.coalesce(F.sum(n), F.lit(0)).alias("kept"))
    return offered.agg(F.count(F.lit(1)).alias("offered")).crossJoin(kept).withColumn(  # one row each
        "late", F.col("offered") - F.col("kept")
    )


def stream_gold(
    metrics: DataFrame, keys: list[str], values: list[str], path: str, checkpoint: str,
    merge: Callable[[DataFrame], DataFrame] | None = None,
):
    """Per-batch partial aggregates, idempotent by batch id.

    Each batch overwrites its own ``batch=N`` directory, so a repeated batch changes
    nothing; ``read_gold`` adds the batches up.
    """

    def write(batch: DataFrame, number: int) -> None:
        sums = batch.groupBy(*keys).agg(*[F.sum(v).alias(v) for v in values])
        (merge(sums) if merge else sums).write.mode("overwrite").parquet(f"{path}/batch={number}")

    query = (
        metrics.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def read_gold(spark: SparkSession, path: str, keys: list[str], values: list[str]) -> DataFrame:
    return spark.read.parquet(path).groupBy(*keys).agg(*[F.sum(v).alias(v) for v in values])
