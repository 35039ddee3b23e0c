"""The streaming jobs, drained to Parquet and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from terrahaz.queries import views as V
from terrahaz.queries.registry import query
from terrahaz.session import scratch
from terrahaz.streaming import jobs

DELAY = "10 minutes"
_MARK = "(SELECT max(ts)-INTERVAL 10 MINUTE FROM events)"


def _events(spark, sf, delay: str = DELAY):
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    return jobs.with_event_time(jobs.file_stream(spark, sf, schema, "events.parquet"), delay=delay)


def _derive(df, name: str):
    """A derived view over the stream: the same expressions as in batch."""
    _, condition, columns = V.VIEWS[name]
    df = df if condition is None else df.where(condition)
    return df.selectExpr(*[f"{expr} AS {column}" for column, expr in columns])


def _drain(spark, df, label: str):
    path = scratch(spark, label)
    jobs.run_available(df, path, scratch(spark, f"{label}-checkpoint"))
    return spark.read.schema(df.schema).parquet(path)


def _ntz(df, *columns):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


@query(
    "stream_silver",
    """SELECT request_id, longitude AS lon, CASE WHEN contains(complaint_type,'Noise') THEN 'medical' WHEN contains(complaint_type,'Parking') THEN 'rescue'
    WHEN contains(complaint_type,'Condition') THEN 'hazmat' ELSE 'rescue' END AS ai_hazard_type FROM fx_311 WHERE latitude IS NOT NULL""",
)
def stream_silver(spark, sf):
    silver = jobs.stream_silver(_derive(_events(spark, sf), "fx_311"))
    return _drain(spark, silver, "stream-silver").select("request_id", "geometry.lon", "ai_hazard_type")


@query("stream_dedupe", "SELECT DISTINCT event_id, event_type FROM events")
def stream_dedupe(spark, sf):
    """Every event is offered twice; one copy survives."""
    events = _events(spark, sf)
    doubled = events.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    return _drain(spark, jobs.stream_dedupe(doubled, ["event_id"]), "stream-dedupe").select("event_id", "event_type")


@query(
    "stream_tumbling",
    f"""SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, layer, cast(sum(records) as bigint) AS records, cast(sum(errors) as bigint) AS errors
    FROM fx_metrics GROUP BY 1,2 HAVING time_bucket(INTERVAL 1 HOUR, ts)+INTERVAL 1 HOUR <= {_MARK}""",
)
def stream_tumbling(spark, sf):
    rows = jobs.stream_tumbling(_derive(_events(spark, sf), "fx_metrics"), "ts", "1 hour")
    return _ntz(_drain(spark, rows, "stream-tumbling"), "window_start").select("window_start", "layer", "records", "errors")


@query(
    "stream_sliding",
    f"""SELECT window_start, layer, sum(records)/300.0::double AS rate FROM (SELECT layer, records, unnest([time_bucket(INTERVAL 1 MINUTE, ts)-INTERVAL 0 MINUTE,
    time_bucket(INTERVAL 1 MINUTE, ts)-INTERVAL 1 MINUTE, time_bucket(INTERVAL 1 MINUTE, ts)-INTERVAL 2 MINUTE, time_bucket(INTERVAL 1 MINUTE, ts)-INTERVAL 3 MINUTE,
    time_bucket(INTERVAL 1 MINUTE, ts)-INTERVAL 4 MINUTE]) AS window_start FROM fx_metrics) GROUP BY 1,2 HAVING window_start+INTERVAL 5 MINUTE <= {_MARK}""",
)
def stream_sliding(spark, sf):
    rows = jobs.stream_sliding(_derive(_events(spark, sf), "fx_metrics"), "ts", "5 minutes", "1 minute", 300.0)
    return _ntz(_drain(spark, rows, "stream-sliding"), "window_start").select("window_start", "layer", "rate")


@query(
    "stream_sessions",
    f"""WITH g AS (SELECT user_id, ts, sum(CASE WHEN b IS NULL OR ts-b > INTERVAL 6 HOUR THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts) AS s FROM
    (SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS b FROM events))
    SELECT user_id, min(ts) AS session_start, max(ts)+INTERVAL 6 HOUR AS session_end, count(*) AS n_events FROM g GROUP BY user_id, s
    HAVING max(ts)+INTERVAL 6 HOUR <= {_MARK}""",
)
def stream_sessions(spark, sf):
    rows = jobs.stream_sessions(_events(spark, sf), "ts", "user_id", "6 hours")
    return _ntz(_drain(spark, rows, "stream-sessions"), "session_start", "session_end")


_QUIET_MS = 12 * 3600 * 1000


@query(
    "stream_no_data",
    f"""WITH g AS (SELECT user_id, epoch_us(ts)//1000 AS t, lead(epoch_us(ts)//1000) OVER (PARTITION BY user_id ORDER BY ts) AS b FROM events)
    SELECT user_id, make_timestamp(t*1000) AS since, make_timestamp((t+{_QUIET_MS})*1000) AS fired_at FROM g
    WHERE (b IS NULL OR b-t > {_QUIET_MS}) AND t+{_QUIET_MS} < (SELECT epoch_us(max(ts))//1000-600000 FROM events)""",
)
def stream_no_data(spark, sf):
    """Twelve hours of silence, told by a timer and not by the next event."""
    alerts = jobs.stream_no_data(_events(spark, sf), "user_id", _QUIET_MS / 1000)
    return _ntz(_drain(spark, alerts, "stream-no-data"), "since", "fired_at")


@query("stream_land_mask", "SELECT request_id, borough FROM fx_311 WHERE request_id IN (SELECT request_id FROM fx_hits_311)")
def stream_land_mask(spark, sf):
    points = _derive(_events(spark, sf), "fx_311")
    path = scratch(spark, "stream-mask")
    jobs.drain_land_mask(points, V.land(spark, sf), path, scratch(spark, "stream-mask-checkpoint"))
    return spark.read.schema(points.schema).option("basePath", path).parquet(path).select("request_id", "borough")


@query(
    "late_data",
    f"""WITH q AS (SELECT ts, min(epoch_us(ts)) OVER () AS a, max(epoch_us(ts)) OVER () AS b FROM events)
    SELECT count(*) AS offered, count_if(epoch_us(ts) >= a+3*((b-a)//4)
      OR epoch_us(time_bucket(INTERVAL 1 HOUR, ts))+3600000000 > b-600000000) AS kept,
    count_if(NOT (epoch_us(ts) >= a+3*((b-a)//4) OR epoch_us(time_bucket(INTERVAL 1 HOUR, ts))+3600000000 > b-600000000)) AS late FROM q""",
)
def late_data(spark, sf):
    """Events in four arrivals, the newest quarter of their time first: what an arrival brings
    for hours the watermark has closed by then is late."""
    staged, path, checkpoint = (scratch(spark, f"late-{x}") for x in ("input", "counts", "checkpoint"))
    events = spark.read.parquet(f"{sf}/events.parquet")
    us = V.micros("ts")
    low, high = events.agg(F.min(us), F.max(us)).first()
    if low is None:
        low = high = 0
    quarter = F.least(F.floor((us - F.lit(low)) / F.lit(max(1, (high - low) // 4))), F.lit(3))
    for i in reversed(range(4)):
        events.where(quarter == i).write.mode("append").parquet(staged)
        # all files of an arrival are one batch; the watermark goes on from the checkpoint
        stream = jobs.with_event_time(jobs.file_stream(spark, staged, events.schema), delay=DELAY)
        counts = stream.groupBy(F.window("ts", "1 hour").alias("w")).agg(F.count("*").alias("n"))
        jobs.run_counts(counts, path, checkpoint)
    return jobs.late_events(spark, events, path, ["w"])


@query("stream_gold", "SELECT layer, cast(sum(records) as bigint) AS records, cast(sum(errors) as bigint) AS errors FROM fx_metrics GROUP BY 1")
def stream_gold(spark, sf):
    path = scratch(spark, "stream-gold")
    metrics = _derive(_events(spark, sf), "fx_metrics")
    jobs.stream_gold(metrics, ["layer"], ["records", "errors"], path, scratch(spark, "stream-gold-checkpoint"))
    return jobs.read_gold(spark, path, ["layer"], ["records", "errors"])
