"""Ordered scans: running totals, rates, alerts, latest rows, splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from terrahaz.operators import ordered as W
from terrahaz.queries import views as V
from terrahaz.queries.registry import query
from terrahaz.queries.rollups import hash_sql


def _metrics(spark, sf):
    return V.view(spark, sf, "fx_metrics").withColumn("t_us", V.micros("ts"))


@query(
    "latest_per_key",
    """SELECT obs_id, borough, ts, temperature_f FROM (SELECT *, row_number() OVER (PARTITION BY borough ORDER BY ts DESC, obs_id DESC) AS r FROM fx_weather) WHERE r=1""",
)
def latest_per_key(spark, sf):
    latest = W.latest_per_key(V.view(spark, sf, "fx_weather"), ["borough"], ["ts", "obs_id"])
    return latest.select("obs_id", "borough", "ts", "temperature_f")


_DELTA = """SELECT layer, ts, CASE WHEN p IS NULL THEN 0 WHEN v>=p THEN v-p ELSE v END AS d FROM
 (SELECT layer, ts, v, lag(v) OVER (PARTITION BY layer ORDER BY ts) AS p FROM (SELECT layer, ts, max({c}) AS v FROM fx_metrics GROUP BY 1,2))"""


@query(
    "counter_rate",
    f"""SELECT layer, epoch_us(ts) AS t_us, round(sum(d) OVER (PARTITION BY layer ORDER BY ts RANGE BETWEEN INTERVAL 5 MINUTES PRECEDING AND CURRENT ROW)/300,6) AS rate
    FROM ({_DELTA.format(c='counter')})""",
)
def counter_rate(spark, sf):
    rates = W.counter_rate(_metrics(spark, sf), ["layer"], "t_us", "counter")
    return rates.select("layer", "t_us", F.round("rate", 6).alias("rate"))




@query(
    "mean_duration",
    """WITH d AS (SELECT layer, ts, lag(ts) OVER (PARTITION BY layer ORDER BY ts) AS before, cast(records as double) AS seconds FROM fx_metrics),
    k AS (SELECT layer, ts, CASE WHEN before IS NULL THEN 0 ELSE seconds END AS s, CASE WHEN before IS NULL THEN 0 ELSE 1 END AS c FROM d),
    r AS (SELECT layer, ts, sum(s) OVER w AS s, sum(c) OVER w AS c FROM k WINDOW w AS (PARTITION BY layer ORDER BY ts RANGE BETWEEN INTERVAL 30 MINUTES PRECEDING AND CURRENT ROW))
    SELECT layer, epoch_us(ts) AS t_us, round(s/nullif(c,0),9) AS mean_seconds FROM r""",
)
def mean_duration(spark, sf):
    """The two counters are themselves running totals of the samples."""
    samples = _metrics(spark, sf).select("layer", "t_us", "sample_id", F.col("records").cast("double").alias("seconds"))
    order = ["t_us", "sample_id"]
    totals = W.prefix_sum(samples, ["layer"], order, F.col("seconds"), "total_seconds")
    totals = W.prefix_sum(totals, ["layer"], order, F.lit(1.0), "calls")
    means = W.mean_duration(totals, ["layer"], "t_us", "total_seconds", "calls", 1800)
    return means.select("layer", "t_us", F.round("mean_seconds", 9).alias("mean_seconds"))


def _islands(condition: str, hold: int) -> str:
    return f"""WITH s AS (SELECT layer, ts, {condition} AS up, lag({condition}) OVER (PARTITION BY layer ORDER BY ts) AS before FROM fx_metrics),
    g AS (SELECT *, sum(CASE WHEN up IS DISTINCT FROM before THEN 1 ELSE 0 END) OVER (PARTITION BY layer ORDER BY ts) AS island FROM s)
    SELECT layer, epoch_us(min(ts)) AS start_us, epoch_us(max(ts)) AS end_us, count(*) AS samples FROM g WHERE up GROUP BY layer, island
    HAVING epoch_us(max(ts))-epoch_us(min(ts)) >= {hold}*1000000"""


@query("alert_intervals", _islands("(errors*1.0/records)>0.05", 300))
def alert_intervals(spark, sf):
    rate = F.col("errors") / F.col("records") > 0.05
    return W.alert_intervals(_metrics(spark, sf), ["layer"], "t_us", rate, 300)


@query("alert_latency", _islands("seconds>3", 300))
def alert_latency(spark, sf):
    return W.alert_intervals(_metrics(spark, sf), ["layer"], "t_us", F.col("seconds") > 3, 300)


def _totals(spark, sf):
    """The exporters' counters: running totals of records, errors, seconds and calls per layer."""
    counters = {"records_total": F.col("records"), "errors_total": F.col("errors"),
                "seconds_total": F.col("records").cast("double"), "calls_total": F.lit(1.0)}
    totals = W.prefix_sums(_metrics(spark, sf), ["layer"], ["t_us", "sample_id"], counters)
    return totals.select("layer", "t_us", *counters)


_TOTALS = """totals AS (SELECT layer, epoch_us(ts) AS t_us, records, errors, sum(records) OVER w AS r, sum(errors) OVER w AS e FROM fx_metrics
    WINDOW w AS (PARTITION BY layer ORDER BY ts, sample_id ROWS UNBOUNDED PRECEDING)),
    pt AS (SELECT layer, t_us, max(r) AS r, max(e) AS e, 1 AS samples FROM totals GROUP BY 1, 2)"""
#: As text: islands of ``up`` over (layer, t_us, samples), held for some seconds.
_HELD = """g AS (SELECT *, sum(CASE WHEN up THEN 0 ELSE 1 END) OVER (PARTITION BY layer ORDER BY t_us) AS island FROM s)
    SELECT layer, min(t_us) AS start_us, max(t_us) AS end_us, cast(sum(samples) as bigint) AS samples FROM g WHERE up GROUP BY layer, island
    HAVING max(t_us)-min(t_us) >= {hold}*1000000"""


@query(
    "alert_error_rate",
    f"WITH {_TOTALS}, s AS (SELECT layer, t_us, samples, coalesce(e > r*0.016::double, false) AS up FROM pt), {_HELD.format(hold=300)}",
)
def alert_error_rate(spark, sf):
    """Errors over records, both as counters; with a limit these tables do cross (the default is 0.05)."""
    return W.alert_error_rate(_totals(spark, sf), ["layer"], "t_us", "errors_total", "records_total", 0.016)


@query(
    "alert_quality",
    f"WITH {_TOTALS}, s AS (SELECT layer, t_us, samples, coalesce(r - e < r*{98.5 / 100!r}::double, false) AS up FROM pt), {_HELD.format(hold=300)}",
)
def alert_quality(spark, sf):
    """Share of good records below a limit these tables do cross (the default is 90 %)."""
    return W.alert_quality(_totals(spark, sf), ["layer"], "t_us", "errors_total", "records_total", 98.5)


_PACE = """p AS (SELECT layer, t_us, samples, r - lag(r) OVER (PARTITION BY layer ORDER BY t_us) AS d, e - lag(e) OVER (PARTITION BY layer ORDER BY t_us) AS de FROM pt)"""


@query(
    "alert_no_data",
    f"""WITH {_TOTALS}, {_PACE}, f AS (SELECT *, sum(coalesce(de, 0)) OVER (PARTITION BY layer ORDER BY t_us RANGE BETWEEN 300000000 PRECEDING AND CURRENT ROW) AS x FROM p),
    s AS (SELECT layer, t_us, samples, x = 0 AS up FROM f), {_HELD.format(hold=600)}""",
)
def alert_no_data(spark, sf):
    """A counter (here that of errors, which does stand still) without increase over five minutes."""
    return W.alert_no_data(_totals(spark, sf), ["layer"], "t_us", "errors_total")


@query(
    "alert_mean_latency",
    f"""WITH {_TOTALS}, c AS (SELECT layer, t_us, count(*) AS n FROM totals GROUP BY 1, 2), q AS (SELECT pt.*, n FROM pt JOIN c USING (layer, t_us)),
    k AS (SELECT layer, t_us, samples, r - lag(r) OVER (PARTITION BY layer ORDER BY t_us) AS d, CASE WHEN lag(r) OVER (PARTITION BY layer ORDER BY t_us) IS NOT NULL THEN n END AS m FROM q),
    f AS (SELECT *, sum(coalesce(d, 0)) OVER w AS x, sum(coalesce(m, 0)) OVER w AS y FROM k WINDOW w AS (PARTITION BY layer ORDER BY t_us RANGE BETWEEN 300000000 PRECEDING AND CURRENT ROW)),
    s AS (SELECT layer, t_us, samples, coalesce(x > y*30, false) AS up FROM f), {_HELD.format(hold=300)}""",
)
def alert_mean_latency(spark, sf):
    """Mean duration from the counters of seconds and calls, above 30 seconds for five minutes."""
    return W.alert_mean_latency(_totals(spark, sf), ["layer"], "t_us", "seconds_total", "calls_total")


@query(
    "alert_down",
    _islands("up=0 OR errors>0", 120),
)
def alert_down(spark, sf):
    return W.alert_intervals(_metrics(spark, sf), ["layer"], "t_us", (F.col("up") == 0) | (F.col("errors") > 0), 120)


@query(
    "cumulative_records",
    "SELECT sample_id, layer, cast(sum(records) OVER (PARTITION BY layer ORDER BY ts, sample_id ROWS UNBOUNDED PRECEDING) as bigint) AS running_total FROM fx_metrics",
)
def cumulative_records(spark, sf):
    running = W.cumulative_records(_metrics(spark, sf), "layer", ["t_us", "sample_id"], "records")
    return running.select("sample_id", "layer", "running_total")


@query(
    "layer_status",
    "SELECT layer, last_value, CASE WHEN last_value=1 THEN 'RUNNING' ELSE 'STOPPED' END AS status FROM (SELECT layer, arg_max(up, ts) AS last_value FROM fx_metrics GROUP BY 1)",
)
def layer_status(spark, sf):
    return W.layer_status(_metrics(spark, sf), "layer", "t_us", "up")


@query(
    "auc_roc",
    """WITH s AS (SELECT score, sum(label) AS p, sum(1-label) AS q FROM fx_scored GROUP BY 1),
    pairs AS (SELECT sum(a.p*b.q*CASE WHEN a.score>b.score THEN 1.0 WHEN a.score=b.score THEN 0.5 ELSE 0 END)::double AS u FROM s a CROSS JOIN s b)
    SELECT round(u/((SELECT sum(p)::double FROM s)*(SELECT sum(q)::double FROM s)),9) AS auc FROM pairs""",
)
def auc_roc(spark, sf):
    return W.auc_roc(V.view(spark, sf, "fx_scored"), "label", "score").select(F.round("auc", 9).alias("auc"))


@query("split_by_hash", f"SELECT o_orderkey, {hash_sql('o_orderkey')}%100<20 AS is_test FROM orders")
def split_by_hash(spark, sf):
    return W.split_by_hash(V.table(spark, sf, "orders").select("o_orderkey"), "o_orderkey")


@query(
    "stratified_split",
    f"""SELECT o_orderkey, o_orderstatus, row_number() OVER (PARTITION BY o_orderstatus ORDER BY {hash_sql('o_orderkey')}%65536, sha256(cast(o_orderkey as varchar)||'|42'), o_orderkey)
    <= floor(count(*) OVER (PARTITION BY o_orderstatus)*0.2) AS is_test FROM orders""",
)
def stratified_split(spark, sf):
    orders = V.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return W.stratified_split(orders, "o_orderkey", "o_orderstatus")
