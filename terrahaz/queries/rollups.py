"""Aggregations, quality figures, top-k reports and samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from terrahaz.operators import aggregate as A
from terrahaz.operators import ordered as W
from terrahaz.queries import views as V
from terrahaz.queries.registry import query
from terrahaz.session import scratch


@query("count_by_severity", "SELECT Severity AS severity, count(*) AS n FROM fx_accidents GROUP BY 1")
def count_by_severity(spark, sf):
    return A.count_by(V.view(spark, sf, "fx_accidents").withColumnRenamed("Severity", "severity"), "severity")


@query(
    "severity_by_borough",
    """SELECT upper(borough) AS borough, count(*) AS n, avg(length(complaint_type)) AS avg_severity, max(length(complaint_type)) AS max_severity
    FROM fx_311 GROUP BY 1""",
)
def severity_by_borough(spark, sf):
    df = V.view(spark, sf, "fx_311").select(F.upper("borough").alias("borough"), F.length("complaint_type").cast("bigint").alias("severity"))
    return A.severity_by(df, "borough")


@query("events_per_neighborhood", "SELECT neighborhood_id, count(*) AS n FROM fx_first_311 GROUP BY 1")
def events_per_neighborhood(spark, sf):
    from terrahaz.operators import spatial as S

    placed = S.attach_polygon(V.view(spark, sf, "fx_311"), V.land(spark, sf))
    return A.count_by(placed.where(F.col("neighborhood_id").isNotNull()), "neighborhood_id")


@query(
    "severity_by_source",
    """SELECT source, count(*) AS n, round(avg(s),6) AS avg_severity FROM (SELECT 'us_accidents' AS source, cast(Severity as double) AS s FROM fx_accidents
    UNION ALL SELECT 'usgs_earthquakes', magnitude FROM fx_quakes UNION ALL SELECT 'nyc_311_requests', cast(5 as double) FROM fx_311 WHERE latitude IS NOT NULL) GROUP BY 1""",
)
def severity_by_source(spark, sf):
    from terrahaz.operators import clean as P

    keep = ["source", "severity"]
    stacked = (
        P.canonical_accidents(V.view(spark, sf, "fx_accidents")).select(*keep)
        .unionByName(P.canonical_quakes(V.view(spark, sf, "fx_quakes")).select(*keep))
        .unionByName(P.canonical_311(V.view(spark, sf, "fx_311")).select(*keep))
    )
    return A.severity_by(stacked, "source").select("source", "n", F.round("avg_severity", 6).alias("avg_severity"))


@query(
    "city_rollup",
    """SELECT city, count(*) AS n, avg(age) AS avg_age FROM (SELECT DISTINCT c_mktsegment AS city, c_nationkey-2 AS age, c_custkey%400 AS id FROM customer)
    WHERE age>=0 GROUP BY 1""",
)
def city_rollup(spark, sf):
    people = V.table(spark, sf, "customer").selectExpr("c_mktsegment AS city", "c_nationkey-2 AS age", "c_custkey%400 AS id")
    return A.city_rollup(people)


@query(
    "dedupe",
    """SELECT request_id, borough, created_date FROM (SELECT *, row_number() OVER (PARTITION BY borough, complaint_type ORDER BY created_date DESC, request_id DESC) AS r
    FROM fx_311) WHERE r=1""",
)
def dedupe(spark, sf):
    rows = W.dedupe(V.view(spark, sf, "fx_311"), ["borough", "complaint_type"], ["created_date", "request_id"])
    return rows.select("request_id", "borough", "created_date")


_COUNTS = " UNION ALL ".join(
    f"SELECT '{n}' AS dataset, count(*) AS n FROM fx_{n}" for n in ("accidents", "quakes", "311", "osm", "nbhd", "weather", "flights")
)


def _tables(spark, sf):
    return {n: V.view(spark, sf, f"fx_{n}") for n in ("accidents", "quakes", "311", "osm", "nbhd", "weather", "flights")}


@query("table_counts", f"WITH c AS ({_COUNTS}) SELECT * FROM c UNION ALL SELECT 'TOTAL', cast(sum(n) as bigint) FROM c")
def table_counts(spark, sf):
    return A.table_counts(_tables(spark, sf))


@query("ingest_inventory", f"WITH c AS ({_COUNTS}) SELECT * FROM c UNION ALL SELECT 'TOTAL', cast(sum(n) as bigint) FROM c")
def ingest_inventory(spark, sf):
    from terrahaz.sources.feeds import ingest_inventory as inventory

    return inventory(_tables(spark, sf))


@query(
    "layer_quality",
    """SELECT l.layer AS layer, cast(coalesce(sum(records),0) as bigint) AS records, cast(coalesce(sum(errors),0) as bigint) AS errors,
    CASE WHEN coalesce(sum(records),0)=0 THEN NULL ELSE 100.0::double*(sum(records)-sum(errors))/sum(records) END AS success_pct,
    (SELECT cast(sum(errors) as bigint) FROM fx_metrics) AS total_errors
    FROM (SELECT unnest(['bronze','silver','gold','audit']) AS layer) l LEFT JOIN fx_metrics m ON m.layer=l.layer GROUP BY 1""",
)
def layer_quality(spark, sf):
    # the list of layers comes with the table's own layers plus one that reports nothing
    metrics = V.view(spark, sf, "fx_metrics")
    layers = metrics.select("layer").distinct().unionByName(metrics.select(F.lit("audit").alias("layer")).distinct())
    return A.layer_quality(metrics, layers)


@query(
    "extraction_summary",
    """SELECT count(*) AS total, count(*) FILTER (reply IS NOT NULL AND trim(reply)<>'') AS successes,
    count(*) FILTER (reply IS NULL OR trim(reply)='') AS skipped,
    cast(sum(coalesce(prompt_tokens,0)+coalesce(completion_tokens,0)) as bigint) AS total_tokens,
    sum(coalesce(prompt_tokens,0)+coalesce(completion_tokens,0))/count(*) AS avg_tokens,
    cast(sum(reply_id%4) as bigint) AS hazards,
    sum((reply_id%8)/8::double) FILTER (reply IS NOT NULL AND trim(reply)<>'') AS total_latency,
    round(avg((reply_id%8)/8::double) FILTER (reply IS NOT NULL AND trim(reply)<>''),9) AS avg_latency FROM fx_replies""",
)
def extraction_summary(spark, sf):
    from terrahaz.operators.enrich import extraction_summary as summary

    empty = F.coalesce(F.trim("reply"), F.lit("")) == ""
    df = V.view(spark, sf, "fx_replies").withColumns(
        {"status": F.when(empty, "skipped").otherwise("success"), "num_hazards": F.col("reply_id") % 4,
         "latency": F.when(~empty, (F.col("reply_id") % 8) / F.lit(8.0))}
    )
    return summary(df).withColumn("avg_latency", F.round("avg_latency", 9))


@query(
    "judge_summary",
    """SELECT round(avg(s),6) AS mean_score, count(s) AS evaluated, count(*) FILTER (s<3) AS below_threshold FROM
    (SELECT coalesce(try_cast(nullif(regexp_extract(coalesce(judge_reply,''), '"score"\\s*:\\s*([0-9.]+)', 1),'') AS double), 0.5) AS s FROM fx_replies)""",
)
def judge_summary(spark, sf):
    from terrahaz.operators import enrich as E

    scored = V.view(spark, sf, "fx_replies").withColumn("score", E.parse_judge_score("judge_reply"))
    return E.judge_summary(scored, "score").withColumn("mean_score", F.round("mean_score", 6))


_CLASS = """SELECT {g} count(*) AS n, avg((label=prediction)::int) AS accuracy,
 coalesce(sum((label=1 AND prediction=1)::int)/nullif(sum(prediction),0),0) AS "precision",
 coalesce(sum((label=1 AND prediction=1)::int)/nullif(sum(label),0),0) AS recall,
 coalesce(2*sum((label=1 AND prediction=1)::int)/nullif(sum(label)+sum(prediction),0),0) AS f1 FROM fx_scored {b}"""


@query("classification_metrics", _CLASS.format(g="", b=""))
def classification_metrics(spark, sf):
    return A.classification_metrics(V.view(spark, sf, "fx_scored"), "label", "prediction").drop("f1_weighted")


@query(
    "classification_weighted",
    """WITH t AS (SELECT sum((label=1 AND prediction=1)::int) AS tp, sum((label=0 AND prediction=1)::int) AS fp,
    sum((label=1 AND prediction=0)::int) AS fn, sum((label=0 AND prediction=0)::int) AS tn FROM fx_scored)
    SELECT round(((tp+fn)*2*tp/(2*tp+fp+fn)+(tn+fp)*2*tn/(2*tn+fn+fp))/(tp+fp+fn+tn),9) AS f1_weighted FROM t""",
)
def classification_weighted(spark, sf):
    m = A.classification_metrics(V.view(spark, sf, "fx_scored"), "label", "prediction")
    return m.select(F.round("f1_weighted", 9).alias("f1_weighted"))


@query("confusion_counts", "SELECT label, prediction, count(*) AS n FROM fx_scored GROUP BY 1,2")
def confusion_counts(spark, sf):
    return A.confusion(V.view(spark, sf, "fx_scored"), "label", "prediction")


@query(
    "label_eval",
    """SELECT lang AS category, count(*) AS n, avg((label=prediction)::int) AS accuracy,
    coalesce(sum(label*prediction)/nullif(sum(prediction),0),0) AS "precision", coalesce(sum(label*prediction)/nullif(sum(label),0),0) AS recall,
    coalesce(2*sum(label*prediction)/nullif(sum(label)+sum(prediction),0),0) AS f1 FROM
    (SELECT d.lang AS lang, l.quality AS label, CASE WHEN d.n_chars>500 THEN 1 ELSE 0 END AS prediction FROM documents d JOIN labels l ON d.doc_id=l.doc_id) GROUP BY 1""",
)
def label_eval(spark, sf):
    from terrahaz.operators.enrich import label_eval as evaluate

    predictions = V.table(spark, sf, "documents").selectExpr(
        "doc_id", "lang AS category", "CASE WHEN n_chars>500 THEN 1 ELSE 0 END AS prediction"
    )
    labels = V.table(spark, sf, "labels").selectExpr("doc_id", "quality AS label")
    return evaluate(predictions, labels, "doc_id", "category").drop("f1_weighted")


@query(
    "regression_metrics",
    """SELECT count(*) AS n, round(avg((target-estimate)*(target-estimate)),6) AS mse, round(sqrt(avg((target-estimate)*(target-estimate))),6) AS rmse,
    round(1-avg((target-estimate)*(target-estimate))/var_pop(target),6) AS r2 FROM fx_scored""",
)
def regression_metrics(spark, sf):
    m = A.regression_metrics(V.view(spark, sf, "fx_scored"), "target", "estimate")
    return m.select("n", *[F.round(c, 6).alias(c) for c in ("mse", "rmse", "r2")])


@query("max_over_table", "SELECT max(l_extendedprice) AS max_value FROM lineitem")
def max_over_table(spark, sf):
    return A.max_over_table(V.table(spark, sf, "lineitem"), "l_extendedprice")


def _profile_sql() -> str:
    parts = []
    for c in ("request_id", "complaint_type", "borough", "descriptor"):
        parts.append(
            f"SELECT '{c}' AS \"column\", count(*) AS n_rows, count(*)-count({c}) AS n_null, count(DISTINCT {c}) AS n_distinct, "
            f"min({c}) AS min_value, max({c}) AS max_value FROM fx_311"
        )
    parts.append(
        "SELECT 'latitude', count(*), count(*)-count(latitude), count(DISTINCT latitude), "
        "cast(round(min(latitude),4) as varchar), cast(round(max(latitude),4) as varchar) FROM fx_311"
    )
    return " UNION ALL ".join(parts)


@query("dataset_profile", _profile_sql())
def dataset_profile(spark, sf):
    df = V.view(spark, sf, "fx_311").withColumn("latitude", F.round("latitude", 4))
    return A.dataset_profile(df, ["request_id", "complaint_type", "borough", "descriptor", "latitude"], exact=True)


@query(
    "dataset_profile_merged",
    """WITH c AS (SELECT 'o_custkey' AS "column", cast(o_custkey as varchar) AS v, o_custkey::double AS x FROM orders
      UNION ALL SELECT 'o_orderpriority', o_orderpriority, NULL FROM orders UNION ALL SELECT 'o_totalprice', NULL, o_totalprice FROM orders),
    e AS (SELECT 'o_totalprice' AS "column", count(DISTINCT o_totalprice) AS d FROM orders)
    SELECT c."column" AS "column", count(*) AS n_rows, CASE WHEN c."column"='o_totalprice' THEN any_value(e.d) ELSE count(DISTINCT v) END AS n_distinct,
    true AS distinct_close, CASE WHEN c."column"<>'o_orderpriority' THEN true END AS median_close
    FROM c LEFT JOIN e ON e."column"=c."column" GROUP BY c."column" """,
)
def dataset_profile_merged(spark, sf):
    """Profiles of every day, written, then merged over all days: beside the exact counts, distinct values are
    within 3 % and the median's rank within 2 %."""
    path = scratch(spark, "profile-parts")
    orders, columns = V.table(spark, sf, "orders"), ["o_custkey", "o_orderpriority", "o_totalprice"]
    A.profile_parts(orders, F.to_date("o_orderdate"), columns).write.parquet(path)
    merged = A.merge_profiles(spark.read.parquet(path)).select(
        "column", F.col("n_distinct").alias("about"), F.get("quantiles", F.lit(0)).alias("median"))
    medians = {r["column"]: r["median"] for r in merged.collect()}
    below = orders.agg(*[F.avg((F.col(c) <= m).cast("double")).alias(c) for c, m in medians.items() if m is not None])
    named = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("rank")) for c in below.columns])
    ranks = below.select(F.inline(named))
    exact = A.dataset_profile(orders, columns, exact=True).select("column", "n_rows", "n_distinct")
    return exact.join(merged, "column").join(ranks, "column", "left").select(
        "column", "n_rows", "n_distinct", (F.abs(F.col("about") - F.col("n_distinct")) <= 0.03 * F.col("n_distinct")).alias("distinct_close"),
        (F.abs(F.col("rank") - 0.5) <= 0.02).alias("median_close"))


_BOUNDS = [0.1, 0.5, 1.0, 2.0, 5.0, 10.0, 30.0, 60.0]


@query(
    "duration_histogram",
    f"""WITH b AS (SELECT unnest([{','.join(map(str, _BOUNDS))}, 1e300])::double AS bound),
    t AS (SELECT operation, round(sum(seconds),6) AS sum_seconds, count(*) AS n FROM fx_metrics GROUP BY 1)
    SELECT t.operation AS operation, CASE WHEN bound>1e299 THEN '+Inf' ELSE cast(bound as varchar) END AS le, t.sum_seconds AS sum_seconds, t.n AS n,
    (SELECT count(*) FROM fx_metrics m WHERE m.operation=t.operation AND m.seconds<=bound) AS bucket FROM t CROSS JOIN b""",
)
def duration_histogram(spark, sf):
    h = A.duration_histogram(V.view(spark, sf, "fx_metrics"), "operation", "seconds")
    return h.withColumn("sum_seconds", F.round("sum_seconds", 6))


@query(
    "layer_yield",
    """WITH c AS (SELECT source, layer, sum(records) AS r FROM fx_metrics GROUP BY 1,2)
    SELECT a.source AS source, a.layer AS layer, a.r::double/b.r AS yield FROM c a JOIN c b ON a.source=b.source AND
    ((a.layer='silver' AND b.layer='bronze') OR (a.layer='gold' AND b.layer='silver'))""",
)
def layer_yield(spark, sf):
    return A.layer_yield(V.view(spark, sf, "fx_metrics"), V.LAYERS)


@query("labeled_counts", "SELECT source, operation, cast(sum(records) as bigint) AS total FROM fx_metrics GROUP BY 1,2")
def labeled_counts(spark, sf):
    return A.labeled_counts(V.view(spark, sf, "fx_metrics"), ["source", "operation"], "records")


@query(
    "spatial_density",
    """SELECT request_id, count(*) OVER (PARTITION BY cx,cy) AS spatial_density, count(*) OVER (PARTITION BY cx,cy,d) AS event_frequency FROM
    (SELECT request_id, floor(longitude/cast(0.05 as double)) AS cx, floor(latitude/cast(0.05 as double)) AS cy, cast(created_date as date) AS d
     FROM fx_311 WHERE latitude IS NOT NULL)""",
)
def spatial_density(spark, sf):
    located = V.view(spark, sf, "fx_311").where("latitude IS NOT NULL")
    return A.spatial_density(located, 0.05, "created_date").select("request_id", "spatial_density", "event_frequency")


# ---------------------------------------------------------------------- top-k


@query(
    "latest_requests",
    """SELECT request_id, created_date, latitude FROM fx_311 WHERE latitude BETWEEN 40.5 AND 41.0 ORDER BY created_date DESC, request_id DESC LIMIT 1000""",
)
def latest_requests(spark, sf):
    return A.latest_requests(V.view(spark, sf, "fx_311")).select("request_id", "created_date", "latitude")


@query(
    "strongest_quakes",
    """SELECT earthquake_id, magnitude, time FROM fx_quakes WHERE magnitude>=0.5 AND latitude BETWEEN 40 AND 42 AND longitude BETWEEN -75 AND -73
    AND time>=TIMESTAMP '2024-01-03' AND time<TIMESTAMP '2024-01-25' """,
)
def strongest_quakes(spark, sf):
    return A.strongest_quakes(V.view(spark, sf, "fx_quakes"), "2024-01-03", "2024-01-25").select("earthquake_id", "magnitude", "time")


_WEIGHTS = "SELECT p_brand AS feature, round(sum(p_retailprice),4) AS importance FROM part GROUP BY 1"


@query(
    "rank_features",
    f"WITH w AS ({_WEIGHTS}) SELECT feature, importance, round(importance/(SELECT sum(importance) FROM w),9) AS share FROM w ORDER BY importance DESC, feature LIMIT 5",
)
def rank_features(spark, sf):
    w = V.table(spark, sf, "part").groupBy(F.col("p_brand").alias("feature")).agg(F.round(F.sum("p_retailprice"), 4).alias("importance"))
    return A.rank_features(w, top=5).withColumn("share", F.round("share", 9))


@query(
    "best_model",
    """SELECT round(rmse,6) AS rmse, model FROM (SELECT category AS model, sqrt(avg((target-estimate)*(target-estimate))) AS rmse FROM fx_scored GROUP BY 1)
    ORDER BY rmse, model LIMIT 1""",
)
def best_model(spark, sf):
    m = A.regression_metrics(V.view(spark, sf, "fx_scored"), "target", "estimate", ["category"])
    return A.best_model(m, name="category").select(F.round("rmse", 6).alias("rmse"), F.col("category").alias("model"))


def hash_sql(key: str, seed: int = 42) -> str:
    return f"('0x'||substr(sha256(cast({key} as varchar)||'|{seed}'),1,8))::bigint"


@query("audit_sample", f"SELECT doc_id, n_chars FROM documents WHERE {hash_sql('doc_id')}%100<5")
def audit_sample(spark, sf):
    return A.audit_sample(V.table(spark, sf, "documents").select("doc_id", "n_chars"), "doc_id")


@query(
    "quarantine_split",
    """SELECT reply_id, s AS score, CASE WHEN s>=3 THEN 'passed' ELSE 'quarantined' END AS verdict FROM
    (SELECT reply_id, try_cast(regexp_extract(judge_reply, '"score": ([0-9.]+)', 1) AS double) AS s FROM fx_replies)""",
)
def quarantine_split(spark, sf):
    from terrahaz.sources.sinks import quarantine_split as split

    score = F.regexp_extract("judge_reply", '"score": ([0-9.]+)', 1).try_cast("double")
    scored = V.view(spark, sf, "fx_replies").select("reply_id", score.alias("score"))
    good, bad = split(scored, "score")
    return good.withColumn("verdict", F.lit("passed")).unionByName(bad.withColumn("verdict", F.lit("quarantined")))


