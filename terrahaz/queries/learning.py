"""Features, labels, training at the published sizes, and scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from terrahaz.functions import classify as C
from terrahaz.operators import aggregate as A
from terrahaz.operators import features as M
from terrahaz.operators import models as T
from terrahaz.operators import ordered as W
from terrahaz.queries import views as V
from terrahaz.queries.gold import sparse_tables
from terrahaz.queries.registry import query
from terrahaz.queries.rollups import hash_sql
from terrahaz.session import scratch


def _key():
    return F.coalesce(
        "earthquake_id", F.concat(F.lit("r"), "request_id"), F.concat(F.lit("o"), "osm_id"), F.concat(F.lit("w"), "obs_id"),
        F.concat(F.lit("f"), "flight_id"),
    ).alias("row_key")


#: Cell size of the density features, in degrees.
DENSITY_CELL = 0.05


def stacked(spark, sf):
    """All sources in one table, with the events in each row's cell and in its cell on its day."""
    rows = A.union_sparse(sparse_tables(spark, sf)).select("*", _key(), F.coalesce("time", "created_date", "ts").alias("at"))
    return A.spatial_density(rows, DENSITY_CELL, "at").drop("cx", "cy", "day")


V.SQL_VIEWS["fx_stack"] = """SELECT earthquake_id AS row_key, 'usgs_earthquakes' AS data_source, latitude, longitude, magnitude, NULL::varchar AS complaint_type, NULL::varchar AS borough,
 NULL::varchar AS facility_type, NULL::double AS temperature_f, NULL::double AS humidity_pct, NULL::double AS wind_speed_mph, NULL::double AS velocity_mps, longitude, time AS moment FROM fx_quakes
 UNION ALL SELECT 'r'||request_id, '311_requests', latitude, longitude, NULL, complaint_type, borough, NULL, NULL, NULL, NULL, NULL, longitude, created_date FROM fx_311
 UNION ALL SELECT 'o'||osm_id, 'osm', latitude, longitude, NULL, NULL, NULL, facility_type, NULL, NULL, NULL, NULL, longitude, NULL FROM fx_osm
 UNION ALL SELECT 'w'||obs_id, 'nyc_weather', NULL, NULL, NULL, NULL, borough, NULL, temperature_f, humidity_pct, wind_speed_mph, NULL, NULL, ts FROM fx_weather
 UNION ALL SELECT 'f'||flight_id, 'nyc_flights', latitude, longitude, NULL, NULL, borough, NULL, NULL, NULL, NULL, velocity_mps, longitude, ts FROM fx_flights"""
_BOROUGH = "CASE upper(borough) WHEN 'BROOKLYN' THEN 1 WHEN 'QUEENS' THEN 2 WHEN 'BRONX' THEN 3 WHEN 'STATEN ISLAND' THEN 4 ELSE 0 END"
_COMPLAINT = """CASE WHEN regexp_matches(lower(coalesce(complaint_type,'')),'fire|safety|emergency') THEN 4
 WHEN regexp_matches(lower(coalesce(complaint_type,'')),'noise|construction') THEN 3 ELSE 2 END"""


@query(
    "hazard_features",
    f"""SELECT row_key, round(coalesce((latitude-40.5)/0.5,0),9)::double AS lat_normalized, round(coalesce((longitude+74.3)/0.6::double,0),9)::double AS lon_normalized,
    coalesce(magnitude,0) AS earthquake_magnitude, round(coalesce((temperature_f-50)/30,0),9) AS temperature_normalized, coalesce(humidity_pct,50)/100 AS humidity_normalized,
    coalesce(wind_speed_mph,5)/20 AS wind_normalized, coalesce(velocity_mps,200)/500 AS flight_velocity, (data_source='311_requests')::int AS is_311,
    coalesce(facility_type='hospital',false)::int AS is_hospital, (data_source='usgs_earthquakes')::int AS is_earthquake, (data_source='nyc_flights')::int AS is_flight,
    (data_source='nyc_weather')::int AS is_weather, {_COMPLAINT} AS complaint_severity, {_BOROUGH} AS borough_encoded,
    CASE WHEN latitude IS NULL THEN 1.0::double ELSE count(*) OVER (PARTITION BY floor(longitude/0.05::double), floor(latitude/0.05::double)) END AS spatial_density,
    CASE WHEN latitude IS NULL OR moment IS NULL THEN 1.0::double
    ELSE count(*) OVER (PARTITION BY floor(longitude/0.05::double), floor(latitude/0.05::double), moment::date) END AS event_frequency FROM fx_stack""",
)
def hazard_features(spark, sf):
    df = M.hazard_features(stacked(spark, sf))
    rounded = {c: F.round(c, 9) for c in ("lat_normalized", "lon_normalized", "temperature_normalized")}
    return df.withColumns(rounded).select("row_key", *M.HAZARD_FEATURES)


@query(
    "hazard_labels",
    f"""SELECT row_key, ((coalesce(temperature_f,60)>80)::int+(coalesce(temperature_f,60)>75 AND coalesce(humidity_pct,50)<40)::int+(coalesce(wind_speed_mph,5)>15)::int
    +coalesce(facility_type='hospital',false)::int*0.5>=2)::int AS fire_risk,
    ((data_source='311_requests')::int+({_BOROUGH})/4.0+({_COMPLAINT})/4.0>=1)::int AS hospital_overpop,
    round(CASE WHEN latitude IS NULL THEN NULL ELSE least(greatest(5+abs(latitude-40.75::double)*30,3),25) END,6) AS response_time FROM fx_stack""",
)
def hazard_labels(spark, sf):
    df = M.hazard_labels(M.hazard_features(stacked(spark, sf)))
    return df.select("row_key", "fire_risk", "hospital_overpop", F.round("response_time", 6).alias("response_time"))


def _training(spark, sf):
    """Features with labels; bed demand and ambulance calls are computed from the rows."""
    df = M.hazard_labels(M.hazard_features(stacked(spark, sf)), noise_key="row_key")
    bed = C.clip(F.lit(30.0) + F.col("earthquake_magnitude") * 10 + F.col("complaint_severity") * 4, 10.0, 80.0)
    calls = C.clip(F.lit(8.0) + F.col("wind_normalized") * 6 + F.col("is_311") * 3, 2.0, 30.0)
    return df.withColumns({"bed_demand": bed, "ambulance_calls": calls}).select(
        "row_key", *M.HAZARD_FEATURES, "fire_risk", "hospital_overpop", "response_time", "bed_demand", "ambulance_calls"
    )


def _report_sql(spec: T.Spec, source: str, key: str, label: str, split: str | None = None) -> str:
    """Rows of both sides and held-out positives, from the definition of label and split."""
    positives = f"count_if(is_test AND {label}=1)" if spec.is_classifier else "NULL::bigint"
    return f"""SELECT '{spec.name}' AS model, {spec.trees}::int AS trees, {spec.depth}::int AS depth, count_if(NOT is_test)::bigint AS train_rows,
    count_if(is_test)::bigint AS test_rows, {positives}::bigint AS test_positives, true AS beats_constant
    FROM (SELECT *, {split or f"coalesce({hash_sql(key)}%100<20, false)"} AS is_test FROM ({source})) WHERE {label} IS NOT NULL"""


_LABELED = f"""SELECT row_key, ((coalesce(temperature_f,60)>80)::int+(coalesce(temperature_f,60)>75 AND coalesce(humidity_pct,50)<40)::int
 +(coalesce(wind_speed_mph,5)>15)::int+coalesce(facility_type='hospital',false)::int*0.5>=2)::int AS fire_risk,
 ((data_source='311_requests')::int+({_BOROUGH})/4.0+({_COMPLAINT})/4.0>=1)::int AS hospital_overpop, latitude AS response_time, 1 AS bed_demand, 1 AS ambulance_calls FROM fx_stack"""


def _train_query(name: str, spec: T.Spec) -> None:
    def run(spark, sf):
        return T.report(T.train(spec, _training(spark, sf), "row_key"))

    run.__name__ = name
    query(name, _report_sql(spec, _LABELED, "row_key", spec.label))(run)


_train_query("train_fire_risk", T.FIRE_RISK)
_train_query("train_overpop", T.OVERPOP)
_train_query("train_response", T.RESPONSE)
_train_query("train_bed_demand", T.BED_DEMAND)
_train_query("train_ambulance", T.AMBULANCE)

_WEATHER = ["temperature_f", "humidity_pct", "wind_speed_mph", "wind_direction_deg", "visibility_miles", "ceiling_ft", "precipitation_in"]


def delay_table(spark, sf):
    joined = W.asof_join(V.view(spark, sf, "fx_flights"), V.view(spark, sf, "fx_weather"), ["borough"], "ts", "ts", _WEATHER)
    return M.delay_features(joined)


@query(
    "delay_features",
    """SELECT f.flight_id AS flight_id, w.temperature_f AS temperature_f, w.ceiling_ft AS ceiling_ft, f.distance_nm AS route_distance_nm,
    (extract(hour FROM f.ts) NOT BETWEEN 6 AND 19)::int AS is_night,
    coalesce((w.wind_speed_mph>20)::int,0)*0.3::double+coalesce((w.visibility_miles<3)::int,0)*0.3::double+coalesce((w.precipitation_in>0.1::double)::int,0)*0.25::double
    +coalesce((w.temperature_f<32)::int,0)*0.15::double AS delay_score FROM fx_flights f ASOF LEFT JOIN fx_weather w ON f.borough=w.borough AND f.ts>=w.ts""",
)
def delay_features(spark, sf):
    return delay_table(spark, sf).select("flight_id", "temperature_f", "ceiling_ft", "route_distance_nm", "is_night", "delay_score")


_FLIGHT_DELAY = """SELECT flight_id, (coalesce((w.wind_speed_mph>20)::int,0)*0.3::double+coalesce((w.visibility_miles<3)::int,0)*0.3::double
 +coalesce((w.precipitation_in>0.1::double)::int,0)*0.25::double+coalesce((w.temperature_f<32)::int,0)*0.15::double>0.3::double)::int AS delay, 1 AS total_delay_minutes
 FROM fx_flights f ASOF LEFT JOIN fx_weather w ON f.borough=w.borough AND f.ts>=w.ts"""


@query("train_delay", _report_sql(T.DELAY, _FLIGHT_DELAY, "flight_id", "delay"))
def train_delay(spark, sf):
    return T.report(T.train(T.DELAY, delay_table(spark, sf), "flight_id"))


def _minutes_table(spark, sf):
    minutes = F.col("delay_score") * 120 + M.noise(F.col("flight_id"), 7, 3.0)
    return delay_table(spark, sf).withColumn("total_delay_minutes", minutes)


@query(
    "train_delay_minutes",
    f"""SELECT *, true AS one_is_best FROM ({_report_sql(T.DELAY_MINUTES_FOREST, _FLIGHT_DELAY, "flight_id", "total_delay_minutes")}
    UNION ALL {_report_sql(T.DELAY_MINUTES_BOOSTED, _FLIGHT_DELAY, "flight_id", "total_delay_minutes")})""",
)
def train_delay_minutes(spark, sf):
    runs, best = T.train_delay_minutes(_minutes_table(spark, sf), "flight_id", M.DELAY_FEATURES)
    both = T.report(runs[0]).unionByName(T.report(runs[1]))
    names = [F.lit(r.spec.name) for r in runs]
    return both.crossJoin(best.agg((F.count_if(F.col("model").isin(*names)) == 1).alias("one_is_best")))  # one row


_LINES = "SELECT cast(l_quantity>25 as int) AS target FROM lineitem"
#: The stratified split takes floor(0.2 n) rows of each label, whichever they are.
_CUT = "row_number() OVER (PARTITION BY target) <= floor(count(*) OVER (PARTITION BY target)*0.2)"


@query(
    "train_binary_pair",
    f"""SELECT * EXCLUDE (beats_constant) FROM ({_report_sql(T.PAIR_FOREST, _LINES, '', 'target', _CUT)}
    UNION ALL {_report_sql(T.PAIR_BOOSTED, _LINES, '', 'target', _CUT)})""",
)
def train_binary_pair(spark, sf):
    """No comparison with the constant: these columns do not tell the quantity, so neither model need win."""
    df = V.table(spark, sf, "lineitem").selectExpr(
        "xxhash64(*) AS k", "l_extendedprice", "l_discount", "l_tax", "cast(l_quantity>25 as int) AS target"
    )
    forest, boosted = T.train_binary_pair(df, "k", ["l_extendedprice", "l_discount", "l_tax"])
    return T.report(forest).unionByName(T.report(boosted)).drop("beats_constant")


@query(
    "score_delays",
    """SELECT flight_id, callsign, latitude, longitude, p AS delay_probability, cast(trunc(p*120) as int) AS estimated_delay_mins,
    CASE WHEN p<0.15::double THEN 'none' WHEN p<0.30::double THEN 'low' WHEN p<0.50::double THEN 'medium' WHEN p<0.70::double THEN 'high' ELSE 'severe' END AS delay_severity
    FROM (SELECT *, floor(1000/(1+exp(-(velocity_mps-20)/10)))/1000 AS p FROM fx_flights)""",
)
def score_delays(spark, sf):
    """A fixed logistic scorer in the model's place."""
    p = F.floor(F.lit(1000.0) / (F.lit(1.0) + F.exp(-(F.col("velocity_mps") - 20) / 10))) / F.lit(1000.0)
    return T.score_delays(V.view(spark, sf, "fx_flights"), p)


@query("score_delays_model")
def score_delays_model(spark, sf):
    table = delay_table(spark, sf).fillna(0, subset=M.DELAY_FEATURES)
    model = T.fit(T.DELAY, table)
    scored = T.predict(T.DELAY, model, table)
    return T.score_delays(scored, "probability")


@query("feature_importance")
def feature_importance(spark, sf):
    return T.feature_importance(spark, T.train(T.DELAY, delay_table(spark, sf), "flight_id"))


@query(
    "score_nodes",
    """SELECT f.flight_id AS flight_id, 'boosted' AS model, true AS as_fitted FROM fx_flights f
    UNION ALL SELECT flight_id, 'forest', true FROM fx_flights""",
)
def score_nodes(spark, sf):
    """Every flight scored from the written node tables of a boosted model and of a forest, by expressions, beside the
    fitted models."""
    table = delay_table(spark, sf).fillna(0, subset=M.DELAY_FEATURES)
    out = None
    for name, spec in (("boosted", T.DELAY), ("forest", T.Spec("delay_forest", "RandomForestClassifier", T.DELAY.label, 20, 5, T.DELAY.features))):
        trained = T.train(spec, table, "flight_id", trees=20)
        path = scratch(spark, "nodes")
        T.node_table(spark, trained, scratch(spark, "ensemble")).write.parquet(path)
        fitted = T.predict(spec, trained.model, table).select("flight_id", "probability")
        scored = T.score_nodes(spark.read.parquet(path), table, list(spec.features), spec.depth, name == "boosted", True)
        both = scored.select("flight_id", "score").join(fitted, "flight_id")
        part = both.select("flight_id", F.lit(name).alias("model"), (F.abs(F.col("score") - F.col("probability")) < 1e-9).alias("as_fitted"))
        out = part if out is None else out.unionByName(part)
    return out


@query("importance_of_nodes", "SELECT 'boosted' AS model, 1.0::double AS total, true AS as_fitted UNION ALL SELECT 'forest', 1.0::double, true")
def importance_of_nodes(spark, sf):
    """Importances from the gains in the node tables, beside those of the fitted models."""
    table, out = delay_table(spark, sf).fillna(0, subset=M.DELAY_FEATURES), None
    for name, spec in (("boosted", T.DELAY), ("forest", T.Spec("delay_forest", "RandomForestClassifier", T.DELAY.label, 20, 5, T.DELAY.features))):
        trained = T.train(spec, table, "flight_id", trees=20)
        own = T.importance_of_nodes(T.node_table(spark, trained, scratch(spark, "ensemble")), name == "boosted")
        both = T.feature_importance(spark, trained).withColumnRenamed("importance", "fitted").join(own, "feature", "left").fillna(0.0, subset=["importance"])
        part = both.agg(F.round(F.sum("importance"), 9).alias("total"), (F.max(F.abs(F.col("importance") - F.col("fitted"))) < 1e-9).alias("as_fitted"))
        part = part.select(F.lit(name).alias("model"), "total", "as_fitted")
        out = part if out is None else out.unionByName(part)
    return out


@query("run_log")
def run_log(spark, sf):
    path, model_path = scratch(spark, "runs"), scratch(spark, "model")
    trained = T.train(T.RESPONSE, _training(spark, sf), "row_key")
    T.run_log(spark, trained, path, model_path)
    return spark.read.parquet(path).select("model", "kind", "name", "text", "value")


@query(
    "delay_geojson",
    """SELECT flight_id, round(p,3) AS delay_probability, cast(trunc(p*120) as bigint) AS minutes FROM (SELECT flight_id, floor(1000/(1+exp(-(velocity_mps-20)/10)))/1000 AS p FROM fx_flights)""",
)
def delay_geojson(spark, sf):
    from terrahaz.sources.sinks import delay_features as as_features

    text = as_features(score_delays(spark, sf))
    return text.select(
        F.get_json_object("value", "$.properties.flight_id").cast("bigint").alias("flight_id"),
        F.get_json_object("value", "$.properties.delay_probability").cast("double").alias("delay_probability"),
        F.get_json_object("value", "$.properties.estimated_delay_mins").cast("bigint").alias("minutes"),
    )
