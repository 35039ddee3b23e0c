"""Scalar rules, each on a driver table."""

from __future__ import annotations

from pyspark.sql import functions as F

from terrahaz.functions import classify as C
from terrahaz.operators import features as M
from terrahaz.queries import views as V
from terrahaz.queries.registry import query


@query(
    "hazard_from_complaint",
    """SELECT request_id, CASE WHEN contains(complaint_type,'Noise') THEN 'medical' WHEN contains(complaint_type,'Parking') THEN 'rescue'
    WHEN contains(complaint_type,'Condition') THEN 'hazmat' ELSE 'rescue' END AS hazard_type FROM fx_311""",
)
def hazard_from_complaint(spark, sf):
    return V.view(spark, sf, "fx_311").select("request_id", C.hazard_from_complaint("complaint_type").alias("hazard_type"))


@query(
    "hazard_from_facility",
    """SELECT osm_id, CASE facility_type WHEN 'fire_station' THEN 'fire' WHEN 'hospital' THEN 'medical' WHEN 'clinic' THEN 'hazmat' ELSE 'medical' END AS hazard_type FROM fx_osm""",
)
def hazard_from_facility(spark, sf):
    return V.view(spark, sf, "fx_osm").select("osm_id", C.hazard_from_facility("facility_type").alias("hazard_type"))


@query(
    "const_enrichment",
    """SELECT feed, hazard_type, severity, count(*) AS n FROM (SELECT 'usgs_earthquakes' AS feed, 'fire' AS hazard_type, 5 AS severity FROM fx_quakes
    UNION ALL SELECT 'nyc_311', NULL, 5 FROM fx_311 UNION ALL SELECT 'osm_infrastructure', NULL, 7 FROM fx_osm) GROUP BY 1,2,3""",
)
def const_enrichment(spark, sf):
    parts = []
    for feed, name, hazard in (
        ("usgs_earthquakes", "fx_quakes", C.QUAKE_HAZARD), ("nyc_311", "fx_311", None), ("osm_infrastructure", "fx_osm", None)
    ):
        parts.append(V.view(spark, sf, name).select(
            F.lit(feed).alias("feed"), F.lit(hazard).cast("string").alias("hazard_type"), C.feed_severity(feed).alias("severity")
        ))
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("feed", "hazard_type", "severity").agg(F.count("*").alias("n"))


_KIND = "case o_orderkey%9 when 0 then 'Chemical leak' when 1 then 'FIRE' when 2 then 'hospital' when 3 then 'Safety' when 4 then null when 5 then 'flood' when 6 then 'asbestos' when 7 then 'clinic' else 'fire_station' end"
_SEV = "case o_orderkey%7 when 0 then null else cast(o_orderkey%11 as double) end"


@query(
    "map_category",
    f"""SELECT o_orderkey, c AS category, upper(c[1])||substr(c,2) AS label, CASE c WHEN 'fire' THEN '#ff0040' WHEN 'medical' THEN '#0080ff' WHEN 'hazmat' THEN '#ff8800' ELSE '#00ff80' END AS color FROM
    (SELECT o_orderkey, CASE WHEN regexp_matches(k,'hazmat|chemical|spill|asbestos') THEN 'hazmat' WHEN k='fire' OR k='fire_station' THEN 'fire'
     WHEN k IN ('hospital','medical','clinic') THEN 'medical' WHEN k IN ('safety','rescue','emergency') THEN 'rescue' WHEN s>7 THEN 'rescue' ELSE 'medical' END AS c
     FROM (SELECT o_orderkey, lower({_KIND}) AS k, {_SEV} AS s FROM orders))""",
)
def map_category(spark, sf):
    df = V.table(spark, sf, "orders").selectExpr("o_orderkey", f"{_KIND} AS k", f"{_SEV} AS s")
    df = df.withColumn("category", C.map_category("k", "s"))
    return df.select("o_orderkey", "category", C.category_label("category").alias("label"), C.category_color("category").alias("color"))


@query(
    "priority_bucket",
    """SELECT o_orderkey, CASE WHEN w>0.7::double THEN 'HIGH' WHEN w>0.4::double THEN 'MEDIUM' ELSE 'LOW' END AS priority, round(w*100) AS score,
    greatest(w*4,6.0::double) AS radius FROM (SELECT o_orderkey, (o_orderkey%21)/cast(10 as double) AS w FROM orders)""",
)
def priority_bucket(spark, sf):
    df = V.table(spark, sf, "orders").selectExpr("o_orderkey", "(o_orderkey%21)/cast(10 as double) AS w")
    return df.select("o_orderkey", C.priority_bucket("w").alias("priority"), C.score_percent("w").alias("score"), C.marker_radius("w").alias("radius"))


_RISK = "case c_custkey%4 when 0 then null when 1 then (c_custkey%100)/cast(100 as double) else cast(1+c_custkey%10 as double) end"


@query(
    "marker_class",
    f"""SELECT osm_id, CASE facility_type WHEN 'hospital' THEN 'HOSPITAL' WHEN 'fire_station' THEN 'FIRE' WHEN 'clinic' THEN 'HOSPITAL' WHEN 'police' THEN 'RESCUE' ELSE 'OTHER' END AS marker,
    CASE facility_type WHEN 'fire_station' THEN 12.0::double WHEN 'pharmacy' THEN 4.0::double ELSE 10.0::double END AS radius,
    CASE WHEN facility_type<>'fire_station' THEN true WHEN r IS NULL THEN false WHEN r<=1 THEN r>0.5::double ELSE r>5 END AS shown
    FROM (SELECT o.*, {_RISK} AS r FROM fx_osm o JOIN customer c ON c.c_custkey=o.osm_id)""",
)
def marker_class(spark, sf):
    df = V.view(spark, sf, "fx_osm").withColumn("r", F.expr(_RISK.replace("c_custkey", "osm_id")))
    m = C.marker_class("facility_type", "r")
    return df.select("osm_id", m["class"].alias("marker"), m["radius"].alias("radius"), m["shown"].alias("shown"))


@query(
    "severity_ramp",
    "SELECT ID, (Severity-1)/9.0::double AS factor, 1.0::double AS red, 1.0::double-(Severity-1)/9.0::double AS green, Severity*15.0::double AS strength FROM fx_accidents",
)
def severity_ramp(spark, sf):
    df = V.view(spark, sf, "fx_accidents").withColumn("r", C.severity_ramp("Severity"))
    return df.select("ID", "r.factor", "r.red", "r.green", "r.strength")


@query(
    "complaint_severity",
    "SELECT request_id, CASE WHEN regexp_matches(lower(complaint_type),'fire|safety|emergency') THEN 4 WHEN regexp_matches(lower(complaint_type),'noise|construction') THEN 3 ELSE 2 END AS severity FROM fx_311",
)
def complaint_severity(spark, sf):
    return V.view(spark, sf, "fx_311").select("request_id", C.complaint_severity("complaint_type").alias("severity"))


_P = "case event_id%13 when 0 then null else (event_id%101)/cast(100 as double) end"


@query(
    "delay_severity",
    f"""SELECT event_id, CASE WHEN p IS NULL THEN NULL WHEN p<0.15::double THEN 'none' WHEN p<0.30::double THEN 'low' WHEN p<0.50::double THEN 'medium' WHEN p<0.70::double THEN 'high' ELSE 'severe' END AS severity
    FROM (SELECT event_id, {_P} AS p FROM events)""",
)
def delay_severity(spark, sf):
    df = V.table(spark, sf, "events").selectExpr("event_id", f"{_P} AS p")
    return df.select("event_id", C.delay_severity("p").alias("severity"))


@query(
    "flight_risk",
    f"""SELECT event_id, CASE WHEN p<0.30::double THEN 'low' WHEN p<0.50::double THEN 'medium' WHEN p>=0.50::double THEN 'high' END AS risk
    FROM (SELECT event_id, {_P} AS p FROM events)""",
)
def flight_risk(spark, sf):
    df = V.table(spark, sf, "events").selectExpr("event_id", f"{_P} AS p")
    return df.select("event_id", C.flight_risk("p").alias("risk"))


_SCORE = """(CASE WHEN wind_speed_mph>20 THEN 1 ELSE 0 END)*0.3::double+(CASE WHEN visibility_miles<3 THEN 1 ELSE 0 END)*0.3::double
 +(CASE WHEN precipitation_in>0.1::double THEN 1 ELSE 0 END)*0.25::double+(CASE WHEN temperature_f<32 THEN 1 ELSE 0 END)*0.15::double"""


@query(
    "delay_score",
    f"SELECT obs_id, s AS score, CASE WHEN s>0.3::double THEN 1 ELSE 0 END AS delay, cast(trunc(s*120) as int) AS minutes FROM (SELECT obs_id, {_SCORE} AS s FROM fx_weather)",
)
def delay_score(spark, sf):
    df = V.view(spark, sf, "fx_weather").withColumn(
        "score", C.delay_score("wind_speed_mph", "visibility_miles", "precipitation_in", "temperature_f")
    )
    return df.select("obs_id", "score", C.is_delay("score").alias("delay"), C.delay_minutes("score").alias("minutes"))


@query(
    "carrier_code",
    "SELECT flight_id, CASE substr(callsign,1,3) WHEN 'AAL' THEN 1 WHEN 'UAL' THEN 2 WHEN 'DAL' THEN 3 WHEN 'JBU' THEN 4 WHEN 'SWA' THEN 5 ELSE 0 END AS code FROM fx_flights",
)
def carrier_code(spark, sf):
    return V.view(spark, sf, "fx_flights").select("flight_id", C.carrier_code("callsign").alias("code"))


@query(
    "night_weekend",
    "SELECT flight_id, CASE WHEN extract(hour FROM ts) BETWEEN 6 AND 19 THEN 0 ELSE 1 END AS is_night, CASE WHEN isodow(ts)>=6 THEN 1 ELSE 0 END AS is_weekend FROM fx_flights",
)
def night_weekend(spark, sf):
    return V.view(spark, sf, "fx_flights").select("flight_id", C.is_night("ts").alias("is_night"), C.is_weekend("ts").alias("is_weekend"))


@query(
    "unit_convert",
    "SELECT event_id, round(value*9/5+32,6) AS fahrenheit, round(value*2.237::double,6) AS mph FROM events",
)
def unit_convert(spark, sf):
    return V.table(spark, sf, "events").select(
        "event_id", F.round(C.celsius_to_fahrenheit("value"), 6).alias("fahrenheit"), F.round(C.mps_to_mph("value"), 6).alias("mph")
    )


@query(
    "epoch_to_ts",
    "SELECT event_id, date_trunc('millisecond', ts) AS from_ms, date_trunc('second', ts) AS from_s FROM events",
)
def epoch_to_ts(spark, sf):
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    s = F.unix_seconds(F.col("ts").cast("timestamp"))
    return V.table(spark, sf, "events").select(
        "event_id", C.epoch_ms_to_ts(ms).cast("timestamp_ntz").alias("from_ms"), C.epoch_s_to_ts(s).cast("timestamp_ntz").alias("from_s")
    )


@query(
    "normalize_features",
    """SELECT obs_id, round((temperature_f-50)/30,9) AS temperature_normalized, humidity_pct/100 AS humidity_normalized, wind_speed_mph/20 AS wind_normalized,
    0.4::double AS flight_velocity FROM fx_weather""",
)
def normalize_features(spark, sf):
    df = M.normalize_features(V.view(spark, sf, "fx_weather"))
    return df.select("obs_id", F.round("temperature_normalized", 9).alias("temperature_normalized"), "humidity_normalized", "wind_normalized", "flight_velocity")


@query("clip", "SELECT event_id, CASE WHEN event_id%5=0 THEN NULL WHEN value<3 THEN 3.0::double WHEN value>25 THEN 25.0::double ELSE value END AS clipped FROM events")
def clip(spark, sf):
    df = V.table(spark, sf, "events").selectExpr("event_id", "case when event_id%5=0 then null else value end AS v")
    return df.select("event_id", C.clip("v", 3.0, 25.0).alias("clipped"))


@query(
    "text_prep",
    """SELECT doc_id, lower(trim(source)) AS source, len(list_filter(regexp_split_to_array(text,'\\s+'), lambda x: x<>'')) AS n_tokens,
    substr(trim(lang),1,1) AS initial, upper(lang[1])||substr(lang,2) AS capitalized FROM documents""",
)
def text_prep(spark, sf):
    return V.table(spark, sf, "documents").select(
        "doc_id", F.lower(F.trim("source")).alias("source"), C.token_count("text").cast("bigint").alias("n_tokens"),
        F.substring(F.trim("lang"), 1, 1).alias("initial"), F.initcap("lang").alias("capitalized"),
    )


@query("contains_ci", "SELECT osm_id, coalesce(facility_type ILIKE '%HOSP%', false) AS found FROM fx_osm")
def contains_ci(spark, sf):
    return V.view(spark, sf, "fx_osm").select("osm_id", C.contains_ci("facility_type", "Hosp").alias("found"))


@query("json_build", """SELECT osm_id, '{"id":'||osm_id||',"tags":["'||facility_type||'","'||operator||'"]}' AS body FROM fx_osm""")
def json_build(spark, sf):
    body = F.to_json(F.struct(F.col("osm_id").alias("id"), F.array("facility_type", "operator").alias("tags")))
    return V.view(spark, sf, "fx_osm").select("osm_id", body.alias("body"))


@query("first_of", "SELECT o_orderkey, coalesce(nullif(a,''),nullif(b,''),'none') AS picked FROM (SELECT o_orderkey, CASE o_orderkey%3 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE o_orderpriority END AS a, CASE o_orderkey%2 WHEN 0 THEN '' ELSE o_orderstatus END AS b FROM orders)")
def first_of(spark, sf):
    df = V.table(spark, sf, "orders").selectExpr(
        "o_orderkey", "CASE o_orderkey%3 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE o_orderpriority END AS a",
        "CASE o_orderkey%2 WHEN 0 THEN '' ELSE o_orderstatus END AS b",
    )
    return df.select("o_orderkey", C.first_of("a", "b", F.lit("none")).alias("picked"))
