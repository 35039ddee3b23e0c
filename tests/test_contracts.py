"""Contracts on literal rows: cleaning, classification, gold, replies, sinks."""

import datetime
import json
import random

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import rows
from terrahaz.functions import classify as C
from terrahaz.functions import geometry as G
from terrahaz.operators import aggregate as A
from terrahaz.operators import clean as P
from terrahaz.operators import enrich as E
from terrahaz.operators import models as M
from terrahaz.operators import ordered as W
from terrahaz.plans import flows, gold
from terrahaz.session import scratch
from terrahaz.sources import feeds, readers, sinks

NOW = datetime.datetime(2026, 4, 27, 12)


# ------------------------------------------------------------------- cleaning


def test_coordinate_bounds(spark):
    inner = [(0.0, 0.0), (-33.5, 151.25), (64.1, -21.9), (12.5, 179.999)]
    outer = [(-90.5, 151.25), (64.1, 200.0), (151.25, -33.5)]
    df = spark.createDataFrame(inner + outer, "latitude double, longitude double")
    assert rows(P.valid_wgs84(df)) == sorted(inner, key=repr)
    edge = [(90.0, 180.0), (-90.0, -180.0), (90.0001, 0.0), (0.0, -180.0001), (float("nan"), 0.0), (None, 0.0)]
    assert P.valid_wgs84(spark.createDataFrame(edge, "latitude double, longitude double")).count() == 2


def test_resolver():
    assert P.resolve_column(["LAT", "x"], "latitude") == "LAT"
    assert P.resolve_column(["Latitude", "my_lat"], "latitude") == "Latitude"
    assert P.resolve_column(["start_lat", "end_lat"], "latitude") == "start_lat"
    assert P.resolve_column(["lng"], "longitude") == "lng" and P.resolve_column(["lon"], "longitude") == "lon"
    assert P.resolve_column(["a"], "description", required=False) is None
    with pytest.raises(ValueError, match="ambiguous"):
        P.resolve_column(["a_lat", "b_lat"], "latitude")
    with pytest.raises(ValueError, match="no latitude"):
        P.resolve_column(["a"], "latitude")


def test_drop_any_null(spark):
    kept = [(1, 2.5, "south"), (4, 0.0, "")]
    df = spark.createDataFrame([*kept, (2, None, "north"), (3, 7.5, None), (5, None, None)], "id int, depth double, zone string")
    assert rows(P.drop_missing(df, ["depth", "zone"])) == kept
    assert P.drop_missing(df, ["id"]).count() == 5


def test_canonical_accidents(spark):
    df = spark.createDataFrame([("T1", 40.7, -74.0, "2024-01-01", 3, "crash"), ("T2", None, -74.0, "2024-01-01", 2, "x")],
                               "ID string, Start_Lat double, Start_Lng double, Start_Time string, Severity int, Description string")
    out = P.canonical_accidents(df).collect()
    assert [(r.source, r.source_id, r.severity, r.description) for r in out] == [("us_accidents", "T1", 3.0, "crash")]
    assert out[0].geometry.lon == -74.0 and out[0].geometry.srid == 4326


def test_enforce_schema(spark):
    schema = T.StructType().add("a", "integer").add("b", "string")
    df = spark.createDataFrame([("1", "x"), ("no", "y")], "a string, c string")
    assert rows(P.enforce_schema(df, schema)) == [(1, None, 0), (None, None, 1)]
    with pytest.raises(ValueError):
        P.enforce_schema(df, schema, extra="reject")


def test_quality_flags(spark):
    df = spark.createDataFrame([(1.0, 1.0), (None, 1.0), (float("nan"), 1.0), (99.0, 1.0)], "latitude double, longitude double")
    flags = [r.data_quality_flag for r in P.flag_quality(df).collect()]
    assert flags == ["validated", "missing_coordinates", "not_a_number", "out_of_range"]


# ------------------------------------------------------------- classification


def test_category_and_priority_edges(spark):
    df = spark.createDataFrame([(None, None, 0.4), ("odd", 8.0, 0.7), ("odd", 7.0, 0.71), ("HAZMAT spill", None, 0.41)], "k string, s double, w double")
    got = df.select(C.map_category("k", "s"), C.priority_bucket("w")).collect()
    assert [tuple(r) for r in got] == [("medical", "LOW"), ("rescue", "MEDIUM"), ("medical", "HIGH"), ("hazmat", "MEDIUM")]


def test_scalar_edges(spark):
    df = spark.createDataFrame([("", None), (None, 0.15), (" a  b ", 0.7)], "t string, p double")
    got = df.select(C.token_count("t"), C.delay_severity("p"), C.hazard_from_complaint("t")).collect()
    assert [tuple(r) for r in got] == [(0, None, "rescue"), (0, "low", "rescue"), (2, "severe", "rescue")]


# ----------------------------------------------------------------------- gold


def test_dim_and_fact_contracts(spark):
    hoods = spark.createDataFrame([
        Row(neighborhood_id="N2", name="UES", county_fips="061", state_fips="36", geometry='{"type":"Polygon","coordinates":[[[0,0],[1,0],[1,1],[0,0]]]}', silver_updated=NOW),
        Row(neighborhood_id="N1", name="UWS", county_fips="061", state_fips="36", geometry="not json", silver_updated=NOW),
    ])
    dim = gold.dim_neighborhoods(hoods)
    assert rows(dim, "neighborhood_sk", "neighborhood_name") == [(1, "UWS"), (2, "UES")]
    infra = spark.createDataFrame([Row(facility_id="F1", name="Mt Sinai", facility_type="hospital", latitude=40.7, longitude=-73.9, address="a", silver_updated=NOW)])
    got = gold.dim_infrastructure(infra).first()
    assert (got.infrastructure_sk, got.facility_name) == (1, "Mt Sinai")
    accidents = spark.createDataFrame([Row(incident_id="A1", incident_description="Crash", latitude=40.7, longitude=-73.9, ai_severity=3.5, ai_hazard_type="accident", start_time=NOW)])
    quakes = spark.createDataFrame([Row(earthquake_id="E1", description="Quake", latitude=34.0, longitude=-118.0, ai_severity=4.2, ai_hazard_type="earthquake", time=NOW)])
    fact = gold.fact_hazard_events([
        gold.fact_part(accidents, "us_accidents", "incident_id", "incident_description", "start_time"),
        gold.fact_part(quakes, "usgs_earthquakes", "earthquake_id", "description", "time"),
    ])
    assert rows(fact, "source_system", "severity") == [("us_accidents", 3.5), ("usgs_earthquakes", 4.2)]
    assert fact.select("event_sk").distinct().count() == 2


def test_hazard_metrics_contract(spark):
    df = spark.createDataFrame([(1, "accident", 3.0), (1, "accident", 5.0), (2, "accident", 2.0)], "neighborhood_sk int, hazard_type string, severity double")
    assert rows(A.hazard_metrics(df)) == [(1, "accident", 2, 4.0, "accident"), (2, "accident", 1, 2.0, "accident")]


def test_counts_and_metrics_contracts(spark):
    s = spark.createDataFrame([("T001", 3), ("T002", 2), ("T003", 1), ("T004", 3)], "id string, severity int")
    assert rows(A.count_by(s, "severity")) == [(1, 1), (2, 1), (3, 2)]
    c = spark.createDataFrame(list(zip([1, 0, 1, 1, 0], [1, 0, 1, 0, 0])), "y int, p int")
    m = A.classification_metrics(c, "y", "p").first()
    assert (m.accuracy, m.precision, m.recall, m.f1) == (0.8, 1.0, 2 / 3, 0.8)
    r = A.regression_metrics(spark.createDataFrame(list(zip([1., 2., 3., 4., 5.], [1.1, 2.1, 2.9, 4.2, 4.8])), "y double, p double"), "y", "p").first()
    assert abs(r.mse - 0.022) < 1e-12 and r.r2 > 0.98
    none = A.classification_metrics(c.where("false"), "y", "p").first()
    assert (none.n, none.accuracy, none.f1_weighted) == (0, 0.0, 0.0)
    f = A.rank_features(spark.createDataFrame([("a", .1), ("b", .2), ("c", .3), ("d", .15), ("e", .25)], "feature string, importance double"))
    assert [x.feature for x in f.collect()] == ["c", "e", "b", "d", "a"] and abs(sum(x.share for x in f.collect()) - 1) < 1e-12


def test_merge_and_dedupe(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k int, t string, v int")
    new = spark.createDataFrame([(2, "B", None), (3, "c", 3)], "k int, t string, v int")
    assert rows(A.merge_records(old, new, ["k"])) == [(1, "a", 1), (2, "B", 2), (3, "c", 3)]
    df = spark.createDataFrame([(1, 5, "x"), (1, 7, "y"), (1, 7, "z"), (2, 1, "w")], "k int, t int, id string")
    assert rows(W.dedupe(df, ["k"], ["t", "id"])) == [(1, 7, "z"), (2, 1, "w")]


# -------------------------------------------------------------------- replies


def test_enrichment_replies(spark):
    cases = ['{"severity": 8, "hazard_type": "traffic"}', "not_json", '{"severity":"high","hazard_type":"traffic"}', '{"severity": 15, "hazard_type": "fire"}',
             '{"severity": 0, "hazard_type": "fire"}', None, "", "[1]", '{"severity": 7.9}', '{"severity": null, "hazard_type": null}']
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, t string").withColumn("p", E.parse_ai_enrichment("t"))
    got = [(r.p.ai_severity, r.p.ai_hazard_type) for r in df.orderBy("i").collect()]
    assert got == [(8, "traffic"), (5, "unknown"), (5, "traffic"), (10, "fire"), (1, "fire"), (5, "unknown"), (5, "unknown"), (5, "unknown"), (7, "unknown"), (5, "unknown")]


def test_hazard_arrays(spark):
    one = '[{"hazard_type":"a","description":"b","severity":"low"}]'
    cases = [one, f"Sure!\n{one}\nbye", '{"hazard_type":"a"}', "", None, "[]", "[{broken", '[{"hazard_type":"a"}, ']
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, t string")
    got = [r.n for r in df.select("i", F.size(E.parse_hazard_array("t")).alias("n")).orderBy("i").collect()]
    assert got[:6] == [1, 1, 0, 0, 0, 0] and all(n >= 0 for n in got)


def test_prompt_is_filled_once(spark):
    df = spark.createDataFrame([("say {{b}}", "x"), (None, "y")], "a string, b string")
    got = [r[0] for r in df.select(E.render_prompt("1 {{a}} 2 {{b}} 3", {"a": F.col("a"), "b": F.col("b")})).collect()]
    assert got == ["1 say {{b}} 2 x 3", "1  2 y 3"]


def test_failing_model_is_data(spark):
    def broken(prompts):
        raise RuntimeError("down")

    df = spark.createDataFrame([(1, "text"), (2, ""), (3, None)], "id int, t string")
    got = {r.id: r for r in E.batch_extract(df, "t", broken, "id").collect()}
    assert (got[1].status, got[1].extracted_hazards, got[1].error) == ("error", "[]", "down")
    assert got[2].status == got[3].status == "skipped"


def test_template_and_bad_replies(spark):
    def model(prompts):
        assert all(p.startswith("about: ") for p in prompts)
        return [None, {"response": "[]", "prompt_tokens": None}, {"response": '[{"hazard_type": "a", "location": "b"}]'}][: len(prompts)]

    df = spark.createDataFrame([(1, "t"), (2, "u"), (3, "v"), (4, "w"), (5, "  ")], "id int, t string").coalesce(1)
    got = {r.id: r for r in E.batch_extract(df, "t", model, "id", "about: {{x}}", "x").collect()}
    assert [got[i].status for i in (1, 2, 3, 4, 5)] == ["error", "success", "success", "error", "skipped"]
    assert json.loads(got[3].extracted_hazards) == [{"hazard_type": "a", "location": "b"}] and got[3].latency >= 0


def test_audit(spark):
    def judge(prompts):
        return [{"response": "nope" if "third" in p else '{"score": 0.25, "reasoning": "thin"}'} for p in prompts]

    df = spark.createDataFrame([(1, "first", "[]"), (2, "second", "[{"), (3, "third", "[]"), (4, "fourth", None)], "id int, t string, x string")
    got = {r.id: (r.judge_score, r.score, r.judge_reason, r.quarantined) for r in E.audit(df, "t", "x", judge, "id", percent=100).collect()}
    assert got == {
        1: (0.25, 2.0, "thin", True), 2: (0.0, 1.0, "prediction is not JSON", True),
        3: (0.0, 1.0, "judge reply is not JSON", True), 4: (0.0, 1.0, "prediction is not JSON", True)}


def test_extraction_checks(spark):
    full = '[{"hazard_type": "fire", "description": "smoke seen", "severity": "low"}]'
    part = '[{"hazard_type": "fire", "description": "smoke seen"}]'
    df = spark.createDataFrame([(1, "smoke was seen", full), (2, "smoke was seen", part), (3, "nothing", full), (4, "x", None), (5, "x", "[{")], "id int, s string, r string")
    got = {r.id: (r.c.valid_json, r.c.complete, r.c.is_accurate) for r in df.select("id", E.extraction_checks("s", "r").alias("c")).collect()}
    assert got == {1: (True, True, True), 2: (True, False, False), 3: (True, True, False), 4: (False, False, False), 5: (False, False, False)}


def test_judge_and_faithfulness(spark):
    df = spark.createDataFrame([("[]", '{"score": 4, "reasoning": "ok"}'), ("[{", '{"score": 4}'), ("[]", "nope")], "x string, r string")
    got = [(r.judge_score, r.judge_reason) for r in E.judge_rows(df, "x", "r").collect()]
    assert got == [(4.0, "ok"), (0.0, "prediction is not JSON"), (0.0, "judge reply is not JSON")]
    f = spark.createDataFrame([("Engine failure at noon", "engine FIRE failure")], "s string, c string").select(E.faithfulness("s", "c").alias("f")).first().f
    assert abs(f.faithfulness_score - 2 / 3) < 1e-12 and f.unsupported_claims == ["fire"]


def test_final_severity_words(spark):
    df = spark.createDataFrame([("critical", 1.0), (None, 12.0), (None, None), ("7", 1.0)], "a string, s double")
    assert [r[0] for r in df.select(E.final_severity("a", "s")).collect()] == [10, 10, 5, 7]


# -------------------------------------------------------------- feeds and sinks


def test_quake_feed(spark):
    doc = {"features": [
        {"id": "a", "properties": {"mag": 1.5, "place": "p", "time": 1700000000123, "url": "u"}, "geometry": {"coordinates": [-74.0, 40.7, 5.0]}},
        {"id": "b", "properties": {"mag": None}, "geometry": {"coordinates": [-74.0, 40.7]}},
        {"id": "c", "properties": {"mag": 2.0}, "geometry": {"coordinates": [-74.0]}},
        {"id": "d", "properties": {"mag": 2.0}},
    ]}
    out = feeds.flatten_quakes(spark.createDataFrame([(json.dumps(doc),), ("broken",), (None,)], "payload string")).collect()
    assert [(r.earthquake_id, r.depth_km, r.source) for r in out] == [("a", 5.0, "usgs")]


def test_empty_ingest_fails(spark):
    ok = spark.range(3)
    assert rows(feeds.ingest_inventory({"a": ok})) == [("TOTAL", 3), ("a", 3)]
    with pytest.raises(Exception, match="no rows ingested"):
        feeds.ingest_inventory({"a": ok, "b": ok.where("false")}).collect()


def test_read_layer_rejects_unknown_format(spark):
    with pytest.raises(ValueError, match="unsupported format"):
        readers.read_layer(spark, "shp", "/nowhere")


def test_rejects(spark):
    good = '{"features": []}'
    df = spark.createDataFrame([(good,), ("broken",), (None,), ('{"other": 1}',)], "payload string")
    got = sorted((r.payload or "", r.reason) for r in feeds.rejected(df, "quakes").collect())
    assert got == [("", "no payload"), ("broken", "not JSON"), ('{"other": 1}', "no list of features")]
    path = scratch(spark, "t-lines")
    lines = ['{"type": "Feature", "properties": {"a": "b"}, "geometry": {"type": "Point"}}', "broken", "", '{"type": "Point"}']
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(path)
    assert readers.scan_geojson_seq(spark, path).count() == 1
    assert sorted(r.line for r in readers.geojson_seq_rejects(spark, path).collect()) == ["broken", '{"type": "Point"}']


def test_layer_schema(spark):
    path = scratch(spark, "t-csv")
    spark.createDataFrame([("7", "x")], "a string, b string").write.option("header", "true").csv(path)
    assert readers.read_layer(spark, "csv", path, schema="a string, b string").first().a == "7"
    with pytest.raises(ValueError, match="own schema"):
        readers.read_layer(spark, "parquet", path, schema="a string")


def test_density_without_time(spark):
    from terrahaz.operators import aggregate as A

    df = spark.createDataFrame([(1, 0.1, 0.1, "2024-01-01"), (2, 0.2, 0.2, None), (3, None, 0.1, "2024-01-01")], "id int, longitude double, latitude double, t string")
    got = {r.id: (r.spatial_density, r.event_frequency) for r in A.spatial_density(df, 1.0, "t").collect()}
    assert got == {1: (2, 1), 2: (2, None), 3: (None, None)}


def test_feature_text(spark):
    df = spark.createDataFrame([("e1", "d", "fire", 4), ("e2", None, None, None)], "event_id string, event_description string, hazard_type string, severity int")
    text = flows.heatmap_export(df.withColumn("event_geometry", G.st_point(F.lit(-74.0), F.lit(40.5))))
    first, second = [json.loads(r.value) for r in text.collect()]
    assert first == {"type": "Feature", "geometry": {"type": "Point", "coordinates": [-74.0, 40.5]},
                     "properties": {"id": "e1", "category": "fire", "label": "Fire", "weight": 0.4, "description": "d"}}
    assert second["properties"]["category"] == "medical" and second["properties"]["weight"] is None


def test_versions_and_partitions(spark):
    path = scratch(spark, "t-versions")
    assert sinks.write_versioned(spark.range(3), path) == 1
    assert sinks.write_versioned(spark.range(5), path) == 2
    assert sinks.read_version(spark, path).count() == 5 and sinks.read_version(spark, path, 1).count() == 3
    part = scratch(spark, "t-part")
    df = spark.range(10).withColumn("f", F.col("id") % 2)
    assert sinks.write_partitioned(df, part, ["f"]) == 10
    assert sinks.write_partitioned(df, part, ["f"], mode="append") == 10
    assert spark.read.parquet(part).count() == 20


def test_quarantine_is_a_partition(spark):
    df = spark.createDataFrame([(1, 2.9), (2, 3.0), (3, None), (4, 5.0)], "id int, s double")
    good, bad = sinks.quarantine_split(df, "s")
    assert rows(good, "id") == [(2,), (4,)] and rows(bad, "id") == [(1,), (3,)]
    path = scratch(spark, "t-quarantine")
    sinks.write_quarantine(df, path, "s")
    assert rows(spark.read.parquet(path).groupBy("verdict").count()) == [("passed", 2), ("quarantined", 2)]


def test_run_metrics(spark):
    out, metrics = scratch(spark, "t-run"), scratch(spark, "t-metrics")
    figures = sinks.write_run_metrics(spark.range(10), out, metrics, "silver", F.col("id") > 7)
    assert (figures["records"], figures["errors"]) == (10.0, 2.0)
    assert spark.read.parquet(metrics).where("name='records'").first().value == 10.0


# --------------------------------------------------------------------- models


def test_models_beat_the_baseline_and_repeat(spark, sf):
    from terrahaz.queries import learning

    data = learning._training(spark, sf).cache()
    first = M.train(M.OVERPOP, data, "row_key", 5, 4).metrics.first()
    again = M.train(M.OVERPOP, data, "row_key", 5, 4).metrics.first()
    share = data.agg(F.avg("hospital_overpop")).first()[0]
    assert first.asDict() == again.asDict()
    assert first.accuracy > max(share, 1 - share) and first.auc > 0.9
    assert M.train(M.RESPONSE, data, "row_key", 5, 4).metrics.first().r2 > 0


def test_numeric_columns(spark):
    df = spark.createDataFrame([(1, 2.0, "x")], "a int, b double, c string")
    assert P.numeric_columns(df, ["zz"]) == ["a", "b"]
    assert P.numeric_columns(df, ["a", "b"], minimum=2) == ["a", "b"]


@pytest.mark.parametrize("indent,separators", [(None, (",", ":")), (None, (", ", ": ")), (2, None)])
def test_collection_in_several_tasks(spark, tmp_path, indent, separators):
    """One document, whatever its spacing, cut at feature borders by several tasks."""
    features = [{"type": "Feature", "properties": {"id": i, "note": 'a "Feature" { [' if i % 7 == 0 else None}, "geometry": None if i % 5 == 0 else
                 {"type": "Point", "coordinates": [i / 10, -i / 10]}} for i in range(3000)]
    document = {"type": "FeatureCollection", "name": "all", "features": features}
    (tmp_path / "all.json").write_text(json.dumps(document, indent=indent, separators=separators))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")
    try:
        got = readers.scan_geojson_split(spark, str(tmp_path)).select(
            F.col("properties")["id"].cast("int").alias("id"), F.col("properties")["note"].alias("note"), "geometry_type",
            F.spark_partition_id().alias("part")).collect()
        assert len({r.part for r in got}) > 3
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(r.id for r in got) == list(range(3000))
    assert all((r.note is not None) == (r.id % 7 == 0) and (r.geometry_type == "Point") == (r.id % 5 > 0) for r in got)


def test_collection_with_late_type_is_refused(spark, tmp_path):
    text = '{"type":"FeatureCollection","features":[{"type":"Feature","properties":{},"geometry":null},{"id":1,"type":"Feature","geometry":null}]}'
    (tmp_path / "odd.json").write_text(text)
    with pytest.raises(Exception, match="same member"):
        readers.scan_geojson_split(spark, str(tmp_path)).collect()
    assert readers.scan_geojson(spark, str(tmp_path)).count() == 2


def test_collections_in_a_stated_number_of_files(spark, tmp_path):
    rows_ = spark.range(500).select(sinks.feature_json(G.st_point(F.col("id") * 0.1, F.lit(1.0)), {"id": F.col("id")}).alias("value"))
    sinks.export_collections(rows_, str(tmp_path / "out"), files=4)
    made = [json.loads(p.read_text()) for p in (tmp_path / "out").glob("part-*")]
    assert len(made) == 4 and sum(len(m["features"]) for m in made) == 500
    sinks.export_collections(rows_.limit(0), str(tmp_path / "none"), files=2)
    assert readers.scan_geojson(spark, str(tmp_path / "none")).count() == 0


# -------------------------------------------------------------------- training


def _points(spark):
    rng = random.Random(5)
    data = [(i, rng.choice([0.0, 1.0, 2.5]), rng.gauss(0, 3), float(rng.randint(0, 60)), rng.random()) for i in range(3000)]
    df = spark.createDataFrame(data, "k long, a double, b double, c double, u double")
    noisy = F.col("a") + F.sin("b") * 2 + F.col("c") / 20
    return df.withColumn("y", noisy + F.col("u")).withColumn("hit", (noisy + F.col("u") * 2 > 4).cast("int")).drop("u").cache()


@pytest.mark.parametrize("kind, label", [("GBTRegressor", "y"), ("GBTClassifier", "hit")])
def test_boosted_fit_to_cells_is_fit_to_rows(spark, kind, label):
    """The same thresholds, node sizes and predictions as Spark ML's fit to the rows themselves."""
    spec, df = M.Spec("m", kind, label, 3, 4, ("a", "b", "c")), _points(spark)
    model = M.fit(spec, df)
    assert model.stages[-1].getWeightCol() == "__weight"
    rows_fit = Pipeline(stages=[VectorAssembler(inputCols=["a", "b", "c"], outputCol="features"), M.estimator(spec)]).fit(df)
    want = {r["k"]: r["prediction"] for r in rows_fit.transform(df).collect()}
    got = {r["k"]: r["prediction"] for r in M.predict(spec, model, df).collect()}
    assert got == pytest.approx(want, abs=1e-9)
    nodes = [M.node_table(spark, M.Trained(spec, m, None, None), scratch(spark, "ensemble")) for m in (model, rows_fit)]
    columns = ("tree", "node", "feature", "threshold", "left_child", "right_child")
    assert rows(nodes[0], *columns) == rows(nodes[1], *columns)


@pytest.mark.parametrize("kind, label", [("GBTRegressor", "y"), ("GBTClassifier", "hit")])
def test_boosted_rounds_read_each_cell_once(spark, monkeypatch, kind, label):
    """Cells of many rows are one row of a round, and nodes, importances and small leaves are those of the rows."""
    spec, seen = M.Spec("m", kind, label, 3, 6, ("a", "c")), []
    df = _points(spark).where("c > 10 or k % 40 = 0")  # leaves of one row would be worth splitting off
    if kind == "GBTRegressor":
        df = df.withColumn("y", F.col("a") + F.col("c").cast("int") / 7)
    assembled = VectorAssembler.transform
    monkeypatch.setattr(VectorAssembler, "transform", lambda self, x, *a: (seen.append(x), assembled(self, x, *a))[1])
    model = M.fit(spec, df)
    names = ["__bin_0", "__bin_1", *([label] if spec.is_classifier else [])]
    assert seen[0].count() == seen[0].select(*names).distinct().count() < df.count() / 4
    rows_fit = Pipeline(stages=[VectorAssembler(inputCols=["a", "c"], outputCol="features"), M.estimator(spec)]).fit(df)
    nodes = [M.node_table(spark, M.Trained(spec, m, None, None), scratch(spark, "ensemble")) for m in (model, rows_fit)]
    columns = ("tree", "node", "feature", "threshold", "left_child", "right_child", "n")
    assert rows(nodes[0], *columns) == rows(nodes[1], *columns)
    assert nodes[0].agg(F.min("n")).first()[0] >= M.MIN_PER_LEAF
    got = {r["feature"]: r["importance"] for r in M.importance_of_nodes(nodes[0], True).collect()}
    weights = model.stages[-1].featureImportances.toArray()
    assert got == pytest.approx({f: w for f, w in zip(("a", "c"), weights) if w}, abs=1e-9)


@pytest.mark.parametrize("n", [1, 2, 3, 4])
def test_boosted_fit_to_very_few_rows(spark, n):
    spec = M.Spec("m", "GBTRegressor", "y", 2, 3, ("a",))
    df = spark.createDataFrame([(float(i), 10.0 * i) for i in range(n)], "a double, y double")
    assert M.fit(spec, df).stages[-1].trees[0].numNodes == (3 if n == 4 else 1)


def test_cells_keep_every_row(spark):
    spec, df = M.Spec("m", "GBTClassifier", "hit", 2, 2, ("a", "b", "c")), _points(spark)
    twenty = df.withColumn("_", F.explode(F.sequence(F.lit(1), F.lit(20)))).drop("_")
    n = [M.cells(spec, x, M.binning(spec, df, 3000)) for x in (df, twenty)]
    assert n[0].count() == n[1].count() <= 3000  # no more rows to go through for twenty times the input
    for most in (None, 500, 9000, 60000):
        slices = M.in_slices(n[1], 60000, most)
        assert slices.agg(F.sum("__weight")).first()[0] == pytest.approx(60000)
        assert slices.count() <= (most or 0) + 2 * n[1].count()
    assert M.in_slices(n[1], 60000, 60000).where("__weight <> 1").isEmpty()


def test_forest_of_slices(spark, monkeypatch):
    """Beyond ``BAG_ROWS`` a forest is fitted to slices; it tells the classes about as well."""
    spec, df = M.Spec("m", "RandomForestClassifier", "hit", 20, 5, ("a", "b", "c")), _points(spark)
    share = []
    for most in (10_000, 1_000):
        monkeypatch.setattr(M, "BAG_ROWS", most)
        model = M.fit(spec, df)
        assert len(model.stages[-1].trees) == 20 and len(model.stages) == (2 if most == 10_000 else 3)
        share.append(M.predict(spec, model, df).where("prediction = hit").count() / 3000)
    assert min(share) > 0.85 and abs(share[0] - share[1]) < 0.05


def test_bin_edges():
    assert M.bin_edges(np.array([3.0, 1.0, 1.0, 2.0])) == [1.5, 2.5] and M.bin_edges(np.array([4.0, 4.0])) == []
    many = M.bin_edges(np.arange(3200.0))
    assert len(many) == 31 and many[0] == 99.5 and set(np.diff(many)) == {100.0}
    assert len(M.bin_edges(np.concatenate([np.zeros(5000), np.arange(100.0)]))) <= 31
