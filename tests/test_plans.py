"""Plans: no nested-loop or cartesian joins, no Python on the row path, filters in the scan."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from terrahaz.functions import geometry as G
from terrahaz.operators import aggregate as A
from terrahaz.operators import clean as P
from terrahaz.operators import ordered as W
from terrahaz.operators import spatial as S
from terrahaz.plans import flows
from terrahaz.queries import views as V

QUERIES = entry.queries()
SPATIAL = ["land_mask", "land_mask_inner", "off_land", "event_neighborhood", "nearest_facility", "near_facility", "fact_hazard_events", "top_hazards", "fact_dim"]
PYTHON = {"batch_extract", "audit_flow", "audit_summary", "enrichment_udf", "export_collections"}


def plan(df) -> str:
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", 2000)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", SPATIAL)
def test_spatial_joins_are_equi_joins(name, spark, sf):
    text = plan(QUERIES[name](spark, sf))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("op", [S.land_mask, S.off_land, S.attach_polygon, S.land_mask_inner])
def test_large_masks_shuffle_instead_of_looping(op, spark, sf):
    text = plan(op(V.points(spark, sf), V.land(spark, sf), max_bytes=0))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_small_mask_does_not_shuffle_points(spark, sf):
    text = plan(S.attach_polygon(V.points(spark, sf), V.land(spark, sf)))
    points_side = text.split("BroadcastExchange")[0]
    assert "BroadcastHashJoin" in points_side and "Exchange hashpartitioning" not in points_side


@pytest.mark.parametrize("name", ["scalar", "silver", "gold"])
def test_no_python_on_the_row_path(name, spark, sf):
    from importlib import import_module

    module = import_module(f"terrahaz.queries.{name}")
    for key, fn in QUERIES.items():
        if getattr(module, key, None) is not None and key not in PYTHON:
            text = plan(fn(spark, sf))
            assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text and "InPandas" not in text, key


def test_filters_reach_the_scan(spark, sf):
    recent = plan(P.recent_events(V.table(spark, sf, "orders"), "1998-01-01", "o_orderdate"))
    assert "GreaterThanOrEqual(o_orderdate" in recent
    box = plan(P.in_bbox(V.table(spark, sf, "lineitem"), (0.01, 0.05, 0.0, 0.04), "l_discount", "l_tax"))
    assert "GreaterThanOrEqual(l_discount" in box and "LessThanOrEqual(l_tax" in box


def test_columns_are_pruned(spark, sf):
    text = plan(A.max_over_table(V.table(spark, sf, "lineitem"), "l_extendedprice"))
    assert "ReadSchema: struct<l_extendedprice:double>" in text


def test_top_k_is_not_a_full_sort(spark, sf):
    assert "TakeOrderedAndProject" in plan(A.latest_requests(V.view(spark, sf, "fx_311")))


def test_spatial_join_in_sql_is_an_equi_join(spark, sf):
    text = plan(QUERIES["sql_spatial_join"](spark, sf))
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text
    assert "HashJoin" in text or "SortMergeJoin" in text


def test_cover_in_sql_has_cells_of_the_shape_s_size(spark):
    """However many shapes there are, a point meets those near it."""
    flows.register_sql_functions(spark)
    text = '{"type":"Polygon","coordinates":[[[-74,40.7],[-73.995,40.7],[-73.995,40.704],[-74,40.704],[-74,40.7]]]}'
    row = spark.sql(f"""WITH s AS (SELECT st_polygon('{text}') AS g)
        SELECT st_level(g) AS level, size(st_cover(g, st_level(g))) AS cells, st_levels() AS levels FROM s""").first()
    assert row.level == 18 and row.cells <= 64 and row.level in row.levels


def test_collections_have_a_bounded_size(spark, tmp_path):
    from terrahaz.sources import readers, sinks

    features = spark.range(1000, numPartitions=1).select(sinks.feature_json(G.st_point(F.lit(1.0), F.lit(2.0)), {"id": F.col("id")}).alias("value"))
    sinks.export_collections(features, str(tmp_path / "many"), per_document=300)
    assert len(list((tmp_path / "many").glob("part-*"))) == 4
    got = readers.scan_geojson(spark, str(tmp_path / "many")).select(F.col("properties")["id"].cast("int")).collect()
    assert sorted(r[0] for r in got) == list(range(1000))


def test_a_range_takes_few_rows(spark):
    """What one task has to sort stays a small part of its memory."""
    ranged, several = W.assign_ranges(spark.range(4_500_000).withColumn("k", F.lit(1)), ["k"], ["id"])
    assert several and ranged.groupBy(W.RANGE).count().agg(F.max("count")).first()[0] <= 4_000_000


def test_spatial_join_in_sql_makes_each_cover_once(spark, sf):
    """The functions' arguments are not written into every use, where they would be made again for every cell."""
    df = QUERIES["sql_spatial_join"](spark, sf)
    assert df._jdf.queryExecution().optimizedPlan().toString().count("from_json") <= 12
