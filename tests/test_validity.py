"""Validity of polygons: named cases, and long rings with one planted fault."""

import json
import math
import random

import pytest
from pyspark.sql import functions as F

from terrahaz.functions import geometry as G
from terrahaz.operators import spatial as S
from terrahaz.operators.validity import validity

SQUARE = [[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]]


def box(x, y, w, h=None):
    h = w if h is None else h
    return [[x, y], [x + w, y], [x + w, y + h], [x, y + h], [x, y]]


CASES = {
    "square": ([[SQUARE]], []),
    "turned square": ([[SQUARE[::-1]]], []),
    "position twice": ([[[[0, 0], [0, 0], [4, 0], [4, 4], [4, 4], [0, 4], [0, 0]]]], []),
    "corner on a straight line": ([[[[0, 0], [2, 0], [4, 0], [4, 4], [0, 0]]]], []),
    "bow tie": ([[[[0, 0], [4, 4], [4, 0], [0, 4], [0, 0]]]], ["self intersection"]),
    "spike": ([[[[0, 0], [4, 0], [6, 0], [4, 0], [4, 4], [0, 0]]]], ["self intersection"]),
    "there and back": ([[[[0, 0], [4, 0], [0, 0], [4, 0], [0, 0]]]], ["self intersection"]),
    "touches itself": ([[[[0, 0], [4, 0], [2, 2], [4, 4], [0, 4], [2, 2], [0, 0]]]], ["self intersection"]),
    "hole": ([[SQUARE, box(1, 1, 1)]], []),
    "hole touching in a point": ([[SQUARE, [[0, 2], [1, 1], [1, 3], [0, 2]]]], []),
    "hole along the shell": ([[SQUARE, box(1, 0, 1)]], ["rings cross"]),
    "hole over the shell": ([[SQUARE, box(3, 1, 2)]], ["hole outside shell", "rings cross"]),
    "hole elsewhere": ([[SQUARE, box(10, 10, 1)]], ["hole outside shell"]),
    "holes that cross": ([[SQUARE, box(1, 1, 1), box(1.5, 1.5, 1)]], ["rings cross"]),
    "two parts": ([[SQUARE], [box(5, 5, 1)]], []),
    "part in a hole": ([[SQUARE, box(1, 1, 2)], [box(1.5, 1.5, 0.5)]], []),
    "part in a part": ([[SQUARE], [box(1, 1, 1)]], ["parts overlap"]),
    "parts that cross": ([[SQUARE], [box(3, 3, 3)]], ["parts overlap", "rings cross"]),
    "open": ([[SQUARE[:-1]]], ["structure"]),
    "empty": ([], ["structure"]),
    "out of range": ([[box(179, 0, 5)]], ["structure"]),
}


@pytest.mark.parametrize("size", [1.0, 1e-5, 7.0])
def test_cases(spark, size):
    def at(shape):
        return [[[[x * size, y * size] for x, y in ring] for ring in part] for part in shape]

    rows = [(name, json.dumps({"type": "MultiPolygon", "coordinates": at(shape)})) for name, (shape, _) in CASES.items() if size == 1.0 or name != "out of range"]
    df = spark.createDataFrame([*rows, ("null", None)], "name string, t string").withColumn("g", G.polygon_from_geojson("t"))
    got = {r.name: (r.is_valid, r.reasons) for r in validity(df, "name", "g").collect()}
    want = {name: (not CASES[name][1], CASES[name][1]) for name, _ in rows} | {"null": (False, ["structure"])}
    # scaled corners may miss a point they touched exactly
    loose = {"hole touching in a point", "touches itself"} if size != 1.0 else set()
    assert {k: v for k, v in got.items() if k not in loose} == {k: v for k, v in want.items() if k not in loose}


def test_long_rings(spark):
    rng, n = random.Random(3), 4000
    ring = []
    for i in range(n):
        r, a = 0.5 * rng.uniform(0.6, 1.0), 2 * math.pi * i / n
        ring.append([10 + r * math.cos(a), 50 + r * math.sin(a)])
    bad = [*ring]
    bad[1000], bad[1002] = bad[1002], bad[1000]
    rows = [(k, json.dumps({"type": "Polygon", "coordinates": [[*r, r[0]]]})) for k, r in enumerate((ring, bad))]
    df = spark.createDataFrame(rows, "k int, t string").withColumn("g", G.polygon_from_geojson("t"))
    assert {r.k: r.reasons for r in validity(df, "k", "g").collect()} == {0: [], 1: ["self intersection"]}
    edges = S.polygon_entries(df, "k", "g").agg(F.max(F.size("edges"))).first()[0]
    assert edges <= S.MAX_EDGES


def test_shapes_of_few_edges_need_no_cells(spark, monkeypatch):
    """They are judged row by row, and as the others are."""
    rows = [(name, json.dumps({"type": "MultiPolygon", "coordinates": shape})) for name, (shape, _) in CASES.items()]
    df = spark.createDataFrame(rows, "name string, t string").withColumn("g", G.polygon_from_geojson("t"))
    monkeypatch.setattr(S, "divided", lambda *a: pytest.fail("cells were made"))
    few = sorted(map(str, validity(df, "name", "g").collect()))
    monkeypatch.undo()
    monkeypatch.setattr(S, "MAX_EDGES", 3)
    assert sorted(map(str, validity(df, "name", "g").collect())) == few
