"""Nearest reading in space and time against a plain search."""

import math
import random

import pytest

from terrahaz.operators import stations as T

HOUR = 3600


def _metres(a, b):
    lon1, lat1, lon2, lat2 = map(math.radians, (*a, *b))
    h = math.sin((lat2 - lat1) / 2) ** 2 + math.cos(lat1) * math.cos(lat2) * math.sin((lon2 - lon1) / 2) ** 2
    return round(2 * 6371000.0 * math.asin(min(1.0, math.sqrt(h))), 3)


def _tables(seed=2):
    rng = random.Random(seed)
    stations = [(i, rng.uniform(-75, -73), rng.uniform(40, 42)) for i in range(60)]
    stations += [(100, 179.9, 0.0), (101, -74.0, 41.0), (102, -74.0, 41.0), (103, None, 41.0), (104, 10.0, 50.0)]
    # a third of all readings come from one station; some stations never report, some stop
    readings = [(rng.choice([i, 101]), rng.randrange(0, 100 * HOUR, 60), float(k)) for k in range(300) for i in [rng.randrange(0, 40)]]
    readings += [(100, 5 * HOUR, 1.5), (102, 50 * HOUR, 2.5), (101, 50 * HOUR, 3.5), (101, 50 * HOUR, 4.5), (None, 0, 9.0), (103, 0, 9.0), (7, None, 9.0), (999, 0, 9.0)]
    events = [(i, rng.uniform(-75.2, -72.8), rng.uniform(39.8, 42.2), rng.randrange(-HOUR, 110 * HOUR, 30)) for i in range(150)]
    events += [(500 + i, -74.0, 41.0, 50 * HOUR) for i in range(80)]
    events += [(600, None, 41.0, 5), (601, -74.0, 41.0, None), (602, float("nan"), 1.0, 5), (603, -179.9, 0.0, 6 * HOUR), (604, 60.0, -40.0, 99 * HOUR), (600, None, 41.0, 5)]
    return stations, readings, events


@pytest.mark.parametrize("max_age,per_task,per_range", [(None, 2_000_000, 20_000_000), (2 * HOUR, 2_000_000, 20_000_000), (6 * HOUR, 40, 100)])
def test_nearest_reading(spark, max_age, per_task, per_range):
    stations, readings, events = _tables()
    stamp = ("*", "timestamp_seconds(s) AS ts")
    s = spark.createDataFrame(stations, "station_id int, longitude double, latitude double")
    r = spark.createDataFrame(readings, "station_id int, s long, value double").selectExpr(*stamp)
    e = spark.createDataFrame(events, "id int, longitude double, latitude double, s long").selectExpr(*stamp)
    got = T.nearest_reading(e, s, r, ["value"], max_age_s=max_age, rows_per_task=per_task, rows_per_range=per_range)
    places = {i: (x, y) for i, x, y in stations if x is not None}

    def answer(x, y, t):
        best = None
        if x is None or t is None or math.isnan(x):
            return None
        for i, at in places.items():
            heard = [(w, v) for j, w, v in readings if j == i and w is not None and w <= t and (max_age is None or w >= t - max_age)]
            if heard:
                w, v = max(heard)
                best = min(best or (9e9,), (_metres((x, y), at), i, w, v))
        return best

    rows = got.selectExpr("id", "station_m", "station_id", "unix_seconds(reading_ts) AS w", "value").collect()
    want = sorted((i, *(answer(x, y, t) or (None,) * 4)) for i, x, y, t in events)
    assert sorted((r.id, r.station_m, r.station_id, r.w, r.value) for r in rows) == want
    assert any(w[1] and w[1] > 1e6 for w in want) or max_age


def test_no_readings(spark):
    s = spark.createDataFrame([(1, 0.0, 0.0)], "station_id int, longitude double, latitude double")
    r = spark.createDataFrame([], "station_id int, ts timestamp, value double")
    e = spark.createDataFrame([(1, 0.0, 0.0, 5)], "id int, longitude double, latitude double, s long").selectExpr("*", "timestamp_seconds(s) AS ts")
    assert [x.value for x in T.nearest_reading(e, s, r, ["value"]).collect()] == [None]


@pytest.mark.parametrize("max_age", [None, 2 * HOUR])
def test_only_the_winner_is_asked_for_its_readings(spark, monkeypatch, max_age):
    """As-of rows do not grow with the stations an event meets."""
    asked, join = [], T.W.asof_join
    monkeypatch.setattr(T.W, "asof_join", lambda left, *a: asked.append(left.count()) or join(left, *a))
    s = spark.createDataFrame([(i, -74 + i / 1000, 41.0) for i in range(40)], "station_id int, longitude double, latitude double")
    r = spark.createDataFrame([(i, 100 * i, float(i)) for i in range(40)], "station_id int, s long, value double").selectExpr("*", "timestamp_seconds(s) AS ts")
    e = spark.createDataFrame([(i, -74.1, 41.0, 200 * i) for i in range(30)], "id int, longitude double, latitude double, s long").selectExpr("*", "timestamp_seconds(s) AS ts")
    got = T.nearest_reading(e, s, r, ["value"], max_age_s=max_age)
    heard = {t: [i for i in range(40) if 100 * i <= t and (max_age is None or t - 100 * i <= max_age)] for t in range(0, 6000, 200)}
    assert {x.s: x.station_id for x in got.select("s", "station_id").collect()} == {t: min(h, default=None) for t, h in heard.items()}
    assert sum(asked) <= 30
