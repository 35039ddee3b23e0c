"""Ordered scans: many small ranges must give what one range gives, whatever the keys."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.conftest import rows
from terrahaz.operators import ordered as W
from terrahaz.operators import sizing
from terrahaz.queries import views as V

RANGES = pytest.mark.parametrize("per_range", [10_000_000, 60, 7])


@pytest.fixture(scope="module")
def samples(spark):
    """Two thirds of the rows in one layer, a burst within one second, gaps and nulls."""
    rng = random.Random(11)
    data, t = [], 0
    for i in range(600):
        t += rng.choice([1, 1000, 40_000_000]) if not 200 <= i < 400 else 3
        layer = "bronze" if rng.random() < 0.66 else rng.choice(["silver", "gold"])
        value = None if i % 13 == 0 else rng.randint(0, 50)
        data.append((i, layer, t, value, float((i * 7) % 100)))
    return spark.createDataFrame(data, "id int, layer string, t bigint, v int, counter double").repartition(5).cache()


@RANGES
def test_prefix_sum(samples, per_range):
    w = Window.partitionBy("layer").orderBy("t", "id").rowsBetween(Window.unboundedPreceding, 0)
    want = rows(samples.select("id", F.sum("v").over(w).alias("s")))
    assert rows(W.prefix_sum(samples, ["layer"], ["t", "id"], F.col("v"), "s", per_range), "id", "s") == want


@RANGES
@pytest.mark.parametrize("current", [True, False])
def test_last_known(samples, per_range, current):
    w = Window.partitionBy("layer").orderBy("t", "id").rowsBetween(Window.unboundedPreceding, 0 if current else -1)
    want = rows(samples.select("id", F.last("v", ignorenulls=True).over(w).alias("s")))
    got = W.last_known(samples, ["layer"], ["t", "id"], F.col("v"), "s", include_current=current, rows_per_range=per_range)
    assert rows(got, "id", "s") == want


@RANGES
def test_surrogate_key_is_dense(samples, per_range):
    got = rows(W.surrogate_key(samples, ["t", "id"], "sk", per_range), "sk", "id")
    order = [r.id for r in samples.orderBy("t", "id").collect()]
    assert sorted(got) == list(zip(range(1, 601), order))


@RANGES
def test_counter_rate(samples, per_range):
    got = rows(W.counter_rate(samples, ["layer"], "t", "counter", 60, per_range).withColumn("rate", F.round("rate", 6)), "layer", "t", "rate")
    by_layer = {}
    for r in samples.collect():
        by_layer.setdefault(r.layer, {}).setdefault(r.t, []).append(r.counter)
    want = []
    for layer, series in by_layer.items():
        times, deltas, before = sorted(series), {}, None
        for t in times:
            now = max(series[t])
            deltas[t] = 0.0 if before is None else (now - before if now >= before else now)
            before = now
        for t in times:
            total = sum(d for u, d in deltas.items() if t - 60_000_000 <= u <= t)
            want.append((layer, t, round(total / 60, 6)))
    assert [x[:2] for x in got] == [x[:2] for x in sorted(want, key=repr)]
    assert all(abs(a[2] - b[2]) < 2e-6 for a, b in zip(got, sorted(want, key=repr)))


@RANGES
def test_alerts(samples, per_range):
    firing = F.col("counter") > 30
    got = rows(W.alert_intervals(samples.dropDuplicates(["layer", "t"]), ["layer"], "t", firing, 1, per_range))
    assert got == rows(W.alert_intervals(samples.dropDuplicates(["layer", "t"]), ["layer"], "t", firing, 1))
    assert got and all(e - s >= 1_000_000 for _, s, e, _ in got)


def test_alert_islands_on_literals(spark):
    on = [1, 1, 0, 1, None, 1, 1, 1]
    df = spark.createDataFrame([("a", i * 1_000_000, v) for i, v in enumerate(on)], "layer string, t bigint, v int")
    assert rows(W.alert_intervals(df, ["layer"], "t", F.col("v") == 1, 1)) == [("a", 0, 1_000_000, 2), ("a", 5_000_000, 7_000_000, 3)]


@RANGES
def test_asof(spark, sf, per_range):
    flights, weather = V.view(spark, sf, "fx_flights"), V.view(spark, sf, "fx_weather")
    got = rows(W.asof_join(flights, weather, ["borough"], "ts", "ts", ["obs_id"], per_range), "flight_id", "obs_id")
    pairs = flights.join(weather.withColumnRenamed("ts", "wts"), "borough", "left").where("wts <= ts")
    latest = pairs.groupBy("flight_id").agg(F.max_by("obs_id", F.struct("wts", "obs_id")).alias("obs_id"))
    assert got == rows(flights.select("flight_id").join(latest, "flight_id", "left"), "flight_id", "obs_id")


@RANGES
def test_auc(spark, per_range):
    data = [(1, 0.9), (1, 0.4), (0, 0.4), (0, 0.1), (1, 0.8), (0, 0.7)] * 20
    df = spark.createDataFrame(data, "label int, score double")
    pos, neg = [s for y, s in data if y], [s for y, s in data if not y]
    want = sum(1.0 if p > q else 0.5 if p == q else 0.0 for p in pos for q in neg) / (len(pos) * len(neg))
    assert abs(W.auc_roc(df, "label", "score", per_range).first().auc - want) < 1e-12


def test_counter_edge_cases(spark):
    df = spark.createDataFrame([("one", 5, 3.0), ("reset", 0, 10.0), ("reset", 1, 4.0), ("reset", 2, 6.0)], "layer string, t bigint, counter double")
    got = rows(W.counter_deltas(df, ["layer"], "t", "counter"), "layer", "t", "delta")
    assert got == [("one", 5, None), ("reset", 0, None), ("reset", 1, 4.0), ("reset", 2, 2.0)]


def test_ranges_are_balanced_under_a_hot_key(samples):
    ranged, several = W.assign_ranges(samples, ["layer"], ["t", "id"], 60)
    assert several
    assert ranged.groupBy(W.RANGE).count().agg(F.max("count")).first()[0] < 200


def test_stratified_split_is_exact(samples):
    split = W.stratified_split(samples, "id", "layer", test_fraction=0.2, grain=8)
    for r in split.groupBy("layer").agg(F.count("*").alias("n"), F.count_if("is_test").alias("k")).collect():
        assert r.k == int(r.n * 0.2)
    assert split.count() == 600 and split.select("id").distinct().count() == 600


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_skew_join_equals_plain_join(spark, how):
    left = spark.createDataFrame([(i, 0 if i % 3 else i % 11) for i in range(500)], "id int, k int")
    right = spark.createDataFrame([(k, f"v{k}{j}") for k in range(0, 9) for j in range(1 + k % 2)], "k int, v string")
    want = rows(left.join(right, ["k"], how), "id", *(["v"] if how in ("inner", "left") else []))
    got = sizing.skew_join(left, right, ["k"], how, rows_per_task=20)
    assert rows(got, "id", *(["v"] if how in ("inner", "left") else [])) == want


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_skew_join_hot_right_and_null_keys(spark, how):
    left = spark.createDataFrame([(i, None if i % 3 == 0 else i % 4) for i in range(200)], "id int, k int")
    right = spark.createDataFrame([(None if j % 5 == 0 else 1, f"v{j}") for j in range(150)], "k int, v string")
    kept = ["v"] if how in ("inner", "left") else []
    want = rows(left.join(right, ["k"], how), "id", *kept)
    assert rows(sizing.skew_join(left, right, ["k"], how, rows_per_task=20), "id", *kept) == want


def test_join_dim_both_ways(spark):
    fact = spark.createDataFrame([(i, i % 5) for i in range(100)], "id int, k int")
    dim = spark.createDataFrame([(k, f"n{k}") for k in range(4)], "k int, name string")
    small = rows(sizing.join_dim(fact, dim, ["k"], "left"), "id", "name")
    assert small == rows(sizing.join_dim(fact, dim, ["k"], "left", max_bytes=0, rows_per_task=5), "id", "name")


@RANGES
def test_every_orderable_type_and_null_keys(spark, per_range):
    """Dates, timestamps, decimals and null keys and times order the same at every size."""
    df = spark.range(240).selectExpr(
        "id", "if(id % 5 = 0, null, id % 2) AS k", "date_add(DATE'2024-01-01', cast(id % 9 AS int)) AS d",
        "timestamp_micros(id * 1234567) AS ts", "cast(id * 1.37 AS decimal(20,6)) AS x",
        "if(id % 17 = 0, null, id % 31) AS some", "unhex(lpad(hex(id), 4, '0')) AS b", "id % 3 = 0 AS flag",
    )
    for order in (["d", "id"], ["ts"], ["x"], ["some", "b"], ["flag", "d", "id"]):
        w = Window.partitionBy("k").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        want = rows(df.select("id", F.sum("id").over(w).alias("s")))
        assert rows(W.prefix_sum(df, ["k"], order, F.col("id"), "s", per_range), "id", "s") == want, order


@RANGES
def test_trailing_sums_keep_every_digit(spark, per_range):
    values = [1.12345678949, 1e20, 3.5, None, 1e-12, 7.25]
    data = [(None if i % 7 == 0 else i % 3, i * 1_500_000, values[i % 6], i) for i in range(200)]
    data += [(9, None, 2.5, 900), (None, None, 4.5, 901)]
    df = spark.createDataFrame(data, "k int, t bigint, v double, id int")
    got = {r.id: r.s for r in W.trailing_sums(df, ["k"], "t", {"s": F.col("v")}, 10_000_000, per_range).collect()}
    for k, t, v, i in data:
        near = [x for q, u, x, _ in data if q == k and (u is None if t is None else u is not None and t - 10_000_000 <= u <= t) and x is not None]
        if near:
            assert got[i] == pytest.approx(sum(near), rel=1e-14)
        else:
            assert got[i] is None
    assert len(got) == len(data)


def test_chains_evaluate_their_input_twice(spark):
    """However many ranges there are: once to count, once to write."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    source = spark.range(500).selectExpr("id % 3 AS k", "id * 1000000 AS t", "double(id) AS total", "double(id) AS calls")
    for run in (
        lambda df, n: W.counter_rate(df, ["k"], "t", "total", 60, n),
        lambda df, n: W.mean_duration(df, ["k"], "t", "total", "calls", 60, n),
    ):
        results = []
        for per_range in (10_000_000, 20):
            before = seen.value
            results.append(rows(run(source.mapInArrow(count, source.schema), per_range)))
            assert seen.value - before <= 1000
        assert [r[:2] for r in results[0]] == [r[:2] for r in results[1]]
        assert all(a[-1] == pytest.approx(b[-1]) for a, b in zip(*results))


def test_null_keys_match_nothing_as_of(spark):
    left = spark.createDataFrame([(1, None, 5), (2, "a", 5)], "id int, k string, t int").withColumn("t", F.timestamp_seconds("t"))
    right = spark.createDataFrame([(None, 1, "n"), ("a", 1, "v")], "k string, u int, v string").withColumn("u", F.timestamp_seconds("u"))
    assert rows(W.asof_join(left, right, ["k"], "t", "u", ["v"]), "id", "v") == [(1, None), (2, "v")]
