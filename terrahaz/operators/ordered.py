"""Ordered scans whose work does not depend on how the keys are spread.

A window partitioned by layer or borough puts a third of the table into one task.
Here the rows are cut into ranges of the sort order instead (keys first, then the
order columns), so a range holds about ``rows_per_range`` rows whatever the keys look
like. A range is computed on its own; what earlier ranges of the same key hand over is
one extra row that leads each (range, key).

The cut points come from a bounded sample and are then constants of the plan: which
range a row belongs to is a pure function of the row, so a task that runs again, or a
second use of the same input, sees the same ranges. The sample only balances the work;
it never decides which rows take part. Every orderable type may be a key or an order
column; nulls sort first.

Beyond one range the input is written once to the shared folder and every step of a
chain reads that table: the input itself is evaluated twice, to count and to write.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from terrahaz.operators.sizing import join_dim, materialize
from terrahaz.session import scratch

ROWS_PER_RANGE = 2_000_000
MAX_RANGES = 8192
_SAMPLES_PER_RANGE = 20

RANGE = "__range"
_LEAD = "__lead"


def lay_out(df: DataFrame, rows_per_range: int, rows: int | None = None) -> tuple[DataFrame, int]:
    """``df`` and its number of rows; written to the shared folder first if it needs ranges."""
    rows = df.count() if rows is None else rows
    if rows <= rows_per_range:
        return df, rows
    path = scratch(df.sparkSession, "ordered")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), rows


def assign_ranges(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    rows_per_range: int = ROWS_PER_RANGE,
    rows: int | None = None,
    max_ranges: int = MAX_RANGES,
) -> tuple[DataFrame, bool]:
    """Add ``__range``; the flag tells whether there is more than one.

    ``rows`` is the count of a table that is laid out already. About
    ``_SAMPLES_PER_RANGE * max_ranges`` narrow rows at most reach the driver; beyond
    ``max_ranges`` ranges they grow instead of their number.
    """
    if rows is None:
        df, rows = lay_out(df, rows_per_range)
    ranges = min(max_ranges, -(-rows // rows_per_range))
    if ranges <= 1:
        return df.withColumn(RANGE, F.lit(0)), False
    here = F.struct(*dict.fromkeys([*keys, *order]))
    places = df.select(here.alias("h"))
    fraction = min(1.0, _SAMPLES_PER_RANGE * ranges / rows)
    sampled = places.sample(fraction=fraction, seed=17).orderBy("h").select(F.to_json("h")).collect()
    step = max(1, len(sampled) // ranges)
    cuts = [r[0] for r in sampled[step::step]]
    if not cuts:
        return df.withColumn(RANGE, F.lit(0)), False
    # a cut need not be an exact value of the data, so what JSON rounds off is harmless
    boundaries = F.from_json(F.lit(f"[{','.join(cuts)}]"), ArrayType(places.schema["h"].dataType))
    return df.withColumn(RANGE, _rank_among(F.array_sort(boundaries), len(cuts), here)), True


def _rank_among(boundaries: Column, count: int, value: Column) -> Column:
    """How many boundaries are <= value, by binary search."""
    steps = [F.lit(1 << i) for i in reversed(range(count.bit_length()))]

    def advance(position, step):
        reached = F.get(boundaries, position + step - 1) <= value
        ok = (position + step <= count) & F.coalesce(reached, F.lit(False))
        return F.when(ok, position + step).otherwise(position)

    return F.aggregate(F.array(*steps), F.lit(0), advance)


def _scan(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    values: dict[str, Column],
    over,
    total,
    earlier_of,
    end: int,
    rows_per_range: int,
    rows: int | None,
) -> DataFrame:
    """Window functions ``over`` running up to ``end`` within a key, range by range.

    ``total`` reduces a value per (range, key), ``earlier_of`` reduces such totals.
    """
    names = {out: f"__v{i}" for i, out in enumerate(values)}
    valued = df.withColumns({names[out]: v for out, v in values.items()})
    ranged, several = assign_ranges(valued, keys, order, rows_per_range, rows)
    within = Window.partitionBy(RANGE, *keys).rowsBetween(Window.unboundedPreceding, end)
    plain = ranged.withColumns({out: over(n).over(within.orderBy(*order)) for out, n in names.items()})
    if not several:
        return plain.drop(RANGE, *names.values())
    earlier = Window.partitionBy(*keys).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy(RANGE, *keys).agg(*[total(n).alias(n) for n in names.values()])
    lead = totals.select(
        RANGE, *keys, *[earlier_of(n).over(earlier).alias(n) for n in names.values()], F.lit(0).alias(_LEAD)
    )
    stacked = ranged.withColumn(_LEAD, F.lit(1)).unionByName(lead, allowMissingColumns=True)
    led = within.orderBy(_LEAD, *order)
    whole = stacked.withColumns(
        {out: over(n).over(led).cast(plain.schema[out].dataType) for out, n in names.items()}
    )
    return whole.where(F.col(_LEAD) == 1).drop(RANGE, _LEAD, *names.values())


def prefix_sums(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    values: dict[str, Column],
    rows_per_range: int = ROWS_PER_RANGE,
    rows: int | None = None,
) -> DataFrame:
    """Running totals per key, current row included: a column per entry of ``values``."""
    return _scan(df, keys, order, values, F.sum, F.sum, F.sum, 0, rows_per_range, rows)


def prefix_sum(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    value: Column,
    out: str,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Running total of ``value`` per key, current row included."""
    return prefix_sums(df, keys, order, {out: value}, rows_per_range)


def last_knowns(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    values: dict[str, Column],
    *,
    include_current: bool = True,
    rows_per_range: int = ROWS_PER_RANGE,
    rows: int | None = None,
) -> DataFrame:
    """Latest non-null value per key up to the row (or strictly before it), for each entry."""

    def newest(n):
        return F.max_by(n, F.when(F.col(n).isNotNull(), F.struct(*order)))

    def last(n):
        return F.last(n, ignorenulls=True)

    end = 0 if include_current else -1
    return _scan(df, keys, order, values, last, newest, last, end, rows_per_range, rows)


def last_known(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    value: Column,
    out: str,
    *,
    include_current: bool = True,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Latest non-null ``value`` per key up to the row (or strictly before it)."""
    return last_knowns(
        df, keys, order, {out: value}, include_current=include_current, rows_per_range=rows_per_range
    )


def surrogate_key(
    df: DataFrame, order: list[str], out: str, rows_per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    """Dense 1..n key in natural-key order, with no window over the whole table."""
    return prefix_sum(df, [], order, F.lit(1).cast("bigint"), out, rows_per_range)


def trailing_sums(
    df: DataFrame,
    keys: list[str],
    time_us: str,
    values: dict[str, Column],
    window_us: int,
    rows_per_range: int = ROWS_PER_RANGE,
    rows: int | None = None,
) -> DataFrame:
    """Sums over [t - window, t] per key; (keys, time) must be unique, nulls being values.

    Time is cut into blocks one window long, so the window of a row is the beginning of
    its own block up to t and the end of the block before from t - window on. Both are
    running totals within a block, forwards and backwards; nothing is subtracted, so no
    digit is lost, and every size is computed in the same way.
    """
    t, width = F.col(time_us), F.lit(window_us)
    names = {out: f"__x{i}" for i, out in enumerate(values)}
    blocks = df.withColumns({names[out]: v for out, v in values.items()}).withColumn("__block", t - F.pmod(t, width))
    blocks, rows = lay_out(blocks, rows_per_range, rows)
    within = [*keys, "__block"]
    forwards = {f"__upto{i}": F.col(n) for i, n in enumerate(names.values())}
    upto = prefix_sums(blocks, within, [time_us], forwards, rows_per_range, rows)
    markers = upto.select(
        *keys, (F.col("__block") - width).alias("__block"), (width - t).alias("__back"), F.lit(1).alias("__kind"),
        F.struct(*df.columns).alias("__row"), *forwards,
    )
    samples = blocks.where(t.isNotNull()).select(*within, (-t).alias("__back"), F.lit(0).alias("__kind"), *names.values())
    both = samples.unionByName(markers, allowMissingColumns=True)
    backwards = {f"__from{i}": F.col(n) for i, n in enumerate(names.values())}
    ended = prefix_sums(both, within, ["__back", "__kind"], backwards, rows_per_range, 2 * rows)

    def added(i):
        a, b = F.col(f"__upto{i}"), F.col(f"__from{i}")
        return F.when(a.isNull(), b).when(b.isNull(), a).otherwise(a + b)

    return ended.where(F.col("__kind") == 1).select(
        "__row.*", *[added(i).alias(out) for i, out in enumerate(names)]
    )


# ------------------------------------------------------------------ operators


def asof_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    left_ts: str,
    right_ts: str,
    values: list[str],
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Attach to each left row the latest right row of its key at or before its time.

    Both sides are stacked and scanned in time order; there is no inequality join. Of
    right rows with equal key and time the largest value tuple wins. Right rows with a
    null key match nothing, as in an equality join.
    """
    carried = F.struct(*values)
    rights = (
        right.dropna(subset=[*keys, right_ts])
        .groupBy(*keys, F.unix_micros(F.col(right_ts).cast("timestamp")).alias("__t"))
        .agg(F.max(carried).alias("__r"))
    )
    stacked = (
        left.select(
            *keys,
            F.unix_micros(F.col(left_ts).cast("timestamp")).alias("__t"),
            F.struct(*left.columns).alias("__l"),
        )
        .withColumn("__side", F.lit(1))
        .unionByName(rights.withColumn("__side", F.lit(0)), allowMissingColumns=True)
    )
    scanned = last_known(
        stacked, keys, ["__t", "__side"], F.col("__r"), "__known", rows_per_range=rows_per_range
    )
    return scanned.where(F.col("__side") == 1).select(
        "__l.*", *[F.col("__known")[v].alias(v) for v in values]
    )


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Newest row per key: an aggregate, so a hot key is combined before the shuffle."""
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*df.columns), F.struct(*order)).alias("__row"))
    return picked.select("__row.*")


def dedupe(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key; the survivor is the last in ``order``, not an arbitrary one."""
    return latest_per_key(df, keys, order)


def cumulative_records(
    df: DataFrame, key: str, order: list[str], value: str, rows_per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    return prefix_sum(df, [key], order, F.col(value), "running_total", rows_per_range)


def counter_deltas(
    df: DataFrame, keys: list[str], time_us: str, counter: str, rows_per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    """Increase since the previous sample; after a reset the new value counts.

    Samples repeated at one time keep the larger value. The first sample has no delta.
    """
    return _deltas(df, keys, time_us, {"delta": counter}, rows_per_range)[0]


def _deltas(df, keys, time_us, counters: dict[str, str], rows_per_range) -> tuple[DataFrame, int]:
    wanted = list(dict.fromkeys(counters.values()))
    samples = df.groupBy(*keys, time_us).agg(*[F.max(c).alias(c) for c in wanted])
    samples, rows = lay_out(samples, rows_per_range)
    before = {c: f"__before{i}" for i, c in enumerate(wanted)}
    seen = last_knowns(
        samples, keys, [time_us], {before[c]: F.col(c) for c in wanted},
        include_current=False, rows_per_range=rows_per_range, rows=rows,
    )

    def delta(c):
        previous, now = F.col(before[c]), F.col(c)
        return F.when(previous.isNull(), None).when(now >= previous, now - previous).otherwise(now)

    return seen.withColumns({out: delta(c) for out, c in counters.items()}).drop(*before.values()), rows


def counter_rates(
    df: DataFrame,
    keys: list[str],
    time_us: str,
    counters: dict[str, str],
    window_seconds: int = 300,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """As ``counter_rate`` for several counters in one go: ``{output column: counter}``."""
    deltas = {out: f"__d{i}" for i, out in enumerate(counters)}
    known, rows = _deltas(df, keys, time_us, {deltas[out]: c for out, c in counters.items()}, rows_per_range)
    increases = {out: F.coalesce(F.col(d).cast("double"), F.lit(0.0)) for out, d in deltas.items()}
    summed = trailing_sums(known, keys, time_us, increases, window_seconds * 1_000_000, rows_per_range, rows)
    return summed.withColumns({out: F.col(out) / F.lit(float(window_seconds)) for out in counters}).drop(*deltas.values())


def counter_rate(
    df: DataFrame,
    keys: list[str],
    time_us: str,
    counter: str,
    window_seconds: int = 300,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Per-second increase over the trailing window (no extrapolation at its edges)."""
    return counter_rates(df, keys, time_us, {"rate": counter}, window_seconds, rows_per_range)


def mean_duration(
    df: DataFrame,
    keys: list[str],
    time_us: str,
    total: str,
    count: str,
    window_seconds: int = 300,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """rate(sum) / rate(count): mean duration over the trailing window; null without calls."""
    rates = counter_rates(df, keys, time_us, {"__sum": total, "__count": count}, window_seconds, rows_per_range)
    return rates.select(*keys, time_us, F.try_divide(F.col("__sum"), F.col("__count")).alias("mean_seconds"))


def alert_intervals(
    df: DataFrame,
    keys: list[str],
    time_us: str,
    firing: Column,
    hold_seconds: int,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Stretches in which ``firing`` holds in every sample for at least ``hold_seconds``.

    A stretch is named by the last sample before it that was not firing, so finding it
    takes one scan and the stretches themselves are a plain aggregate.
    """
    # samples at one time count as one: it fires if all of them do
    state = df.withColumn("__on", F.coalesce(firing, F.lit(False))).groupBy(*keys, time_us).agg(
        F.bool_and("__on").alias("__on"), F.count(F.lit(1)).alias("__samples"))
    scanned = last_known(
        state, keys, [time_us], F.when(~F.col("__on"), F.col(time_us)), "__off",
        rows_per_range=rows_per_range,
    )
    spans = (
        scanned.where("__on")
        .groupBy(*keys, "__off")
        .agg(
            F.min(time_us).alias("start_us"),
            F.max(time_us).alias("end_us"),
            F.sum("__samples").alias("samples"),
        )
        .drop("__off")
    )
    return spans.where(F.col("end_us") - F.col("start_us") >= F.lit(hold_seconds * 1_000_000))


def _on_counters(df: DataFrame, keys: list[str], time_us: str, counters: list[str]) -> DataFrame:
    """One row per (key, time) with the newest value of each counter; ``samples`` of an alert counts these rows."""
    return df.groupBy(*keys, time_us).agg(*[F.max(c).alias(c) for c in counters])


def alert_error_rate(
    df: DataFrame, keys: list[str], time_us: str, errors: str, records: str, limit: float = 0.05,
    hold_seconds: int = 300, rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Stretches with errors / records (both counters) above ``limit``."""
    state = _on_counters(df, keys, time_us, [errors, records])
    firing = F.col(errors) > F.col(records) * F.lit(limit)
    return alert_intervals(state, keys, time_us, firing, hold_seconds, rows_per_range)


def alert_quality(
    df: DataFrame, keys: list[str], time_us: str, errors: str, records: str, percent: float = 90.0,
    hold_seconds: int = 300, rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Stretches with less than ``percent`` of the records (a counter) free of errors."""
    state = _on_counters(df, keys, time_us, [errors, records])
    firing = F.col(records) - F.col(errors) < F.col(records) * F.lit(percent / 100)
    return alert_intervals(state, keys, time_us, firing, hold_seconds, rows_per_range)


def alert_no_data(
    df: DataFrame, keys: list[str], time_us: str, records: str, window_seconds: int = 300,
    hold_seconds: int = 600, rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Stretches in which the counter did not grow over the trailing window."""
    rates = counter_rates(df, keys, time_us, {"__rate": records}, window_seconds, rows_per_range)
    return alert_intervals(rates, keys, time_us, F.col("__rate") == 0, hold_seconds, rows_per_range)


def alert_mean_latency(
    df: DataFrame, keys: list[str], time_us: str, seconds: str, calls: str, limit: float = 30.0,
    window_seconds: int = 300, hold_seconds: int = 300, rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Stretches with rate(seconds) / rate(calls) above ``limit``."""
    means = mean_duration(df, keys, time_us, seconds, calls, window_seconds, rows_per_range)
    return alert_intervals(means, keys, time_us, F.col("mean_seconds") > limit, hold_seconds, rows_per_range)


def layer_status(df: DataFrame, key: str, time_us: str, value: str) -> DataFrame:
    """Last gauge value per layer, read as a state."""
    last = df.groupBy(key).agg(F.max_by(value, F.col(time_us)).alias("last_value"))
    status = F.when(F.col("last_value") == 1, "RUNNING").otherwise("STOPPED")
    return last.withColumn("status", status)


def auc_roc(
    df: DataFrame, label: str, score: str, rows_per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    """Rank-based area under the ROC curve; tied scores count half."""
    positive = F.col(label) == 1
    by_score = df.groupBy(score).agg(
        F.count_if(positive).alias("__p"), F.count_if(~positive).alias("__q")
    )
    ranked = prefix_sum(by_score, [], [score], F.col("__q"), "__q_upto", rows_per_range)
    below = F.col("__q_upto") - F.col("__q") + F.col("__q") / F.lit(2.0)
    total = ranked.agg(
        F.sum(F.col("__p") * below).alias("u"), F.sum("__p").alias("p"), F.sum("__q").alias("q")
    )
    return total.select(F.try_divide(F.col("u"), (F.col("p") * F.col("q")).cast("double")).alias("auc"))


def hash_bucket(key: Column, seed: int, buckets: int) -> Column:
    """Stable bucket of a key: leading hex digits of a digest, modulo ``buckets``."""
    digest = F.sha2(F.concat(key.cast("string"), F.lit(f"|{seed}")), 256)
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % F.lit(buckets)


def split_by_hash(df: DataFrame, key: str, seed: int = 42, test_percent: int = 20) -> DataFrame:
    """Add ``is_test``; the same key always lands on the same side."""
    return df.withColumn("is_test", F.coalesce(hash_bucket(F.col(key), seed, 100) < F.lit(test_percent), F.lit(False)))


def stratified_split(
    df: DataFrame, key: str, label: str, seed: int = 42, test_fraction: float = 0.2, grain: int = 65536
) -> DataFrame:
    """Exactly ``floor(test_fraction * n)`` test rows per label, by hash order of the key.

    The cut is found from a histogram of hash buckets per label. Buckets below it are
    in, buckets above are out, and only rows of the cut bucket itself are ranked. A null
    label is a label; a null key is hashed as an empty one. The rows are written with their
    bucket once, so each is hashed once; the cut bucket's are hashed again for their order.
    """
    digest = F.sha2(F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(f"|{seed}")), 256)
    bucket = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % F.lit(grain)
    hashed = materialize(df.withColumn("__b", bucket).withColumn("__l", F.to_json(F.struct(label))), "hashed")
    counts = hashed.groupBy("__l", "__b").agg(F.count(F.lit(1)).alias("__n"))
    # at most grain rows per label from here on
    upto = Window.partitionBy("__l").orderBy("__b").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("__l")
    cut = (
        counts.withColumn("__upto", F.sum("__n").over(upto))
        .withColumn("__want", F.floor(F.sum("__n").over(whole) * F.lit(test_fraction)))
        .where(F.col("__upto") > F.col("__want"))
        .groupBy("__l")
        .agg(
            F.min("__b").alias("__cut"),
            F.min_by(F.col("__want") - (F.col("__upto") - F.col("__n")), F.col("__b")).alias("__take"),
        )
    )
    marked = join_dim(hashed, materialize(cut, "cuts"), ["__l"], "left")
    at_cut = F.coalesce(F.col("__b") == F.col("__cut"), F.lit(False))
    # order inside the cut bucket continues with the digest itself
    inside = Window.partitionBy("__l", "__b").orderBy(digest, key)
    ranked = marked.where(at_cut).withColumn("__rank", F.row_number().over(inside))
    decided = marked.where(~at_cut).withColumn("is_test", F.coalesce(F.col("__b") < F.col("__cut"), F.lit(True)))  # no cut: all are test rows
    picked = ranked.withColumn("is_test", F.col("__rank") <= F.col("__take")).drop("__rank")
    return decided.unionByName(picked).drop("__b", "__d", "__l", "__cut", "__take")
