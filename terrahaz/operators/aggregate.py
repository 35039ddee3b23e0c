"""Hazard roll-ups, quality figures, model metrics, profiles, set operations, top-k."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrahaz.functions import grid
from terrahaz.operators.ordered import hash_bucket
from terrahaz.operators.sizing import join_dim

# Histogram bounds of the duration metrics, in seconds.
DURATION_BOUNDS = [0.1, 0.5, 1.0, 2.0, 5.0, 10.0, 30.0, 60.0]


# ------------------------------------------------------------------- roll-ups


def hazard_metrics(fact: DataFrame) -> DataFrame:
    """Per neighborhood and hazard: count and mean severity, plus the neighborhood's types.

    The type list is built from the already aggregated rows, not from the fact.
    """
    per_type = fact.groupBy("neighborhood_sk", "hazard_type").agg(
        F.count(F.lit(1)).alias("event_count"), F.avg("severity").alias("avg_severity")
    )
    types = per_type.groupBy(F.col("neighborhood_sk").alias("__sk")).agg(
        F.array_join(F.sort_array(F.collect_set("hazard_type")), ",").alias("event_types")
    )
    same = per_type["neighborhood_sk"].eqNullSafe(types["__sk"])
    return per_type.join(types, same, "left").drop("__sk")


def count_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def severity_by(df: DataFrame, *keys: str, severity: str = "severity") -> DataFrame:
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.avg(severity).alias("avg_severity"), F.max(severity).alias("max_severity")
    )


def top_hazards(
    fact: DataFrame, dim: DataFrame, since: str, limit: int = 20, max_bytes: int | None = None
) -> DataFrame:
    """Most frequent (neighborhood, hazard) since a date; names break ties.

    The fact is aggregated on the key first, so the join sees one row per group.
    """
    recent = fact.where(F.col("event_time") >= F.lit(since).cast(fact.schema["event_time"].dataType))
    grouped = (
        recent.where(F.col("neighborhood_id").isNotNull())
        .groupBy("neighborhood_id", "hazard_type")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("final_severity").alias("s"), F.count("final_severity").alias("k"))
    )
    named = join_dim(grouped, dim.select("neighborhood_id", "neighborhood_name"), ["neighborhood_id"], max_bytes=max_bytes)
    return (
        named.groupBy("neighborhood_name", "hazard_type")
        .agg(F.sum("n").alias("event_count"), F.try_divide(F.sum("s"), F.sum("k")).alias("avg_severity"))
        .orderBy(F.desc("event_count"), "neighborhood_name", "hazard_type")
        .limit(limit)
    )


def city_rollup(df: DataFrame) -> DataFrame:
    """Distinct people with a valid age, counted and averaged per city."""
    return (
        df.dropDuplicates()
        .where(F.col("age") >= 0)
        .groupBy("city")
        .agg(F.count(F.lit(1)).alias("n"), F.avg("age").alias("avg_age"))
        .orderBy(F.desc("n"), "city")
    )


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table and their total; an empty table shows as 0."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("dataset"), "n")
        for name, df in tables.items()
    ]
    per_table = reduce(DataFrame.unionByName, counts)
    total = per_table.agg(F.sum("n").alias("n")).select(F.lit("TOTAL").alias("dataset"), "n")
    return per_table.unionByName(total)


def layer_quality(df: DataFrame, layers: DataFrame | None = None) -> DataFrame:
    """Success percentage per layer; a listed layer without samples counts 0 records."""
    per_layer = df.groupBy("layer").agg(
        F.sum("records").alias("records"), F.sum("errors").alias("errors")
    )
    if layers is not None:
        per_layer = layers.select("layer").join(per_layer, "layer", "left")
    records, errors = F.coalesce("records", F.lit(0)), F.coalesce("errors", F.lit(0))
    return per_layer.select(
        "layer",
        records.alias("records"),
        errors.alias("errors"),
        F.try_divide(F.lit(100.0) * (records - errors), records).alias("success_pct"),
        F.sum(errors).over(Window.partitionBy(F.lit(0))).alias("total_errors"),
    )


def layer_yield(df: DataFrame, layers: list[str]) -> DataFrame:
    """Rows of a layer over rows of the layer before it, per source."""
    counts = df.where(F.col("layer").isin(layers)).groupBy("source").pivot("layer", layers).agg(F.sum("records"))
    rows = [
        F.struct(
            F.lit(after).alias("layer"),
            F.try_divide(F.col(after).cast("double"), F.col(before)).alias("yield"),
        )
        for before, after in zip(layers, layers[1:])
    ]
    return counts.select("source", F.inline(F.array(*rows)))


def labeled_counts(df: DataFrame, labels: list[str], value: str) -> DataFrame:
    return df.groupBy(*labels).agg(F.sum(value).alias("total"))


def max_over_table(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.max(column).alias("max_value"))


def duration_histogram(df: DataFrame, operation: str, seconds: str, bounds=DURATION_BOUNDS) -> DataFrame:
    """Cumulative ``le`` buckets per operation, with sum and count on every row."""
    counted = [F.count_if(F.col(seconds) <= b).alias(f"b{i}") for i, b in enumerate(bounds)]
    wide = df.groupBy(operation).agg(
        *counted, F.sum(seconds).alias("sum_seconds"), F.count(seconds).alias("n")
    )
    rows = [F.struct(F.lit(str(b)).alias("le"), F.col(f"b{i}").alias("bucket")) for i, b in enumerate(bounds)]
    rows.append(F.struct(F.lit("+Inf").alias("le"), F.col("n").alias("bucket")))
    return wide.select(operation, "sum_seconds", "n", F.inline(F.array(*rows)))


def dataset_profile(df: DataFrame, columns: list[str] | None = None, exact: bool = False) -> DataFrame:
    """Per column: rows, nulls, distinct values, min, max as text; one row per column.

    Approximate distinct counts take one pass. Exact ones are counted over rows already
    reduced to (column, value), so a frequent value costs one row per task.
    """
    columns = columns or df.columns
    distinct = F.lit(None).cast("bigint") if exact else None
    aggs = []
    for c in columns:
        aggs.append(
            F.struct(
                F.lit(c).alias("column"),
                F.count(F.lit(1)).alias("n_rows"),
                F.count_if(F.col(c).isNull()).alias("n_null"),
                (distinct if exact else F.approx_count_distinct(c)).alias("n_distinct"),
                F.min(c).cast("string").alias("min_value"),
                F.max(c).cast("string").alias("max_value"),
            )
        )
    profile = df.agg(F.array(*aggs).alias("p")).select(F.inline("p"))
    if not exact:
        return profile
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("v")) for c in columns])
    values = df.select(F.inline(cells)).where(F.col("v").isNotNull()).groupBy("column", "v").agg(F.lit(1).alias("one"))
    counts = values.groupBy("column").agg(F.count(F.lit(1)).alias("n_distinct"))
    joined = profile.drop("n_distinct").join(F.broadcast(counts), "column", "left")
    return joined.withColumn("n_distinct", F.coalesce("n_distinct", F.lit(0)))


#: Sizes of the sketches: distinct counts are then off by about 0.8 % (one standard deviation), ranks by 0.7 %.
HLL_BITS, KLL_K = 14, 400


def profile_parts(df: DataFrame, part: Column, columns: list[str]) -> DataFrame:
    """``part, column, n_rows, n_null, distinct, numbers, min_value, max_value``: a profile per part (a day, say)
    that can be merged. ``distinct`` is a HyperLogLog sketch of the values as text, ``numbers`` a KLL sketch of
    their size (null for a column that is no number). One pass; a part's row count does not matter to its size."""
    numeric = {f.name for f in df.schema if isinstance(f.dataType, T.NumericType)}
    rows = []
    for c in columns:
        value = F.col(c).cast("double")
        finite = F.when(value.isNotNull() & ~F.isnan(value), value) if c in numeric else F.lit(None).cast("double")
        rows.append(F.struct(
            F.lit(c).alias("column"), F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col(c).isNull()).alias("n_null"),
            F.hll_sketch_agg(F.col(c).cast("string"), HLL_BITS).alias("distinct"),
            (F.kll_sketch_agg_double(finite, KLL_K) if c in numeric else F.lit(None).cast("binary")).alias("numbers"),
            F.min(F.col(c).cast("string")).alias("min_value"), F.max(F.col(c).cast("string")).alias("max_value")))
    return df.groupBy(part.alias("part")).agg(F.array(*rows).alias("p")).select("part", F.inline("p"))


def merge_profiles(parts: DataFrame, quantiles: tuple[float, ...] = (0.5,)) -> DataFrame:
    """One row per column from any number of parts, or of profiles of parts: ``column, n_rows, n_null, n_distinct,
    quantiles, min_value, max_value`` (as text, so in the order of text). The data are not read again."""
    merged = parts.groupBy("column").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_null").alias("n_null"), F.hll_sketch_estimate(F.hll_union_agg("distinct")).alias("n_distinct"),
        F.kll_merge_agg_double("numbers").alias("numbers"), F.max(F.col("numbers").isNotNull()).alias("numeric"), F.min("min_value").alias("min_value"), F.max("max_value").alias("max_value"))
    # a column that is no number, or holds none, has no quantiles
    held = F.when(F.col("numeric"), F.kll_sketch_get_n_double("numbers") > 0)
    asked = F.array(*[F.kll_sketch_get_quantile_double("numbers", F.lit(q)) for q in quantiles])
    return merged.select("column", "n_rows", "n_null", "n_distinct", F.when(held, asked).alias("quantiles"), "min_value", "max_value")


def spatial_density(
    df: DataFrame, size: float, ts: str, lon: str = "longitude", lat: str = "latitude",
    max_bytes: int | None = None,
) -> DataFrame:
    """Events in the row's cell, and in its cell on its day, added to every row. A row without a
    place has neither, one without a time has the first."""
    cell = grid.grid_cell(lon, lat, size)
    # a day no calendar of events reaches stands for none, so that such rows find their cell
    day = F.coalesce(F.to_date(ts), F.lit("0001-01-01").cast("date"))
    marked = df.withColumns({"cx": cell["cx"], "cy": cell["cy"], "day": day})
    daily = marked.groupBy("cx", "cy", "day").agg(F.count(F.lit(1)).alias("event_frequency"))
    # the per-cell count comes from the daily counts, not from another pass
    total = daily.groupBy("cx", "cy").agg(F.sum("event_frequency").alias("spatial_density"))
    figures = daily.join(total, ["cx", "cy"])
    joined = join_dim(marked, figures, ["cx", "cy", "day"], "left", max_bytes=max_bytes)
    return joined.withColumns({"event_frequency": F.when(F.to_date(ts).isNotNull(), F.col("event_frequency")), "day": F.to_date(ts)})


# -------------------------------------------------------------- model metrics


def confusion(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n")
    )


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0))


def classification_metrics(df: DataFrame, label: str, prediction: str, groups: list[str] | None = None) -> DataFrame:
    """Accuracy, binary precision/recall/F1 and support-weighted F1; 0 where undefined."""
    groups = groups or []
    is_label, is_pred = F.col(label) == 1, F.col(prediction) == 1
    c = df.groupBy(*groups).agg(
        F.count_if(is_label & is_pred).alias("tp"),
        F.count_if(~is_label & is_pred).alias("fp"),
        F.count_if(is_label & ~is_pred).alias("fn"),
        F.count_if(~is_label & ~is_pred).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(n) for n in ("tp", "fp", "fn", "tn"))
    total = tp + fp + fn + tn
    f1_one, f1_zero = _ratio(2 * tp, 2 * tp + fp + fn), _ratio(2 * tn, 2 * tn + fn + fp)
    weighted = F.coalesce(F.try_divide((tp + fn) * f1_one + (tn + fp) * f1_zero, total), F.lit(0.0))
    return c.select(
        *groups,
        total.alias("n"),
        _ratio(tp + tn, total).alias("accuracy"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        f1_one.alias("f1"),
        weighted.alias("f1_weighted"),
    )


def regression_metrics(df: DataFrame, label: str, prediction: str, groups: list[str] | None = None) -> DataFrame:
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    error = y - p
    sums = df.groupBy(*(groups or [])).agg(
        F.count(error).alias("n"), F.avg(error * error).alias("mse"), F.var_pop(y).alias("v")
    )
    r2 = F.lit(1.0) - F.try_divide(F.col("mse"), F.col("v"))
    return sums.select(*(groups or []), "n", "mse", F.sqrt("mse").alias("rmse"), r2.alias("r2"))


# ----------------------------------------------------------------------- sets


def union_sparse(tables: dict[str, DataFrame]) -> DataFrame:
    """Stack unlike tables: missing columns are null, ``data_source`` names the origin."""
    tagged = [df.withColumn("data_source", F.lit(name)) for name, df in tables.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def fact_union(quakes: DataFrame, requests: DataFrame, infrastructure: DataFrame, load_time: Column | None = None) -> DataFrame:
    """The three silver tables as one fact. Infrastructure has no event time of its own."""

    def part(df, event_id, description, event_time):
        return df.select(
            F.col(event_id).cast("string").alias("event_id"),
            F.col(description).alias("event_description"),
            F.col("geometry").alias("event_geometry"),
            F.col("ai_severity").cast("int").alias("severity"),
            F.col("ai_hazard_type").alias("hazard_type"),
            event_time.cast("timestamp").alias("event_time"),
        )

    when_loaded = F.lit(None) if load_time is None else load_time
    return (
        part(quakes, "earthquake_id", "place", F.col("time"))
        .unionByName(part(requests, "request_id", "complaint_type", F.col("created_date")))
        .unionByName(part(infrastructure, "osm_id", "name", when_loaded))
    )


def merge_records(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Upsert by key: new values win where present, everything else stays.

    One aggregate over both sides instead of a full outer join: rows combine before
    the shuffle, and repeated keys cannot multiply.
    """
    values = [c for c in old.columns if c not in keys]
    stacked = old.withColumn("__side", F.lit(0)).unionByName(new.withColumn("__side", F.lit(1)))
    newest = [
        F.max_by(c, F.when(F.col(c).isNotNull(), F.col("__side"))).alias(c) for c in values
    ]
    return stacked.groupBy(*keys).agg(*newest)


# ---------------------------------------------------------------------- top-k


def latest_requests(df: DataFrame, limit: int = 1000, lat_min: float = 40.5, lat_max: float = 41.0) -> DataFrame:
    """Newest requests with a usable latitude (a top-k report)."""
    usable = df.where(F.col("latitude").between(lat_min, lat_max))
    return usable.orderBy(F.desc("created_date"), F.desc("request_id")).limit(limit)


# The area and magnitude the strongest-quakes report asks for.
QUAKE_BOX = (40.0, 42.0, -75.0, -73.0)
QUAKE_MINIMUM = 0.5


def strongest_quakes(df: DataFrame, start: str, end: str, box=QUAKE_BOX, minimum: float = QUAKE_MINIMUM) -> DataFrame:
    kind = df.schema["time"].dataType
    lat_min, lat_max, lon_min, lon_max = box
    return df.where(
        (F.col("magnitude") >= minimum)
        & F.col("latitude").between(lat_min, lat_max)
        & F.col("longitude").between(lon_min, lon_max)
        & (F.col("time") >= F.lit(start).cast(kind))
        & (F.col("time") < F.lit(end).cast(kind))
    ).orderBy(F.desc("magnitude"), "earthquake_id")


def nearest_events(df: DataFrame, metres: str, key: str, within_m: float = 1000.0, limit: int = 50) -> DataFrame:
    return df.where(F.col(metres) < within_m).orderBy(metres, key).limit(limit)


def rank_features(df: DataFrame, top: int | None = None) -> DataFrame:
    """Importances normalised to sum 1, largest first. One row per feature of a model."""
    total = Window.partitionBy(F.lit(0))
    ranked = df.withColumn("share", F.col("importance") / F.sum("importance").over(total)).orderBy(
        F.desc("importance"), "feature"
    )
    return ranked if top is None else ranked.limit(top)


def best_model(df: DataFrame, metric: str = "rmse", name: str = "model") -> DataFrame:
    """The model with the lowest metric; equal metrics go to the first name."""
    return df.agg(F.min(F.struct(F.col(metric).alias(metric), F.col(name).alias(name))).alias("b")).select("b.*")


def audit_sample(df: DataFrame, key: str, percent: int = 5, seed: int = 42) -> DataFrame:
    """Repeatable sample by key hash (a sampling operator)."""
    return df.where(hash_bucket(F.col(key), seed, 100) < percent)
