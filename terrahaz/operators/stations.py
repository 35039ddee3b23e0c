"""As-of join in space and time: the reading of the nearest station that has one.

The nearest station of an event may be silent at its time, and the next one too. So stations are
met level by level as in the nearest search (candidates by an equi-join on the cell), and the nearest that
has a reading wins once it is no farther than the radius the cells surely cover. Events still open go on to
coarser cells. Whether a station has one is told without its readings: time is cut into blocks as long as a reading
lasts, the block is part of the join's key, and two times a station and block say when it is heard. Only the
winner is asked for its latest reading, by one as-of join on the station.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrahaz.functions import geometry as G
from terrahaz.functions import grid
from terrahaz.operators import ordered as W
from terrahaz.operators import spatial as S
from terrahaz.operators.sizing import ROWS_PER_TASK, materialize, skew_join


def _block(micros: Column, age: int | None) -> Column:
    """Begin of the stretch of time, as long as a reading lasts, in which an event falls; one for all where readings last."""
    return F.lit(0).cast("bigint") if age is None else micros - F.pmod(micros, F.lit(max(age, 1)).cast("bigint"))


def _heard(told: DataFrame, age: int | None) -> DataFrame:
    """``fid, block, since, upto`` of readings (``fid, r``): at a time in a block, a station has a reading of at most
    ``age`` microseconds if the time is not before ``since`` or not after ``upto``. The former is its first reading of the
    block, the latter the end of its last one of the block before; no other reading lasts into the block."""
    if age is None:
        ends = told.select("fid", _block(F.col("r"), age).alias("block"), F.col("r").alias("since"), F.lit(None).cast("bigint").alias("upto"))
    else:
        begun = F.struct(_block(F.col("r"), age).alias("block"), F.col("r").alias("since"), F.lit(None).cast("bigint").alias("upto"))
        lasting = F.struct((_block(F.col("r"), age) + max(age, 1)).alias("block"), F.lit(None).cast("bigint").alias("since"), (F.col("r") + age).alias("upto"))
        ends = told.select("fid", F.inline(F.array(begun, lasting)))
    return ends.groupBy("fid", "block").agg(F.min("since").alias("since"), F.max("upto").alias("upto"))


def nearest_reading(
    events: DataFrame,
    stations: DataFrame,
    readings: DataFrame,
    values: list[str],
    *,
    ts: str = "ts",
    lon: str = "longitude",
    lat: str = "latitude",
    station: str = "station_id",
    s_lon: str = "longitude",
    s_lat: str = "latitude",
    r_ts: str = "ts",
    max_age_s: float | None = None,
    rows_per_task: int = ROWS_PER_TASK,
    rows_per_range: int = W.ROWS_PER_RANGE,
) -> DataFrame:
    """Every event with ``values`` of the latest reading, at or before its time and at most ``max_age_s``
    seconds old, of the nearest station (metres rounded to mm, then id) that has one; with ``station``,
    ``station_m`` and ``reading_ts``. Events without time, place or reading keep nulls.

    Of a station's readings at one time the largest value tuple counts; of several places of a station the
    smallest.
    """
    told = readings.dropna(subset=[station, r_ts])
    age = None if max_age_s is None else round(max_age_s * 1e6)
    heard = materialize(_heard(told.select(F.col(station).alias("fid"), F.unix_micros(F.col(r_ts).cast("timestamp")).alias("r")), age), "station-heard")
    placed = stations.where(S._located(F.col(s_lon), F.col(s_lat))).groupBy(F.col(station).alias("fid")).agg(
        F.min(F.struct(F.col(s_lon).alias("fx"), F.col(s_lat).alias("fy"))).alias("at"))
    sites = materialize(placed.join(heard.select("fid").distinct(), "fid").select("fid", "at.fx", "at.fy", F.lit(0).alias("cat")), "stations")
    plan = S._search_plan(sites)
    asking = materialize(skew_join(heard, sites.drop("cat"), ["fid"], "inner", rows_per_task), "station-sites")
    rows = materialize(events.withColumn("__row", F.monotonically_increasing_id()), "station-events")
    time = F.unix_micros(F.col(ts).cast("timestamp"))
    still_open = rows.where(S._located(F.col(lon), F.col(lat)) & F.col(ts).isNotNull()).select(
        "__row", F.col(lon).alias("__x"), F.col(lat).alias("__y"), F.col(ts).alias("__at"), time.alias("__t"), _block(time, age).alias("block"))
    x, y = F.col("__x"), F.col("__y")
    metres = F.round(G.haversine_m(x, y, F.col("fx"), F.col("fy")), 3)
    alive = (F.col("since") <= F.col("__t")) | (F.col("upto") >= F.col("__t"))
    answers = []
    levels = [] if plan is None else [*plan.levels, 0]
    for level in levels:
        probing = still_open.withColumn("cell", grid.quad_cell(x, y, level))
        # at level 0 every cell is a neighbour of every other
        filed = S._filed(asking, level) if level else asking.withColumn("cell", F.lit(0).cast("bigint"))
        met = skew_join(probing, filed, ["cell", "block"], "inner", rows_per_task)
        best = met.where(alive).groupBy("__row").agg(
            F.min(F.struct(metres.alias("m"), F.col("fid"))).alias("best"), F.first("__y").alias("__y"), F.first("__at").alias("__at"))
        sure = F.lit(True) if level == 0 else F.col("best.m") <= S._safe_radius(y, level)
        found = materialize(best.where(sure).select("__row", "__at", "best.m", "best.fid"), "station-answers")
        answers.append(found)
        if level:
            still_open = materialize(still_open.join(found.select("__row"), "__row", "left_anti"), "station-open")
            if still_open.isEmpty():
                break
    carried = F.struct(F.col(r_ts).alias("at"), *values)
    told = told.select(F.col(station).alias("fid"), F.col(r_ts).alias("__rt"), carried.alias("reading"))
    if answers:
        nearest = reduce(DataFrame.unionByName, answers)
        read = W.asof_join(nearest, told, ["fid"], "__at", "__rt", ["reading"], rows_per_range)
        out = rows.join(read.select("__row", F.struct("m", "fid", "reading").alias("best")), "__row", "left")
    else:
        kind = f"struct<m:double,fid:{readings.schema[station].dataType.simpleString()},reading:{told.schema['reading'].dataType.simpleString()}>"
        out = rows.withColumn("best", F.lit(None).cast(kind))
    return out.select(
        *events.columns, F.col("best.fid").alias(station), F.col("best.m").alias("station_m"),
        F.col("best.reading.at").alias("reading_ts"), *[F.col("best.reading")[v].alias(v) for v in values])
