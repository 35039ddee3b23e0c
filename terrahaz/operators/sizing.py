"""Size checks before broadcasting, and joins that survive a hot key.

A side is broadcast only after one aggregate job measured it; beyond the limit the
join shuffles, and keys holding more rows than one task should take are split.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrahaz.session import scratch

MAX_BROADCAST_BYTES = 64 * 1024 * 1024
ROWS_PER_TASK = 2_000_000


@dataclass(frozen=True)
class Size:
    rows: int
    bytes: int


def row_bytes(columns: list[str]) -> Column:
    """Upper-end estimate of a row's width: its JSON text plus fixed overhead."""
    return F.length(F.to_json(F.struct(*columns))) + F.lit(16)


def measure(df: DataFrame) -> Size:
    """Rows and bytes of ``df``, in one distributed aggregate."""
    row = df.agg(
        F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(row_bytes(df.columns)), F.lit(0)).alias("bytes")
    ).first()
    return Size(int(row["rows"]), int(row["bytes"]))


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a table under the shared folder and read it back.

    Cuts lineage in a way that survives the loss of an executor, and keeps the plan that
    uses the table small.
    """
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fits_broadcast(df: DataFrame, max_bytes: int | None = None) -> bool:
    limit = MAX_BROADCAST_BYTES if max_bytes is None else max_bytes
    return limit > 0 and measure(df).bytes <= limit


def _hot_keys(df: DataFrame, on: list[str], rows_per_task: int, salts: str) -> DataFrame:
    """Keys of more than ``rows_per_task`` rows and into how many parts to split them."""
    counted = df.groupBy(*on).agg(F.count(F.lit(1)).alias("__n"))
    hot = counted.where(F.col("__n") > rows_per_task)
    return hot.select(*on, F.ceil(F.col("__n") / F.lit(rows_per_task)).cast("int").alias(salts))


def skew_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    how: str = "inner",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Shuffle join with hot keys split over several tasks.

    Keys with more than ``rows_per_task`` rows get ``ceil(n / rows_per_task)`` salts. A row takes
    one salt of its own side by hash of its content and is repeated for every salt of the other
    side, so every pair still meets exactly once. An inner join splits both sides; the other types
    need all of a key's right rows together and split the left. Hot keys are counted once and
    written to the shared folder; without any the join is a plain one. Copies of one whole row
    share a salt; AQE's skew join splits those by map output.
    """
    if how not in {"inner", "left", "left_semi", "left_anti"}:
        raise ValueError(f"join type {how} cannot be salted on the left side")
    hot = _hot_keys(left, on, rows_per_task, "__l")
    if how == "inner":
        hot = hot.join(_hot_keys(right, on, rows_per_task, "__r"), on, "full").dropna(subset=on)
    else:
        hot = hot.withColumn("__r", F.lit(None).cast("int"))
    hot = materialize(hot, "hot-keys")
    if hot.isEmpty():
        return left.join(right, on, how)
    renamed = [f"__hot_{i}" for i in range(len(on))]
    named = hot.select(*[F.col(c).alias(r) for c, r in zip(on, renamed)], "__l", "__r")
    # a handful of keys in practice; beyond the limit the planner shuffles
    table = F.broadcast(named) if fits_broadcast(named) else named

    def salted(df: DataFrame, own: str, other: str) -> DataFrame:
        condition = F.lit(True)
        for c, r in zip(on, renamed):
            condition = condition & df[c].eqNullSafe(F.col(r))  # rows without a key are spread too
        content = F.xxhash64(*[F.col(c) for c in df.columns])
        mine = F.coalesce(F.pmod(content, F.col(own)).cast("int"), F.lit(0))
        out = df.join(table, condition, "left").withColumns({f"__salt{own}": mine, f"__n{other}": F.coalesce(other, F.lit(1))})
        out = out.drop(*renamed, "__l", "__r")
        return out.withColumn(f"__salt{other}", F.explode(F.sequence(F.lit(0), F.col(f"__n{other}") - 1))).drop(f"__n{other}")

    keys = [*on, "__salt__l", "__salt__r"]
    joined = salted(left, "__l", "__r").join(salted(right, "__r", "__l"), keys, how)
    return joined.drop("__salt__l", "__salt__r")


def join_dim(
    fact: DataFrame,
    dim: DataFrame,
    on: list[str],
    how: str = "inner",
    max_bytes: int | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Fact to dimension: broadcast a dimension measured to be small, else split hot keys."""
    if fits_broadcast(dim, max_bytes):
        return fact.join(F.broadcast(dim), on, how)
    return skew_join(fact, dim, on, how, rows_per_task)
