"""Small helpers the operators share: reading tables, batch mapping, staging."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from terrahaz.session import scratch


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, body``: only the two columns an operator reads; a null text is empty."""
    return df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("body"))


def map_batches(df: DataFrame, ddl: str | StructType, fn: Callable[[Iterator[dict]], Iterator[dict]]) -> DataFrame:
    """``mapInArrow`` where ``fn`` turns an iterator of column dicts (name -> Arrow array) into
    column dicts (name -> list, numpy array or Arrow array)."""
    fields = StructType.fromDDL(ddl) if isinstance(ddl, str) else ddl

    def run(batches):
        schema = to_arrow_schema(fields)

        def columns():
            for b in batches:
                if b.num_rows:
                    yield {n: b.column(i) for i, n in enumerate(b.schema.names)}

        for out in fn(columns()):
            arrays = []
            for f in schema:
                a = out[f.name]
                arrays.append(a.cast(f.type) if isinstance(a, pa.Array) else pa.array(a, type=f.type))
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return df.mapInArrow(run, fields)


def slices(batch: dict, column: str, size: int = 1 << 20, rows: int = 1024) -> Iterator[dict]:
    """Parts of a batch with about ``size`` bytes of a text or binary ``column`` and at most ``rows`` rows, so
    that what is made of a part does not grow with rows per batch times length."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(ends):
        before = int(ends[at - 1]) if at else 0
        n = min(rows, max(1, int(np.searchsorted(ends, before + size, "right")) - at))
        yield {c: v.slice(at, n) for c, v in batch.items()}
        at += n


def annotate(df: DataFrame, text_col: str, ddl: str, fn: Callable[[bytes], tuple], name: str) -> DataFrame:
    """``df`` with a struct column ``name`` of what ``fn`` makes of each text (null: empty); all
    other columns pass through as they are."""
    made = StructType.fromDDL(ddl)
    types = list(to_arrow_schema(made))
    fields = StructType([*df.schema.fields, StructField(name, made)])
    at = df.columns.index(text_col)

    def run(batches):
        for b in batches:
            if b.num_rows:
                bodies = slices({"body": b.column(at).cast(pa.binary())}, "body")
                rows = [fn(x or b"") for part in bodies for x in part["body"].to_pylist()]
                parts = [pa.array(c, type=f.type) for c, f in zip(zip(*rows, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*b.columns, pa.StructArray.from_arrays(parts, fields=types)], schema=to_arrow_schema(fields))

    return df.mapInArrow(run, fields)


def per_text(df: DataFrame, id_col: str, text_col: str, ddl: str, fn: Callable[[bytes], tuple]) -> DataFrame:
    """One output row per row: the id and the columns ``fn(text)`` gives."""
    rows = df.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    return annotate(rows, "_text", ddl, fn, "_made").select(F.col("_id").alias(id_col), "_made.*")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` is called that."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write to a fresh table in the shared folder and read it back: lineage ends there, and a
    lost executor costs a re-read of files all executors reach."""
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
