"""Nearest neighbours by a permutation index.

Pivots are a bounded sample of the vectors (``n_pivots``, those with the smallest hashes). A
vector is represented by its ``prefix`` nearest pivots in order; every vector is posted in the
inverted file of each of them, together with the pivot's place. A query reads the files of its own
nearest pivots and adds up the footrule distance, a pivot missing from one of the two lists
counting as if it stood just behind the list. The vectors of smallest footrule, ties at the edge
included, are ranked by the measure itself.

The inverted files are cut by vector into shards of bounded size; blocks of queries meet shards in
a cogroup, so every query sees every shard and no task holds more than one shard and one block.
Of ``n`` vectors ``reach * sqrt(n)`` are ranked for a query (at least ``floor`` in a shard), in equal
shares from all shards: a share that falls as the table grows, at a recall that does not.

Defined cases: vectors that are null, all zero, of another length than most, or with null or
non-finite components take no part, nor do rows without an id; repeated rows are candidates of each
other; ties go to the smaller id; no usable vector gives no rows; other columns are ignored. The result
is written to the shared folder, so what is read of it later does not search again.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrahaz.llm import tables

PIVOTS = 256
PREFIX = 64
REACH = 12.0
FLOOR = 500
SHARD = 16384
BLOCK = 16384


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``row, id, vec``: vectors fit for search, as doubles, with a number of their own."""
    vec = F.col(vector_col).cast("array<double>")
    fit = vec.isNotNull() & (F.size(vec) > 0) & ~F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return df.select(F.col(id_col).alias("id"), vec.alias("vec")).where(
        fit & F.exists("vec", lambda x: x != 0) & F.col("id").isNotNull()).withColumn(
        "row", F.monotonically_increasing_id())


def matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    a = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return a.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def permutations(x: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """For each row the ``prefix`` pivots of largest inner product, nearest first."""
    near = -(x @ pivots.T)
    prefix = min(prefix, near.shape[1])
    first = np.argpartition(near, prefix - 1, axis=1)[:, :prefix]
    order = np.lexsort((first, np.take_along_axis(near, first, 1)), axis=1)
    return np.take_along_axis(first, order, 1).astype(np.int32)


class InvertedFiles:
    """Posting lists of one shard: for each pivot the vectors that list it, and its place there."""

    def __init__(self, perms: np.ndarray, n_pivots: int):
        n, self.prefix = perms.shape
        pivot = perms.ravel()
        order = np.argsort(pivot, kind="stable")
        self.n = n
        self.vector = np.repeat(np.arange(n, dtype=np.int32), self.prefix)[order]
        self.place = np.tile(np.arange(self.prefix, dtype=np.int32), n)[order]
        self.start = np.searchsorted(pivot[order], np.arange(n_pivots + 1))

    def footrule(self, perm: np.ndarray) -> np.ndarray:
        """Footrule distance of the query's list to every vector, less a constant of the query."""
        parts, gains = [], []
        for place, pivot in enumerate(perm):
            a, b = self.start[pivot], self.start[pivot + 1]
            at = self.place[a:b]
            parts.append(self.vector[a:b])
            # both lists hold the pivot: the difference of places, not the two distances to the end
            gains.append(np.abs(at - place) - (self.prefix - at) - (self.prefix - place))
        return np.bincount(np.concatenate(parts), weights=np.concatenate(gains), minlength=self.n)


def _search(queries: pa.Table, vectors: pa.Table, n_pivots: int, k: int, share: float, floor: int, width: int):
    out = {c: [] for c in ("query_row", "query_id", "id", "score")}
    if queries.num_rows and vectors.num_rows:
        x, perms = matrix(vectors["vec"], width), matrix(vectors["perm"], len(vectors["perm"][0]))
        ids, rows = vectors["id"].to_numpy(), vectors["row"].to_numpy()
        files = InvertedFiles(perms, n_pivots)
        take = min(len(x), max(floor, int(np.ceil(share * len(x)))))
        qx, qperm = matrix(queries["vec"], width), matrix(queries["perm"], perms.shape[1])
        for q, perm, q_row, q_id in zip(qx, qperm, queries["row"].to_numpy(), queries["id"].to_pylist(), strict=True):
            far = files.footrule(perm)
            edge = np.partition(far, take - 1)[take - 1]
            near = np.flatnonzero((far <= edge) & (rows != q_row))
            score = (x[near] * q).sum(axis=1)  # one order of addition for every row: equal vectors tie
            best = np.lexsort((ids[near], -score))[:k]
            out["query_row"].append(np.full(len(best), q_row))
            out["query_id"] += [q_id] * len(best)
            out["id"].append(ids[near][best])
            out["score"].append(score[best])
    flat = {c: np.concatenate(v) if v and c != "query_id" else v for c, v in out.items()}
    return pa.table({c: pa.array(v, type=t) for (c, v), t in zip(
        flat.items(), (pa.int64(), pa.int64(), pa.int64(), pa.float64()), strict=True)})


def nearest(df: DataFrame, queries, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
            n_pivots: int = PIVOTS, prefix: int = PREFIX, reach: float = REACH, floor: int = FLOOR,
            shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """``query_id, rank, <id_col>, score``: the ``k`` rows of largest inner product with each
    query row; ``queries`` is a condition on ``df``'s id (a column named ``id``)."""
    spark = df.sparkSession
    rows = tables.staged(usable(df, id_col, vector_col).withColumn("id", F.col("id").cast("long")), "vectors")
    empty = spark.createDataFrame([], f"query_id long, rank int, {id_col} long, score double")
    width = rows.groupBy(F.size("vec").alias("w")).count().orderBy(F.desc("count"), "w").first()
    if width is None:
        return empty
    width = width["w"]
    rows = rows.where(F.size("vec") == width)
    # the pivots: a sample of at most n_pivots rows, small whatever the table
    sample = rows.select("vec", F.xxhash64("vec", "id").alias("h")).orderBy("h", "vec").limit(n_pivots).collect()
    pivots = np.array([r["vec"] for r in sample])
    prefix = min(prefix, len(pivots))
    sizes = rows.agg(F.count("*").alias("n"), F.count(F.when(queries, 1)).alias("q")).first()
    share = min(1.0, reach / sizes["n"] ** 0.5)
    shards, blocks = -(-sizes["n"] // shard), max(1, -(-sizes["q"] // block))

    def represent(batches):
        for b in batches:
            p = permutations(matrix(b["vec"], width), pivots, prefix)
            yield dict(b) | {"perm": list(p)}

    posted = tables.staged(tables.map_batches(
        rows.select("row", "id", "vec"), "row long, id long, vec array<double>, perm array<int>", represent), "postings")
    vectors = posted.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int")).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    asked = posted.where(queries).withColumn("block", F.pmod(F.xxhash64("row", F.lit(1)), F.lit(blocks)).cast("int")).withColumn(
        "shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    n = len(pivots)
    found = tables.staged(asked.groupBy("shard", "block").cogroup(vectors.groupBy("shard", "block")).applyInArrow(
        lambda q, v: _search(q, v, n, k, share, floor, width), "query_row long, query_id long, id long, score double"), "neighbours")
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc("id"))
    return (
        found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score")
    )
