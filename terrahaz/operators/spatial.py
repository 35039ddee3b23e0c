"""Spatial joins: point in polygon, nearest facility, within distance.

All of them turn the spatial predicate into an equi-join on a quad-grid cell:

* A small indexed side (measured) becomes a cell dictionary, one row per cell with
  an array of entries, and is broadcast. Points are looked up in place: no shuffle of
  the points, and one input row stays one row.
* A larger side is shuffled on the cell. The points are first reduced to distinct
  locations, hot cells are split (``skew_join``), and results return to the rows by an
  equi-join on the location.

Polygons become an index table that is written once and opened by every join that asks for the
same polygons. A cell wholly inside a polygon needs no geometry. Any other cell keeps the edges that
touch it, and whether its reference point is inside: a point of the cell is inside if the way
from there to it crosses edges an even number of times, else the other way round. So a cell
never needs edges from elsewhere, and cells are divided until they hold few.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from terrahaz.functions import geometry as G
from terrahaz.functions import grid
from terrahaz.operators.sizing import (
    MAX_BROADCAST_BYTES,
    ROWS_PER_TASK,
    fits_broadcast,
    join_dim,
    materialize,
    row_bytes,
    skew_join,
)
from terrahaz.session import scratch, shared_folder

#: Levels of cells. A polygon starts at the finest of ``START_LEVELS`` at which its box spans at most
#: ``MAX_SPAN`` cells each way; a cell with more than ``MAX_EDGES`` edges is divided into the cells of the
#: next level, ``STEP`` finer.
STEP = 3
START_LEVELS = (18, 15, 12, 9, 6, 3, 0)
FINEST = 24
MAX_SPAN = 7
MAX_EDGES = 32
_SLACK = 1e-9
#: The reference point of a cell, in parts of its size. Odd parts, so that round coordinates and their
#: lines do not run through it.
_REF_X, _REF_Y = 0.38196601125010515, 0.6180339887498949


# ------------------------------------------------------------- polygon index


@dataclass(frozen=True)
class PolygonIndex:
    """A written index. ``entries``: ``level, cell, item, full, base, edges``; ``dictionary``: the same
    grouped by cell (none for a large one); ``largest``: most edges in an entry; ``firsts``: of a large one, the
    index of ``first_entries``."""

    path: str
    entries: DataFrame
    dictionary: DataFrame | None
    levels: tuple[int, ...]
    rows: int
    bytes: int
    largest: int
    small: bool
    firsts: PolygonIndex | None = None

    @property
    def deciding(self) -> PolygonIndex:
        """The index for joins that ask for the first polygon or for any."""
        return self.firsts or self


def _level_of_box(box: Column) -> Column:
    width = F.greatest(box["max_x"] - box["min_x"], box["max_y"] - box["min_y"])
    choice = F.lit(0)
    for level in reversed(START_LEVELS):
        choice = F.when(width <= F.lit(MAX_SPAN * grid.quad_size(level)), F.lit(level)).otherwise(choice)
    return choice


def _reference(cx: Column, cy: Column, level) -> tuple[Column, Column]:
    size = grid.size_of(level)
    return (cx + F.lit(_REF_X)) * size - F.lit(180.0), (cy + F.lit(_REF_Y)) * size - F.lit(90.0)


def _down_or_across(e: Column, x: Column, y: Column, corner_x: Column) -> Column:
    """Is the way from (x, y) level to (corner_x, y), then straight up without end, crossed oddly?"""
    return G.crosses_right(e, x, y) != (G.crosses_right(e, corner_x, y) != G.crosses_up(e, corner_x, y))


def _touching_cells(e: Column, level: Column, inside: tuple[Column, Column, Column, Column] | None = None) -> Column:
    """``cx, cy`` of the cells that a segment touches, to within ``_SLACK``; ``inside`` limits them to a
    range of columns and rows."""
    size, slack = grid.size_of(level), F.lit(_SLACK)
    west, east = F.least(e["x1"], e["x2"]) - slack, F.greatest(e["x1"], e["x2"]) + slack
    south, north = F.least(e["y1"], e["y2"]) - slack, F.greatest(e["y1"], e["y2"]) + slack
    x0, x1 = grid.quad_column(west, level), grid.quad_column(east, level)
    y0, y1 = grid.quad_row(south, level), grid.quad_row(north, level)
    if inside is not None:
        x0, x1, y0, y1 = F.greatest(x0, inside[0]), F.least(x1, inside[1]), F.greatest(y0, inside[2]), F.least(y1, inside[3])

    def touches(c: Column) -> Column:
        """Not all corners on one side of the segment's line."""
        left, low = c["cx"] * size - F.lit(180.0) - slack, c["cy"] * size - F.lit(90.0) - slack
        sides = [G.side(e, x, y) for x in (left, left + size + 2 * slack) for y in (low, low + size + 2 * slack)]
        return (F.least(*sides) <= 0) & (F.greatest(*sides) >= 0)

    cells = F.flatten(F.transform(F.sequence(x0, x1), lambda cx: F.transform(
        F.sequence(y0, y1), lambda cy: F.struct(cx.alias("cx"), cy.alias("cy")))))
    none = F.array().cast("array<struct<cx:bigint,cy:bigint>>")
    return F.when((x0 <= x1) & (y0 <= y1), F.filter(cells, touches)).otherwise(none)


CELL = ["pid", "level", "cx", "cy"]


def _odd(c: Column) -> Column:
    return F.coalesce(F.sum(c.cast("long")), F.lit(0)) % 2 == 1


def _first_round(shapes: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The cells of each polygon's box with the parity of their reference points, and the edges in them."""
    level, e = F.col("level"), F.col("e")
    ranges = {n: f(b, level) for n, f, b in (
        ("x0", grid.quad_column, F.col("box.min_x")), ("x1", grid.quad_column, F.col("box.max_x")),
        ("y0", grid.quad_row, F.col("box.min_y")), ("y1", grid.quad_row, F.col("box.max_y")))}
    boxes = shapes.select("pid", "level", *[c.alias(n) for n, c in ranges.items()])
    cells = boxes.select("pid", "level", F.explode(F.sequence("x0", "x1")).alias("cx"), "y0", "y1").select(
        "pid", "level", "cx", F.explode(F.sequence("y0", "y1")).alias("cy"))
    # rows of cells whose reference line an edge crosses, one more on either side against rounding
    low, high = F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"])
    rows = F.sequence(F.greatest(grid.quad_row(low, level) - 1, F.col("y0")), F.least(grid.quad_row(high, level) + 1, F.col("y1")))
    columns = F.sequence(F.col("x0"), F.least(grid.quad_column(F.greatest(e["x1"], e["x2"]), level) + 1, F.col("x1")))
    ray = edges.select("pid", "level", "e", "x0", "x1", F.explode(rows).alias("cy"))
    _, ref_y = _reference(F.lit(0).cast("bigint"), F.col("cy"), level)
    ray = ray.where((e["y1"] > ref_y) != (e["y2"] > ref_y)).select("pid", "level", "e", F.explode(columns).alias("cx"), "cy")
    ref_x, ref_y = _reference(F.col("cx"), F.col("cy"), level)
    parity = ray.groupBy(*CELL).agg(_odd(G.crosses_right(e, ref_x, ref_y)).alias("odd"))
    cells = cells.join(parity, CELL, "left").withColumn("odd", F.coalesce("odd", F.lit(False)))
    inside = (F.col("x0"), F.col("x1"), F.col("y0"), F.col("y1"))
    local = edges.select("pid", "level", "e", F.explode(_touching_cells(e, level, inside)).alias("c")).select(
        "pid", "level", "c.cx", "c.cy", "e")
    return cells, local


def _next_round(heavy: DataFrame, local: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The cells into which heavy cells (``CELL, odd``) are divided, and the edges in them."""
    e, parts = F.col("e"), 1 << STEP
    crowded = local.join(heavy.select(*CELL), CELL)
    finer = F.col("level") + STEP
    first_x, first_y = F.col("cx") * parts, F.col("cy") * parts
    steps = F.sequence(F.lit(0), F.lit(parts - 1))
    children = F.flatten(F.transform(steps, lambda i: F.transform(steps, lambda j: F.struct((first_x + i).alias("cx"), (first_y + j).alias("cy")))))
    # from the parent's reference point straight to the child's height, then across
    from_x, from_y = _reference(F.col("cx"), F.col("cy"), F.col("level"))
    at = crowded.select("pid", finer.alias("finer"), "e", from_x.alias("from_x"), from_y.alias("from_y"), F.explode(children).alias("c"))
    at = at.withColumnRenamed("finer", "level")
    ref_x, ref_y = _reference(F.col("c.cx"), F.col("c.cy"), F.col("level"))
    turned = G.crosses_up(e, F.col("from_x"), F.col("from_y")) != _down_or_across(e, ref_x, ref_y, F.col("from_x"))
    changed = at.groupBy("pid", "level", F.col("c.cx").alias("cx"), F.col("c.cy").alias("cy")).agg(_odd(turned).alias("changed"))
    cells = heavy.select("pid", finer.alias("finer"), "odd", F.explode(children).alias("c")).select(
        "pid", F.col("finer").alias("level"), "c.cx", "c.cy", "odd")
    cells = cells.join(changed, CELL).withColumn("odd", F.col("odd") != F.col("changed")).drop("changed")
    inside = (first_x, first_x + (parts - 1), first_y, first_y + (parts - 1))
    touched = crowded.select("pid", finer.alias("finer"), "e", F.explode(_touching_cells(e, finer, inside)).alias("c"))
    return cells, touched.select("pid", F.col("finer").alias("level"), "c.cx", "c.cy", "e")


def divided(shapes: DataFrame, edges: DataFrame, max_edges: int = MAX_EDGES):
    """Round by round: all cells (``pid, level, cx, cy, odd, n``: is the reference point inside, how many edges)
    and the edges (``e`` beside the cell) of those that need no further division. ``shapes`` has ``pid, box,
    level``, ``edges`` a row per edge, from ``exploded_edges``; ``e`` may carry more than its four numbers."""
    cells, local = _first_round(shapes, edges)
    while True:
        local = materialize(local, "polygon-edges")
        counted = local.groupBy(*CELL).agg(F.count("*").alias("n"))
        cells = materialize(cells.join(counted, CELL, "left").withColumn("n", F.coalesce("n", F.lit(0))), "polygon-cells")
        fine = (F.col("n") <= max_edges) | (F.col("level") + STEP > FINEST)
        yield cells, local.join(cells.where((F.col("n") > 0) & fine).select(*CELL), CELL, "left_semi")
        heavy = cells.where((F.col("n") > 0) & ~fine)
        if heavy.isEmpty():
            return
        cells, local = _next_round(heavy, local)


def exploded_edges(shapes: DataFrame) -> DataFrame:
    """A row per edge of ``shapes`` (``pid, box, level, edges``), beside the range of cells of the box."""
    box, level = F.col("box"), F.col("level")
    ranges = [grid.quad_column(box["min_x"], level).alias("x0"), grid.quad_column(box["max_x"], level).alias("x1"),
              grid.quad_row(box["min_y"], level).alias("y0"), grid.quad_row(box["max_y"], level).alias("y1")]
    return shapes.select("pid", "level", *ranges, F.explode("edges").alias("e"))


#: Pairs of a cell and an edge judged at once.
_PAIRS_AT_ONCE = 1 << 20


def _entries_in_place(shapes: DataFrame) -> DataFrame:
    """What ``polygon_entries`` returns for polygons (``item, box, level, edges``) of so few edges that no cell has to be
    divided: every cell of the box is judged beside all of its polygon's edges, so no row leaves its task."""
    box, level = F.col("box"), F.col("level")
    ranges = [grid.quad_column(box["min_x"], level).alias("x0"), grid.quad_column(box["max_x"], level).alias("x1"),
              grid.quad_row(box["min_y"], level).alias("y0"), grid.quad_row(box["max_y"], level).alias("y1")]
    item, edges = (shapes.schema[c].dataType.simpleString() for c in ("item", "edges"))

    def run(batches):
        for batch in batches:
            pairs = _cells_of(batch) * pc.list_value_length(batch["edges"]).to_numpy(zero_copy_only=False)
            at = np.flatnonzero(np.diff(np.cumsum(pairs) // _PAIRS_AT_ONCE, prepend=-1))
            for start, end in zip(at, [*at[1:], batch.num_rows], strict=True):
                yield _judged_cells(batch.slice(start, end - start))

    kept = shapes.select("item", level.cast("int").alias("level"), "edges", *ranges)
    return kept.mapInArrow(run, f"level int, cell bigint, item {item}, full boolean, base boolean, edges {edges}")


def _cells_of(batch) -> np.ndarray:
    x0, x1, y0, y1 = (batch[c].to_numpy() for c in ("x0", "x1", "y0", "y1"))
    return (x1 - x0 + 1) * (y1 - y0 + 1)


def _judged_cells(batch) -> pa.RecordBatch:
    """The entries of some polygons, by the expressions of ``_reference``, ``_touching_cells`` and ``geometry``."""
    size = _cells_of(batch)
    shape = np.repeat(np.arange(len(size)), size)
    step = np.arange(len(shape)) - np.repeat(np.cumsum(size) - size, size)
    high = (batch["y1"].to_numpy() - batch["y0"].to_numpy() + 1)[shape]
    cx, cy = batch["x0"].to_numpy()[shape] + step // high, batch["y0"].to_numpy()[shape] + step % high
    level = batch["level"].to_numpy().astype(np.int64)[shape]
    width = 360.0 / np.exp2(level)
    edges = batch["edges"].flatten()
    count = pc.list_value_length(batch["edges"]).to_numpy().astype(np.int64)
    many = count[shape]
    c = np.repeat(np.arange(len(shape)), many)
    e = np.arange(len(c)) + np.repeat((np.cumsum(count) - count)[shape] - (np.cumsum(many) - many), many)
    x1, y1, x2, y2 = (edges.field(n).to_numpy()[e] for n in ("x1", "y1", "x2", "y2"))

    def side(x, y):
        return (x2 - x1) * (y - y1) - (x - x1) * (y2 - y1)

    def crossed(straddles, left, upwards):
        return straddles & (left == upwards)

    w, ref_x, ref_y = width[c], ((cx + _REF_X) * width - 180.0)[c], ((cy + _REF_Y) * width - 90.0)[c]
    turn = side(ref_x, ref_y)
    right = crossed((y1 > ref_y) != (y2 > ref_y), turn > 0, y2 > y1)
    up = crossed((x1 > ref_x) != (x2 > ref_x), turn < 0, x2 > x1)
    left, low = cx[c] * w - 180.0 - _SLACK, cy[c] * w - 90.0 - _SLACK
    corners = [side(x, y) for x in (left, left + w + 2 * _SLACK) for y in (low, low + w + 2 * _SLACK)]
    near = (np.minimum.reduce(corners) <= 0) & (np.maximum.reduce(corners) >= 0)
    for at, a, b, origin in ((cx[c], x1, x2, 180.0), (cy[c], y1, y2, 90.0)):
        near &= (np.floor((np.minimum(a, b) - _SLACK + origin) / w) <= at) & (at <= np.floor((np.maximum(a, b) + _SLACK + origin) / w))

    def times(mask):
        return np.bincount(c[mask], minlength=len(shape))

    odd, held = times(right) % 2 == 1, times(near)
    kept = (held > 0) | odd
    cell = (cy << level) | (cx % (1 << level))
    starts = np.concatenate([[0], np.cumsum(held[kept])]).astype(np.int32)
    columns = {
        "level": pa.array(level[kept].astype(np.int32)), "cell": pa.array(cell[kept]), "item": batch["item"].take(pa.array(shape[kept])),
        "full": pa.array(held[kept] == 0), "base": pa.array(((odd != (times(near & up) % 2 == 1)) & (held > 0))[kept]),
        "edges": pa.ListArray.from_arrays(pa.array(starts), edges.take(pa.array(e[near])))}
    return pa.RecordBatch.from_pydict(columns)


def polygon_entries(
    polygons: DataFrame, key: str, geom: str, attrs: tuple[str, ...] = (), max_edges: int = MAX_EDGES
) -> DataFrame:
    """One row per polygon and covered cell: ``level, cell, item, full, base, edges``; cells wholly outside are
    dropped. Edges are rows until they are gathered in a cell that keeps at most ``max_edges`` of them (more only
    at the finest level, where they cannot be told apart), so the largest row does not grow with a polygon.
    ``base``: is the way from the reference point straight up, as far as the cell's own edges matter, even?"""
    conf = polygons.sparkSession.conf.get("spark.sql.shuffle.partitions")
    spread = polygons.repartition(max(int(conf), polygons.sparkSession.sparkContext.defaultParallelism), key)
    item = F.struct(F.col(key), *[F.col(a) for a in attrs])
    base = spread.select(F.monotonically_increasing_id().alias("pid"), item.alias("item"), G.polygon_edges(geom).alias("edges"))
    # a polygon without edges has no box, hence no cells
    base = base.withColumn("box", G.edges_envelope(F.col("edges"))).where(F.col("box").isNotNull())
    box = F.col("box")
    in_range = (box["min_x"] >= -180) & (box["max_x"] <= 180) & (box["min_y"] >= -90) & (box["max_y"] <= 90)
    refused = F.raise_error(F.lit("polygon leaves the WGS84 range; split it at the antimeridian")).cast("int")
    base = materialize(base.withColumn("level", F.when(in_range, _level_of_box(box)).otherwise(refused)), "polygon-shapes")
    few = F.size("edges") <= max_edges
    in_place = _entries_in_place(base.where(few).select("item", "box", "level", "edges"))
    base = base.where(~few)
    if base.isEmpty():
        return in_place
    shapes = base.select("pid", "item", "box", "level")
    edges = exploded_edges(base)
    ends = []
    for cells, held in divided(shapes, edges, max_edges):
        ends.append(cells.where((F.col("n") == 0) & F.col("odd")).select(
            *CELL, F.lit(True).alias("full"), F.lit(False).alias("base"), F.array().cast(base.schema["edges"].dataType).alias("edges")))
        ref_x, ref_y = _reference(F.col("cx"), F.col("cy"), F.col("level"))
        gathered = held.groupBy(*CELL).agg(
            F.collect_list("e").alias("edges"), _odd(G.crosses_up(F.col("e"), ref_x, ref_y)).alias("up"))
        ends.append(gathered.join(cells.select(*CELL, "odd"), CELL).select(
            *CELL, F.lit(False).alias("full"), (F.col("odd") != F.col("up")).alias("base"), "edges"))
    every = reduce(DataFrame.unionByName, ends).join(shapes.select("pid", "item"), "pid")
    every = every.select("level", grid.pack(F.col("cx"), F.col("cy"), F.col("level")).alias("cell"), "item", "full", "base", "edges")
    return every.unionByName(in_place)


def first_entries(entries: DataFrame) -> DataFrame:
    """The entries that can tell whether a point has a polygon, and which is its first: in a cell wholly inside a polygon
    none of a larger item can. However many polygons lie over one another, few of a cell's entries are left."""
    place = ["level", "cell"]
    tops = entries.where("full").groupBy(*place).agg(F.min("item").alias("top"))
    item, top = F.col("item"), F.col("top")
    told = join_dim(entries, materialize(tops, "polygon-tops"), place, "left")
    return told.where(top.isNull() | (item < top) | (F.col("full") & (item == top))).select(*entries.columns)


#: Changes with what an index holds, so that older ones are not opened.
_FORMAT = 3
_MANIFEST = "path string, key string, levels array<int>, rows long, bytes long, largest int, grouped boolean, firsts boolean, schema string"


def write_polygon_index(
    polygons: DataFrame, path: str, *, key: str = "neighborhood_id", geom: str = "geometry", attrs: tuple[str, ...] = (),
    max_edges: int = MAX_EDGES, content: str = "",
) -> PolygonIndex:
    """Write the index of a polygon table under ``path`` and open it.

    ``entries`` is partitioned by level, ``dictionary`` (written if the whole fits a broadcast) has a row per
    cell, ``firsts`` (written if it does not) is an index of the entries that decide the first polygon of a point; the manifest with level list and sizes comes last, so an index that can be opened is whole."""
    return _write_entries(polygon_entries(polygons, key, geom, attrs, max_edges), path, content, True)


def _write_entries(made: DataFrame, path: str, content: str, with_firsts: bool) -> PolygonIndex:
    spark = made.sparkSession
    made.write.partitionBy("level").parquet(f"{path}/entries")
    entries = spark.read.schema(made.schema).parquet(f"{path}/entries")
    # as nested rows take it in memory: headers, four numbers and a place per edge
    width = F.lit(96) + F.size("edges") * 48 + F.length(F.to_json("item"))
    row = entries.agg(
        F.coalesce(F.sort_array(F.collect_set("level")), F.array().cast("array<int>")).alias("levels"), F.count("*").alias("rows"),
        F.coalesce(F.sum(width), F.lit(0)).alias("bytes"), F.coalesce(F.max(F.size("edges")), F.lit(0)).alias("largest"),
    ).first()
    grouped = row["bytes"] <= MAX_BROADCAST_BYTES and bool(row["levels"])
    firsts = with_firsts and row["bytes"] > MAX_BROADCAST_BYTES
    if firsts:
        _write_entries(first_entries(entries), f"{path}/firsts", content, False)
    if grouped:
        entry = F.struct("item", "full", "base", "edges")
        by_cell = entries.groupBy("level", "cell").agg(F.sort_array(F.collect_list(entry)).alias("entries"))
        by_cell.write.partitionBy("level").parquet(f"{path}/dictionary")
    facts = spark.createDataFrame([(path, content, row["levels"], row["rows"], row["bytes"], row["largest"], grouped, firsts, made.schema.json())], _MANIFEST)
    facts.coalesce(1).write.parquet(f"{path}/manifest")
    return open_polygon_index(spark, path)


def open_polygon_index(spark: SparkSession, path: str, max_bytes: int | None = None) -> PolygonIndex:
    """An index written before; ``max_bytes`` is the largest to be broadcast."""
    facts = spark.read.schema(_MANIFEST).parquet(f"{path}/manifest").first()
    limit = MAX_BROADCAST_BYTES if max_bytes is None else max_bytes
    dictionary = spark.read.parquet(f"{path}/dictionary") if facts["grouped"] else None
    entries = spark.read.schema(StructType.fromJson(json.loads(facts["schema"]))).parquet(f"{path}/entries")
    return PolygonIndex(path, entries, dictionary, tuple(facts["levels"]), facts["rows"], facts["bytes"],
                        facts["largest"], 0 < limit and facts["bytes"] <= limit,
                        open_polygon_index(spark, f"{path}/firsts", max_bytes) if facts["firsts"] else None)


def _content_key(polygons: DataFrame, key: str, geom: str, attrs: tuple[str, ...]) -> str:
    """Names the rows and columns an index is made of; equal for equal contents in any order."""
    columns = [key, geom, *attrs]
    digest = F.xxhash64(*columns)
    row = polygons.agg(
        F.count("*"), F.sum(digest.cast("decimal(38,0)")), F.bit_xor(digest), F.sum(F.xxhash64(F.lit(1), *columns).cast("decimal(38,0)"))).first()
    kinds = [polygons.schema[c].dataType.simpleString() for c in columns]
    return "-".join(map(str, [*columns, *kinds, *row, STEP, MAX_SPAN, MAX_EDGES]))


def polygon_index(
    polygons: DataFrame,
    key: str,
    geom: str,
    attrs: tuple[str, ...] = (),
    max_bytes: int | None = None,
) -> PolygonIndex:
    """The index of these polygons: opened if one of the same content lies in the shared folder, else
    written there. One cheap aggregate over the polygons tells."""
    spark = polygons.sparkSession
    content = _content_key(polygons, key, geom, attrs)
    known = f"{shared_folder(spark)}/polygon-indexes-{_FORMAT}"
    try:
        made = spark.read.schema(_MANIFEST).parquet(known).where(F.col("key") == content).agg(F.max("path")).first()[0]
        if made is not None:
            return open_polygon_index(spark, made, max_bytes)
    except AnalysisException:  # nothing written there yet, or cleared since
        pass
    made = write_polygon_index(polygons, scratch(spark, "polygon-index"), key=key, geom=geom, attrs=attrs, content=content).path
    spark.read.schema(_MANIFEST).parquet(f"{made}/manifest").coalesce(1).write.mode("append").parquet(known)
    return open_polygon_index(spark, made, max_bytes)


def _located(x: Column, y: Column) -> Column:
    return x.isNotNull() & y.isNotNull() & G.is_number(x) & G.is_number(y)


def _hit(e, x: Column, y: Column, level, predicate: str) -> Column:
    """Does the polygon of an entry of the point's cell hold the point? ``e`` gives its columns."""
    corner_x, _ = _reference(grid.quad_column(x, level), F.lit(0).cast("bigint"), level)
    inside = F.aggregate(e["edges"], e["base"], lambda odd, edge: odd != _down_or_across(edge, x, y, corner_x))
    on_edge = G.edges_boundary(e["edges"], x, y)
    return e["full"] | ((inside & ~on_edge) if predicate == "within" else (inside | on_edge))


def _found_in(entries: Column, x: Column, y: Column, level: int, predicate: str, want: str, item: str) -> Column:
    """What ``_lookup`` wants from the entries of one level."""

    def holds(e):
        return _hit(e, x, y, level, predicate)

    def first(got, e):
        return F.when(got.isNotNull(), got).when(holds(e), e["item"])

    if want == "any":
        return F.coalesce(F.exists(entries, holds), F.lit(False))
    if want == "first":
        return F.aggregate(entries, F.lit(None).cast(item), first)
    return F.coalesce(F.transform(F.filter(entries, holds), lambda e: e["item"]), F.array().cast(f"array<{item}>"))


def _at_level(index: PolygonIndex, level: int) -> DataFrame:
    if index.dictionary is not None:
        return index.dictionary.where(F.col("level") == level).select("cell", "entries")
    entry = F.struct("item", "full", "base", "edges")
    return index.entries.where(F.col("level") == level).groupBy("cell").agg(F.sort_array(F.collect_list(entry)).alias("entries"))


def _lookup(points: DataFrame, index: PolygonIndex, lon: str, lat: str, predicate: str, want: str) -> DataFrame:
    """Small index: add ``__found``. ``want``: ``any`` (is there a polygon that holds the point), ``first`` (the
    smallest item; entries are sorted, so later ones are not tried) or ``all`` (an array of items)."""
    x, y = F.col(lon), F.col(lat)
    item = index.entries.schema["item"].dataType.simpleString()
    out, found = points, []
    for level in index.levels:
        dictionary = _at_level(index, level).toDF(f"__cell_{level}", f"__entries_{level}")
        probe = F.when(_located(x, y), grid.quad_cell(x, y, level))
        out = out.withColumn(f"__cell_{level}", probe).join(F.broadcast(dictionary), f"__cell_{level}", "left")
        here = F.col(f"__entries_{level}")

        found.append(_found_in(here, x, y, level, predicate, want, item))
    if want == "any":
        result = reduce(lambda a, b: a | b, found, F.lit(False))
    elif want == "first":
        result = F.least(*found) if len(found) > 1 else found[0] if found else F.lit(None).cast(item)
    else:
        result = reduce(lambda a, b: F.concat(a, b), found, F.array().cast(f"array<{item}>"))
    return out.withColumn("__found", result).drop(*[f"__{part}_{n}" for part in ("cell", "entries") for n in index.levels])


def _pairs(
    points: DataFrame, index: PolygonIndex, lon: str, lat: str, predicate: str, rows_per_task: int
) -> DataFrame:
    """Large index: distinct locations joined to their items, ``lon, lat, item``."""
    located = points.where(_located(F.col(lon), F.col(lat)))
    places = located.select(F.col(lon).alias("__x"), F.col(lat).alias("__y")).distinct()
    x, y = F.col("__x"), F.col("__y")
    probes = F.array(
        *[F.struct(F.lit(n).alias("level"), grid.quad_cell(x, y, n).alias("cell")) for n in index.levels]
    )
    probing = places.withColumn("p", F.explode(probes)).select("__x", "__y", "p.level", "p.cell")
    # stated, since a candidate costs far more time than its bytes tell: small partitions are not to be merged
    spread = max(int(points.sparkSession.conf.get("spark.sql.shuffle.partitions")), points.sparkSession.sparkContext.defaultParallelism)
    probing = probing.repartition(spread, "level", "cell")
    joined = skew_join(probing, index.entries, ["level", "cell"], "inner", rows_per_task)
    return joined.where(_hit({c: F.col(c) for c in ("full", "base", "edges")}, x, y, F.col("level"), predicate)).select(
        F.col("__x").alias(lon), F.col("__y").alias(lat), "item"
    )


def land_mask(
    points: DataFrame,
    polygons: DataFrame,
    *,
    key: str = "neighborhood_id",
    geom: str = "geometry",
    lon: str = "longitude",
    lat: str = "latitude",
    predicate: str = "within",
    max_bytes: int | None = None,
    rows_per_task: int = ROWS_PER_TASK,
    index: PolygonIndex | None = None,
) -> DataFrame:
    """Keep points inside at least one polygon; never multiplies rows.

    ``index`` is an opened index of these polygons; without it the one of the same content in the
    shared folder is opened, or written first. So for all joins with polygons.
    """
    index = (index or polygon_index(polygons, key, geom, (), max_bytes)).deciding
    if index.small:
        return _lookup(points, index, lon, lat, predicate, "any").where("__found").drop("__found")
    inside = _pairs(points, index, lon, lat, predicate, rows_per_task).select(lon, lat).distinct()
    return skew_join(points, inside, [lon, lat], "left_semi", rows_per_task).select(*points.columns)


def off_land(
    points: DataFrame,
    polygons: DataFrame,
    *,
    key: str = "neighborhood_id",
    geom: str = "geometry",
    lon: str = "longitude",
    lat: str = "latitude",
    predicate: str = "within",
    max_bytes: int | None = None,
    rows_per_task: int = ROWS_PER_TASK,
    index: PolygonIndex | None = None,
) -> DataFrame:
    """The points no polygon holds, those without coordinates included."""
    index = (index or polygon_index(polygons, key, geom, (), max_bytes)).deciding
    if index.small:
        return _lookup(points, index, lon, lat, predicate, "any").where("not __found").drop("__found")
    inside = _pairs(points, index, lon, lat, predicate, rows_per_task).select(lon, lat).distinct()
    return skew_join(points, inside, [lon, lat], "left_anti", rows_per_task).select(*points.columns)


def land_mask_inner(
    points: DataFrame,
    polygons: DataFrame,
    *,
    key: str = "neighborhood_id",
    geom: str = "geometry",
    attrs: tuple[str, ...] = (),
    lon: str = "longitude",
    lat: str = "latitude",
    predicate: str = "intersects",
    prefix: str = "land_",
    max_bytes: int | None = None,
    rows_per_task: int = ROWS_PER_TASK,
    index: PolygonIndex | None = None,
) -> DataFrame:
    """One row per point and polygon that holds it, polygon columns prefixed. An ``index`` must hold ``attrs``."""
    index = index or polygon_index(polygons, key, geom, attrs, max_bytes)
    if index.small:
        hit = _lookup(points, index, lon, lat, predicate, "all").withColumn("__item", F.explode("__found"))
    else:
        pairs = _pairs(points, index, lon, lat, predicate, rows_per_task)
        hit = skew_join(points, pairs.withColumnRenamed("item", "__item"), [lon, lat], "inner", rows_per_task)
    carried = [F.col("__item")[c].alias(f"{prefix}{c}") for c in (key, *attrs)]
    return hit.select(*points.columns, *carried)


def attach_polygon(
    points: DataFrame,
    polygons: DataFrame,
    *,
    key: str = "neighborhood_id",
    geom: str = "geometry",
    attrs: tuple[str, ...] = (),
    lon: str = "longitude",
    lat: str = "latitude",
    predicate: str = "within",
    max_bytes: int | None = None,
    rows_per_task: int = ROWS_PER_TASK,
    index: PolygonIndex | None = None,
) -> DataFrame:
    """Left join point to polygon; overlaps go to the smallest key, so the grain stays. An ``index`` must
    hold ``attrs``."""
    index = (index or polygon_index(polygons, key, geom, attrs, max_bytes)).deciding
    if index.small:
        joined = _lookup(points, index, lon, lat, predicate, "first").withColumnRenamed("__found", "__item")
    else:
        pairs = _pairs(points, index, lon, lat, predicate, rows_per_task)
        first = pairs.groupBy(lon, lat).agg(F.min("item").alias("__item"))
        joined = skew_join(points, first, [lon, lat], "left", rows_per_task)
    return joined.select(*points.columns, *[F.col("__item")[c].alias(c) for c in (key, *attrs)])


# ------------------------------------------------------------------- nearest

#: Search levels from fine to coarse.
NEAREST_LEVELS = tuple(range(18, 0, -1))


def _safe_radius(lat: Column, level: int) -> Column:
    """Metres within which every facility lies in the 3 x 3 cells around a point."""
    step = min(grid.quad_size(level), 90.0)
    across = F.asin(F.greatest(F.cos(F.radians(lat)), F.lit(0.0)) * F.lit(math.sin(math.radians(step))))
    return across * F.lit(G.EARTH_RADIUS_M * (1 - 1e-9)) - F.lit(0.001)


def distinct_sites(facilities: DataFrame, key: str, lon: str, lat: str, category: Column | None = None) -> DataFrame:
    """Facilities of one category (``cat``, a small number) at one location answer alike: keep the smallest
    id of each. Rows without a category are none of those asked for."""
    cat = F.lit(0) if category is None else category
    located = facilities.where(_located(F.col(lon), F.col(lat)) & cat.isNotNull())
    return located.groupBy(F.col(lon).alias("fx"), F.col(lat).alias("fy"), cat.alias("cat")).agg(F.min(key).alias("fid"))


#: Contenders are picked by cosine and then measured. The cut lies below the best cosine by
#: more than its rounding error and by more than two millimetres of distance, so rounding to
#: millimetres decides ties exactly as if every candidate had been measured.
_COSINE_ERROR = 4e-15
_TWO_MM = 0.002 / G.EARTH_RADIUS_M


def _bind(value: Column, use) -> Column:
    """Evaluate ``value`` once per row and use it inside other lambdas."""
    return F.get(F.transform(F.array(value), use), 0)


def _measured(f: Column, x: Column, y: Column, *more: str) -> Column:
    metres = F.round(G.haversine_m(x, y, f["fx"], f["fy"]), 3)
    return F.struct(metres.alias("m"), f["fid"].alias("fid"), *[f[c].alias(c) for c in more])


def _best_of(near: Column, x: Column, y: Column) -> Column:
    """Smallest (metres, id): cheap cosines pick the contenders, only those are measured."""

    def from_here(u):
        def cut(best):
            sine = F.sqrt(F.greatest(F.lit(2.0) - F.lit(2.0) * best, F.lit(0.0)))
            return best - F.lit(_COSINE_ERROR) - F.lit(_TWO_MM) * sine

        def contenders(limit):
            close = F.filter(near, lambda f: G.cosine(f, u) >= limit)
            return F.array_min(F.transform(close, lambda f: _measured(f, x, y)))

        highest = F.array_max(F.transform(near, lambda f: G.cosine(f, u)))
        return _bind(_bind(highest, cut), contenders)

    return _bind(G.unit_vector(x, y), from_here)


def _with_vectors(sites: DataFrame) -> DataFrame:
    u = G.unit_vector("fx", "fy")
    return sites.withColumns({c: u[c] for c in ("ux", "uy", "uz")})


#: A search starts where no cell holds more sites than this.
MAX_SITES_PERCELL = 4


@dataclass(frozen=True)
class SearchPlan:
    """``size``: bytes of the sites; ``levels``: fine to coarse; ``leaf``: where no cell is crowded
    (or the finest); ``coarse``: where the sites occupy about as many cells as each holds sites."""

    size: int
    levels: list[int]
    leaf: int
    coarse: int


def _search_plan(sites: DataFrame) -> SearchPlan | None:
    """Where to search; None without sites.

    The search starts at the coarsest level at which even the densest cell is small, so a
    crowded corner costs its callers no more than any other place. Levels at which the
    sites occupy a handful of cells would show every site anyway and are left out. Cells are
    counted once for each category in them.
    """
    cells = F.array(*[F.struct(F.lit(n).alias("n"), grid.quad_cell("fx", "fy", n).alias("c")) for n in NEAREST_LEVELS])
    occupied = (
        sites.select(F.explode(cells).alias("at"), "cat", row_bytes(sites.columns).alias("w"))
        .groupBy("at", "cat")
        .agg(F.count(F.lit(1)).alias("k"), F.sum("w").alias("w"))
        .groupBy("at.n")
        .agg(F.max("k").alias("densest"), F.count(F.lit(1)).alias("cells"), F.sum("k").alias("sites"), F.sum("w").alias("bytes"))
        .collect()  # one row per level
    )
    if not occupied:
        return None
    seen = {r["n"]: r for r in occupied}
    calm = [n for n in NEAREST_LEVELS if seen[n]["densest"] <= MAX_SITES_PERCELL]
    leaf = min(calm, default=NEAREST_LEVELS[0])
    levels = [n for n in range(leaf, 0, -2) if seen[n]["cells"] > 4 * 9]
    coarse = min(NEAREST_LEVELS, key=lambda n: (abs(seen[n]["cells"] ** 2 - seen[n]["sites"]), n))
    return SearchPlan(int(occupied[0]["bytes"]), levels, leaf, coarse)


#: Metres added to bounds on distances through a cell's centre: far above their rounding, also for
#: points on the other side of the globe.
_BOUND_SLACK_M = 1.0


def _centre(level: int) -> tuple[Column, Column]:
    """Longitude and latitude of the centre of a site's cell."""
    x, y = F.col("fx"), F.col("fy")
    step = grid.quad_size(level)
    lon = (grid.quad_column(x, level) + F.lit(0.5)) * F.lit(step) - F.lit(180.0)
    lat = (grid.quad_row(y, level) + F.lit(0.5)) * F.lit(step) - F.lit(90.0)
    return lon, F.least(lat, F.lit(90.0))


def _boxes(sites: DataFrame, above: int, level: int, label: str, *sums: Column) -> DataFrame:
    """``cat``, ``cell`` (at ``above``), ``inner`` (at ``level``), centre ``bx, by`` and ``r``, the metres
    from there within which all its sites lie: a row per category and occupied inner cell."""
    bx, by = _centre(level)
    outer = F.lit(0).cast("bigint") if above == 0 else grid.quad_cell("fx", "fy", above)
    filed = sites.withColumns({"cell": outer, "inner": grid.quad_cell("fx", "fy", level), "bx": bx, "by": by})
    reach = F.max(G.haversine_m(F.col("bx"), F.col("by"), F.col("fx"), F.col("fy")))
    return materialize(filed.groupBy("cat", "cell", "inner").agg(F.min("bx").alias("bx"), F.min("by").alias("by"), reach.alias("r"), *sums), label)


def _meet(asking: DataFrame, cells: DataFrame, max_bytes: int | None, rows_per_task: int) -> DataFrame:
    """Inner join on category and cell: look small tables up in place, else split hot cells of both sides."""
    if fits_broadcast(cells, max_bytes):
        return asking.join(F.broadcast(cells), ["cat", "cell"])
    return skew_join(materialize(asking, "asking"), cells, ["cat", "cell"], "inner", rows_per_task)


def nearest_facility(
    points: DataFrame,
    facilities: DataFrame,
    *,
    key: str = "infrastructure_id",
    lon: str = "longitude",
    lat: str = "latitude",
    f_lon: str = "longitude",
    f_lat: str = "latitude",
    out_id: str = "nearest_id",
    out_m: str = "nearest_m",
    max_bytes: int | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Nearest facility of every point, by (metres rounded to mm, id).

    Levels go from fine to coarse. At a level a point sees the facilities of the 3 x 3
    cells around it; once the best of them is no farther than the radius those cells
    surely cover, the point is settled and asks no coarser level. The few points left lie far
    from all facilities. They go through occupied cells from the coarse end and keep, by upper
    and lower bounds of distance, only cells that can hold the answer; no point ever meets
    all facilities.
    """
    best = _nearest(points, distinct_sites(facilities, key, f_lon, f_lat), 1, lon, lat, max_bytes, rows_per_task)
    return best.select(
        *points.columns, F.col("__best_0")["fid"].alias(out_id), F.col("__best_0")["m"].alias(out_m)
    )


def nearest_of_each(
    points: DataFrame,
    facilities: DataFrame,
    categories: dict[str, tuple[str, str]],
    *,
    category: str = "facility_category",
    key: str = "infrastructure_id",
    lon: str = "longitude",
    lat: str = "latitude",
    f_lon: str = "longitude",
    f_lat: str = "latitude",
    max_bytes: int | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Nearest facility of every category, in one search: ``categories`` names for each the columns
    of the id and of the metres.

    One table of sites, in which the category is part of the cell key, answers for all: every point goes
    through the levels once and keeps a best per category; it asks on while any of them is open.
    """
    number = F.lit(None).cast("int")
    for i, name in enumerate(categories):
        number = F.when(F.col(category) == name, i).otherwise(number)
    sites = distinct_sites(facilities, key, f_lon, f_lat, number)
    best = _nearest(points, sites, len(categories), lon, lat, max_bytes, rows_per_task)
    found = [(F.col(f"__best_{i}"), names) for i, names in enumerate(categories.values())]
    return best.select(*points.columns, *[c for b, (fid, m) in found for c in (b["fid"].alias(fid), b["m"].alias(m))])


def _nearest(points, sites, count: int, lon, lat, max_bytes, rows_per_task) -> DataFrame:
    """``points`` with ``__best_0`` ... : nearest of the sites of each category."""
    sites = materialize(_with_vectors(sites), "sites")
    plan = _search_plan(sites)
    limit = MAX_BROADCAST_BYTES if max_bytes is None else max_bytes
    if plan is None:
        none = F.lit(None).cast(f"struct<m:double,fid:{sites.schema['fid'].dataType.simpleString()}>")
        return points.withColumns({f"__best_{i}": none for i in range(count)})
    # each facility is filed under nine cells per level and once under its coarse cell
    if limit > 0 and plan.size * 9 * (len(plan.levels) + 1) <= limit:
        return _nearest_small(points, sites, plan, count, lon, lat)
    return _nearest_large(points, sites, plan, count, lon, lat, max_bytes, rows_per_task)


def _filed(sites: DataFrame, level: int) -> DataFrame:
    """Facilities under every cell that must see them at this level."""
    return sites.withColumn("cell", F.explode(grid.quad_neighbourhood("fx", "fy", level)))


def _nearest_small(points, sites, plan, count, lon, lat) -> DataFrame:
    x, y = F.col(lon), F.col(lat)
    id_type = sites.schema["fid"].dataType.simpleString()
    numbers = range(count)
    none = F.lit(None).cast(f"struct<m:double,fid:{id_type}>")
    out = points.withColumns({f"__best_{i}": none for i in numbers} | {f"__open_{i}": _located(x, y) for i in numbers})
    site = F.struct("fx", "fy", "fid", "ux", "uy", "uz", "cat")

    def any_open() -> Column:
        return reduce(lambda a, b: a | b, [F.col(f"__open_{i}") for i in numbers])

    def of_category(sites_: Column, i: int) -> Column:
        return sites_ if count == 1 else F.filter(sites_, lambda f: f["cat"] == i)

    for level in plan.levels:
        dictionary = (
            _filed(sites, level)
            .groupBy(F.col("cell").alias("__cell"))
            .agg(F.collect_list(site).alias("__near"))
        )
        # a settled point asks with a null key and so carries no candidates along
        out = out.withColumn("__cell", F.when(any_open(), grid.quad_cell(x, y, level)))
        out = out.join(F.broadcast(dictionary), "__cell", "left")
        out = out.withColumns({
            f"__best_{i}": F.when(F.col(f"__open_{i}"), _best_of(of_category(F.col("__near"), i), x, y)).otherwise(F.col(f"__best_{i}"))
            for i in numbers})
        out = out.withColumns({
            f"__open_{i}": F.col(f"__open_{i}") & ~F.coalesce(F.col(f"__best_{i}")["m"] <= _safe_radius(y, level), F.lit(False))
            for i in numbers}).drop("__cell", "__near")
    # the rest: one row of all occupied coarse cells with their sites; sites are looked at only in
    # cells not farther than the nearest cell surely is
    bx, by = _centre(plan.coarse)
    boxes = sites.withColumns({"bx": bx, "by": by, "c": grid.quad_cell("fx", "fy", plan.coarse)}).groupBy("c", "cat").agg(
        F.min("bx").alias("bx"), F.min("by").alias("by"), F.collect_list(site).alias("near"),
        F.max(G.haversine_m(F.col("bx"), F.col("by"), F.col("fx"), F.col("fy"))).alias("r"))
    globe = boxes.groupBy(grid.quad_cell("bx", "by", 0).alias("__cell")).agg(F.collect_list(F.struct("bx", "by", "r", "near", "cat")).alias("__boxes"))
    out = out.withColumn("__cell", F.when(any_open(), grid.quad_cell(x, y, 0))).join(F.broadcast(globe), "__cell", "left")

    def away(b):
        return G.haversine_m(x, y, b["bx"], b["by"])

    def far(boxes_: Column) -> Column:
        def inside(limit):
            return F.flatten(F.transform(F.filter(boxes_, lambda b: away(b) - b["r"] <= limit), lambda b: b["near"]))

        nearest_cell = F.array_min(F.transform(boxes_, lambda b: away(b) + b["r"])) + F.lit(_BOUND_SLACK_M)
        return _bind(_bind(nearest_cell, inside), lambda near: _best_of(near, x, y))

    out = out.withColumns({
        f"__best_{i}": F.when(F.col(f"__open_{i}"), far(of_category(F.col("__boxes"), i))).otherwise(F.col(f"__best_{i}")) for i in numbers})
    return out.drop("__cell", "__boxes", *[f"__open_{i}" for i in numbers])


def _nearest_large(points, sites, plan, count, lon, lat, max_bytes, rows_per_task) -> DataFrame:
    located = points.where(_located(F.col(lon), F.col(lat)))
    places = located.select(F.col(lon).alias("__x"), F.col(lat).alias("__y")).distinct()
    asked = places.withColumn("cat", F.explode(F.sequence(F.lit(0), F.lit(count - 1))))
    answers = _nearest_of_places(materialize(asked, "places"), sites, plan, max_bytes, rows_per_task)
    best = [F.max(F.when(F.col("cat") == i, F.col("__best"))).alias(f"__best_{i}") for i in range(count)]
    answers = answers.groupBy(F.col("__x").alias(lon), F.col("__y").alias(lat)).agg(*best)
    return skew_join(points, answers, [lon, lat], "left", rows_per_task)


def _nearest_of_places(places, sites, plan, max_bytes, rows_per_task) -> DataFrame:
    """``__x, __y, cat, __best`` of every place and category of a written table."""
    x, y = F.col("__x"), F.col("__y")
    place = ["__x", "__y", "cat"]
    metres = F.round(G.haversine_m(x, y, F.col("fx"), F.col("fy")), 3)
    best = F.min(F.struct(metres.alias("m"), F.col("fid"))).alias("__best")
    settled, still_open = [], places
    for level in plan.levels:
        probing = still_open.withColumn("cell", grid.quad_cell(x, y, level))
        found = (
            skew_join(probing, _filed(sites, level), ["cat", "cell"], "inner", rows_per_task)
            .groupBy(*place)
            .agg(best)
            .where(F.col("__best")["m"] <= _safe_radius(y, level))
        )
        found = materialize(found, "settled")
        settled.append(found)
        still_open = materialize(still_open.join(found.select(*place), place, "left_anti"), "open")
    # the rest, from the globe down: a cell is kept while its lower bound is within the least upper bound
    candidates, above = still_open.withColumn("cell", F.lit(0).cast("bigint")), 0
    for level in sorted(range(plan.leaf, 0, -2)):
        met = _meet(candidates, _boxes(sites, above, level, "cells"), max_bytes, rows_per_task)
        met = materialize(met.withColumn("d", G.haversine_m(x, y, F.col("bx"), F.col("by"))), "bounds")
        top = met.groupBy(*place).agg(F.min(F.col("d") + F.col("r")).alias("top"))
        kept = F.col("d") - F.col("r") <= F.col("top") + F.lit(_BOUND_SLACK_M)
        candidates, above = met.join(top, place).where(kept).select(*place, F.col("inner").alias("cell")), level
    at_leaf = sites.withColumn("cell", grid.quad_cell("fx", "fy", plan.leaf))
    settled.append(_meet(candidates, at_leaf, max_bytes, rows_per_task).groupBy(*place).agg(best))
    return reduce(DataFrame.unionByName, settled)


# ----------------------------------------------------------- within a distance


def _disc_level(radius_m: float) -> int:
    """Finest level whose cells are at least as high as the radius."""
    degrees = math.degrees(radius_m / G.EARTH_RADIUS_M)
    level = 0
    while level < 24 and grid.quad_size(level + 1) >= degrees:
        level += 1
    return level


def _disc_cells(lon: Column, lat: Column, radius_m: float, level: int) -> Column:
    """Every cell a disc around (lon, lat) can reach, wrapped at the antimeridian."""
    angle = radius_m / G.EARTH_RADIUS_M + 1e-12
    dlat = math.degrees(angle)
    columns = 1 << level
    # widest longitude offset of the disc; the whole circle if it holds a pole
    ratio = F.lit(math.sin(min(angle, math.pi / 2))) / F.cos(F.radians(lat))
    polar = (F.abs(lat) + F.lit(dlat)) >= 90.0
    dlon = F.when(polar, F.lit(360.0)).otherwise(F.degrees(F.asin(F.least(ratio, F.lit(1.0)))) + 1e-9)
    west, east = grid.quad_column(lon - dlon, level), grid.quad_column(lon + dlon, level)
    east = F.least(east, west + F.lit(columns - 1).cast("bigint"))
    south, north = grid.quad_row(lat - F.lit(dlat), level), grid.quad_row(lat + F.lit(dlat), level)
    cells = F.transform(
        F.sequence(west, east),
        lambda cx: F.transform(F.sequence(south, north), lambda cy: grid.pack(cx, cy, level)),
    )
    return F.array_distinct(F.flatten(cells))


def within_distance(
    points: DataFrame,
    facilities: DataFrame,
    radius_m: float,
    *,
    key: str = "infrastructure_id",
    lon: str = "longitude",
    lat: str = "latitude",
    f_lon: str = "longitude",
    f_lat: str = "latitude",
    max_bytes: int | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Points with at least one facility in reach: how many, which is nearest, how far.

    One row per point, so a dense area yields no pair list. Facilities sharing a
    location are counted through their number. Beyond the broadcast limit, cells wholly in reach
    count by their total; only sites of cells on the rim are measured.
    """
    level = _disc_level(radius_m)
    located = facilities.where(_located(F.col(f_lon), F.col(f_lat)))
    sites = located.groupBy(F.col(f_lon).alias("fx"), F.col(f_lat).alias("fy"), F.lit(0).alias("cat")).agg(
        F.min(key).alias("fid"), F.count(F.lit(1)).alias("k")
    )
    sites = materialize(_with_vectors(sites), "sites")
    filed = sites.withColumn("cell", F.explode(_disc_cells(F.col("fx"), F.col("fy"), radius_m, level)))
    x, y = F.col(lon), F.col(lat)
    names = ["facilities_within", "nearest_id", "nearest_m"]
    if fits_broadcast(filed, max_bytes):
        filed = materialize(filed, "discs")
        dictionary = filed.groupBy(F.col("cell").alias("__cell")).agg(
            F.collect_list(F.struct("fx", "fy", "fid", "k", "ux", "uy", "uz")).alias("__near")
        )
        located_points = points.where(_located(x, y))
        out = located_points.withColumn("__cell", grid.quad_cell(x, y, level)).join(
            F.broadcast(dictionary), "__cell", "inner"
        )
        angle = min(radius_m / G.EARTH_RADIUS_M, math.pi)
        limit = math.cos(angle) - _COSINE_ERROR - 2 * _TWO_MM * math.sin(angle / 2)

        def in_reach(u):
            contenders = F.filter("__near", lambda f: G.cosine(f, u) >= F.lit(limit))
            measured = F.transform(contenders, lambda f: _measured(f, x, y, "k"))
            return F.filter(measured, lambda f: f["m"] <= radius_m)

        def summed(found):
            total = F.aggregate(found, F.lit(0).cast("bigint"), lambda s, f: s + f["k"])
            return F.struct(total.alias("__k"), F.array_min(found).alias("__best"))

        found = F.array(_bind(G.unit_vector(x, y), in_reach))
        rows = F.transform(F.filter(found, lambda a: F.size(a) > 0), summed)
        out = out.select(*points.columns, F.inline(rows))
    else:
        places = points.where(_located(x, y)).select(x.alias("__x"), y.alias("__y")).distinct()
        reach = _reach_of_places(materialize(places, "places"), sites, radius_m, level, max_bytes, rows_per_task)
        reach = reach.select(F.col("__x").alias(lon), F.col("__y").alias(lat), "__k", "__best")
        out = skew_join(points, reach, [lon, lat], "inner", rows_per_task)
    values = [F.col("__k"), F.col("__best")["fid"], F.col("__best")["m"]]
    return out.select(*points.columns, *[v.alias(n) for v, n in zip(values, names)])


def _reach_of_places(places, sites, radius_m, level, max_bytes, rows_per_task) -> DataFrame:
    """``__x, __y, __k, __best`` of the places of a written table with a site in reach."""
    plan = _search_plan(sites)
    x, y, d, r = F.col("__x"), F.col("__y"), F.col("d"), F.col("r")
    metres = F.round(G.haversine_m(x, y, F.col("fx"), F.col("fy")), 3)
    if plan is None:
        none = sites.join(places, F.lit(False))
        return none.groupBy("__x", "__y").agg(F.sum("k").alias("__k"), F.min(F.struct(metres.alias("m"), "fid")).alias("__best"))
    reached = places.withColumns({"cat": F.lit(0), "cell": F.explode(_disc_cells(x, y, radius_m, level))})
    candidates, above, parts = reached, level, []
    for inner in range(level + 2, plan.leaf + 1, 2):
        met = _meet(candidates, _boxes(sites, above, inner, "cells", F.sum("k").alias("k")), max_bytes, rows_per_task)
        met = materialize(met.withColumn("d", G.haversine_m(x, y, F.col("bx"), F.col("by"))).where(
            d - r <= radius_m + _BOUND_SLACK_M).withColumn("whole", d + r <= radius_m - _BOUND_SLACK_M), "reach")
        parts.append(met.where("whole").select("__x", "__y", "k"))
        candidates, above = met.where("not whole").select("__x", "__y", "cat", F.col("inner").alias("cell")), inner
    rim = _meet(candidates, sites.withColumn("cell", grid.quad_cell("fx", "fy", above)), max_bytes, rows_per_task)
    parts.append(rim.where(metres <= radius_m).select("__x", "__y", "k"))
    counted = materialize(reduce(DataFrame.unionByName, parts).groupBy("__x", "__y").agg(F.sum("k").alias("__k")), "counts")
    best = _nearest_of_places(counted.select("__x", "__y", F.lit(0).alias("cat")), sites, plan, max_bytes, rows_per_task)
    return counted.join(best, ["__x", "__y"])
