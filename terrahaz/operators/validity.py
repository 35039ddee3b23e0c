"""Is a polygon valid beyond its structure: do its rings cross themselves or one another, do holes lie
in their shell, do parts overlap?

Edges are compared with edges only where they share a cell, and cells are divided until they hold few
edges, so a ring of any length is compared by an equi-join of small groups (edges that all meet in one
place share the finest cell). Holes and parts are tested vertex by vertex against the cells of the shell or
part they must lie in or keep out of.

Reasons: ``structure`` (what ``geometry.st_is_valid`` asks; such shapes are not looked at further), ``self
intersection`` (a ring meets itself elsewhere than from one edge to the next, or turns back on itself), ``rings
cross`` (two rings cross or run along each other; touching in single points is allowed), ``hole outside shell``
and ``parts overlap`` (a vertex of one part strictly inside another).

Defined cases: a null or empty shape is invalid by structure; repeated positions count once; repeated keys each get
a row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrahaz.functions import geometry as G
from terrahaz.functions import grid
from terrahaz.operators import spatial as S
from terrahaz.operators.sizing import materialize

REASONS = ("structure", "self intersection", "rings cross", "hole outside shell", "parts overlap")


def _same(p: Column, q: Column) -> Column:
    return (F.get(p, 0) == F.get(q, 0)) & (F.get(p, 1) == F.get(q, 1))


def _rings(shapes: DataFrame) -> DataFrame:
    """``pid, part, ring, at``: the positions of every ring without repetitions, the closing one included."""
    rings = shapes.select("pid", F.posexplode("shape").alias("part", "rings")).select("pid", "part", F.posexplode("rings").alias("ring", "raw"))
    raw = F.col("raw")
    once = F.filter(raw, lambda p, i: (i == 0) | ~_same(p, F.get(raw, i - 1)))
    closed = (F.size("at") > 1) & _same(F.get("at", 0), F.get("at", F.size("at") - 1))
    return rings.withColumn("at", once).select("pid", "part", "ring", F.when(closed, F.slice("at", 1, F.size("at") - 1)).otherwise(F.col("at")).alias("at"))


def _edges_of(rings: DataFrame) -> DataFrame:
    """``pid, edges``: all edges of a shape with part, ring, number and ring length."""
    at = F.col("at")

    def edge(p, i):
        q = F.get(at, (i + 1) % F.size(at))
        return F.struct(F.get(p, 0).alias("x1"), F.get(p, 1).alias("y1"), F.get(q, 0).alias("x2"), F.get(q, 1).alias("y2"),
                        F.col("part").alias("part"), F.col("ring").alias("ring"), i.alias("i"), F.size(at).alias("n"))

    return rings.withColumn("e", F.transform(at, edge)).groupBy("pid").agg(F.flatten(F.collect_list("e")).alias("edges"))


def _clash(a: Column, b: Column) -> Column:
    """What is wrong between two edges, ``a`` before ``b``; null if nothing is."""
    sides = [G.side(a, b["x1"], b["y1"]), G.side(a, b["x2"], b["y2"]), G.side(b, a["x1"], a["y1"]), G.side(b, a["x2"], a["y2"])]
    cross = ((sides[0] > 0) & (sides[1] < 0) | (sides[0] < 0) & (sides[1] > 0)) & (
        (sides[2] > 0) & (sides[3] < 0) | (sides[2] < 0) & (sides[3] > 0))
    ends = {(e, k): G.on_edge(f, g[f"x{k}"], g[f"y{k}"]) for e, f, g in (("b on a", a, b), ("a on b", b, a)) for k in (1, 2)}
    meet = cross | reduce(lambda x, y: x | y, ends.values())

    def overlap(c: str) -> Column:
        return F.greatest(F.least(a[f"{c}1"], a[f"{c}2"]), F.least(b[f"{c}1"], b[f"{c}2"])) < F.least(
            F.greatest(a[f"{c}1"], a[f"{c}2"]), F.greatest(b[f"{c}1"], b[f"{c}2"]))

    along = (sides[0] == 0) & (sides[1] == 0) & (overlap("x") | overlap("y"))
    one_ring = (a["part"] == b["part"]) & (a["ring"] == b["ring"])
    follows, closes = b["i"] == a["i"] + 1, (a["i"] == 0) & (b["i"] == a["n"] - 1)
    back = (follows & (ends["b on a", 2] | ends["a on b", 1])) | (closes & (ends["b on a", 1] | ends["a on b", 2]))
    own = F.when(follows | closes, back).otherwise(meet)
    return F.when(one_ring & own, REASONS[1]).when(~one_ring & (cross | along), REASONS[2])


def _crossings(base: DataFrame) -> DataFrame:
    """``pid, reason`` from edges that share a cell; a shape of no more edges than a cell may hold is one cell."""
    few = F.size("edges") <= S.MAX_EDGES
    order = F.struct("a.part", "a.ring", "a.i") < F.struct("b.part", "b.ring", "b.i")
    one = base.where(few).select("pid", "edges", F.explode("edges").alias("a")).select("pid", "a", F.explode("edges").alias("b"))
    clash = one.where(order).select("pid", _clash(F.col("a"), F.col("b")).alias("reason"))
    found, base = [clash.where("reason is not null").distinct()], base.where(~few)
    if base.isEmpty():
        return found[0]
    shapes = base.select("pid", "box", "level")
    for _, held in S.divided(shapes, S.exploded_edges(base)):
        held = materialize(held, "validity-cells")
        a, b = held.withColumnRenamed("e", "a"), held.withColumnRenamed("e", "b")
        pairs = a.join(b, S.CELL).where(order).select("pid", _clash(F.col("a"), F.col("b")).alias("reason"))
        found.append(pairs.where("reason is not null").distinct())
    return reduce(DataFrame.unionByName, found)


def _located(points: DataFrame, shapes: DataFrame, predicate: str, other: bool) -> DataFrame:
    """The ``points`` (``pid, part, x, y``) with ``inside``: does the own part's shape (``pid, part, shape``), or
    with ``other`` that of any other part of the polygon, hold them?"""
    keyed = shapes.select(F.struct("pid", "part").alias("own"), "shape")
    entries = materialize(S.polygon_entries(keyed, "own", "shape").withColumn("pid", F.col("item.own.pid")), "validity-shapes")
    levels = [r[0] for r in entries.select("level").distinct().collect()]  # at most as many as there are levels
    x, y = F.col("x"), F.col("y")
    named = materialize(points.distinct(), "validity-points")
    if not levels:
        return named.withColumn("inside", F.lit(False))
    probes = F.array(*[F.struct(F.lit(n).alias("level"), grid.quad_cell(x, y, n).alias("cell")) for n in sorted(levels)])
    asked = named.select("*", F.explode(probes).alias("p")).select("pid", "part", "x", "y", "p.level", "p.cell")
    met = asked.join(entries, ["pid", "level", "cell"])
    met = met.where(F.col("item.own.part") != F.col("part")) if other else met.where(F.col("item.own.part") == F.col("part"))
    hit = S._hit({c: F.col(c) for c in ("full", "base", "edges")}, x, y, F.col("level"), predicate)
    inside = met.where(hit).select("pid", "part", "x", "y").distinct().withColumn("inside", F.lit(True))
    return named.join(inside, ["pid", "part", "x", "y"], "left").withColumn("inside", F.coalesce("inside", F.lit(False)))


def _misplaced(sound: DataFrame) -> DataFrame:
    """``pid, reason`` from holes and parts of shapes of few edges: vertices against edges, row by row."""
    parts = sound.select("pid", "shape", F.posexplode("shape").alias("part", "rings"))
    shell, holes = F.array(F.array(F.get("rings", 0))), F.flatten(F.slice("rings", 2, F.size("rings") - 1))
    hole = parts.where(F.size("rings") > 1).select("pid", shell.alias("own"), holes.alias("holes")).select(
        "pid", G.polygon_edges("own").alias("edges"), "holes").select("pid", "edges", F.explode("holes").alias("v"))
    x, y = F.get("v", 0), F.get("v", 1)
    outside = hole.where(~G.edges_intersects(F.col("edges"), x, y)).select("pid", F.lit(REASONS[3]).alias("reason"))
    met = parts.where(F.size("shape") > 1).select("pid", "part", F.get("rings", 0).alias("vertices"), F.posexplode("shape").alias("other", "rings"))
    met = met.where("other <> part").select("pid", F.array("rings").alias("own"), "vertices").select(
        "pid", G.polygon_edges("own").alias("edges"), "vertices").select("pid", "edges", F.explode("vertices").alias("v"))
    over = met.where(G.edges_within(F.col("edges"), x, y)).select("pid", F.lit(REASONS[4]).alias("reason"))
    return outside.unionByName(over)


def validity(polygons: DataFrame, key: str, geom: str) -> DataFrame:
    """``key, is_valid, reasons`` (sorted) of every row."""
    shapes = materialize(polygons.select(
        F.monotonically_increasing_id().alias("pid"), F.col(key).alias("key"), F.col(geom).alias("shape"), G.st_is_valid(geom).alias("sound")),
        "validity")
    sound = shapes.where("sound").select("pid", "shape")
    rings = materialize(_rings(sound), "validity-rings")
    base = _edges_of(rings).withColumn("box", G.edges_envelope(F.col("edges")))
    base = materialize(base.withColumn("level", S._level_of_box(F.col("box"))), "validity-edges")
    reasons = [shapes.where("not sound").select("pid", F.lit(REASONS[0]).alias("reason")), _crossings(base)]
    few = F.size(F.flatten(F.flatten("shape"))) <= S.MAX_EDGES
    reasons.append(_misplaced(sound.where(few)))
    sound = sound.where(~few)
    if not sound.isEmpty():
        reasons.append(_misplaced_far(sound, rings))
    found = reduce(DataFrame.unionByName, reasons).groupBy("pid").agg(F.array_sort(F.collect_set("reason")).alias("reasons"))
    return shapes.join(found, "pid", "left").select(
        F.col("key").alias(key), F.col("reasons").isNull().alias("is_valid"),
        F.coalesce("reasons", F.array().cast("array<string>")).alias("reasons"))


def _misplaced_far(sound: DataFrame, rings: DataFrame) -> DataFrame:
    """As ``_misplaced``, for shapes of any number of edges: vertices against the cells of shells and parts."""
    rings, vertex = rings.join(sound.select("pid"), "pid", "left_semi"), F.explode("at")
    vertices = rings.select("pid", "part", "ring", vertex.alias("v")).select("pid", "part", "ring", F.get("v", 0).alias("x"), F.get("v", 1).alias("y"))
    parts = sound.select("pid", F.posexplode("shape").alias("part", "rings"))
    holed = parts.where(F.size("rings") > 1).select("pid", "part", F.array(F.array(F.get("rings", 0))).alias("shape"))
    several = parts.join(sound.where(F.size("shape") > 1).select("pid"), "pid").select("pid", "part", F.array("rings").alias("shape"))
    outside = _located(vertices.where("ring > 0").select("pid", "part", "x", "y"), holed, "intersects", False).where("not inside")
    shells = vertices.where("ring = 0").join(several.select("pid").distinct(), "pid").select("pid", "part", "x", "y")
    over = _located(shells, several, "within", True).where("inside")
    return outside.select("pid", F.lit(REASONS[3]).alias("reason")).unionByName(over.select("pid", F.lit(REASONS[4]).alias("reason")))
