"""Conversation prefix trie by truncation peeling.

A node stands for a different sequence of first turns (role and text); its members are the
conversations that begin so. The trie is peeled from its greatest depth upwards: the conversations that
end at a depth join the nodes that survived from below, equal ones merge, what a node has gathered
(members, smallest member, children, leaves, saved tokens) is closed, its last turn is stripped and
it goes on as one child of the shorter sequence. Nodes are found and aggregated in this one
way up; no list of all prefixes is grouped.

How it is dealt out:

* A turn is the MD5 of role and text; texts are read once and never shuffled. A node's key is a
  polynomial hash of its turns modulo a 127-bit prime, which can be carried from one range of the sort
  order to the next, so a conversation of any length is spread over ranges.
* Equal conversations are counted before anything else: one stands for all.
* Depths are peeled in bands of ``band`` turns. A band's rows (one per conversation or node that is
  still alive, with its keys in the band) are sorted by these keys in ranges; nodes whose rows all lie
  inside a range are closed there with a stack of at most ``band`` nodes, whatever the number of rows
  below a node. Only the nodes on a range's first and last row may go on in another range: these, at
  most ``2 * (band + 1)`` a range, are merged and peeled afterwards in one small task.
* Where a conversation passes a band's edge alone, the rest of it is a chain that no other conversation
  shares; it is written as it is and one row takes part in the band above.

Turns are ordered by turn (null first), then by the MD5 of role and text where turns tie. Defined cases: null
role or text is empty; repeated rows are turns of their own; a null conversation id is one conversation, which
counts as a member but is never the smallest of several nor among the listed ends; no conversations
give no nodes, not even a root; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrahaz.llm import tables
from terrahaz.operators.sizing import skew_join

BAND = 256
#: Modulus and base of the keys: any large prime and any number below it.
PRIME = (1 << 127) - 1
BASE = int.from_bytes(hashlib.sha256(b"prefix trie").digest()[:15], "big")
#: Key of the root.
ROOT = bytes(16)
#: Characters of member ids that are handed on as one piece, and rows of a parent or anchor that a task takes.
PIECE = 1 << 16
ROWS_PER_TASK = 100_000
_SLICE = 256


def _ranges(df: DataFrame) -> int:
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def turns_of(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv, turn, digest, words``: a row per turn, without its text."""
    role, text = F.coalesce(F.col(role_col), F.lit("")), F.coalesce(F.col(text_col), F.lit(""))
    return df.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"),
        F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))).alias("digest"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"))


def along(turns: DataFrame, order: tuple[str, ...] = ("conv", "turn", "digest"), keep: tuple[str, ...] = ("words",)) -> DataFrame:
    """``turns`` in ``order`` (``conv`` first), with ``depth`` (from 1) and ``key`` of the digests of a conversation so far.

    Sorted ranges are scanned once; of each range its last conversation's state (one row) goes to the
    driver, and the rows that continue a conversation from an earlier range get theirs added."""
    names = list(dict.fromkeys([*order, "digest", *keep]))
    ddl = ", ".join(f"{c} {turns.schema[c].dataType.simpleString()}" for c in names)

    def scan(batches):
        part, conv, depth, value, first, whole = TaskContext.get().partitionId(), None, 0, 0, True, True
        for b in batches:
            convs = b["conv"].to_pylist()
            out: dict[str, list] = {"depth": [], "key": [], "open": []}
            for c, digest in zip(convs, b["digest"].to_pylist(), strict=True):
                if first or c != conv:
                    whole, first = first, False
                    conv, depth, value = c, 0, 0
                depth += 1
                value = (value * BASE + int.from_bytes(digest, "big") + 1) % PRIME
                out["depth"].append(depth)
                out["key"].append(value.to_bytes(16, "big"))
                out["open"].append(whole)
            yield {c: b[c] for c in names} | out | {"part": [part] * len(convs)}

    sorted_rows = turns.select(names).repartitionByRange(_ranges(turns), *order).sortWithinPartitions(*order)
    seen = tables.staged(tables.map_batches(sorted_rows, f"{ddl}, depth long, key binary, open boolean, part int", scan), "trie-turns")
    # the conversation each range begins with, and the state in which it leaves the range it ends with
    last = seen.groupBy("part").agg(
        F.max(F.struct("conv", F.col("depth"), "key", "open")).alias("end"), F.min("conv").alias("first"),
        F.max(F.col("conv").isNull()).alias("none")).orderBy("part").collect()
    carried: dict[int, tuple[int, int]] = {}
    state = None  # (conv, depth, value) at the end of the ranges so far
    for r in last:
        starts = None if r["none"] else r["first"]  # nulls sort first
        if state is not None and state[0] == starts:
            carried[r["part"]] = state[1:]
        conv, depth, value = r["end"]["conv"], r["end"]["depth"], int.from_bytes(r["end"]["key"], "big")
        if r["end"]["open"] and r["part"] in carried:
            before = carried[r["part"]]
            value = (before[1] * pow(BASE, depth, PRIME) + value) % PRIME
            depth += before[0]
        state = (conv, depth, value)
    if not carried:
        return seen.select(*names, "depth", "key")

    def carry(batches):
        for b in batches:
            depths, keys = b["depth"].to_pylist(), b["key"].to_pylist()
            for i, (part, goes_on) in enumerate(zip(b["part"].to_pylist(), b["open"].to_pylist(), strict=True)):
                if goes_on and part in carried:
                    n, value = carried[part]
                    keys[i] = ((value * pow(BASE, depths[i], PRIME) + int.from_bytes(keys[i], "big")) % PRIME).to_bytes(16, "big")
                    depths[i] += n
            yield {c: b[c] for c in names} | {"depth": depths, "key": keys}

    return tables.map_batches(seen, f"{ddl}, depth long, key binary", carry)


def _shared(a: list, b: list) -> int:
    """How many first elements are equal; keys that are equal have equal keys before them."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        if a[mid - 1] == b[mid - 1]:
            low = mid
        else:
            high = mid - 1
    return low


#: A node on its way up: members, the smallest, children, leaves and saved tokens below it.
_SUMS = "conv {conv}, n long, children long, leaves long, saved long"


def _least(a, b):
    return b if a is None else a if b is None else min(a, b)


def _closed(node: dict) -> dict:
    """``node`` when all of it is known: a leaf counts itself, its own turn is saved for all members but one."""
    return node | {"leaves": node["leaves"] if node["children"] else 1, "saved": node["saved"] + (node["n"] - 1) * node["words"]}


def _strip(parent: dict, child: dict) -> None:
    """What a closed child hands to the sequence without its last turn."""
    parent["n"] += child["n"]
    parent["conv"] = _least(parent["conv"], child["conv"])
    parent["children"] += 1
    parent["leaves"] += child["leaves"]
    parent["saved"] += child["saved"]


_OUT = ("whole", "level", "key", "parent", "words", "conv", "n", "children", "leaves", "saved")


def _columns(rows: list[tuple]) -> dict:
    return dict(zip(_OUT, map(list, zip(*rows, strict=True)), strict=True))


def _peel(batches):
    """Rows sorted by ``path`` to nodes: whole ones, closed, and the parts of those on the range's edges.
    A band's top level (0) is gathered but not closed: that is done in the band above, or last."""
    stack: list[dict] = []
    path: list[bytes] = []
    edge = None  # levels of the stack that still belong to the range's first row
    done: list[tuple] = []

    def close(keep: int) -> None:
        nonlocal edge
        while len(stack) > keep:
            node, level = stack.pop(), len(stack)
            whole = level >= edge
            if whole and level:
                node = _closed(node)
                _strip(stack[-1], node)
            done.append((whole, level, path[level], path[level - 1] if level else None, node["words"], node["conv"],
                         node["n"], node["children"], node["leaves"], node["saved"]))
        edge = min(edge, keep)

    for b in batches:
        size = len(b["path"])
        for at in range(0, size, _SLICE):
            part = {c: v.slice(at, _SLICE).to_pylist() for c, v in b.items()}
            for new, words, conv, n, children, leaves, saved in zip(*(part[c] for c in (
                    "path", "words", "conv", "n", "children", "leaves", "saved")), strict=True):
                if edge is None:
                    edge = len(new)
                else:
                    close(_shared(path, new))
                path = new
                for level in range(len(stack), len(new)):
                    stack.append({"words": words[level], "conv": None, "n": 0, "children": 0, "leaves": 0, "saved": 0})
                top = stack[-1]
                top["n"] += n
                top["conv"] = _least(top["conv"], conv)
                for c, v in (("children", children), ("leaves", leaves), ("saved", saved)):
                    top[c] += v
            if done:
                yield _columns(done)
                done = []
    if edge is not None:
        edge = len(stack)  # the last row's nodes may go on in the next range
        close(0)
        yield _columns(done)


def _merge(batches):
    """The parts of nodes on the edges of ranges: equal ones merged, then peeled from the deepest level."""
    levels: dict[int, dict[bytes, dict]] = {}
    for b in batches:
        for level, key, parent, words, conv, n, children, leaves, saved in zip(*(b[c].to_pylist() for c in _OUT[1:]), strict=True):
            node = levels.setdefault(level, {}).setdefault(
                key, {"parent": parent, "words": words, "conv": None, "n": 0, "children": 0, "leaves": 0, "saved": 0})
            node["conv"] = _least(node["conv"], conv)
            for c, v in (("n", n), ("children", children), ("leaves", leaves), ("saved", saved)):
                node[c] += v
    for level in sorted(levels, reverse=True):
        done = []
        for key, node in levels[level].items():
            if level:
                node = _closed(node)
                _strip(levels[level - 1][node["parent"]], node)
            done.append((True, level, key, node["parent"], node["words"], node["conv"], node["n"], node["children"], node["leaves"], node["saved"]))
        yield _columns(done)


class Trie:
    """``nodes``: key, depth, parent (key), conv (smallest member), parent_conv, n_convs, n_children, n_leaves,
    saved_tokens. ``ends``: conv, key: the node at which a conversation ends."""

    def __init__(self, nodes: DataFrame, ends: DataFrame):
        self.nodes, self.ends = nodes, ends


def _band(depth: Column, band: int) -> Column:
    return F.floor((depth - 1) / band).cast("long")


def build(turns: DataFrame, convs: DataFrame | None = None, band: int = BAND, rows_per_task: int = ROWS_PER_TASK) -> Trie:
    """``turns`` as ``turns_of`` gives them; ``convs`` (``conv``) may name conversations without turns."""
    conv_type = turns.schema["conv"].dataType.simpleString()
    rows = tables.staged(along(turns).select("conv", "depth", "key", "words"), "trie-keys")
    ends = rows.groupBy("conv").agg(F.max(F.struct("depth", "key")).alias("end")).select("conv", "end.depth", "end.key")
    if convs is not None:
        bare = convs.select(F.col("conv").alias("named")).distinct().join(ends, F.col("named").eqNullSafe(F.col("conv")), "left_anti")
        ends = ends.unionByName(bare.select(F.col("named").alias("conv"), F.lit(0).cast("long").alias("depth"), F.lit(ROOT).alias("key")))
    ends = tables.staged(ends, "trie-ends")

    # equal conversations as one; the row number stands for the conversation whose keys are looked up
    stands = ends.groupBy("key", "depth").agg(F.count("*").alias("n"), F.min("conv").alias("conv"))
    stands = tables.staged(stands.withColumn("band", F.greatest(F.lit(0).cast("long"), _band(F.col("depth"), band))), "trie-distinct")

    # the keys of a conversation in a band, after that of the node above it
    anchor = rows.where(F.col("depth") % band == 0).withColumn("band", F.floor(F.col("depth") / band).cast("long"))
    in_band = rows.withColumn("band", _band(F.col("depth"), band)).unionByName(anchor)
    paths = in_band.groupBy("conv", "band").agg(F.array_sort(F.collect_list(F.struct("depth", "key", "words"))).alias("p"))
    root = F.array(F.struct(F.lit(0).cast("long").alias("depth"), F.lit(ROOT).alias("key"), F.lit(0).cast("long").alias("words")))
    paths = tables.staged(paths.withColumn("p", F.when(F.col("band") == 0, F.concat(root, "p")).otherwise(F.col("p"))).select(
        F.col("conv").alias("of"), F.col("band").alias("of_band"), F.transform("p", lambda x: x["key"]).alias("path"),
        F.transform("p", lambda x: x["words"]).alias("words")), "trie-paths")

    # alone at a band's edge: a chain from there on
    lone = anchor.groupBy("key", "depth").agg(F.count("*").alias("n"), F.min("conv").alias("conv")).where("n = 1")
    cut = tables.staged(lone.groupBy("conv").agg(F.min("depth").alias("cut")), "trie-cuts")
    cut = ends.select("conv", "depth").join(cut, "conv").where("depth > cut").select("conv", "cut")

    alive = stands.join(cut, "conv", "left")
    zero = F.lit(0).cast("long")
    ended = alive.where("cut is null").select("conv", "band", "n", zero.alias("children"), zero.alias("leaves"), zero.alias("saved"))
    one = F.lit(1).cast("long")
    passed = alive.where("cut is not null").select(
        "conv", _band(F.col("cut"), band).alias("band"), one.alias("n"), one.alias("children"), one.alias("leaves"), zero.alias("saved"))
    entries = tables.staged(ended.unionByName(passed), "trie-entries")
    top = entries.agg(F.max("band")).first()[0]

    sums = _SUMS.format(conv=conv_type)
    ddl = f"whole boolean, level int, key binary, parent binary, words long, {sums}"
    above, nodes = None, None
    for b in range(-1 if top is None else top, -1, -1):
        here = entries.where(F.col("band") == b).drop("band")
        here = here if above is None else here.unionByName(above)
        lone_root = F.struct(F.array(F.lit(ROOT)).alias("path"), F.array(zero).alias("words"))
        found = paths.where(F.col("of_band") == b)
        placed = here.join(found, F.col("conv").eqNullSafe(F.col("of")), "left").withColumns({
            "path": F.coalesce("path", lone_root["path"]), "words": F.coalesce("words", lone_root["words"])}).drop("of", "of_band")
        dealt = tables.staged(placed, "trie-band").repartitionByRange(_ranges(rows), "path").sortWithinPartitions("path")
        peeled = tables.staged(tables.map_batches(dealt, ddl, _peel), "trie-peeled")
        merged = tables.staged(tables.map_batches(peeled.where("not whole").coalesce(1), ddl, _merge), "trie-edges")
        done = peeled.where("whole").unionByName(merged)
        made = done.where("level > 0").withColumn("depth", F.col("level") + F.lit(b * band).cast("long"))
        nodes = made if nodes is None else nodes.unionByName(made)
        above = done.where("level = 0").select("conv", "n", "children", "leaves", "saved")
        if b == 0:  # the root has no turn of its own to save
            leaf = F.when(F.col("children") > 0, F.col("leaves")).otherwise(one)
            nodes = nodes.unionByName(done.where("level = 0").withColumn("depth", zero).withColumn("leaves", leaf))
    columns = ["key", "depth", "parent", "conv", "parent_conv", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    if nodes is None:
        empty = f"key binary, depth long, parent binary, conv {conv_type}, parent_conv {conv_type}, n_convs long, n_children long, n_leaves long, saved_tokens long"
        return Trie(turns.sparkSession.createDataFrame([], empty), ends.select("conv", "key"))
    nodes = nodes.select("key", "depth", "parent", "conv", F.col("n").alias("n_convs"), F.col("children").alias("n_children"),
                         F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"))
    upper = nodes.where("n_children > 0").select(F.col("key").alias("parent"), (F.col("depth") + 1).alias("depth"), F.col("conv").alias("parent_conv"))
    below = skew_join(nodes.where("depth > 0"), upper, ["parent", "depth"], rows_per_task=rows_per_task)
    whole = nodes.where("depth = 0").withColumn("parent_conv", F.lit(None).cast(conv_type)).select(columns).unionByName(below.select(columns))

    tails = skew_join(rows, cut, ["conv"], rows_per_task=rows_per_task).where("depth > cut")
    long_ends = ends.select("conv", F.col("depth").alias("last"))
    tails = tails.join(long_ends, "conv").select(
        "key", "depth", F.lit(None).cast("binary").alias("parent"), "conv", F.col("conv").alias("parent_conv"), one.alias("n_convs"),
        F.when(F.col("depth") < F.col("last"), one).otherwise(zero).alias("n_children"), one.alias("n_leaves"), zero.alias("saved_tokens"))
    return Trie(whole.unionByName(tails), ends.select("conv", "key"))


def member_digests(ends: DataFrame) -> DataFrame:
    """``key, ends_sha256``: SHA-256 of the decimal ids that end at a node, ascending, comma-joined.

    Ids are sorted by (node, id) in ranges and joined to pieces there; a digest is sequential, so a
    node's pieces stream through one hash, a piece at a time."""

    def pieces(batches):
        now, held, size, number = None, [], 0, 0
        part = TaskContext.get().partitionId()
        for b in batches:
            out = {"key": [], "part": [], "number": [], "piece": []}

            def hand(out=out):
                for c, v in zip(out, (now, part, number, ",".join(held)), strict=True):
                    out[c].append(v)

            for key, conv in zip(b["key"].to_pylist(), b["conv"].to_pylist(), strict=True):
                if held and (key != now or size > PIECE):
                    hand()
                    held, size, number = [], 0, number + 1
                now = key
                held.append(str(conv))
                size += len(held[-1]) + 1
            yield out
        if held:
            yield {"key": [now], "part": [part], "number": [number], "piece": [",".join(held)]}

    def digest(batches):
        now, made = None, None
        for b in batches:
            out = {"key": [], "ends_sha256": []}
            for k in range(len(b["key"])):
                key, piece = b["key"][k].as_py(), b["piece"][k].as_py().encode()
                if key != now:
                    if now is not None:
                        out["key"].append(now)
                        out["ends_sha256"].append(made.hexdigest())
                    now, made = key, hashlib.sha256(piece)
                else:
                    made.update(b"," + piece)
            yield out
        if now is not None:
            yield {"key": [now], "ends_sha256": [made.hexdigest()]}

    order = ["key", "conv"]
    ordered = ends.where("conv is not null").select(order).repartitionByRange(_ranges(ends), *order).sortWithinPartitions(*order)
    cut = tables.staged(tables.map_batches(ordered, "key binary, part int, number int, piece string", pieces), "trie-pieces")
    dealt = cut.repartition("key").sortWithinPartitions("key", "part", "number")
    return tables.map_batches(dealt, "key binary, ends_sha256 string", digest)
