"""Chat formatting as a prefix tree: shared initial turns once, depth first.

A turn is written ``<s>[role]\\n`` + text + ``</s>``; in role and text a backslash is doubled and
the first character of a control string (``<s>``, ``</s>``, ``[INST]``, ``[/INST]``) is replaced by
``\\3c`` or ``\\5b``, so no text can close or open a turn and every text comes back exactly.
Marks and text are encoded apart, so the loss mask (the text of assistant turns) ends at token edges.

Conversations that begin alike share the nodes of these turns. The key of a node is a 127-bit hash
of all turns up to it, carried from range to range (``prefix_trie.along``), so the turns of one
conversation are spread over tasks. Conversations are sorted by their node keys, which is depth-first order: each node is first met in the least conversation that holds it,
and nodes sorted by (that conversation, depth) are the tree in preorder. Token offsets are a
running sum over that order, taken per range with the ranges' totals added. Per node:

* ``start``/``n_tokens``: its stretch of the emitted tokens;
* ``position``: position id of its first token, i.e. the tokens of its ancestors;
* ``sees``: the stretches of its ancestors, adjacent ones merged: with its own stretch (causal)
  they are what its tokens attend to.

Hot first turns and repeated conversations are aggregated with map-side combining; only a
conversation's node keys (16 bytes a turn) must fit in a row. Texts and ids are taken up in slices of
about a megabyte or one turn, so memory does not follow the length of turns times rows per batch.

Defined cases: null text or role is empty; turns are ordered by turn, then role, then text (ties,
repeated rows and null turns included, nulls first); a null conversation id is one conversation.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrahaz.llm import prefix_trie, tables

OPEN, CLOSE = "<s>[", "</s>"
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]")
TURN = re.compile(r"<s>\[(.*?)\]\n(.*?)</s>", re.S)


def escape(c: Column) -> Column:
    out = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    for s in CONTROLS:
        out = F.replace(out, F.lit(s), F.lit({"<": "\\3c", "[": "\\5b"}[s[0]] + s[1:]))
    return out


def escape_role(c: Column) -> Column:
    """Roles also must not hold the bracket that ends them."""
    return F.replace(escape(c), F.lit("]"), F.lit("\\5d"))


def unescape(text: str) -> str:
    return re.sub(r"\\(\\|3c|5b|5d)", lambda m: {"\\": "\\", "3c": "<", "5b": "[", "5d": "]"}[m.group(1)], text)


def read_turn(formatted: str) -> tuple[str, str]:
    """(role, text) of one formatted turn."""
    m = TURN.fullmatch(formatted)
    if not m:
        raise ValueError("not a formatted turn")
    return unescape(m.group(1)), unescape(m.group(2))


def _cumulated(df: DataFrame, length: str, label: str) -> DataFrame:
    """``df``, whose partitions are sorted ranges in order, with ``start``: the sum of ``length`` over
    all rows before. Staged; one number per range goes to the driver."""
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)

    def local(batches):
        part, at = TaskContext.get().partitionId(), 0
        for b in batches:
            n = b[length].to_numpy()
            ends = np.cumsum(n) + at
            yield dict(b) | {"part": np.full(len(n), part), "within": ends - n}
            at = int(ends[-1])

    out = tables.staged(tables.map_batches(df, f"{ddl}, part int, within long", local), label)
    totals = sorted(out.groupBy("part").agg(F.max(F.col("within") + F.col(length)).alias("n")).collect())
    before = np.cumsum([0, *[r["n"] for r in totals]]).tolist()
    if not totals:
        return out.withColumn("start", F.col("within")).drop("part", "within")
    base = F.create_map(*[x for r, n in zip(totals, before, strict=False) for x in (F.lit(r["part"]), F.lit(n).cast("long"))])
    return out.withColumn("start", F.col("within") + base[F.col("part")]).drop("part", "within")


class Forest:
    """``nodes``: a row per node (node, parent, tree, depth, role, ids as little-endian unsigned 32-bit, start,
    n_tokens, position, loss_from, loss_to, sees). ``turns``: (conv, depth, node), a row per turn."""

    def __init__(self, nodes: DataFrame, turns: DataFrame):
        self.nodes, self.turns = nodes, turns


def build(df: DataFrame, encoder, ranges: int | None = None, conv_col: str = "conv_id", turn_col: str = "turn",
          role_col: str = "role", text_col: str = "text") -> Forest:
    """``encoder`` is a function that makes a text -> ids function in the worker."""
    spark = df.sparkSession
    ranges = ranges or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    role, text = F.coalesce(F.col(role_col), F.lit("")), F.coalesce(F.col(text_col), F.lit(""))
    said = df.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text"),
        F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))).alias("digest"))
    keyed = prefix_trie.along(said, ("conv", "turn", "role", "text"), ())
    turns = tables.staged(keyed.select("conv", "depth", F.col("key").alias("node"), "role", "text"), "chat-turns")

    # depth-first order of the conversations
    paths = turns.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("depth", "node"))).alias("path"))
    leaves = paths.groupBy(F.transform("path", lambda p: p["node"]).alias("path")).agg(F.count("*").alias("copies"))
    ranked = tables.staged(
        leaves.repartitionByRange(ranges, "path").sortWithinPartitions("path")
        .withColumn("rank", F.monotonically_increasing_id()), "chat-paths")
    along = ranked.select("rank", "path", F.posexplode("path").alias("at", "node"))
    first = along.select("rank", "node", (F.col("at") + 1).alias("depth"), F.get("path", F.col("at") - 1).alias("parent")).groupBy("node").agg(
        F.min("rank").alias("rank"), F.min("depth").alias("depth"), F.min("parent").alias("parent"))
    content = turns.groupBy("node").agg(F.min(F.struct("role", "text")).alias("c"))
    marked = content.select(
        "node", F.col("c.role").alias("role"),
        F.concat(F.lit(OPEN), escape_role(F.col("c.role")), F.lit("]\n")).alias("head"), escape(F.col("c.text")).alias("body"))
    marked = marked.join(first, "node")

    def encode(batches):
        enc = encoder()
        close = np.array(enc(CLOSE), dtype="<u4").tobytes()
        for batch in batches:
            for b in tables.slices(batch, "body"):
                out = {c: [] for c in ("ids", "n_tokens", "loss_from", "loss_to")}
                for head, body in zip(b["head"].to_pylist(), b["body"].to_pylist(), strict=True):
                    h, t = (np.array(enc(x), dtype="<u4").tobytes() for x in (head, body))
                    ids = h + t + close
                    for c, v in zip(out, (ids, len(ids) // 4, len(h) // 4, (len(h) + len(t)) // 4), strict=True):
                        out[c].append(v)
                yield {c: b[c] for c in ("node", "parent", "role", "rank", "depth")} | out

    ddl = "node binary, parent binary, role string, rank long, depth int, ids binary, n_tokens long, loss_from int, loss_to int"
    encoded = tables.map_batches(marked.select("node", "parent", "role", "rank", "depth", "head", "body"), ddl, encode)
    # staged before the ranges are drawn, so that drawing them does not encode again
    encoded = tables.staged(encoded, "chat-nodes")
    placed = _cumulated(encoded.repartitionByRange(ranges, "rank", "depth").sortWithinPartitions("rank", "depth"),
                        "n_tokens", "chat-order")

    # down each least conversation: positions and ancestors, in one streaming pass
    walk = (
        ranked.select("rank", F.explode("path").alias("node"))
        .join(placed.select("node", "start", "n_tokens", "depth", F.col("rank").alias("own")), "node")
        .repartition("rank").sortWithinPartitions("rank", "depth")
    )

    def descend(batches):
        now, position, tree, seen = None, 0, None, []
        for batch in batches:
            for b in tables.slices(batch, "node"):
                out = {c: [] for c in ("node", "position", "tree", "sees")}
                for rank, node, start, n, own in zip(*(b[c].to_pylist() for c in ("rank", "node", "start", "n_tokens", "own")), strict=True):
                    if rank != now:
                        now, position, tree, seen = rank, 0, start, []
                    if own == rank:
                        for c, v in zip(out, (node, position, tree, [{"from": a, "to": z} for a, z in seen]), strict=True):
                            out[c].append(v)
                    position += n
                    if seen and seen[-1][1] == start:
                        seen[-1] = (seen[-1][0], start + n)
                    else:
                        seen = [*seen, (start, start + n)]
                yield out

    views = tables.map_batches(walk, "node binary, position long, tree long, sees array<struct<from:bigint,to:bigint>>", descend)
    nodes = placed.join(views, "node").select(
        "node", "parent", "tree", "depth", "role", "ids", "start", "n_tokens", "position",
        F.when(F.col("role") == "assistant", F.col("loss_from")).alias("loss_from"),
        F.when(F.col("role") == "assistant", F.col("loss_to")).alias("loss_to"), "sees")
    return Forest(nodes, turns.select("conv", "depth", "node"))


def read_back(forest: Forest, decoder) -> DataFrame:
    """A row per conversation, from the emitted tokens alone: number of turns, digests and lengths
    of what the tokens say and of what the loss mask covers. Conversations stream through sorted
    partitions, so a long one needs no more memory than its longest turn."""
    t, n = forest.turns, forest.nodes.select("node", "ids", "loss_from", "loss_to")
    conv_type = t.schema["conv"].dataType.simpleString()
    rows = t.join(n, "node").select("conv", "depth", "ids", "loss_from", "loss_to").repartition("conv").sortWithinPartitions("conv", "depth")
    ddl = (f"conv {conv_type}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")

    def run(batches):
        decode, now = decoder(), None
        done = []

        def close():
            done.append((now[0], now[1], now[2].hexdigest(), now[3], now[4].hexdigest(), now[5]))

        for batch in batches:
            for b in tables.slices(batch, "ids"):
                for conv, raw, a, z in zip(*(b[c].to_pylist() for c in ("conv", "ids", "loss_from", "loss_to")), strict=True):
                    if now is None or conv != now[0]:
                        if now is not None:
                            close()
                        now = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                    ids = np.frombuffer(raw, "<u4")
                    formatted = decode(ids.tolist())
                    role, text = read_turn(formatted)
                    now[1] += 1
                    now[2].update(f"{role}\n{text}\n".encode())
                    now[5] += len(formatted)
                    if a is not None:
                        said = unescape(decode(ids[a:z].tolist()))
                        now[3] += len(said)
                        now[4].update(said.encode())
            if len(done) >= 1000:
                yield _columns(done)
                done = []
        if now is not None:
            close()
        if done:
            yield _columns(done)

    return tables.map_batches(rows, ddl, run)


def _columns(rows: list[tuple]) -> dict:
    names = ("conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
    return dict(zip(names, map(list, zip(*rows, strict=True)), strict=True))
