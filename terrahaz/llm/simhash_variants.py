"""SimHash near-duplicates through deletion variants of few segments.

Fingerprints at most three bits apart: cut into two halves, one half differs by at most one bit.
Each half is indexed under each of its one-wildcard variants (the half without one bit), so such
a pair meets in an equality join on (kept bits, their values) and is verified by its exact
distance. Only different fingerprints take part; copies are one row there.

A bucket with very many fingerprints is not compared all with all: its members go to a finer
index, in which the other half is cut in two again in the same way (the pair still differs by at
most three bits there), and so on until a bucket leaves so few bits open that its size is bounded
(2**11). No pair is lost and no group is capped. Buckets stream through sorted partitions.

Links are joined to components by large-star/small-star rounds over tables in the shared folder.

Defined cases: null text is empty; a text without words has fingerprint zero and is linked like
any other; fewer than ``shingle`` words hash as one sequence; repeated rows share a component;
rows with a null id share the component of their fingerprint, whose name ignores nulls.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrahaz.llm import components, tables

BITS = 64
MAX_DISTANCE = 3
#: Buckets above this size are indexed finer instead of being compared all with all.
BUCKET = 512
#: Narrowest stretch that is still cut in two.
NARROWEST = 16
SEED = 42
#: Hashes per block when bits are counted: bounds the memory of a very long text.
BLOCK = 1 << 15


def fingerprint(body: bytes, shingle: int = 3, seed: int = SEED) -> int:
    """Bit set where over half of the shingles' hashes have it; as a signed 64-bit number."""
    words = body.lower().split()  # on bytes: A-Z only, the six ASCII blanks only
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    if n == 1:
        starts, ends = [0], [len(joined)]
    else:
        edge = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1)
        starts = [0, *edge[: n - 1].tolist()]
        ends = (edge[shingle - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    votes = np.zeros(BITS, dtype=np.int64)
    for i in range(0, n, BLOCK):
        part = [digest(joined[a:b], seed) for a, b in zip(starts[i : i + BLOCK], ends[i : i + BLOCK], strict=True)]
        raw = np.array(part, dtype="<u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(raw, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > n, bitorder="little").view("<i8")[0])


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def variant_masks(start: int, width: int) -> list[tuple[int, int]]:
    """For the stretch of bits [start, start + width): (kept bits, start of the half left open)."""
    half, out = width // 2, []
    for own, other in ((start, start + half), (start + half, start)):
        full = ((1 << half) - 1) << own
        out += [(_signed(full & ~(1 << (own + i))), other) for i in range(half)]
    return out


def index_variants(df: DataFrame, width: int) -> DataFrame:
    """``fp, mask, open`` rows to rows with one wildcard variant of either half of the open
    stretch added to ``mask``; ``open`` becomes the start of the half that stays open."""
    starts = range(0, BITS, width)
    cases = F.create_map(*[x for s in starts for x in (F.lit(s), F.array(*[
        F.struct(F.lit(m).cast("long").alias("m"), F.lit(o).cast("int").alias("o")) for m, o in variant_masks(s, width)]))])
    return (
        df.select("fp", "mask", F.explode(cases[F.col("open")]).alias("v"))
        .select("fp", F.col("mask").bitwiseOR(F.col("v.m")).alias("mask"), F.col("v.o").alias("open"))
        .withColumn("value", F.col("fp").bitwiseAND(F.col("mask")))
    )


def _compare(fp: np.ndarray, run: np.ndarray, far: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions (i, j) of equal ``run`` whose fingerprints are at most ``far`` bits apart."""
    left, right, n = [], [], len(fp)
    at = np.arange(n - 1)
    step = 1
    while len(at):
        at = at[at + step < n]
        at = at[run[at] == run[at + step]]
        near = at[np.bitwise_count(fp[at] ^ fp[at + step]) <= far]
        left.append(near)
        right.append(near + step)
        step += 1
    empty = np.zeros(0, dtype=np.int64)
    return (np.concatenate(left), np.concatenate(right)) if left else (empty, empty)


def _buckets(batches, limit: int, far: int):
    """Rows sorted by bucket to links and to the members of buckets above ``limit`` rows."""
    held = None  # rows of the bucket at the end of what was read: (mask, value, open, fp)
    hot = None  # key of a bucket known to be above the limit

    def settle(rows):
        mask, value, open_, fp = rows
        new = np.flatnonzero((np.diff(mask) != 0) | (np.diff(value) != 0)) + 1
        edges = np.concatenate([[0], new, [len(fp)]])
        size = np.diff(edges)
        run = np.repeat(np.arange(len(size)), size)
        large = (size > limit)[run]
        i, j = _compare(fp[~large].view(np.uint64), run[~large], far)
        ok = fp[~large]
        return ok[i], ok[j], mask[large], open_[large], fp[large]

    def emit(a, b, mask, open_, fp):
        n, k = len(a), len(fp)
        return {
            "a": np.concatenate([np.minimum(a, b), fp]), "b": np.concatenate([np.maximum(a, b), fp]),
            "mask": np.concatenate([np.zeros(n, np.int64), mask]),
            "open": np.concatenate([np.full(n, -1, np.int32), open_.astype(np.int32)]),
        } if n + k else None

    none = np.zeros(0, dtype=np.int64)
    for b in batches:
        rows = [b[c].to_numpy(zero_copy_only=False) for c in ("mask", "value", "open", "fp")]
        if hot is not None:
            same = (rows[0] == hot[0]) & (rows[1] == hot[1])
            if same.any():
                yield emit(none, none, rows[0][same], rows[2][same], rows[3][same])
                rows = [x[~same] for x in rows]
            if not len(rows[0]):
                continue
            hot = None
        if held is not None:
            rows = [np.concatenate([x, y]) for x, y in zip(held, rows, strict=True)]
        last = (rows[0] == rows[0][-1]) & (rows[1] == rows[1][-1])
        cut = len(last) - int(last.sum())
        held = [x[cut:] for x in rows]
        if cut and (out := emit(*settle([x[:cut] for x in rows]))):
            yield out
        if len(held[0]) > limit:
            hot = (held[0][0], held[1][0])
            yield emit(none, none, held[0], held[2], held[3])
            held = None
    if held is not None and (out := emit(*settle(held))):
        yield out


def links(fingerprints: DataFrame, far: int = MAX_DISTANCE, bucket: int = BUCKET) -> DataFrame:
    """``a < b`` of all different fingerprints (column ``fp``) at most ``far`` <= 3 bits apart."""
    if far > 3:
        raise ValueError("two halves with one wildcard find up to three differing bits")
    todo = fingerprints.select("fp", F.lit(0).cast("long").alias("mask"), F.lit(0).cast("int").alias("open"))
    width, found = BITS, []
    while True:
        last = width <= NARROWEST  # what is left open then bounds the bucket
        limit = 1 << 62 if last else bucket
        rows = index_variants(todo, width).repartition("mask", "value").sortWithinPartitions("mask", "value", "fp")
        out = tables.staged(tables.map_batches(
            rows, "a long, b long, mask long, open int", lambda b, n=limit: _buckets(b, n, far)), "simhash-links")
        found.append(out.where("open < 0").select("a", "b"))
        if last:
            break
        todo = out.where("open >= 0").select(F.col("a").alias("fp"), "mask", "open").distinct()
        if todo.isEmpty():
            break
        width //= 2
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return every.where("a <> b").distinct()


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    far: int = MAX_DISTANCE, bucket: int = BUCKET) -> DataFrame:
    """A row per input row: id, ``fp`` (signed 64 bits) and ``component_id``, the smallest id of
    those reachable over links of at most ``far`` bits."""
    rows = tables.staged(
        tables.per_text(df, id_col, text_col, "fp long", lambda x: (fingerprint(x, shingle),))
        .withColumnRenamed(id_col, "id"), "simhash")
    groups = rows.groupBy("fp").agg(F.min("id").alias("least"))
    joined = components.components(links(groups.select("fp"), far, bucket))  # node, root
    named = groups.join(joined, groups["fp"] == joined["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    names = named.groupBy("root").agg(F.min("least").alias("component_id"))
    label = named.select("fp", "root").join(names, "root").select(F.col("fp").alias("fp_"), "component_id")
    return (
        rows.join(label, rows["fp"] == label["fp_"], "left")
        .select(F.col("id").alias(id_col), "fp", "component_id")
    )
