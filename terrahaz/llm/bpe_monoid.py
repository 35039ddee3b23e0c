"""Byte-level BPE as a monoid: encode halves, join neighbours by re-encoding the seam.

The split pattern gives pieces (letters, digits, other signs, blanks, each with at most one
leading blank) and merges never leave a piece. No piece holds a visible character followed by a
blank, and the pattern never looks back, so every place between a visible character and a space
or line feed is a piece boundary whatever stands around it. ``join`` therefore looks for the last
such place in the left element and the first one in the right element, in windows that double
until one is found or the element is used up; ids outside are proven stable, the ids between
are encoded again. The join is associative, so any tree gives the ids of the whole text. Decoding
is concatenation up the tree.

Texts above ``segment_chars`` are cut into segments that different tasks encode and that are
joined pair by pair in shuffles; the others are encoded where they lie, by the same functions.

Defined cases: null text is empty and gives no ids; repeated rows each get their row; extra
columns are ignored; strings of special tokens are ordinary text.
"""

from __future__ import annotations

import base64
import os
import re
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrahaz.llm import tables

LEAF_CHARS = 8192
SEGMENT_CHARS = 1 << 20
WINDOW = 64
#: Rows a task turns into ids at a time.
ROWS = 256
BOUNDARY = re.compile(r"\S(?=[ \n])")


@lru_cache(maxsize=4)
def codec(ranks_file: str, pattern: str):
    import tiktoken

    with open(ranks_file, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(os.path.basename(ranks_file), pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def last_boundary(text: str, window: int = WINDOW) -> int:
    """The last certain piece boundary, 0 if there is none."""
    while True:
        start = max(0, len(text) - window)
        found = 0
        for m in BOUNDARY.finditer(text, start):
            found = m.end()
        if found or start == 0:
            return found
        window *= 2


def first_boundary(text: str, window: int = WINDOW) -> int:
    """The first certain piece boundary, the text's end if there is none."""
    while True:
        m = BOUNDARY.search(text, 0, min(len(text), window))
        if m:
            return m.end()
        if window >= len(text):
            return len(text)
        window *= 2


def join(codec_, left: str, left_ids: list[int], right: str, right_ids: list[int]) -> list[int]:
    """Ids of ``left + right`` from the ids of both."""
    if not left or not right:
        return left_ids or right_ids
    encode = codec_.encode_ordinary
    a, b = last_boundary(left), first_boundary(right)
    kept = len(left_ids) - len(encode(left[a:]))
    dropped = len(encode(right[:b]))
    return left_ids[:kept] + encode(left[a:] + right[:b]) + right_ids[dropped:]


def encode_tree(codec_, text: str, leaf_chars: int = LEAF_CHARS) -> list[int]:
    if len(text) <= leaf_chars:
        return codec_.encode_ordinary(text)
    half = len(text) // 2
    left, right = text[:half], text[half:]
    return join(codec_, left, encode_tree(codec_, left, leaf_chars), right, encode_tree(codec_, right, leaf_chars))


def decode_tree(codec_, ids, leaf_ids: int = 4096) -> bytes:
    if len(ids) <= leaf_ids:
        return codec_.decode_bytes(ids)
    half = len(ids) // 2
    return decode_tree(codec_, ids[:half], leaf_ids) + decode_tree(codec_, ids[half:], leaf_ids)


def _slices(batch: dict, rows: int = ROWS):
    """A batch in parts of at most ``rows`` rows: ids take several times the room of their text."""
    n = len(next(iter(batch.values())))
    for i in range(0, n, rows):
        yield {name: column.slice(i, rows) for name, column in batch.items()}


def _encode_batches(batches, ranks_file, pattern, leaf_chars):
    c = codec(ranks_file, pattern)
    for batch in batches:
        for b in _slices(batch):
            ids = [np.array(encode_tree(c, x.decode("utf-8", "replace"), leaf_chars), dtype=np.int32) for x in b["body"].to_pylist()]
            ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
            yield b | {"ids": pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids)))}


def _join_groups(rows: pa.Table, ranks_file, pattern) -> pa.Table:
    """Two neighbouring segments, or a last one without a neighbour, become one."""
    c = codec(ranks_file, pattern)
    got = sorted(rows.to_pylist(), key=lambda r: r["part"])
    text, ids = got[0]["body"].decode("utf-8", "replace"), got[0]["ids"]
    for r in got[1:]:
        more = r["body"].decode("utf-8", "replace")
        text, ids = text + more, join(c, text, ids, more, r["ids"])
    out = got[0] | {"part": got[0]["part"] // 2, "body": text.encode(), "ids": ids}
    return pa.Table.from_pylist([out], schema=rows.schema)


def encode(df: DataFrame, ranks_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
           leaf_chars: int = LEAF_CHARS, segment_chars: int = SEGMENT_CHARS) -> DataFrame:
    """``id, ids`` with the ids of each whole text as ``array<int>``."""
    id_type = df.schema[id_col].dataType.simpleString()
    body = F.coalesce(F.col(text_col), F.lit(""))
    rows = df.select(F.col(id_col).alias("id"), body.alias("text"))
    long = F.length("text") > segment_chars
    run = partial(_encode_batches, ranks_file=ranks_file, pattern=pattern, leaf_chars=leaf_chars)

    whole = rows.where(~long).select("id", F.col("text").cast("binary").alias("body"))
    short = tables.map_batches(whole, f"id {id_type}, body binary, ids array<int>", run).select("id", "ids")

    cut = (
        rows.where(long)
        .withColumn("row", F.monotonically_increasing_id())
        .select("id", "row", "text", F.explode(F.sequence(
            F.lit(0), F.ceil(F.length("text") / segment_chars).cast("int") - 1)).alias("part"))
        .select("id", "row", "part", F.expr(
            f"cast(substring(text, part * {segment_chars} + 1, {segment_chars}) as binary)").alias("body"))
    )
    most = rows.agg(F.max(F.length("text"))).first()[0] or 0
    if most <= segment_chars:
        return short.withColumnRenamed("id", id_col)
    ddl = f"id {id_type}, row bigint, part int, body binary, ids array<int>"
    # staged, so that a repeated task finds the same row numbers
    pieces = tables.map_batches(tables.staged(cut, "bpe-segments").repartition("row", "part"), ddl, run)
    n = -(-most // segment_chars)
    while n > 1:
        pieces = (
            pieces.withColumn("pair", F.expr("part div 2")).groupBy("row", "pair")
            .applyInArrow(lambda t: _join_groups(t.drop_columns(["pair"]), ranks_file, pattern), ddl)
        )
        n = -(-n // 2)
    return short.unionByName(pieces.select("id", "ids")).withColumnRenamed("id", id_col)


def decode(df: DataFrame, ranks_file: str, pattern: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """All columns of ``df`` and the bytes of its ids."""
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)

    def run(batches):
        c = codec(ranks_file, pattern)
        for batch in batches:
            for b in _slices(batch):
                ids = b[ids_col]
                flat, ends = ids.values.to_numpy(zero_copy_only=False), ids.offsets.to_numpy()
                null = ids.is_null().to_numpy(zero_copy_only=False)
                texts = [b"" if z else decode_tree(c, flat[i:j].tolist()) for i, j, z in zip(ends[:-1], ends[1:], null, strict=True)]
                yield b | {out_col: texts}

    return tables.map_batches(df, f"{types}, `{out_col}` binary", run)
