"""Packing by lexical retrieval.

Every text is encoded and closed with ``end_id``. Its whole windows are sequences as they are; the
rest, shorter than a window, is a unit to be packed. Units are dealt to shards in the order of a
weighted min-hash of their tokens, in which rare shared tokens decide, so alike units meet. A shard
(``shard_tokens``) has one BM25 inverted index over tokens whose document frequencies come from all
units. The first unused unit is the seed; the index returns the shard's unused neighbours by falling
BM25 score, and they fill the seed's window greedily. The one that does not fit is cut, and its rest
seeds the next window, so a shard pads one sequence at most. Used units are left out of the index
whenever they are over three tenths of it.

Nothing is collected but one number per vocabulary entry. Encoded pieces are staged once.

Defined cases: null text is empty and gives the closing id alone; repeated rows are packed as often
as they come; strings of special tokens follow the tokenizer file; no rows give no pieces.
"""

from __future__ import annotations

import os
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrahaz.llm import tables
from terrahaz.llm.bpe_monoid import codec

WINDOW = 1024
#: A token of one in so many units is kept as a row of the matrix.
DENSE = 12
#: An index is laid anew once used units are over this share of it.
USED = 0.3
SHARD_TOKENS = 4_000_000
K1, B = 1.2, 0.75
#: Sequences of packed units are numbered from here on, whole windows below.
PACKED = 1 << 61
_PIECES = "seq long, id {id}, start long, doc_tokens long, whole boolean, ids binary"


#: Bytes of text that are encoded at a time.
STRETCH = 1 << 24
#: Texts that are encoded at a time, at most.
SLICE = 10_000


class Encoder:
    """Ids of ``tokenizer_file`` as little-endian unsigned 32-bit bytes. Where the same vocabulary is
    also given as ranks with its split pattern, texts without special tokens are encoded by those:
    the same ids, sooner. Merges never cross a place between a visible character and a space
    (``bpe_monoid``), so a text is the concatenation of the stretches between such places: ``many``
    encodes each different stretch of several texts once."""

    def __init__(self, tokenizer_file: str, ranks_file: str | None = None, pattern: str | None = None):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.slow = Tokenizer.from_file(tokenizer_file)
        self.special = [t.content for t in self.slow.get_added_tokens_decoder().values()]
        self.size = self.slow.get_vocab_size()
        self.fast = self.numbers = None
        if ranks_file:
            ranks = codec(ranks_file, pattern)
            self.fast, self.numbers = ranks.encode_ordinary, partial(ranks.encode_to_numpy, disallowed_special=())
            self.bytes = np.zeros(ranks.n_vocab, dtype=np.int64)  # of each id
            for token in ranks.token_byte_values():
                self.bytes[ranks.encode_single_token(token)] = len(token)

    def __call__(self, text: str) -> bytes:
        if self.fast is None or any(s in text for s in self.special):
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        return np.array(self.fast(text), dtype="<u4").tobytes()

    def many(self, texts: pa.Array) -> list[bytes]:
        """What the encoder makes of each text."""
        if self.fast is None:
            return [self(t) for t in texts.to_pylist()]
        cut = pc.split_pattern(texts, " ")
        size = pc.list_value_length(cut).to_numpy(zero_copy_only=False).astype(np.int64)
        first = np.cumsum(size) - size
        words = cut.flatten().dictionary_encode()
        at, words = words.indices.to_numpy(zero_copy_only=False), words.dictionary
        n_bytes = pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
        visible = pc.binary_length(pc.utf8_rtrim_whitespace(words)).to_numpy(zero_copy_only=False)
        # behind a blank the next one may be part of a piece: such texts are encoded as they are
        whole = np.logical_or.reduceat(((visible < n_bytes) | (n_bytes == 0))[at], first)
        for s in self.special:
            whole |= pc.match_substring(texts, s).to_numpy(zero_copy_only=False)
        used = np.zeros(len(words), dtype=bool)
        used[at[np.repeat(~whole, size)]] = True
        asked = np.flatnonzero(used)
        # an empty string before them gives the first its blank
        text = pa.LargeListArray.from_arrays([0, len(asked) + 1], pa.concat_arrays([pa.array([""], words.type), words.take(pa.array(asked))]))
        ids = self.numbers(pc.binary_join(text, pa.scalar(" ", words.type))[0].as_py()).astype("<u4", copy=False)
        ends = np.zeros(len(words) + 1, dtype=np.int64)
        ends[asked + 1] = np.diff(np.searchsorted(np.cumsum(self.bytes[ids]), np.cumsum(n_bytes[asked] + 1), "right"), prepend=0)
        # a text is its first stretch, which has no blank before it, and the others; or it is one
        own = [self(t) if entire else np.array(self.fast(words[i].as_py()), dtype="<u4").tobytes()
               for t, entire, i in zip(texts.to_pylist(), whole.tolist(), at[first].tolist(), strict=True)]
        ends = np.concatenate([4 * np.cumsum(ends), 4 * int(ends.sum()) + np.cumsum([*map(len, own), 0])])
        pool = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(ids.tobytes() + b"".join(own))])
        part = np.where(np.repeat(whole, size), len(ends) - 2, at)
        part[first] = len(words) + np.arange(len(own))
        made = pool.take(pa.array(part))
        upto, raw = np.frombuffer(made.buffers()[1], dtype=np.int64)[: len(part) + 1], made.buffers()[2]
        return [raw[i:j].to_pybytes() for i, j in zip(upto[first].tolist(), upto[first + size].tolist(), strict=True)]


def sort_ranks(df: np.ndarray, idf: np.ndarray, end_id: int) -> np.ndarray:
    """A rank per token for weighted min-hashing: the smallest of exponential clocks whose rates are
    squared weights, so rare shared tokens decide. Tokens of one unit and ``end_id`` come last."""
    mixed = (np.arange(len(df), dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(31)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(29)
    clock = -np.log(((mixed >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)) / idf**2
    clock[df < 2] = np.inf
    clock[end_id] = np.inf
    rank = np.empty(len(df), dtype=np.int64)
    rank[np.argsort(clock, kind="stable")] = np.arange(len(df))
    rank[np.isinf(clock)] = len(df)
    return rank


def signature(ids: np.ndarray, rank: np.ndarray) -> int:
    """The two smallest ranks among the tokens, the smallest one first."""
    got = rank[ids]
    first = got.min()
    rest = got[got > first]
    return int(first << 32 | (rest.min() if len(rest) else len(rank)))


def pieces(df: DataFrame, encoder, id_col: str, text_col: str, window: int, end_id: int) -> DataFrame:
    """Whole windows and units of all texts, staged. ``encoder`` is a function that makes one."""
    id_type = df.schema[id_col].dataType.simpleString()

    def run(batches):
        encode, n, closing = encoder(), TaskContext.get().partitionId() << 33, end_id.to_bytes(4, "little")
        for b in (x for batch in batches for x in tables.slices(batch, "body", STRETCH, SLICE)):
            out = {c: [] for c in ("seq", "id", "start", "doc_tokens", "whole", "ids")}
            texts = pa.array([x.decode("utf-8", "replace") for x in b["body"].to_pylist()], pa.large_string())
            made = encode.many(texts) if isinstance(encode, Encoder) else map(encode, texts.to_pylist())
            for key, raw in zip(b["id"].to_pylist(), made, strict=True):
                ids = np.frombuffer(raw + closing, dtype="<u4")
                for start in range(0, len(ids), window):
                    part = ids[start : start + window]
                    whole = len(part) == window
                    for c, v in zip(out, (n, key, start, len(ids), whole, part.tobytes()), strict=True):
                        out[c].append(v)
                    n += 1
            yield out

    return tables.staged(tables.map_batches(tables.texts(df, id_col, text_col), _PIECES.format(id=id_type), run), "pack-pieces")


def token_frequencies(units: DataFrame, vocabulary: int) -> np.ndarray:
    """In how many units each token occurs, over all units: one number per vocabulary entry."""

    def run(batches):
        seen, last = np.zeros(vocabulary, dtype=np.int64), np.zeros(vocabulary, dtype=np.int64)
        for b in batches:
            for raw in b["ids"].to_pylist():
                seen[distinct(np.frombuffer(raw, "<u4"), last)] += 1
        at = np.flatnonzero(seen)
        yield {"token": at, "n": seen[at]}

    total = np.zeros(vocabulary, dtype=np.int64)
    for r in tables.map_batches(units.select("ids"), "token long, n long", run).groupBy("token").agg(F.sum("n").alias("n")).collect():
        total[r["token"]] = r["n"]
    return total


def distinct(ids: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The different ids, each once; ``last`` is working space as long as the vocabulary."""
    at = np.arange(len(ids))
    last[ids] = at
    return ids[last[ids] == at]


class Index:
    """BM25 inverted index over the units of a shard. Tokens of ``1 / DENSE`` of the units or more are
    kept as a matrix (at most ``DENSE`` times as many cells as postings), the others as postings."""

    def __init__(self, units: list[np.ndarray], idf: np.ndarray, mean_length: float):
        self.last = np.zeros(len(idf), dtype=np.int64)
        lengths = np.array([len(u) for u in units])
        pair = (np.concatenate(units).astype(np.int64) << 32) | np.repeat(np.arange(len(units)), lengths)
        pair, count = np.unique(pair, return_counts=True)
        token, unit = pair >> 32, pair & 0xFFFFFFFF
        weight = (idf[token] * count * (K1 + 1) / (count + K1 * (1 - B + B * lengths[unit] / mean_length))).astype(np.float32)
        self._lay(token, unit, weight, np.arange(len(units)))

    def _lay(self, token, unit, weight, alive):
        self.token, self.unit, self.weight, self.alive = token, unit, weight, alive
        n = len(alive)
        size = np.bincount(token, minlength=len(self.last))
        self.first, self.size, self.n = np.cumsum(size) - size, size.copy(), n
        often = np.flatnonzero(size * DENSE >= max(n, 1))
        self.row = np.full(len(size), -1)
        self.row[often] = np.arange(len(often))
        self.matrix = np.zeros((len(often), n), dtype=np.float32)
        at = self.row[token] >= 0
        self.matrix[self.row[token[at]], unit[at]] = weight[at]
        self.size[often] = 0

    def drop(self, unused: np.ndarray):
        """Leave the used units out of the index."""
        new = np.cumsum(unused[self.alive]) - 1
        at = unused[self.alive[self.unit]]
        self._lay(self.token[at], new[self.unit[at]], self.weight[at], self.alive[unused[self.alive]])

    def scores(self, seed: np.ndarray) -> np.ndarray:
        """Scores of the units in ``alive``."""
        terms = distinct(seed, self.last)
        rows = self.row[terms]
        asked = np.zeros(len(self.matrix), dtype=np.float32)
        asked[rows[rows >= 0]] = 1
        total = asked @ self.matrix
        size = self.size[terms]
        ends = np.cumsum(size)
        if len(ends) and ends[-1]:
            where = np.arange(ends[-1]) + np.repeat(self.first[terms] - ends + size, size)
            total = total + np.bincount(self.unit[where], weights=self.weight[where], minlength=self.n)
        return total


class Packer:
    def __init__(self, window: int, idf: np.ndarray, mean_length: float, first_sequence: int):
        self.window, self.idf, self.mean_length = window, idf, mean_length
        self.sequence, self.filled, self.seed = first_sequence, 0, None

    def chunk(self, units: list[np.ndarray]):
        """Yields (unit, first token, last token + 1, sequence, offset) for all tokens of all units."""
        index = Index(units, self.idf, self.mean_length)
        done = np.zeros(len(units), dtype=np.int64)
        unused = np.ones(len(units), dtype=bool)
        first, ranked, cut, left = 0, None, None, len(units)
        while True:
            if self.filled == 0:  # a new window: the rest of a cut unit or the first unused one
                while cut is None and first < len(units) and not unused[first]:
                    first += 1
                at = cut if cut is not None else first
                if at == len(units):
                    return
                self.seed, ranked, cut = units[at], None, None
            else:
                if not left:
                    return
                if ranked is None:
                    ranked = self._ranked(index, unused)
                at = next(ranked)
            left -= int(unused[at])
            unused[at] = False
            take = min(self.window - self.filled, len(units[at]) - int(done[at]))
            yield at, int(done[at]), int(done[at]) + take, self.sequence, self.filled
            done[at] += take
            self.filled += take
            if self.filled == self.window:
                self.filled, self.sequence = 0, self.sequence + 1
                if done[at] < len(units[at]):
                    cut = at

    def _ranked(self, index: Index, unused: np.ndarray):
        """The unused units by falling score for the seed, then by number; sorted as far as asked."""
        if int(unused[index.alive].sum()) < (1 - USED) * index.n:
            index.drop(unused)
        live = unused[index.alive]
        scores, alive = index.scores(self.seed)[live], index.alive[live]
        more = 16
        while len(alive):
            if more < len(alive):
                edge = np.partition(scores, len(scores) - more)[len(scores) - more]
                near = scores > edge
                near[np.flatnonzero(scores == edge)[: more - int(near.sum())]] = True
            else:
                near = np.ones(len(alive), dtype=bool)
            yield from alive[near][np.argsort(-scores[near], kind="stable")].tolist()
            scores, alive, more = scores[~near], alive[~near], more * 4


def pack(df: DataFrame, encoder, vocabulary: int, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
         end_id: int = 0, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """A row per piece: id, ``start`` (tokens of its text before it), ``ids`` (little-endian
    unsigned 32-bit), ``doc_tokens``, ``sequence_id`` and ``offset``."""
    spark = df.sparkSession
    every = pieces(df, encoder, id_col, text_col, window, end_id)
    units = every.where("not whole")
    size = units.agg(F.count("*").alias("n"), F.sum(F.octet_length("ids")).alias("bytes")).first()
    whole = every.where("whole").select(
        F.col("id").alias(id_col), "start", "ids", "doc_tokens", F.col("seq").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    if not size["n"]:
        return whole
    tokens = size["bytes"] // 4
    df_ = token_frequencies(units, vocabulary)
    idf = np.log1p((size["n"] - df_ + 0.5) / (df_ + 0.5))
    shared = spark.sparkContext.broadcast((idf, tokens / size["n"]))  # as long as the vocabulary
    shards = -(-tokens // shard_tokens)
    id_type = df.schema[id_col].dataType.simpleString()

    def run(batches):
        idf, mean = shared.value
        packer = Packer(window, idf, mean, PACKED + (TaskContext.get().partitionId() << 33))
        held: list[tuple] = []

        def emit(rows):
            ids = [np.frombuffer(r[3], "<u4") for r in rows]
            cuts = list(packer.chunk(ids))
            return {
                "id": [rows[u][0] for u, *_ in cuts], "start": [rows[u][1] + a for u, a, *_ in cuts],
                "ids": [ids[u][a:b].tobytes() for u, a, b, *_ in cuts], "doc_tokens": [rows[u][2] for u, *_ in cuts],
                "sequence_id": [c[3] for c in cuts], "offset": [c[4] for c in cuts],
            }

        for b in batches:
            held += zip(*(b[c].to_pylist() for c in ("id", "start", "doc_tokens", "ids")), strict=True)
        if held:
            yield emit(held)

    def signed(batches):
        rank = ranks.value
        for b in batches:
            yield dict(b) | {"sig": [signature(np.frombuffer(x, "<u4"), rank) for x in b["ids"].to_pylist()]}

    ranks = spark.sparkContext.broadcast(sort_ranks(df_, idf, end_id))
    units = units.select("seq", "id", "start", "doc_tokens", "ids")
    ordered = tables.map_batches(units, f"seq long, id {id_type}, start long, doc_tokens long, ids binary, sig long", signed)
    shard = (
        ordered.repartitionByRange(shards, "sig", "seq").sortWithinPartitions("sig", "seq")
        .select("id", "start", "doc_tokens", "ids")
    )
    packed = tables.map_batches(
        shard, f"id {id_type}, start long, ids binary, doc_tokens long, sequence_id long, offset long", run)
    return whole.unionByName(packed.withColumnRenamed("id", id_col))


@lru_cache(maxsize=2)
def encoder_of(tokenizer_file: str, ranks_file: str | None = None, pattern: str | None = None) -> Encoder:
    """One encoder per worker process."""
    return Encoder(tokenizer_file, ranks_file, pattern)
