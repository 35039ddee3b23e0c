"""Spelling variants: words one edit apart, found over a reduced alphabet.

Letters are hashed to ``symbols`` symbols. If two words differ by one inserted, deleted or replaced
letter, their reduced words are equal or differ by one edit too. So for every different reduced word its
full one-edit neighbourhood is generated (all deletions, replacements and insertions of symbols, as
64-bit hashes), joined by equality with the reduced words of the vocabulary, and the words behind
both sides are verified on the original letters. Of each pair of reduced words one side carries the
join. Colliding hashes only add candidates.

A word's ``form`` is its most frequent near word if that is ``ratio`` times as frequent or more;
``root`` follows forms to the last. Each step multiplies the count by ``ratio``, so chains are short and
free of cycles; they are followed by pointer doubling.

What is gathered per word is bounded by the alphabet (near words) and the vocabulary is counted with
partial sums, so a frequent word is no task's burden; a reduced word behind which very many words lie is
split over tasks. A neighbourhood is a row per neighbour, so a word of any length needs memory in
proportion to its length.

Defined cases: null text has no words; a null id counts as empty text where ``change`` sees it; repeated
documents count each time; empty tables give none; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrahaz.llm import tables
from terrahaz.operators.sizing import skew_join

LETTERS = "A-Za-zÀ-ÿ"
MIN_LENGTH = 7
MIN_COUNT = 2
SYMBOLS = 8
RATIO = 10
#: Different words counted in a task before they are handed on, and hashes made at a time.
HELD = 200_000
AT_ONCE = 1 << 20
#: Rows of one reduced word that a task takes.
ROWS_PER_TASK = 200_000
#: Odd base of the hash of reduced words, and its inverse; both modulo 2**64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


def dropped_letter(doc_id: str, word: str) -> str:
    """``word`` without one letter for every 31st hash of id and word, as a typing error would."""
    h = zlib.crc32(f"{doc_id}:{word}".encode())
    if h % 31:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def vocabulary(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
               min_count: int = MIN_COUNT, change: Callable[[str, str], str] | None = None) -> DataFrame:
    """``word, n``: maximal runs of letters with A-Z in lower case, of ``min_length`` letters and
    ``min_count`` occurrences or more. ``change(id, word)`` may shorten a word before it is counted."""
    rows = df.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
                     F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("body"))
    runs = re.compile(f"[{LETTERS}]{{{min_length},}}")

    def count(batches):
        tally: Counter = Counter()
        for b in batches:
            for k in range(len(b["id"])):
                found = Counter(runs.findall(b["body"][k].as_py().lower().decode("utf-8", "replace")))
                if change is None:
                    tally.update(found)
                else:
                    i = b["id"][k].as_py()
                    for word, n in found.items():
                        word = change(i, word)
                        if len(word) >= min_length:
                            tally[word] += n
                if len(tally) > HELD:
                    yield {"word": list(tally), "n": list(tally.values())}
                    tally = Counter()
        yield {"word": list(tally), "n": list(tally.values())}

    counted = tables.map_batches(rows, "word string, n long", count)
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words and the place at which each word begins."""
    ends = np.cumsum([0, *map(len, words)])
    return np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32).astype(np.uint64), ends


def symbols_of(codes: np.ndarray, symbols: int) -> np.ndarray:
    """A symbol from 1 to ``symbols`` for each code point."""
    with np.errstate(over="ignore"):
        return ((codes * np.uint64(BASE)) >> np.uint64(40)) % np.uint64(symbols) + np.uint64(1)


def _powers(n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, BASE, dtype=np.uint64))])


def reduced_hashes(words: list[str], symbols: int) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Each word's reduced word, its hash (the sum of symbol i times BASE to the i) and the set of its
    letters as 64 bits: one edit changes at most two of them."""
    codes, ends = _codes(words)
    made = symbols_of(codes, symbols)
    lengths = np.diff(ends)
    place = np.arange(len(codes)) - np.repeat(ends[:-1], lengths)
    with np.errstate(over="ignore"):
        terms = np.concatenate([[np.uint64(0)], np.cumsum(made * _powers(int(lengths.max(initial=0)))[place])])
        hashes = terms[ends[1:]] - terms[ends[:-1]]
    bits = np.concatenate([np.uint64(1) << (codes % np.uint64(64)), [np.uint64(0)]])
    masks = np.where(lengths > 0, np.bitwise_or.reduceat(bits, ends[:-1]), 0).astype(np.uint64)
    raw = made.astype(np.uint8).tobytes()
    return [raw[a:z] for a, z in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)], hashes.view(np.int64), masks.view(np.int64)


def neighbours(reduced: np.ndarray, symbols: int) -> np.ndarray:
    """Hashes of all one-edit neighbours of reduced words of one length, a row each (the word itself
    and repetitions among them)."""
    n, length = reduced.shape
    c, every = reduced.astype(np.uint64), np.arange(1, symbols + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        power = _powers(length + 1)
        before = np.concatenate([np.zeros((n, 1), np.uint64), np.cumsum(c * power[:length], axis=1)], axis=1)
        total = before[:, -1:]
        deleted = before[:, :-1] + np.uint64(INVERSE) * (total - before[:, 1:])
        replaced = total[:, :, None] + (every[None, None, :] - c[:, :, None]) * power[None, :length, None]
        inserted = (before + np.uint64(BASE) * (total - before))[:, :, None] + every[None, None, :] * power[None, : length + 1, None]
    return np.concatenate([deleted, replaced.reshape(n, -1), inserted.reshape(n, -1)], axis=1).view(np.int64)


def _neighbourhoods(reduced: DataFrame, symbols: int) -> DataFrame:
    """``r, h``: for every hash of a reduced word the larger hashes in its neighbourhood, each once."""

    def run(batches):
        for b in batches:
            by_length: dict[int, list] = {}
            for r, words in zip(b["r"].to_pylist(), b["words"].to_pylist(), strict=True):
                if len(words) == 1:
                    by_length.setdefault(len(words[0]), []).append((r, words[0]))
                else:  # words of equal hash
                    made = [neighbours(np.frombuffer(w, np.uint8)[None, :], symbols).ravel() for w in words]
                    h = np.unique(np.concatenate(made))
                    h = h[h > r]
                    yield {"r": np.full(len(h), r), "h": h}
            for length, found in by_length.items():
                step = max(1, AT_ONCE // (length + symbols * (2 * length + 1)))
                for at in range(0, len(found), step):
                    part = found[at : at + step]
                    r = np.array([x[0] for x in part], dtype=np.int64)[:, None]
                    h = np.sort(neighbours(np.frombuffer(b"".join(x[1] for x in part), np.uint8).reshape(len(part), length), symbols), axis=1)
                    keep = h > r
                    keep[:, 1:] &= h[:, 1:] != h[:, :-1]
                    yield {"r": np.broadcast_to(r, h.shape)[keep], "h": h[keep]}

    return tables.map_batches(reduced, "r long, h long", run)


def near_words(words: DataFrame, symbols: int = SYMBOLS, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """``a, n_a, b, n_b``: every pair of words (``word, n``, each word once) that are one edit apart, once."""

    def reduce(batches):
        for b in batches:
            w = b["word"].to_pylist()
            reduced, r, mask = reduced_hashes(w, symbols)
            yield {"word": b["word"], "n": b["n"], "reduced": pa.array(reduced, pa.binary()), "r": r, "mask": mask}

    known = tables.staged(tables.map_batches(words, "word string, n long, reduced binary, r long, mask long", reduce), "spelling-words")
    # at most as many words as reduced words of one hash, hardly ever more than one
    behind = known.groupBy("r", "reduced").agg(F.lit(1)).groupBy("r").agg(F.collect_list("reduced").alias("words"))
    around = _neighbourhoods(behind, symbols)
    other = known.select(F.col("r").alias("h"), F.col("word").alias("b"), F.col("n").alias("n_b"), F.col("mask").alias("mask_b"))
    met = around.join(other, "h")
    same = other.select("h", F.col("h").alias("r"), "b", "n_b", "mask_b")
    met = tables.staged(met.select("h", "r", "b", "n_b", "mask_b").unionByName(same), "spelling-met")
    one = known.select("r", F.col("word").alias("a"), F.col("n").alias("n_a"), F.col("mask").alias("mask_a"))
    near = skew_join(one, met, ["r"], rows_per_task=rows_per_task).where(
        (F.bit_count(F.col("mask_a").bitwiseXOR(F.col("mask_b"))) <= 2)
        & (F.abs(F.length("a") - F.length("b")) <= 1)
        & ((F.col("r") != F.col("h")) | (F.col("a") < F.col("b")))
        & (F.levenshtein("a", "b", 1) == 1))
    return near.select("a", "n_a", "b", "n_b")


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root`` from ``word, form``: the end of each chain, by doubling."""
    now = tables.staged(forms.select("word", F.col("form").alias("root")), "spelling-forms")
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = tables.staged(skew_join(now, onward, ["root"], "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("on")), "spelling-roots")
        now = moved.select("word", "root")
        if moved.where("on").isEmpty():
            return now


def group(words: DataFrame, symbols: int = SYMBOLS, ratio: int = RATIO, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """A row per word of ``words`` (``word, n``): ``word, n, n_near, form, form_n, root``."""
    words = tables.staged(words.select("word", "n"), "spelling-vocabulary")
    pair = F.explode(F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("m")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_a").alias("m"))))
    near = near_words(words, symbols, rows_per_task).select(pair.alias("p")).select("p.*")
    most = near.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "near")).alias("top"))
    bound = -F.col("top.m") >= ratio * F.col("n")
    formed = tables.staged(words.join(most, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(bound, F.col("top.near")).alias("form"), F.when(bound, -F.col("top.m")).alias("form_n")), "spelling-near")
    roots = _roots(formed.where("form is not null").select("word", "form"))
    return formed.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
