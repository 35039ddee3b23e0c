"""Quality rules from compression: zstandard ratios of whole texts and of fixed chunks.

A ratio is raw bytes over compressed bytes. Text that repeats itself compresses too well, noise
too badly, and what is normal depends on the length, so every length band has its own limits.
The whole text is held against the band of its length and each chunk of ``chunk_bytes`` bytes
against the band of the chunk's length (a last chunk under ``min_chunk`` bytes is judged with the
whole text only).

Defined cases: a null text counts as empty; an empty text has no words, fails the base rule and
has null ratios; repeated rows each get their row; columns other than the two named are ignored.
"""

from __future__ import annotations

import numpy as np
import zstandard
from pyspark.sql import DataFrame

from terrahaz.llm import tables

#: From so many bytes on: smallest and largest ratio that pass. Below the first band nothing is
#: judged: there the frame header outweighs the text.
BANDS = [
    (96, 0.6, 2.0), (256, 0.8, 2.2), (512, 1.0, 2.4), (1024, 1.15, 2.5), (2048, 1.2, 2.6),
    (4096, 1.25, 2.7), (16384, 1.3, 3.0), (131072, 1.3, 3.5),
]
CHUNK_BYTES = 4096
#: A last chunk is judged from the first band on, as a text of that length alone is.
MIN_CHUNK = BANDS[0][0]
LEVEL = 3
BLANK = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"


def repeated_words(words: list[bytes], width: int = 5) -> int:
    """Words standing in a window of ``width`` words that occurs twice or more, counted once."""
    n = len(words)
    if n <= width:
        return 0
    codes: dict[bytes, int] = {}
    ids = np.fromiter((codes.setdefault(w, len(codes)) for w in words), dtype=np.int64, count=n)
    # exact names for windows of 2, 4 and then width words, by pairing names of shorter ones
    names, span = ids, 1
    while span < width:
        step = min(span, width - span)
        left, right = names[: len(names) - step], names[step:]
        names = np.unique(left * (int(right.max()) + 1) + right, return_inverse=True)[1]
        span += step
    twice = np.bincount(names)[names] > 1
    if not twice.any():
        return 0
    edge = np.zeros(n + 1, dtype=np.int64)
    at = np.flatnonzero(twice)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + width, -1)
    return int((np.cumsum(edge[:n]) > 0).sum())


def base_counts(body: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of one text."""
    words = body.split()  # bytes split at exactly the six ASCII blanks
    points = len(body.decode("utf-8", "replace"))
    blanks = sum(body.count(bytes([c])) for c in BLANK)
    seen, dup = set(), 0
    for line in body.split(b"\n"):
        if line.strip(BLANK):
            dup += line in seen
            seen.add(line)
    symbols = sum(body.count(bytes([c])) for c in SYMBOLS)
    return len(words), points - blanks, symbols, dup, repeated_words(words)


def limits(n: int, bands=BANDS) -> tuple[float, float]:
    low, high = 0.0, float("inf")
    for start, lo, hi in bands:
        if n >= start:
            low, high = lo, hi
    return low, high


def verdict(body: bytes, compressor, bands=BANDS, chunk_bytes: int = CHUNK_BYTES, min_chunk: int = MIN_CHUNK):
    """(whole ratio, smallest and largest chunk ratio, 'ok' | 'repetitive' | 'incompressible')"""
    if not body:
        return None, None, None, "ok"

    def judge(part: bytes):
        ratio = len(part) / len(compressor.compress(part))
        low, high = limits(len(part), bands)
        return ratio, "repetitive" if ratio > high else "incompressible" if ratio < low else "ok"

    whole, found = judge(body)
    ratios = []
    if len(body) > chunk_bytes:
        for i in range(0, len(body), chunk_bytes):
            part = body[i : i + chunk_bytes]
            if len(part) >= min_chunk:
                ratio, says = judge(part)
                ratios.append(ratio)
                found = says if found == "ok" else found
    else:
        ratios.append(whole)
    return whole, min(ratios), max(ratios), found


COLUMNS = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
           "kept boolean, ratio double, chunk_min double, chunk_max double, verdict string")


def judge(bands=BANDS, chunk_bytes: int = CHUNK_BYTES, min_chunk: int = MIN_CHUNK, level: int = LEVEL):
    """A function from a text to the values of ``COLUMNS``, for use in tasks."""
    held: list = []  # the compressor is made in the worker, once

    def one(body: bytes) -> tuple:
        if not held:
            held.append(zstandard.ZstdCompressor(level=level))
        counts = base_counts(body)
        failed = counts[0] < 10 or 100 * counts[4] > 20 * counts[0]
        whole, low, high, says = verdict(body, held[0], bands, chunk_bytes, min_chunk)
        return *counts, failed, not failed and says == "ok", whole, low, high, says

    return one


def compression_bands(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits_) -> DataFrame:
    """A row per text: id, the base counts, ``base_failed``, ``kept``, ratios and ``verdict``.
    Further arguments are those of ``judge``."""
    return tables.per_text(df, id_col, text_col, COLUMNS, judge(**limits_))
