"""Benchmark decontamination as a prefix-filtered set join of word shingles.

An item is cut into windows of ``window`` consecutive words (an item of fewer words is one window)
and a window is the set of its ``shingle``-word shingles with their places. A document stretch as
long as a window meets it if it holds at least ``containment`` hundredths of the shingles, each
in its place; at 100 that is the window word for word. The join finds every such stretch:

* shingles are put in one order, rarest first, by how often the whole corpus holds them (counted,
  not sampled);
* of ``m`` shingles, ``need`` must be met, so a stretch and a window that meet share one of the
  window's first ``m - need + 1`` in that order: equality join on these prefix shingles;
* the place of the shared shingle in the window fixes where the stretch starts (positional bound),
  and the stretch must end inside the document (length bound);
* what remains is verified on the words themselves.

Documents are cut into blocks of ``block`` words that overlap by ``window - 1``, so a block holds every
stretch that starts in it and no row of the join grows with a document. The text is cut into words
once: a block keeps its words only if some of its shingles occur in the items. Up to ``listed`` item
shingles are looked up while a block is read; beyond that they are joined (same result).

Everything is DataFrame operations. One document's words must fit in a row, as must the places at
which one document meets items.

Defined cases: a null text has no words; a null item text has no windows; items without words are
never met; equal items share their windows; a null item id is not listed, its windows still hit;
repeated documents each get their row; other columns are ignored, whatever their names; no items
or no documents give zeros and no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrahaz.llm import tables
from terrahaz.llm.license_join import words_of
from terrahaz.operators.sizing import join_dim, skew_join

WINDOW = 10
SHINGLE = 5
#: Hundredths of a window's shingles that a stretch must hold.
CONTAINMENT = 100
#: Words of a block, and item shingles that are looked up without a join.
BLOCK = 4096
LISTED = 100_000


def _hash_at(hashes: str, place: str, length: int) -> str:
    return f"xxhash64({', '.join(f'get({hashes}, {place} + {j})' for j in range(length))})"


def _places(hashes: str, length: int) -> str:
    """All places of a shingle of ``length`` words."""
    return f"if(size({hashes}) >= {length}, sequence(0, size({hashes}) - {length}), array())"


def _word_hashes(words: str) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def windows_of(items: DataFrame, item_col: str, text_col: str, window: int) -> DataFrame:
    """``wid, item, win``: every different window of every item. ``wid`` names the window's words."""
    words = F.col("words")
    start = F.sequence(F.lit(0), F.greatest(F.lit(0), F.size(words) - window))
    cut = items.select(F.col(item_col).alias("item"), words_of(F.col(text_col)).alias("words")).where(F.size("words") > 0)
    each = cut.select("item", F.explode(F.transform(start, lambda i: F.slice(words, i + 1, F.lit(window)))).alias("win"))
    return each.select(F.unhex(F.md5(F.array_join("win", " "))).alias("wid"), "item", "win").distinct()


def _shingles(windows: DataFrame, shingle: int, window: int) -> DataFrame:
    """``wid, win, m, o, sh, length``: the shingles of each window and their places."""
    out = None
    for length in range(1, min(shingle, window) + 1):
        fits = F.size("win") == length if length < min(shingle, window) else F.size("win") >= length
        made = windows.where(fits).withColumn("h", _word_hashes("win")).select(
            "wid", "win", (F.size("win") - length + 1).alias("m"), F.lit(length).alias("length"),
            F.explode(F.expr(f"transform({_places('h', length)}, o -> struct(o as o, {_hash_at('h', 'o', length)} as sh))")).alias("s"))
        made = made.select("wid", "win", "m", "length", "s.o", "s.sh")
        out = made if out is None else out.unionByName(made)
    return out


def _blocks(docs: DataFrame, id_col: str, text_col: str, window: int, block: int) -> DataFrame:
    """``row, id, n_words, at, words, h``: at least one block a document."""
    base = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), words_of(F.col(text_col)).alias("words"))
    words = F.col("words")
    starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.size(words) / block).cast("int") - 1))
    cut = F.transform(starts, lambda b: F.struct((b * block).alias("at"), F.slice(words, b * block + 1, F.lit(block + window - 1)).alias("words")))
    each = base.select("row", "id", F.size(words).cast("long").alias("n_words"), F.explode(cut).alias("b"))
    return each.select("row", "id", "n_words", "b.at", "b.words").withColumn("h", _word_hashes("words"))


def _looked_up(blocks: DataFrame, known: dict[int, list[int]]) -> DataFrame:
    """Blocks with ``found``: the places and hashes of their shingles that are in ``known``."""
    parts = ["array()"]
    for length, hashes in sorted(known.items()):
        among = ", ".join(f"{x}L" for x in hashes)
        parts.append(f"transform(filter({_places('h', length)}, i -> {_hash_at('h', 'i', length)} in ({among})), "
                     f"i -> struct(i as pos, {_hash_at('h', 'i', length)} as sh))")
    found = F.expr(f"concat({', '.join(parts)})").cast("array<struct<pos:int,sh:bigint>>")
    return blocks.withColumn("found", found)


def _joined(blocks: DataFrame, shingles: DataFrame, lengths: list[int]) -> DataFrame:
    """The same by a join on every shingle of the blocks."""
    laid = tables.staged(blocks, "leak-words")
    every = None
    for length in lengths:
        each = laid.select("row", "at", F.explode(F.expr(
            f"transform({_places('h', length)}, i -> struct(i as pos, {_hash_at('h', 'i', length)} as sh))")).alias("s"))
        each = each.select("row", "at", "s.pos", "s.sh", F.lit(length).alias("length"))
        every = each if every is None else every.unionByName(each)
    met = skew_join(every, shingles.select("length", "sh").distinct(), ["length", "sh"], "left_semi")
    found = met.groupBy("row", "at").agg(F.collect_list(F.struct("pos", "sh")).alias("found"))
    none = F.array().cast("array<struct<pos:int,sh:bigint>>")
    return laid.join(found, ["row", "at"], "left").withColumn("found", F.coalesce("found", none))


def _verified(cand: DataFrame, blocks: DataFrame, shingle: int, containment: int) -> DataFrame:
    """``row, start, length, wid``: the candidates that the words bear out."""
    per_block = cand.groupBy("row", "at").agg(F.collect_set(F.struct("start", "wid", "win")).alias("cand"))
    both = blocks.where(F.size("found") > 0).select("row", "at", "words").join(per_block, ["row", "at"])

    def stands(c: Column) -> Column:
        size = F.size(c["win"])
        if containment == 100:
            return F.slice("words", c["start"] + 1, size) == c["win"]
        length = F.least(F.lit(shingle), size)
        held = F.filter(F.sequence(F.lit(0), size - length), lambda o: F.slice("words", c["start"] + o + 1, length) == F.slice(c["win"], o + 1, length))
        return F.size(held) >= F.ceil((size - length + 1) * F.lit(containment) / 100)

    kept = both.select("row", "at", F.explode(F.filter("cand", stands)).alias("c"))
    return kept.select("row", (F.col("at") + F.col("c.start")).cast("long").alias("start"), F.size("c.win").alias("length"), "c.wid")


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", window: int = WINDOW, shingle: int = SHINGLE, containment: int = CONTAINMENT,
                  block: int = BLOCK, listed: int = LISTED) -> DataFrame:
    """A row per document: id, ``n_words``, ``places`` (start and length in words of every stretch that
    meets a window, ascending), ``n_hit`` (words inside them) and ``items`` (ids met, as sorted strings)."""
    shingle = min(shingle, window)
    by_item = tables.staged(windows_of(items, item_col, item_text_col, window), "leak-windows")
    windows = by_item.groupBy("wid").agg(F.first("win").alias("win"))
    shingles = tables.staged(_shingles(windows, shingle, window), "leak-shingles")
    names = shingles.select("length", "sh").distinct()
    some = names.limit(listed + 1).collect()  # at most that many numbers reach the driver
    blocks = _blocks(docs, id_col, text_col, window, block)
    known: dict[int, list[int]] = {}
    for r in sorted(some):
        known.setdefault(r["length"], []).append(r["sh"])
    found = _looked_up(blocks, known) if len(some) <= listed else _joined(blocks, shingles, sorted(range(1, shingle + 1)))
    blocks = tables.staged(found.drop("h").withColumn("words", F.when(F.size("found") > 0, F.col("words"))), "leak-blocks")

    # rarest first; a window with too few of its shingles anywhere has its prefix among absent ones
    seen = blocks.select("row", "at", "n_words", F.explode("found").alias("f")).select("row", "at", "n_words", "f.pos", "f.sh")
    counts = seen.where(F.col("pos") < block).groupBy("sh").agg(F.count("*").alias("n"))
    ranked = shingles.join(counts, "sh", "left").withColumn("place", F.row_number().over(
        Window.partitionBy("wid").orderBy(F.coalesce("n", F.lit(0)), "sh", "o")))
    need = F.ceil(F.col("m") * F.lit(containment) / 100)
    prefix = tables.staged(ranked.where((F.col("place") <= F.col("m") - need + 1) & F.col("n").isNotNull()).select(
        "sh", "o", "wid", "win"), "leak-prefixes")
    start = F.col("pos") - F.col("o")
    cand = join_dim(seen, prefix, ["sh"]).where(
        (start >= 0) & (start < block) & (F.col("at") + start + F.size("win") <= F.col("n_words"))
    ).select("row", "at", start.alias("start"), "wid", "win")
    met = tables.staged(_verified(cand, blocks, shingle, containment), "leak-places")

    places = met.groupBy("row").agg(F.array_sort(F.collect_set(F.struct("start", "length"))).alias("places"))
    named = skew_join(met.select("row", "wid").distinct(), by_item.select("wid", "item"), ["wid"]).where("item is not null")
    listed_items = named.select("row", F.col("item").cast("string").alias("item")).distinct().groupBy("row").agg(
        F.array_sort(F.collect_list("item")).alias("items"))
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))

    def cover(acc: Column, x: Column) -> Column:
        end = x["start"] + x["length"]
        return F.struct((acc["n"] + F.greatest(F.lit(0).cast("long"), end - F.greatest(x["start"], acc["end"]))).alias("n"),
                        F.greatest(acc["end"], end).alias("end"))

    whole = blocks.where("at = 0").select("row", "id", "n_words")
    return whole.join(places, "row", "left").join(listed_items, "row", "left").select(
        F.col("id").alias(id_col), "n_words", F.coalesce("places", F.array().cast("array<struct<start:bigint,length:int>>")).alias("places"),
        F.coalesce(F.aggregate("places", zero, cover)["n"], F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"))
