"""License scans as an exact set-similarity join of text blocks with license templates.

A text is cut into blocks of ``2 * stride`` words that start every ``stride`` words, where
``stride`` is the word count of the longest template: every stretch as long as a template lies
whole inside a block. A block meets a template if it contains at least ``threshold`` of the
template's distinct words. The join finds every such block:

* words outside all templates cannot add to an overlap and are left out of a block;
* length filter: a block needs as many words as the smallest overlap asked for;
* words are ordered by how many blocks of the whole table hold them, rarest first; a block and a
  template that share ``o`` words share one within their first ``size - o + 1``: equality join on
  the prefixes;
* positional filter: what can still follow the shared word must reach the overlap;
* what remains is verified by the exact overlap.

Everything is DataFrame operations. Templates and their words are parameters, so what is
broadcast is bounded by them, not by the data.

Defined cases: null text is empty: no words, no labels, score 0; texts shorter than a template may
still hold ``threshold`` of it; repeated rows each get their row; extra columns are ignored.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrahaz.llm import tables

#: Fixed phrases and their labels: found where their words stand consecutively.
PHRASES = [
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
]
#: Opening sentences of licenses and the usual license lines, under the label they give.
TEMPLATES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files to deal in the software without restriction"),
    ("apache-2", "licensed under the apache license version 2 0 you may not use this file except in compliance with the license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"),
]
THRESHOLD = 0.85
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_OTHER = "".join(map(chr, [*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))


def words_of(text: Column) -> Column:
    """A-Z in lower case, then the runs of ASCII letters, digits and non-ASCII characters."""
    plain = F.translate(F.coalesce(text, F.lit("")), _UPPER + _OTHER, _UPPER.lower() + " " * len(_OTHER))
    return F.array_remove(F.split(plain, " "), "")


def places_of(words: Column, phrase: str) -> Column:
    """Places (from 0) where the phrase's words stand consecutively."""
    parts = phrase.split()
    none = F.array().cast("array<int>")

    def stands(i: Column) -> Column:
        hit = F.lit(True)
        for k, p in enumerate(parts):
            hit = hit & (F.get(words, i + k) == p)
        return hit

    rare = parts[-2] if len(parts) > 3 else parts[0]
    long_enough = (F.size(words) >= len(parts)) & F.array_contains(words, rare)
    return F.when(long_enough, F.filter(F.sequence(F.lit(0), F.size(words) - len(parts)), stands)).otherwise(none)


def license_join(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases=PHRASES, templates=TEMPLATES,
                 threshold: float = THRESHOLD) -> DataFrame:
    """A row per text: id, ``n_words``, ``n_base``, ``first_word``, ``last_word``, ``base_labels``,
    ``labels`` (both sorted arrays), ``score`` and ``blocks``, the (first word, label, overlap
    share) of every block that meets a template."""
    shapes = []
    for number, (label, text) in enumerate(templates):
        distinct = sorted(set(text.split()))
        shapes.append((number, label, distinct, len(text.split()), ceil(threshold * len(distinct) - 1e-9)))
    vocabulary = sorted({w for s in shapes for w in s[2]})
    stride, least = max(s[3] for s in shapes), min(s[4] for s in shapes)

    words = F.col("words")
    known = F.array(*map(F.lit, vocabulary))
    starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.size(words) / stride).cast("int") - 1))
    blocks = F.filter(
        F.transform(starts, lambda k: F.struct(
            (k * stride).alias("start"), F.array_intersect(F.slice(words, k * stride + 1, F.lit(2 * stride)), known).alias("held"))),
        lambda b: F.size(b["held"]) >= least)
    found = [(label, places_of(words, phrase)) for phrase, label in phrases]
    places = F.concat(*[p for _, p in found])
    base = F.array_sort(F.array_distinct(F.filter(
        F.array(*[F.when(F.size(p) > 0, label) for label, p in found]), lambda x: x.isNotNull())))
    rows = df.select(F.col(id_col).alias("id"), words_of(F.col(text_col)).alias("words")).select(
        F.monotonically_increasing_id().alias("row"), "id", F.size(words).cast("long").alias("n_words"),
        places.alias("places"), base.alias("base_labels"), blocks.alias("blocks"))
    # staged without the texts, which are read and cut once
    rows = tables.staged(rows, "license-blocks")

    block = rows.select("row", F.explode("blocks").alias("b")).select("row", "b.start", "b.held")
    counted = dict(block.select(F.explode("held").alias("w")).groupBy("w").count().collect())  # at most the templates' words
    order = sorted(vocabulary, key=lambda w: (counted.get(w, 0), w))
    rank = {w: i for i, w in enumerate(order)}
    ranks = F.create_map(*[x for w, i in rank.items() for x in (F.lit(w), F.lit(i))])
    block = block.select("row", "start", F.array_sort(F.transform("held", lambda w: ranks[w])).alias("held"), F.size("held").alias("size"))
    prefix = block.select("row", "start", "held", "size", F.posexplode(
        F.slice("held", 1, F.col("size") - (least - 1))).alias("at", "word"))
    entries = [
        (word, at, number, label, held, len(held), need)
        for number, label, distinct, _, need in shapes
        for held in [sorted(rank[w] for w in distinct)]
        for at, word in enumerate(held[: len(held) - need + 1])
    ]
    template = df.sparkSession.createDataFrame(
        entries, "word int, t_at int, template int, label string, t_held array<int>, t_size int, need int")
    met = (
        prefix.join(F.broadcast(template), "word")  # as many rows as the templates have prefix words
        .where((F.col("size") >= F.col("need")) & (F.col("at") <= F.col("size") - F.col("need")))
        .where(F.least(F.col("t_size") - F.col("t_at"), F.col("size") - F.col("at")) >= F.col("need"))
        .withColumn("overlap", F.size(F.array_intersect("held", "t_held")))
        .where(F.col("overlap") >= F.col("need"))
        .groupBy("row", "start", "template").agg(
            F.first("label").alias("label"), F.max(F.col("overlap") / F.col("t_size")).alias("share"))
        .groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "label", "share"))).alias("met"))
    )
    method = F.coalesce(F.col("met"), F.array().cast("array<struct<start:int,label:string,share:double>>"))
    return (
        rows.drop("blocks").join(met, "row", "left")
        .select(
            F.col("id").alias(id_col), "n_words", F.size("places").cast("long").alias("n_base"),
            F.array_min("places").cast("long").alias("first_word"), F.array_max("places").cast("long").alias("last_word"),
            "base_labels", F.array_sort(F.array_union("base_labels", F.transform(method, lambda m: m["label"]))).alias("labels"),
            F.greatest(F.when(F.size("places") > 0, 1.0).otherwise(0.0),
                       F.coalesce(F.array_max(F.transform(method, lambda m: m["share"])), F.lit(0.0))).alias("score"),
            method.alias("blocks"))
    )
