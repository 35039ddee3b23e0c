"""One query per operator over the driver tables, with production parameters."""

from __future__ import annotations

from functools import partial

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrahaz.llm import (
    bpe_monoid, chat_tree, compression_bands, license_join, ordinal_quality, permutation_index, pii_bootstrap, prefix_trie,
    retrieval_pack, simhash_variants, spelling_groups, tables, warc_members, window_join,
)
from terrahaz.llm.tables import table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PATTERN = public_tokenizers.PATTERN
#: Ids of the tokenizer file; one more than its largest.
VOCABULARY = 50_257
#: Grades made from the labels: junk, fit but toxic, fit.
GRADES, FIT = 3, 2


def query(name: str, oracle: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle.strip()
        return fn

    return register


@query("op1_compression_bands")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression_bands.compression_bands(table(spark, sf_dir, "documents"))


def _span_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


@query("op2_pii_bootstrap")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii_bootstrap.extract(table(spark, sf_dir, "documents"))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [(F.size("base") - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in pii_bootstrap.KINDS]
    return found.select("doc_id", *counts, F.sha2(_span_text(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                        _span_text(F.col("spans")).alias("spans"))


OP3_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), e AS (
  SELECT *, replace(replace(replace(replace(replace(text, '\', '\\'), '<s>', '\3cs>'), '</s>', '\3c/s>'),
                    '[INST]', '\5bINST]'), '[/INST]', '\5b/INST]') AS body,
    replace(replace(replace(replace(replace(replace(role, '\', '\\'), '<s>', '\3cs>'), '</s>', '\3c/s>'),
                    '[INST]', '\5bINST]'), '[/INST]', '\5b/INST]'), ']', '\5d') AS head
  FROM t
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
  CAST(sum(length(head) + length(body) + 10) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""


def _encode_with(ranks: str, pattern: str):
    return bpe_monoid.codec(ranks, pattern).encode_ordinary


def _decode_with(ranks: str, pattern: str):
    return bpe_monoid.codec(ranks, pattern).decode


@query("op3_chat_prefix_tree", OP3_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    forest = chat_tree.build(turns.unionByName(more), partial(_encode_with, RANKS, PATTERN))
    return chat_tree.read_back(forest, partial(_decode_with, RANKS, PATTERN)).withColumnRenamed("conv", "conv_id")


def _license_sql() -> str:
    """The definition itself: every block against every template, by the overlap of word sets."""
    stride = max(len(t.split()) for _, t in license_join.TEMPLATES)
    upper, other = license_join._UPPER, license_join._OTHER
    points = " || ".join(f"chr({ord(c)})" for c in other if ord(c))
    templates = ", ".join(
        f"({i}, '{label}', [{', '.join(repr(w) for w in sorted(set(t.split())))}], "
        f"{-(-len(set(t.split())) * round(license_join.THRESHOLD * 100) // 100)})"
        for i, (label, t) in enumerate(license_join.TEMPLATES))
    phrases = ", ".join(f"('{label}', [{', '.join(repr(w) for w in p.split())}])" for p, label in license_join.PHRASES)
    return f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id,
    list_filter(string_split(translate(replace(coalesce(text, ''), chr(0), ' '), '{upper}' || {points},
      '{upper.lower()}{" " * (len(other) - 1)}'), ' '), lambda x: x <> '') AS w
  FROM documents
), phrases(label, p) AS (VALUES {phrases}),
templates(number, label, t, need) AS (VALUES {templates}),
places AS (
  SELECT r, label, unnest(list_filter(range(0, len(w) - len(p) + 1), lambda i: w[i + 1 : i + len(p)] = p)) AS place
  FROM docs, phrases WHERE list_has_all(w, p)
), base AS (
  SELECT r, count(*) AS n, min(place) AS lo, max(place) AS hi, list(DISTINCT label) AS ls FROM places GROUP BY r
), blocks AS (
  SELECT r, list_distinct(w[k * {stride} + 1 : (k + 2) * {stride}]) AS b
  FROM (SELECT r, w, unnest(range(0, CAST(ceil(len(w) / {stride}) AS BIGINT))) AS k FROM docs)
), met AS (
  SELECT r, label, len(list_intersect(b, t)) AS o, need, len(t) AS s FROM blocks, templates
), method AS (
  SELECT r, list(DISTINCT label) AS ls, max(o / s) AS score FROM met WHERE o >= need GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_base, lo AS first_word, hi AS last_word,
  coalesce(list_aggregate(list_sort(base.ls), 'string_agg', ','), '') AS base_labels,
  coalesce(list_aggregate(list_sort(list_distinct(list_concat(coalesce(base.ls, []), coalesce(method.ls, [])))), 'string_agg', ','), '') AS labels,
  greatest(CASE WHEN n > 0 THEN 1.0::DOUBLE ELSE 0 END, coalesce(method.score, 0)) AS score
FROM docs LEFT JOIN base USING (r) LEFT JOIN method USING (r)
"""


@query("op4_license_join", _license_sql())
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_join.license_join(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word",
                        F.array_join("base_labels", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"), "score")


@query("op5_simhash_variants")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_variants.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def packed(docs: DataFrame) -> DataFrame:
    return retrieval_pack.pack(docs, partial(retrieval_pack.encoder_of, TOKENIZER, RANKS, PATTERN), VOCABULARY)


def piece_digests(pieces: DataFrame) -> DataFrame:
    return pieces.select(
        "doc_id", "start", F.expr("cast(octet_length(ids) div 4 as bigint)").alias("length"), F.crc32("ids").alias("ids_crc32"),
        "doc_tokens", "sequence_id", "offset")


@query("op6_retrieval_pack")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_digests(packed(table(spark, sf_dir, "documents")))


@query("op7_permutation_index")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permutation_index.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


@query("op8_bpe_monoid")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = bpe_monoid.encode(table(spark, sf_dir, "documents"), RANKS, PATTERN)
    return bpe_monoid.decode(ids, RANKS, PATTERN).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def graded(labels: DataFrame) -> DataFrame:
    """Ratings from the labels: 0 junk, 1 fit but toxic, 2 fit. A null toxic label counts as 0."""
    fit, toxic = F.col("quality") == 1, F.coalesce(F.col("toxic"), F.lit(0)) == 1
    return labels.select("doc_id", F.when(fit & ~toxic, 2).when(fit, 1).when(F.col("quality") == 0, 0).alias("grade"))


def classifier(spark: SparkSession, sf_dir: str) -> ordinal_quality.Model | None:
    sample = ordinal_quality.rated_sample(graded(table(spark, sf_dir, "labels")), table(spark, sf_dir, "documents"))
    return ordinal_quality.fit(sample, GRADES)


@query("op9_ordinal_quality")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordinal_quality.score(table(spark, sf_dir, "documents"), classifier(spark, sf_dir), FIT)


OP10_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes FROM pages
), m AS (
  SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY html) END AS top FROM p
)
SELECT page_id, payload_bytes, sha1(html) AS payload_digest,
  CASE WHEN page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id < top THEN top END AS refers_to
FROM m
"""


@query("op10_warc_members", OP10_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from terrahaz.session import scratch

    folder = scratch(spark, "warc-monolithic")
    warc_members.write_monolithic(warc_members.records(table(spark, sf_dir, "pages")), folder)
    found = warc_members.read_records(warc_members.normalise(spark, folder))

    def page(c: str) -> Column:
        return F.expr(f"try_cast(regexp_extract({c}, '<urn:page:(-?[0-9]+)>', 1) as bigint)")

    return found.select(page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page("refers_to").alias("refers_to"))



#: CRC-32 of the UTF-8 bytes of ``{key}``, bit by bit from the least.
_CRC_SQL = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
  list_transform(range(0, 4 * len(hex(encode({key})))),
    lambda k: (CAST('0x' || substr(hex(encode({key})), 2 * (k // 8) + 1, 2) AS BIGINT) >> CAST(k % 8 AS BIGINT)) & 1)),
  lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1))))"""

OP11_SQL = r"""
WITH c AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base, {crc} % 4 AS h FROM (SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR) AS key FROM conversations)
), t AS (
  SELECT conv_id, md5(strlen(role) || ':' || role || text) AS digest, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(strlen(role) || ':' || role || text)) AS d
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations)
), r AS (
  SELECT c.conv_id, 0 AS part, d, digest, words FROM c JOIN t ON t.conv_id = c.base WHERE d <= h
  UNION ALL SELECT c.conv_id, 1, d, digest, words FROM c JOIN t ON t.conv_id = c.conv_id WHERE d > h
), p AS (
  SELECT conv_id, words, row_number() OVER w AS depth, string_agg(digest, '') OVER w AS key
  FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY part, d ROWS UNBOUNDED PRECEDING)
  UNION ALL SELECT conv_id, 0, 0, '' FROM c
), nodes AS (
  SELECT key, depth, min(conv_id) AS conv_id, count(*) AS n, (count(*) - 1) * any_value(words) AS saved FROM p GROUP BY key, depth
), kids AS (
  SELECT left(key, len(key) - 32) AS key, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1
), below AS (
  SELECT p.key, count(*) FILTER (k.n IS NULL) AS leaves, sum(x.saved) AS saved
  FROM nodes x LEFT JOIN kids k USING (key) JOIN p ON p.conv_id = x.conv_id AND p.depth <= x.depth GROUP BY p.key
), ends AS (
  SELECT key, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids
  FROM (SELECT conv_id, arg_max(key, depth) AS key FROM p GROUP BY conv_id) GROUP BY key
)
SELECT x.conv_id, x.depth, up.conv_id AS parent_conv_id, x.n AS n_convs, coalesce(kids.n, 0) AS n_children, below.leaves AS n_leaves,
  CAST(below.saved AS BIGINT) AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM nodes x JOIN below ON below.key = x.key LEFT JOIN kids ON kids.key = x.key LEFT JOIN ends ON ends.key = x.key
LEFT JOIN nodes up ON x.depth > 0 AND up.key = left(x.key, len(x.key) - 32)
""".replace("{crc}", _CRC_SQL.format(key="key"))


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns of the rebuilt conversations and all conversation ids: the first h turns of conversation
    c - c % 20, then c's own turns after its first h, h being crc32(c) % 4."""
    own = tables.staged(prefix_trie.along(prefix_trie.turns_of(conversations)), "rebuilt-turns")
    convs = own.select("conv").distinct()
    h = F.coalesce(F.crc32(F.col("conv").cast("string").cast("binary")) % 4, F.lit(0))
    heads = own.where("depth <= 3 and conv % 20 = 0").select(F.col("conv").alias("base"), F.col("depth").alias("turn"), "digest", "words")
    begun = convs.withColumns({"h": h, "base": F.col("conv") - F.col("conv") % 20}).where("h > 0").join(heads, "base").where("turn <= h")
    turns = begun.select("conv", "turn", "digest", "words").unionByName(
        own.where(F.col("depth") > h).select("conv", F.col("depth").alias("turn"), "digest", "words"))
    return turns, convs


@query("op11_prefix_peeling", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    trie = prefix_trie.build(*rebuilt(table(spark, sf_dir, "conversations")))
    return trie.nodes.join(prefix_trie.member_digests(trie.ends), "key", "left").select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent_conv").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))


OP12_SQL = r"""
WITH RECURSIVE runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS d, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run
  FROM documents
), keyed AS (
  SELECT d || ':' || run AS key, run, count(*) AS n FROM runs WHERE length(run) >= 7 GROUP BY ALL
), hashed AS (
  SELECT run, n, {crc} AS h FROM keyed
), v AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT CASE WHEN h % 31 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
), cut AS (
  SELECT word, unnest(range(0, length(word))) AS i FROM v
), pairs AS (
  SELECT DISTINCT a.word AS a, b.word AS b FROM cut a JOIN cut b
    ON left(a.word, a.i) || chr(1) || substr(a.word, a.i + 2) = left(b.word, b.i) || chr(1) || substr(b.word, b.i + 2)
    AND a.word <> b.word
  UNION SELECT a.word, v.word FROM cut a JOIN v ON left(a.word, a.i) || substr(a.word, a.i + 2) = v.word
  UNION SELECT v.word, a.word FROM cut a JOIN v ON left(a.word, a.i) || substr(a.word, a.i + 2) = v.word
), near AS (
  SELECT v.word, v.n, count(o.word) AS n_near, arg_min(o.word, (-o.n, o.word)) AS top, max(o.n) AS top_n
  FROM v LEFT JOIN pairs p ON p.a = v.word LEFT JOIN v o ON o.word = p.b GROUP BY ALL
), formed AS (
  SELECT word, n, n_near, CASE WHEN top_n >= 10 * n THEN top END AS form, CASE WHEN top_n >= 10 * n THEN top_n END AS form_n FROM near
), chain(word, top, step) AS (
  SELECT word, word, 0 FROM formed
  UNION ALL SELECT c.word, f.form, step + 1 FROM chain c JOIN formed f ON f.word = c.top WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, r.root, f.n, f.n_near, f.form_n
FROM formed f JOIN (SELECT word, arg_max(top, step) AS root FROM chain GROUP BY word) r USING (word)
""".replace("{crc}", _CRC_SQL.format(key="key"))


@query("op12_spelling_groups", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling_groups.vocabulary(table(spark, sf_dir, "documents"), change=spelling_groups.dropped_letter)
    return spelling_groups.group(words).select("word", "form", "root", "n", "n_near", "form_n")


OP13_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), i AS (
  SELECT item_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, array_to_string(w[k + 1 : k + 10], ' ') AS win, least(10, len(w)) AS size
  FROM (SELECT item_id, w, unnest(range(0, greatest(1, len(w) - 9))) AS k FROM i WHERE len(w) > 0)
), stretches AS (
  SELECT r, k, size, array_to_string(w[k + 1 : k + size], ' ') AS win
  FROM (SELECT r, w, size, unnest(range(0, greatest(0, len(w) - size + 1))) AS k
        FROM d, (SELECT DISTINCT size FROM windows))
), met AS (
  SELECT DISTINCT r, k, size, item_id FROM stretches JOIN windows USING (win, size)
), hit AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(k, k + size)) AS p FROM met) GROUP BY r
), named AS (
  SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM met WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(named.n, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN named USING (r)
"""


@query("op13_decontaminate", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = window_join.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))
