"""Every corpus operator against its plain version, and its defined cases."""

import base64
import collections
import random
import tracemalloc
from functools import partial

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import brute
from terrahaz.llm import (
    bpe_monoid, chat_tree, components, compression_bands, license_join, near_copies, ordinal_quality, permutation_index,
    pii_bootstrap, queries, retrieval_pack, simhash_variants, tables, warc_members,
)

LONG = "word " * 3000 + "ünï " * 2000 + "x" * 20000
ODD = [
    (1, "The quick brown fox jumps over the lazy dog again and again today."), (2, None), (3, ""), (4, " \n\t\x0b\x1c"),
    (5, "same text here"), (5, "same text here"), (None, "same text here"), (7, LONG), (8, "a b  c\n d  e"),
    (9, "mail a.b@x-y.org, 1.2.3.4 and 300.1.1.1, +1 (555) 010-9999, 4111 1111 1111 1111"),
    (10, "released UNDER the-MIT license; Apache License, Version 2.0 and CC BY-NC 4"),
]
RANKS, TOKENIZER, PATTERN = queries.RANKS, queries.TOKENIZER, queries.PATTERN


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty, long and repeated texts, with columns called as operators call theirs."""
    df = spark.createDataFrame(ODD, "doc_id long, text string")
    return df.withColumns({c: F.lit(c) for c in ("id", "kept", "row", "body", "ids", "label", "words", "judged", "spans")})


@pytest.fixture(scope="module")
def docs(spark, sf):
    return {r["doc_id"]: r["text"] for r in tables.table(spark, sf, "documents").collect()}


@pytest.fixture(scope="module")
def encoding():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def plain(df):
    return [r.asDict() for r in df.collect()]


# compression bands


def test_compression_counts(spark, sf, docs, odd):
    for r in plain(queries.QUERIES["op1_compression_bands"](spark, sf)):
        assert brute.quality_base(docs[r["doc_id"]]) == tuple(r[c] for c in (
            "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"))
    got = plain(compression_bands.compression_bands(odd))
    assert sorted((str(r["doc_id"]), r["n_words"], r["n_repeat_words"]) for r in got) == sorted(
        (str(i), *[brute.quality_base(t)[k] for k in (0, 4)]) for i, t in ODD)
    assert compression_bands.compression_bands(odd.limit(0)).count() == 0


def test_compression_verdicts():
    judge = compression_bands.judge()
    rng = np.random.default_rng(1)
    words = ["".join(rng.choice(list("abcdefghij"), 6)) for _ in range(600)]
    assert judge(" ".join(words).encode())[6]
    assert judge(b" ".join(f"{i} but the rest is as it was".encode() for i in range(400)))[10] == "repetitive"
    assert judge(rng.bytes(6000))[10] == "incompressible"
    # a last chunk is judged like a text of its length
    prose = " ".join(words + words[::-1] + words)[: 4096 * 2].encode()
    assert judge(prose)[10] == "ok" and judge(prose + b" spam" * 60)[10] == "repetitive"
    # a repetitive stretch inside a long text is found by its chunk
    assert judge((" ".join(words) + " spam spam" * 900 + " " + " ".join(words[::-1])).encode())[6] is False


# personal data


def test_pii_base(spark, sf, docs, odd):
    for r in plain(queries.QUERIES["op2_pii_bootstrap"](spark, sf)):
        assert r["base_sha256"] == brute.sha(brute.span_text(brute.pii_base(docs[r["doc_id"]])))
    got = {str(r["doc_id"]): [tuple(s) for s in r["base"]] for r in plain(pii_bootstrap.extract(odd))}
    assert got == {str(i): brute.pii_base(t) for i, t in ODD}
    assert pii_bootstrap.extract(odd.limit(0)).count() == 0


@pytest.mark.parametrize("text", [
    "a@b.c@d.e", "x@y.z.@q.r", "1.2.3.4.5.6.7.8", "1..2.3.4", "0001.2.3.004", "12 34-56 7812 3456 78", "+1+2 3456789 0",
    "@a.b", "a@b", "a@b.c.", "4111-1111-1111-1111 4111", "+123.456(789)0", "a" * 3000 + "@", "1" * 3000, "a@b..c d@e.f-g", "٣+4 5678 9012",
])
def test_pii_base_corners(text):
    assert pii_bootstrap.base_spans(text) == brute.pii_base(text)


@pytest.mark.parametrize("lookup", [1 << 20, 0])
def test_pii_discovers_context(spark, lookup):
    rows = [(i, f"please write to: user{i}@example.org soon") for i in range(20)]
    rows += [(100 + i, f"please write to: ZK-{i}77-Q soon") for i in range(4)]
    rows += [(200 + i, f"one of the other{i} things and of the 5{i}5 rest, of the sea") for i in range(4)]
    got = {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in plain(
        pii_bootstrap.extract(spark.createDataFrame(rows, "doc_id long, text string"), lookup_bytes=lookup))}
    assert all(got[100 + i] == [("context", 17, 17 + len(f"ZK-{i}77-Q"))] for i in range(4))
    assert not any(got[200 + i] for i in range(4))


def test_pii_keys_teach_their_context(spark):
    """Hexadecimal keys are found by form; what else stands behind the same cue is found by the cue."""
    key = [f"{i}a{'%032x' % (i * 7919**9)}"[:40] for i in range(12)]
    rows = [(i, f'as {i % 3} said token = "{k}" and more') for i, k in enumerate(key)]
    rows += [(100, 'so token = "ZK-1177-Q" was'), (101, "f" * 40 + " and " + "1" * 40 + " are none"), (102, f"x{key[1]} nor {key[1]}_2"), (103, f"end {key[2]}.")]
    got = {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in plain(pii_bootstrap.extract(spark.createDataFrame(rows, "doc_id long, text string")))}
    text = dict(rows)
    assert all(got[i] == [("secret", text[i].index(k), text[i].index(k) + len(k))] for i, k in enumerate(key))
    assert got[100] == [("context", 12, 21)] and got[101] == [] and got[102] == []
    assert got[103] == [("secret", 4, 4 + len(key[2]))]


@pytest.mark.parametrize("lookup", [1 << 20, 0])
def test_pii_discovers_behind_signs_and_long(spark, lookup):
    """Quoted, bracketed and key=value identifiers, and ones of 65 and 5,000 characters."""
    cues = ['their user ("', "write to <", "see contact=", 'the key = "']
    rows = [(100 * c + i, f"{cue}user{i}@example.org> soon") for c, cue in enumerate(cues) for i in range(20)]
    names = ["ZK-1177-Q", "k7" * 32 + "z", "ab12-" * 1000 + "z", "ab12-" * 16 + "zz"]
    want = {}
    for c, cue in enumerate(cues):
        for k, n in enumerate(names):
            rows.append((100 * c + 50 + k, f'{cue}{n}" soon'))
            want[100 * c + 50 + k] = [("context", len(cue), len(cue) + len(n))]
    got = {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in plain(
        pii_bootstrap.extract(spark.createDataFrame(rows, "doc_id long, text string"), lookup_bytes=lookup))}
    assert {d: got[d] for d in want} == want


def test_redact():
    assert pii_bootstrap.redact("ab cd ef", [("ip", 3, 5)]) == "ab <IP> ef"
    assert pii_bootstrap.redact("abcdef", [("card", 0, 4), ("ip", 2, 5)]) == "<CARD>f"


# chat


def forest_of(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return chat_tree.build(df, partial(queries._encode_with, RANKS, PATTERN), 3)


def test_chat_tree(spark):
    a, b = ("user", "hi <s>[x] \\3c"), ("assistant", "</s> hello")
    talks = {1: [a, b, ("user", "more")], 2: [a, b, ("user", "else"), ("assistant", "")], 3: [a, b], 4: [("system", "s]y"), a],
             5: [a, b, ("user", "more")], 6: [a, ("assistant", "other"), ("user", "more")]}
    rows = [(c, i, r, t) for c, turns in talks.items() for i, (r, t) in enumerate(turns)]
    rows += [(7, 0, None, None), (7, 0, None, None), (None, None, "user", "x")]
    talks |= {7: [("", ""), ("", "")], None: [("user", "x")]}
    forest = forest_of(spark, rows)
    nodes = plain(forest.nodes)
    assert len(nodes) == len({tuple(t[: i + 1]) for t in talks.values() for i in range(len(t))})
    stream = [None] * sum(n["n_tokens"] for n in nodes)
    for n in nodes:
        n["ids"] = np.frombuffer(n["ids"], "<u4").tolist()
        n["node"] = bytes(n["node"])
        stream[n["start"] : n["start"] + n["n_tokens"]] = n["ids"]
    assert None not in stream
    by_node = {n["node"]: n for n in nodes}
    decode = queries._decode_with(RANKS, PATTERN)
    whole = collections.defaultdict(list)
    for t in sorted(plain(forest.turns), key=lambda t: t["depth"]):
        whole[t["conv"]].append(bytes(t["node"]))
    for conv, path in whole.items():
        leaf = by_node[path[-1]]
        seen = [i for s in leaf["sees"] for i in stream[s["from"] : s["to"]]]
        assert len(seen) == leaf["position"]
        text = decode(seen + leaf["ids"])
        assert [(chat_tree.unescape(r), chat_tree.unescape(t)) for r, t in chat_tree.TURN.findall(text)] == talks[conv]
        assert all(a["to"] < b["from"] for a, b in zip(leaf["sees"], leaf["sees"][1:]))
    assert forest_of(spark, rows[:0]).nodes.count() == 0


def test_chat_tree_long_turns_and_a_long_conversation(spark):
    """Turns of 20 kB, one conversation over many ranges, a hundred copies of another."""
    rng = random.Random(4)
    said = [("user" if k % 2 == 0 else "assistant", " ".join(rng.choice(["alpha", "be ta", "\n", "</s>", "ga\\mma"]) for _ in range(4000))) for k in range(40)]
    talks = {1: said + [("user", str(k)) for k in range(600)]} | {c: said[:3] for c in range(10, 110)}
    rows = [(c, k, r, t) for c, turns in talks.items() for k, (r, t) in enumerate(turns)]
    forest = forest_of(spark, rows)
    got = {r["conv"]: r for r in plain(chat_tree.read_back(forest, partial(queries._decode_with, RANKS, PATTERN)))}
    assert set(got) == set(talks) and forest.nodes.count() == 640
    for c in (1, 10, 109):
        assert got[c]["turns_sha256"] == brute.sha("".join(f"{r}\n{t}\n" for r, t in talks[c]))
        assert got[c]["loss_sha256"] == brute.sha("".join(t for r, t in talks[c] if r == "assistant"))


# licenses


def test_license_cases(spark, odd):
    got = {str(r["doc_id"]): r for r in plain(license_join.license_join(odd))}
    assert got["10"]["n_base"] == 3 and got["10"]["base_labels"] == ["apache-2", "cc-by-nc", "mit"]
    assert got["2"]["n_words"] == 0 and got["2"]["labels"] == [] and got["2"]["score"] == 0.0
    assert license_join.license_join(odd.limit(0)).count() == 0


def test_license_blocks_exact(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(60):
        label, text = license_join.TEMPLATES[i % len(license_join.TEMPLATES)]
        words = [w for w in text.split() if rng.random() > 0.15]
        rows.append((i, " ".join([*["pad"] * int(rng.integers(0, 60)), *words, *["more"] * int(rng.integers(0, 60))])))
    got = {r["doc_id"]: {b["label"] for b in r["blocks"]} for r in plain(
        license_join.license_join(spark.createDataFrame(rows, "doc_id long, text string")))}
    stride = max(len(t.split()) for _, t in license_join.TEMPLATES)
    for i, text in rows:
        w, want = text.split(), set()
        for k in range(0, len(w), stride):
            block = set(w[k : k + 2 * stride])
            want |= {lab for lab, t in license_join.TEMPLATES if len(block & set(t.split())) >= license_join.THRESHOLD * len(set(t.split())) - 1e-9}
        assert got[i] == want
    assert any(got.values())


# near-duplicates


def test_simhash(spark, sf, docs, odd):
    fps = [(d, brute.fingerprint(t)) for d, t in docs.items()]
    want, fp = brute.components(fps), dict(fps)
    for r in plain(queries.QUERIES["op5_simhash_variants"](spark, sf)):
        assert (int(r["fingerprint"], 16), r["component_id"]) == (fp[r["doc_id"]], want[r["doc_id"]])
    got = plain(simhash_variants.near_duplicates(odd))
    assert len(got) == len(ODD) and {r["component_id"] for r in got if r["doc_id"] in (5, None)} == {5}
    assert {r["component_id"] for r in got if r["doc_id"] in (2, 3)} == {2}
    assert simhash_variants.near_duplicates(odd.limit(0)).count() == 0


@pytest.mark.parametrize("bucket", [512, 4, 1])
def test_simhash_links_are_complete(spark, bucket):
    """Tight groups around few centres, so that buckets overflow and are indexed finer."""
    rng = np.random.default_rng(5)
    fps = set()
    for centre in rng.integers(0, 1 << 63, 3):
        for _ in range(60):
            x = int(centre)
            for b in rng.choice(64, int(rng.integers(0, 4)), replace=False):
                x ^= 1 << int(b)
            fps.add(x)
    signed = sorted(x - (1 << 64) if x >> 63 else x for x in fps)
    got = {tuple(r) for r in simhash_variants.links(spark.createDataFrame([(x,) for x in signed], "fp long"), bucket=bucket).collect()}
    mask = (1 << 64) - 1
    assert got == {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & mask).bit_count() <= 3}


@pytest.mark.parametrize("sample,often,crowded", [(20_000, 500_000, 20_000), (10, 3, 5)])
def test_near_copies_are_complete(spark, sample, often, crowded):
    """Copies with a few words replaced, among texts that share a passage, against all pairs."""
    rng = np.random.default_rng(8)
    passage, rows = [f"p{i}" for i in range(60)], []
    for i in range(60):
        words = [f"w{x}" for x in rng.integers(0, 400, int(rng.integers(3, 300)))]
        words += passage if i % 3 == 0 else []
        for k in range(3):
            copy = list(words)
            for at in rng.integers(0, len(words), int(k * len(words) // 80)):
                copy[at] = f"new{rng.integers(0, 99)}"
            rows.append((i * 10 + k, " ".join(copy)))
    sets = []
    for d, t in rows:
        w = t.split()
        sets.append((d, {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}))
    root = {d: d for d, _ in sets}
    linked = [(a, b) for i, (a, x) in enumerate(sets) for b, y in sets[i + 1 :] if 5 * len(x & y) >= 4 * len(x | y)]
    for _ in range(5):
        for a, b in linked:
            root[a] = root[b] = min(root[a], root[b])
    got = near_copies.near_copies(spark.createDataFrame(rows, "doc_id long, text string"), sample=sample, often=often, crowded=crowded)
    assert {r["doc_id"]: r["component_id"] for r in plain(got)} == root
    fp = {d: brute.fingerprint(t) for d, t in rows}
    assert sum((fp[a] ^ fp[b]).bit_count() > 3 for a, b in linked) > 10  # what a link at three bits would lose


def test_near_copies_pairs_grow_with_the_group(spark, monkeypatch):
    """Copies alike to one text but hardly to each other: few pairs a copy are asked, and groups come by SimHash first."""
    rng, made, grouped = np.random.default_rng(4), [], []
    pairs, group = near_copies._verified, simhash_variants.near_duplicates
    monkeypatch.setattr(near_copies, "_verified", lambda asked, *a: made.append(asked.count()) or pairs(asked, *a))
    monkeypatch.setattr(simhash_variants, "near_duplicates", lambda df, *a: grouped.append(df.count()) or group(df, *a))
    base = [f"w{x}" for x in range(200)]
    rows = [(0, " ".join(base))]
    for i in range(1, 200):
        copy = list(base)
        for at in rng.choice(200, int(rng.integers(3, 6)), replace=False):
            copy[at] = f"x{i}y{at}"
        rows.append((i, " ".join(copy)))
    rows += [(1000 + i, " ".join(f"z{i}q{k}" for k in range(50))) for i in range(50)]
    got = {r["doc_id"]: r["component_id"] for r in plain(near_copies.near_copies(spark.createDataFrame(rows, "doc_id long, text string")))}
    sets = {d: {tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)} for d, t in rows}
    root, ids = {d: d for d in sets}, sorted(sets)
    linked = [(a, b) for a in ids for b in ids if a < b and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    for _ in range(5):
        for a, b in linked:
            root[a] = root[b] = min(root[a], root[b])
    assert got == root and 20 < len(linked) < 199 * 198 / 2
    assert grouped and max(grouped) <= 200 and sum(made) < 20 * 200  # texts without a link are left out before


def test_components(spark):
    rng = np.random.default_rng(2)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)] + [tuple(map(int, rng.integers(200, 260, 2))) for _ in range(40)]
    got = {r["node"]: r["root"] for r in plain(components.components(spark.createDataFrame(edges, "a long, b long")))}
    least = {x: x for e in edges if e[0] != e[1] for x in e}
    for _ in range(60):
        for a, b in edges:
            if a != b:
                least[a] = least[b] = min(least[a], least[b])
    assert got == least


# packing


def test_packing(spark, sf, docs, encoding, odd):
    ids = {d: [*encoding.encode_ordinary(t), 0] for d, t in docs.items()}
    padding, total = brute.check_packing(plain(queries.QUERIES["op6_retrieval_pack"](spark, sf)), ids)
    assert padding < 1024
    rows = plain(queries.packed(odd))
    assert sum(len(r["ids"]) // 4 for r in rows) == sum(len(encoding.encode_ordinary(t or "")) + 1 for _, t in ODD)
    assert queries.packed(odd.limit(0)).count() == 0


def test_packing_encoder_equals_tokenizer(docs):
    fast, slow = retrieval_pack.Encoder(TOKENIZER, RANKS, PATTERN), retrieval_pack.Encoder(TOKENIZER)
    texts = [*docs.values(), *[t or "" for _, t in ODD], "a  b", "a \n b", "x<|endoftext|> y", " lead", "trail ", "a b\x1c c", "tab\t next"]
    for t in texts[:60] + texts[-20:]:
        assert fast(t) == slow(t)


def test_packing_encodes_each_stretch_once(docs, monkeypatch):
    encoder = retrieval_pack.Encoder(TOKENIZER, RANKS, PATTERN)
    odd = ["a  b", "a \n b", "x<|endoftext|> y", " lead", "trail ", "a b\x1c c", "tab\t next", "", " ", "x", "é ü ", "a\n\nb c", "a b  c", "don't 's"]
    texts, said, fast = [*odd, *docs.values(), "one more of these words"], [], encoder.fast
    want = [encoder(t) for t in texts]
    monkeypatch.setattr(encoder, "fast", lambda x: said.append(len(x)) or fast(x))
    assert encoder.many(pa.array(texts, pa.large_string())) == want
    assert encoder.many(pa.array([" "], pa.large_string())) == [encoder(" ")]
    said.clear()
    encoder.many(pa.array(["again and again"] * 1000, pa.large_string()))
    assert sum(said) < 1000 * len("again and") and max(said) < 100


def test_packing_joins_stretches_once(monkeypatch):
    """One call for all stretches of a batch, each once, and none for an empty batch of them."""
    encoder, said = retrieval_pack.Encoder(TOKENIZER, RANKS, PATTERN), []
    numbers = encoder.numbers
    monkeypatch.setattr(encoder, "numbers", lambda x: said.append(x) or numbers(x))
    texts = ["a b c d", "b c", "d <|endoftext|> e", "x\u00e9 b d"]
    assert encoder.many(pa.array(texts, pa.large_string())) == [encoder(t) for t in texts]
    assert len(said) == 1 and sorted(said[0].split()) == ["a", "b", "c", "d", "x\u00e9"]
    assert encoder.many(pa.array(["a  b"], pa.large_string())) == [encoder("a  b")] and said[1] == ""


def test_packing_prefers_alike_units():
    rng = np.random.default_rng(0)
    a, b = (rng.choice(np.arange(i, i + 300), (8, 128)).astype("<u4") for i in (0, 5000))
    units = [x for pair in zip(a, b) for x in pair]
    idf = np.ones(6000)
    packer = retrieval_pack.Packer(512, idf, 128.0, 0)
    windows = collections.defaultdict(set)
    for u, _, _, s, _ in packer.chunk(units):
        windows[s].add(u % 2)
    assert all(len(w) == 1 for w in windows.values())


def test_packing_finds_alike_units_in_large_tables(spark):
    """1,600 units, four alike each, 400 places apart."""
    rng = np.random.default_rng(3)
    common, rows = [f"c{x}" for x in range(40)], []
    for i in range(400):
        own = [f"t{i}x{k}" for k in range(12)]
        rows += [(i + 400 * k, " ".join([*rng.choice(common, 30), *rng.permutation(own)])) for k in range(4)]
    names, said = {}, {}
    for d, t in rows:
        said[t] = np.array([names.setdefault(w, len(names) + 1) for w in t.split()], dtype="<u4").tobytes()
    got = plain(retrieval_pack.pack(spark.createDataFrame(rows, "doc_id long, text string"), lambda: said.__getitem__,
                                    len(names) + 1, window=128, shard_tokens=40_000))
    where = collections.defaultdict(set)
    for r in got:
        where[r["doc_id"]].add(r["sequence_id"])
    assert sum(len(r["ids"]) // 4 for r in got) == sum(len(t.split()) + 1 for _, t in rows)
    assert np.mean([any(where[d] & where[(d + 400 * k) % 1600] for k in (1, 2, 3)) for d in range(1600)]) > 0.45


# nearest neighbours


def test_permutation_recall(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(4000, 32)).astype(np.float32)
    x[1000:1300] = x[0]  # one very common vector
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(9001, None), (9002, [0.0] * 32), (9003, [float("nan")] * 32), (9004, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit(1))
    got = collections.defaultdict(list)
    for r in permutation_index.nearest(df, F.col("id") % 20 == 0, shard=1500, block=64).collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    d, hit = x.astype(np.float64), 0
    assert set(got) == set(range(0, 4000, 20))
    for q, found in got.items():
        s = (d * d[q]).sum(axis=1)
        s[q] = -np.inf
        top = np.lexsort((np.arange(len(s)), -s))[:20]
        found.sort()
        assert [f[0] for f in found] == list(range(1, 21))
        assert all(abs(s[v] - c) < 1e-9 for _, v, c in found)
        hit += len({v for _, v, _ in found} & set(top.tolist()))
        if q == 0:
            assert [v for _, v, _ in found] == top.tolist()
    assert hit / (20 * len(got)) >= 0.9
    assert permutation_index.nearest(df.limit(0), F.col("id") % 20 == 0).count() == 0


def test_permutation_odd_rows(spark):
    """Many vectors of other lengths, one of which may hash lowest, rows without id, repeated ids; parts of the result."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 8))
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(1000 + i, [float(i), 1.0]) for i in range(250)] + [(None, x[0].tolist()), (40, x[40].tolist())]
    found = permutation_index.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("id") % 20 == 0)
    assert found.count() == 20 * 16 == found.select("vec_id").count() and {r["vec_id"] for r in found.select("vec_id").collect()} <= set(range(300))
    s = x @ x[20]
    s[20] = -np.inf
    best = [r["vec_id"] for r in found.where("query_id = 20").orderBy("rank").collect()]
    assert best == sorted([*range(300), 40], key=lambda v: (-s[v], v))[:20]


# byte-level BPE


@pytest.mark.parametrize("leaf,segment", [(8192, 1 << 20), (1, 1 << 20), (7, 50)])
def test_bpe_tree(spark, odd, encoding, leaf, segment):
    long = "it's we'll 12345 " * 20 + "  \n\n x" * 10 + "ab" * 60
    rows = odd.select("doc_id", "text", "ids").where("doc_id is null or doc_id <> 7").unionByName(
        spark.createDataFrame([(7, long, "")], "doc_id long, text string, ids string"))
    out = plain(bpe_monoid.decode(bpe_monoid.encode(rows, RANKS, PATTERN, leaf_chars=leaf, segment_chars=segment), RANKS, PATTERN))
    text = {str(r["doc_id"]): r["text"] or "" for r in plain(rows)}
    assert len(out) == len(ODD)
    for r in out:
        want = text[str(r["doc_id"])]
        assert r["ids"] == encoding.encode_ordinary(want) and r["decoded"] == want.encode()


def test_bpe_query(spark, sf, docs, encoding):
    for r in plain(queries.QUERIES["op8_bpe_monoid"](spark, sf)):
        ids = encoding.encode_ordinary(docs[r["doc_id"]])
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (
            len(ids), brute.sha(" ".join(map(str, ids))), brute.sha(docs[r["doc_id"]]))


# classifier


def test_ordinal_order_and_held_out(spark, odd):
    rng = np.random.default_rng(6)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(900):
        grade, body = i % 3, list(rng.choice(words, 60))
        if grade == 0:
            body = ["###" + w for w in body]
        if grade == 1:
            body[::6] = ["awful"] * 10
        rows.append((i, " ".join(body), grade))
    df = spark.createDataFrame(rows, "doc_id long, text string, grade int")
    model = ordinal_quality.fit(df.where("doc_id % 5 > 0").unionByName(spark.createDataFrame([(0, "x", None)], df.schema)), 3)
    assert (np.diff(model.thresholds) >= 0).all()
    held = plain(ordinal_quality.score(df.where("doc_id % 5 = 0"), model, 2))
    assert np.mean([r["kept"] == (r["doc_id"] % 3 == 2) for r in held]) > 0.95
    mean = [np.mean([r["expected_grade"] for r in held if r["doc_id"] % 3 == g]) for g in range(3)]
    assert mean[0] < mean[1] < mean[2]
    assert len(plain(ordinal_quality.score(odd, model, 2))) == len(ODD)
    assert ordinal_quality.fit(df.limit(0), 3) is None
    assert all(r["kept"] for r in plain(ordinal_quality.score(odd, None, 2)))


# WARC


def test_ordinal_memory_is_bounded():
    tracemalloc.start()
    make = ordinal_quality.Features()
    for i in range(30):
        make(b" ".join(b"w%d" % x for x in range(10_000 * i, 10_000 * (i + 1))))
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert held < 32 << 20
    column = pa.array([[5], [1, 2], [], [3]], pa.list_(pa.int64()))[1:]
    got = ordinal_quality._lists(column)
    assert [x.tolist() for x in got] == [[1, 2], [], [3]] and all(x.dtype == np.int64 and x.base is not None for x in got)


def test_ordinal_rated_empty_text(spark):
    rows = [(i, t, g) for i, (t, g) in enumerate([("good text", 2), ("bad text", 0), ("", 1), (None, 0)] * 5)]
    model = ordinal_quality.fit(spark.createDataFrame(rows, "doc_id long, text string, grade int"), 3)
    assert np.isfinite(model.weights).all() and np.isfinite(model.thresholds).all()


def test_warc_splitting():
    record = b"WARC/1.1\r\nContent-Length: 9\r\n\r\n\r\n\r\nab\r\nc\r\n\r\n"
    assert len(record.split(b"\r\n\r\n", 1)[1]) == 13
    stream = pa.BufferReader(warc_members.member(record * 3) + warc_members.member(record))
    got = list(warc_members.split_records(warc_members.inflated(stream)))
    assert len(got) == 4 and {b for _, b in got} == {b"\r\n\r\nab\r\nc"}
    with pytest.raises(ValueError):
        list(warc_members.split_records([record[:-3]]))


def test_warc_cases(spark):
    from terrahaz.session import scratch

    big = "x\r\n\r\n<p>é</p>" * 200
    rows = [(1, "http://a\r\nb", big), (2, None, big), (3, "u", None), (4, "u", "small"), (5, "u", "small"), (None, "u", big), (2, "u", big)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(1))
    folder = scratch(spark, "warc-test")
    warc_members.write_monolithic(warc_members.records(df), folder)
    index = warc_members.normalise(spark, folder)
    got = sorted((r["record_id"], r["record_type"], r["payload_bytes"], r["refers_to"] or "") for r in plain(warc_members.read_records(index)))
    n, two = len(big.encode()), "<urn:page:2>"
    assert got == sorted([("<urn:page:1>", "revisit", n, two), (two, "response", n, ""), (two, "response", n, ""), ("<urn:page:none>", "revisit", n, two),
                          ("<urn:page:3>", "response", 0, ""), ("<urn:page:4>", "response", 5, ""), ("<urn:page:5>", "response", 5, "")])
    empty = scratch(spark, "warc-test")
    warc_members.write_monolithic(warc_members.records(df.limit(0)), empty)
    assert warc_members.normalise(spark, empty).count() == 0


# pipeline


def test_pipeline_stages(spark, sf, odd):
    docs = odd
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        if name != "packing":
            assert out.columns == docs.columns
        assert stage(spark, docs.limit(0), sf).count() == 0
        if name == "near_dedup":
            assert out.where("text = 'same text here'").count() == 1
        if name == "personal_data":
            assert "<EMAIL>" in out.where("doc_id = 9").first()["text"]


def test_pipeline_run_keeps_ids(spark, sf, docs):
    got = {r["doc_id"] for r in corpus_pipeline.run(spark, sf).select("doc_id").collect()}
    assert got and got <= set(docs)
