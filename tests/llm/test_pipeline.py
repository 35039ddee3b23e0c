"""The pipeline stage by stage against a plain chain, and the classifier on the given labels."""

import base64

import numpy as np
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import brute
from terrahaz.llm import compression_bands, near_copies, ordinal_quality, pii_bootstrap, queries, simhash_variants, tables
from terrahaz.session import scratch

LARGER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark, sf):
    """What goes into every stage and what comes out of the last, as rows."""
    docs, out = tables.table(spark, sf, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        out.append((name, [r.asDict() for r in docs.collect()]))
        path = scratch(spark, f"t-{name}")
        stage(spark, docs, sf).write.parquet(path)
        docs = spark.read.parquet(path)
    return [*out, ("", [r.asDict() for r in docs.collect()])]


def of(stages, number):
    return {r["doc_id"]: r["text"] for r in stages[number][1]}


def test_classifier_stage(spark, sf, stages):
    judge = ordinal_quality.judge(spark, queries.classifier(spark, sf), queries.FIT)
    before, after = of(stages, 0), of(stages, 1)
    tail = {d: judge((t or "").encode())[1] for d, t in before.items()}
    clear = {d for d, p in tail.items() if abs(p - ordinal_quality.CUT) > 1e-4}
    assert {d for d in clear if tail[d] >= ordinal_quality.CUT} == set(after) & clear and set(after) < set(before)
    labels = {r["doc_id"]: r for r in tables.table(spark, sf, "labels").collect()}
    clean = [d for d in before if d in labels and labels[d]["quality"] == 1 and not labels[d]["toxic"]]
    junk = [d for d in before if d in labels and (labels[d]["quality"] == 0 or labels[d]["toxic"])]
    # a hundred ratings at this size: the held-out figures are in the last test
    assert np.mean([d in after for d in clean]) > 0.95 and np.mean([d in after for d in junk]) < 0.6


def test_rules_stage(stages):
    judge = compression_bands.judge()
    before, after = of(stages, 1), of(stages, 2)
    want = {d for d, t in before.items() if not brute.quality_base(t)[5] and judge((t or "").encode())[6]}
    assert set(after) == want


def test_near_dedup_stage(stages):
    before, after = of(stages, 2), of(stages, 3)
    root = brute.near_components(before)
    assert set(after) == {d for d, r in root.items() if d == r}
    assert all(after[d] == before[d] for d in after)


def test_near_dedup_groups_every_row(spark, sf, monkeypatch):
    """op5 takes all rows, also those whose text can have no link, and its groups are checked on the whole sets."""
    line = "w1 w2 w3"
    often = [f"{' '.join([line] * 400)} {' '.join(f't{k}x{i}' for i in range(60))}" for k in range(3)]  # one fingerprint, few shingles alike
    base = [f"v{i}" for i in range(200)]
    near = [" ".join(base), " ".join([*base[:-1], "other"])]
    apart = [" ".join(f"a{k}b{i}" for i in range(30)) for k in range(5)]
    rows = [(5, often[0]), (6, often[1]), (7, often[2]), (8, near[0]), (None, near[1]), (4, near[1]), (None, apart[0]), (4, apart[1]),
            (9, apart[2]), (10, apart[3]), (11, apart[4]), (12, apart[4]), (13, None), (14, "")]
    fp = {simhash_variants.fingerprint(t.encode()) for t in often}
    assert all(((a ^ b) % (1 << 64)).bit_count() <= simhash_variants.MAX_DISTANCE for a in fp for b in fp)
    grouped, asked = [], []
    group, verify = simhash_variants.near_duplicates, near_copies._verified
    monkeypatch.setattr(simhash_variants, "near_duplicates", lambda df, *a: grouped.append(df.count()) or group(df, *a))
    monkeypatch.setattr(near_copies, "_verified", lambda pairs, *a: asked.append(pairs.count()) or verify(pairs, *a))
    got = corpus_pipeline.near_dedup(spark, spark.createDataFrame(rows, "doc_id long, text string"), sf).collect()
    assert grouped == [len(rows)] and asked[0] >= 3
    want = [(None, apart[0]), (4, apart[1]), (4, near[1]), (5, often[0]), (6, often[1]), (7, often[2]), (9, apart[2]), (10, apart[3]), (11, apart[4]), (13, None)]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_personal_data_stage(spark, stages):
    before, after = of(stages, 3), of(stages, 4)
    assert set(after) == set(before)
    found = {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in pii_bootstrap.extract(
        spark.createDataFrame(list(before.items()), "doc_id long, text string")).collect()}
    for d, t in before.items():
        assert set(brute.pii_base(t)) <= {s for s in found[d]} or not brute.pii_base(t)
        assert after[d] == (pii_bootstrap.redact(t, found[d]) if found[d] else t)
        assert not brute.pii_base(after[d])
    assert all(r["n_chars"] == len(r["text"]) for r in stages[4][1])


def test_packing_stage(stages):
    with open(queries.RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    encoding = tiktoken.Encoding("plain", pat_str=queries.PATTERN, mergeable_ranks=ranks, special_tokens={})
    ids = {d: [*encoding.encode_ordinary(t), 0] for d, t in of(stages, 4).items()}
    padding, _ = brute.check_packing(stages[5][1], ids)
    assert padding < 1024


def test_classifier_on_the_given_labels(spark):
    """Fit on four fifths of the rated documents, judged on the rest beside a plain optimiser of the same loss."""
    labels, docs = queries.graded(tables.table(spark, LARGER, "labels")), tables.table(spark, LARGER, "documents")
    held = F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 0
    rated = ordinal_quality.rated_sample(labels.where(~held), docs)
    model = ordinal_quality.fit(rated, queries.GRADES)
    asked = docs.join(labels.where(held & F.col("grade").isNotNull()), "doc_id").select("doc_id", "text", "grade")
    grade = {r["doc_id"]: (r["grade"], r["text"]) for r in asked.collect()}
    got = {r["doc_id"]: r["kept"] for r in ordinal_quality.score(asked, model, queries.FIT).collect()}
    make = ordinal_quality.Features(ordinal_quality.BUCKETS)
    rows = [(*make((r["text"] or "").encode()), r["grade"]) for r in rated.where("grade is not null").collect()]
    judge = brute.cumulative_link(rows, queries.GRADES)
    other = {d: judge(*make((t or "").encode()))[queries.FIT :].sum() >= ordinal_quality.CUT for d, (_, t) in grade.items()}
    own, plain = (np.mean([k[d] == (grade[d][0] == queries.FIT) for d in grade]) for k in (got, other))
    assert len(grade) > 40 and own >= 0.9 and own >= plain - 0.03, (len(grade), own, plain)
