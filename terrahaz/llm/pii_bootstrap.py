"""Personal data: fixed patterns as seeds, then bootstrapped contextual extraction.

The fixed patterns (email, ip, card, phone) give seed entities, and so do keys: 32 or more hexadecimal
digits, letters and digits among them, which are spans of kind ``secret``. What stands before a seed, its
last two words in lower case or the signs right before it with the word before those, is a lexical pattern; the same pattern before another identifier-like
token (with a digit) makes that token an instance. On the graph of patterns and instances Spark
alternates two scores:

* pattern: sum of its instances' scores, by occurrence, over all places in all texts where the
  pattern's words stand, whatever follows them;
* instance: 1 for a seed, else 1 - product of (1 - pattern score) over the patterns before it.

A pattern counts once it has ``min_instances`` different instances with a score; those that end at
``confidence`` or more mark every instance they precede with a span of kind ``context``. Ordinary
phrases such as "of the" are followed by something else nearly always and stay far below.

Spans are (kind, start, end) in code points, end exclusive. Discovered spans and keys never touch base ones.

Defined cases: null text is empty: no spans; a failing match (part above 255, wrong number of
digits, wrong check digit) is dropped and not tried again; repeated rows each get their row; a null id stays
null; an empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrahaz.llm import tables

KINDS = ("email", "ip", "card", "phone")
SECRET, CONTEXT = "secret", "context"
ROUNDS = 3
MIN_INSTANCES = 3
CONFIDENCE = 0.6
#: Patterns are looked up in the task while their text stays under this size, else joined.
LOOKUP_BYTES = 32 << 20

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
#: Runs of identifier characters with a digit; tried at the first character of a run only.
_RUN = re.compile(r"(?<![A-Za-z0-9_.-])[A-Za-z_.-]*+[0-9][A-Za-z0-9_.-]*+")
_KEY = re.compile(r"(?<![A-Za-z0-9_.-])(?=[0-9]*+[A-Fa-f])(?=[A-Fa-f]*+[0-9])[0-9A-Fa-f]{32,}+(?![A-Za-z0-9_-])")
_BLANKS = " \t\n\x0b\x0c\r"
#: Signs in front of a letter or digit of the same word, and what stands before them there.
_CUE = re.compile(rb"(?:(?<![a-z0-9])([a-z0-9]++)|\A)([^a-z0-9 \t\n\x0b\x0c\r]++)(?=[a-z0-9])")
_DIGIT = re.compile(r"[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def emails(text: str):
    """An at sign with local characters before it (as far back as the last match allows) and a
    dotted domain behind it: found from the sign, so a long run of letters costs nothing."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            free = m.end()
        at = text.find("@", max(at + 1, free))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Base spans by start, then by kind in the order of ``KINDS``."""
    found = [(0, a, b) for a, b in emails(text)]
    if _DIGIT.search(text):
        found += [(1, *m.span()) for m in _IP.finditer(text) if all(_small(p) for p in m.group().split("."))]
        for kind, pattern, low, high in ((2, _CARD, 12, 19), (3, _PHONE, 9, 15)):
            for m in pattern.finditer(text):
                digits = _NOT_DIGIT.sub("", m.group())
                if low <= len(digits) <= high and (kind == 3 or luhn(digits)):
                    found.append((kind, *m.span()))
    found.sort(key=lambda s: (s[1], s[0]))
    return [(KINDS[k], a, b) for k, a, b in found]


def keys(text: str, spans) -> list[tuple[str, int, int]]:
    """Keys that touch none of the spans."""
    return [(SECRET, *m.span()) for m in _KEY.finditer(text) if not any(a < m.end() and m.start() < b for _, a, b in spans)]


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or 0) <= 255


def _ascii_alnum(c: str) -> bool:
    return c.isascii() and c.isalnum()


def _word_before(text: str, at: int) -> tuple[int, int]:
    """The whole word that ends before ``at``, blanks between skipped; empty where there is none."""
    end = at
    while end > 0 and text[end - 1] in _BLANKS:
        end -= 1
    start = end
    while start > 0 and text[start - 1] not in _BLANKS:
        start -= 1
    return start, end


def _name(*parts: str) -> str:
    return " ".join(p.encode().lower().decode("utf-8", "replace") for p in parts)


def context_of(text: str, start: int) -> str | None:
    """The pattern before ``start`` in lower case: the last two words; where a sign stands right
    before it, a blank, the letters and digits (or the word) before the signs, and the signs.
    None where there is too little."""
    if start and text[start - 1] not in _BLANKS:
        cue = start
        while cue > 0 and text[cue - 1] not in _BLANKS and not _ascii_alnum(text[cue - 1]):
            cue -= 1
        if cue > 0 and text[cue - 1] not in _BLANKS:
            a = end = cue
            while a > 0 and _ascii_alnum(text[a - 1]):
                a -= 1
        else:
            a, end = _word_before(text, cue)
        return " " + _name(text[a:end], text[cue:start]) if a < end else None
    a, b = _word_before(text, start)
    c, d = _word_before(text, a)
    return _name(text[c:d], text[a:b]) if c < d else None


def occurrences(text: str, spans) -> list[tuple[str, str, bool, int, int]]:
    """(pattern, instance, seed, start, end) of all seeds and identifier-like tokens."""
    out = []
    for _, a, b in spans:
        p = context_of(text, a)
        if p is not None:
            out.append((p, text[a:b], True, a, b))
    if not _DIGIT.search(text):
        return out
    busy = sorted((a, b) for _, a, b in spans)
    at = 0
    for m in _token_runs(text):
        a, b = m
        while at < len(busy) and busy[at][1] <= a:
            at += 1
        if at < len(busy) and busy[at][0] < b:
            continue
        p = context_of(text, a)
        if p is not None:
            out.append((p, text[a:b], False, a, b))
    return out


def _token_runs(text: str):
    """Identifier-like tokens of any length: three or more characters, a digit among them."""
    for m in _RUN.finditer(text):
        run = m.group()
        a = m.start() + len(run) - len(run.lstrip("_.-"))
        b = m.end() - len(run) + len(run.rstrip("_.-"))
        if b - a >= 3:
            yield a, b


def _slots(body: bytes):
    """The pattern of each place that has one, as ``context_of`` names it."""
    before = None
    for word in body.lower().split():
        if before is not None:
            yield before + b" " + word
        for m in _CUE.finditer(word):
            prev = m[1] or (before if not m.start() else None)
            if prev:
                yield b" " + prev + b" " + m[2]
        before = word


def pattern_totals(rows: DataFrame, patterns: DataFrame, lookup_bytes: int = LOOKUP_BYTES) -> DataFrame:
    """``pattern, total``: at how many places of all texts each pattern's two words stand."""
    size = patterns.agg(F.coalesce(F.sum(F.octet_length("pattern") + 64), F.lit(0))).first()[0]
    if size <= lookup_bytes:
        wanted = rows.sparkSession.sparkContext.broadcast(
            frozenset(r[0].encode() for r in patterns.select("pattern").collect()))

        def count(batches):
            seen: dict[bytes, int] = {}
            keys = wanted.value
            for b in batches:
                for body in b["body"].to_pylist():
                    for pair in _slots(body):
                        if pair in keys:
                            seen[pair] = seen.get(pair, 0) + 1
            yield {"pattern": [p.decode("utf-8", "replace") for p in seen], "n": list(seen.values())}

        counted = tables.map_batches(rows.select("body"), "pattern string, n long", count)
    else:

        def every(batches):
            for b in batches:
                for body in b["body"].to_pylist():
                    seen: dict[bytes, int] = {}
                    for pair in _slots(body):
                        seen[pair] = seen.get(pair, 0) + 1
                    yield {"pattern": [p.decode("utf-8", "replace") for p in seen], "n": list(seen.values())}

        counted = tables.map_batches(rows.select("body"), "pattern string, n long", every).join(patterns, "pattern", "left_semi")
    return counted.groupBy("pattern").agg(F.sum("n").alias("total"))


def confident_patterns(edges: DataFrame, totals: DataFrame, rounds: int, min_instances: int, confidence: float) -> DataFrame:
    """``pattern, score`` of the patterns that end at ``confidence`` or more. ``edges``: ``pattern,
    instance, n, seed``; rounds are staged, so lineage stays short."""
    edges = tables.staged(edges.join(totals, "pattern"), "pii-edges")
    instances = edges.groupBy("instance").agg(F.max(F.col("seed").cast("double")).alias("score"))
    scored = None
    for _ in range(rounds):
        scored = tables.staged(
            edges.join(instances, "instance").groupBy("pattern").agg(
                F.sum(F.col("n") * F.col("score")).alias("good"), F.count(F.when(F.col("score") > 0, 1)).alias("k"),
                F.greatest(F.max("total"), F.sum("n")).alias("total"))
            .select("pattern", F.when(F.col("k") >= min_instances, F.col("good") / F.col("total")).otherwise(0.0).alias("score")),
            "pii-patterns")
        miss = F.least(F.col("score"), F.lit(0.999999))
        instances = edges.join(scored, "pattern").groupBy("instance").agg(
            F.greatest(F.max(F.col("seed").cast("double")), 1 - F.exp(F.sum(F.log1p(-miss)))).alias("score"))
    return scored.where(F.col("score") >= confidence)


def extract(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS,
            min_instances: int = MIN_INSTANCES, confidence: float = CONFIDENCE, lookup_bytes: int = LOOKUP_BYTES) -> DataFrame:
    """A row per text: id, ``base`` and ``spans`` (arrays of kind, start, end; ``spans`` holds the
    discovered ones too)."""
    id_type = df.schema[id_col].dataType.simpleString()
    rows = tables.texts(df, id_col, text_col)
    span = "array<struct<kind:string,start:int,end:int>>"
    seen = "array<struct<pattern:string,instance:string,seed:boolean,start:int,end:int>>"

    def find(batches):
        for b in batches:
            base, secret, occ = [], [], []
            for body in b["body"].to_pylist():
                text = body.decode("utf-8", "replace")
                spans = base_spans(text)
                more = keys(text, spans)
                for c, found in ((base, spans), (secret, more)):
                    c.append([{"kind": k, "start": s, "end": e} for k, s, e in found])
                spans = sorted([*spans, *more], key=lambda s: s[1])
                occ.append([dict(zip(("pattern", "instance", "seed", "start", "end"), o, strict=True)) for o in occurrences(text, spans)])
            yield {"id": b["id"], "base": base, "secret": secret, "seen": occ}

    # without the texts
    first = tables.staged(
        tables.map_batches(rows, f"id {id_type}, base {span}, secret {span}, seen {seen}", find).withColumn("row", F.monotonically_increasing_id()), "pii-spans")
    each = first.select("row", F.explode("seen").alias("o")).select("row", "o.*")
    edges = each.groupBy("pattern", "instance").agg(F.count("*").alias("n"), F.max("seed").alias("seed"))
    supported = edges.groupBy("pattern").agg(F.count("*").alias("k"), F.max("seed").alias("seed")).where(
        F.col("k") >= min_instances).select("pattern")
    supported = tables.staged(supported, "pii-supported")
    # a place that is not cut the same way everywhere (a seed that starts with a sign) counts as often as it was met
    totals = supported.join(pattern_totals(rows, supported, lookup_bytes), "pattern", "left").na.fill(0, ["total"])
    good = confident_patterns(edges, totals, rounds, min_instances, confidence)
    found = (
        each.where("not seed").join(good.select("pattern"), "pattern")
        .groupBy("row").agg(F.array_sort(F.array_distinct(F.collect_list(F.struct(
            F.lit(CONTEXT).alias("kind"), "start", "end")))).alias("more"))
    )
    every = F.concat("base", "secret", F.coalesce("more", F.array().cast(span)))
    ranked = F.array_sort(F.transform(every, lambda s: F.struct(
        s["start"].alias("start"), F.array_position(F.array(*map(F.lit, [*KINDS, SECRET, CONTEXT])), s["kind"]).alias("at"),
        s["end"].alias("end"), s["kind"].alias("kind"))))
    return first.join(found, "row", "left").select(
        F.col("id").alias(id_col), "base",
        F.transform(ranked, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))).alias("spans"))


def redact(text: str, spans) -> str:
    """``text`` with every span replaced by its kind in angle brackets; of overlapping spans the
    first one names the stretch they cover together."""
    parts, at, i = [], 0, 0
    spans = sorted(spans, key=lambda s: (s[1], -s[2]))
    while i < len(spans):
        kind, start, end = spans[i]
        while i + 1 < len(spans) and spans[i + 1][1] < end:
            i += 1
            end = max(end, spans[i][2])
        parts += [text[at:start], f"<{kind.upper()}>"]
        at, i = end, i + 1
    return "".join([*parts, text[at:]])
