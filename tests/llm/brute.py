"""Plain versions of the operators, written from their contracts, for small tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def quality_base(text):
    text = text or ""
    w = WORD.findall(text)
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    often = {k for k, n in Counter(windows).items() if n > 1}
    covered = {i + j for i, x in enumerate(windows) if x in often for j in range(5)}
    lines, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in lines
            lines.add(line)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(covered),
            len(w) < 10 or 100 * len(covered) > 20 * len(w))


def luhn(d):
    t = 0
    for i, c in enumerate(d[::-1]):
        x = int(c) * (1 + i % 2)
        t += x // 10 + x % 10
    return t % 10 == 0


def pii_base(text):
    text, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m.group())
        if 12 <= len(d) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append(("phone", *m.span()))
    kinds = ["email", "ip", "card", "phone"]
    return sorted(out, key=lambda s: (s[1], kinds.index(s[0])))


def span_text(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def lower_ascii(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def fingerprint(text):
    w = WORD.findall(lower_ascii(text))
    if not w:
        return 0
    s = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(fingerprints: list[tuple[int, int]], far=3):
    """doc_id -> smallest doc_id reachable."""
    fps = np.array([f for _, f in fingerprints], dtype=np.uint64)
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= far):
            parent[find(int(j))] = find(i)
    least = {}
    for i, (d, _) in enumerate(fingerprints):
        r = find(i)
        least[r] = min(least.get(r, d), d)
    return {d: least[find(i)] for i, (d, _) in enumerate(fingerprints)}


def check_packing(rows, ids_of: dict, window=1024):
    """rows: dicts of the packing query; ids_of: doc_id -> its ids with the closing one."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
        part = np.array(ids_of[r["doc_id"]][r["start"] : r["start"] + r["length"]], dtype="<u4").tobytes()
        assert r["length"] > 0 and zlib.crc32(part) == r["ids_crc32"]
        assert r["doc_tokens"] == len(ids_of[r["doc_id"]])
    assert set(by_doc) == set(ids_of)
    for d, pieces in by_doc.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r["start"]):
            assert r["start"] == at
            at += r["length"]
        assert at == len(ids_of[d])
    padding = 0
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= window
        padding += window - at
    return padding, sum(map(len, ids_of.values()))


PLAIN_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def leaks(docs, items, window=10):
    """(n_words, words hit, item ids met) of each text."""
    wanted = {}
    for item, text in items:
        w = PLAIN_WORD.findall(lower_ascii(text))
        for i in range(max(1, len(w) - window + 1) if w else 0):
            wanted.setdefault(tuple(w[i : i + window]), set()).add(item)
    sizes = {len(k) for k in wanted}
    out = []
    for text in docs:
        w, hit, met = PLAIN_WORD.findall(lower_ascii(text)), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                found = wanted.get(tuple(w[i : i + n]))
                if found:
                    hit |= set(range(i, i + n))
                    met |= found
        out.append((len(w), len(hit), sorted(str(x) for x in met if x is not None)))
    return out


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) > len(b):
        a, b = b, a
    i = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def spelling(counts: dict, ratio=10):
    """word -> (n_near, form, form_n, root)."""
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, others in near.items():
        if others:
            top = min(others, key=lambda v: (-counts[v], v))
            if counts[top] >= ratio * counts[w]:
                form[w] = top
    out = {}
    for w in counts:
        root = w
        while root in form:
            root = form[root]
        out[w] = (len(near[w]), form.get(w), counts[form[w]] if w in form else None, root)
    return out


def trie(conversations: dict):
    """(turns so far) -> (smallest member, its parent's, members, children, leaves, saved, ids that end there);
    conversations: id -> list of (role, text)."""
    members = {}
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    least = {k: min((c for c in m if c is not None), default=None) for k, m in members.items()}
    out = {}
    for k, m in members.items():
        below = [x for x in members if x[: len(k)] == k]
        kids = {x for x in below if len(x) == len(k) + 1}
        leaves = sum(not any(len(y) == len(x) + 1 and y[: len(x)] == x for y in below) for x in below)
        saved = sum((len(members[x]) - 1) * len(WORD.findall(x[-1][1])) for x in below if x)
        ends = sorted(c for c in m if c is not None and len(conversations[c]) == len(k))
        out[k] = (least[k], least[k[:-1]] if k else None, len(m), len(kids), leaves, saved, ends)
    return out


def cumulative_link(rows, grades, steps=400, rate=0.5, decay=1e-6):
    """Weights and thresholds of ``rows`` (buckets, values, grade) by plain descent on the whole loss; returns a
    function from (buckets, values) to the probabilities of the grades."""
    place = {b: i for i, b in enumerate(sorted({int(b) for at, _, _ in rows for b in at}))}
    x, y = np.zeros((len(rows), len(place))), np.array([g for _, _, g in rows])
    for i, (at, value, _) in enumerate(rows):
        x[i, [place[int(b)] for b in at]] = value
    w, t = np.zeros(x.shape[1]), np.linspace(-1, 1, grades - 1)
    sq_w, sq_t = np.full(len(w), 1e-8), np.full(len(t), 1e-8)

    def sigmoid(v):
        return 1 / (1 + np.exp(-np.clip(v, -35, 35)))

    for _ in range(steps):
        s = x @ w
        edges = np.concatenate([np.zeros((len(s), 1)), sigmoid(t[None, :] - s[:, None]), np.ones((len(s), 1))], axis=1)
        low, high = edges[np.arange(len(s)), y], edges[np.arange(len(s)), y + 1]
        p = np.maximum(high - low, 1e-9)
        g_w = x.T @ (1 - high - low) / len(s) + decay * w
        g_t = np.array([(np.where(y == k + 1, low * (1 - low), 0) / p - np.where(y == k, high * (1 - high), 0) / p).mean() for k in range(grades - 1)])
        sq_w, sq_t = sq_w + g_w**2, sq_t + g_t**2
        w, t = w - rate * g_w / np.sqrt(sq_w), np.maximum.accumulate(t - 0.1 * g_t / np.sqrt(sq_t))

    def judge(at, value):
        score = sum(w[place[int(b)]] * v for b, v in zip(at, value) if int(b) in place)
        return np.diff(np.concatenate([[0.0], sigmoid(t - score), [1.0]]))

    return judge


def near_components(texts: dict, similarity=0.8, shingle=5):
    """id -> smallest id reachable over Jaccard similarity of word shingles."""
    sets = {}
    for d, t in texts.items():
        w = WORD.findall(lower_ascii(t))
        sets[d] = frozenset(tuple(w[i : i + shingle]) for i in range(max(1, len(w) - shingle + 1))) if w else frozenset()
    root, ids = {d: d for d in texts}, sorted(texts)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            x, y = sets[a], sets[b]
            if x == y or (x and y and len(x & y) >= similarity * len(x | y) - 1e-12):
                low, high = sorted((root[a], root[b]))
                root = {d: low if r == high else r for d, r in root.items()}
    return root
