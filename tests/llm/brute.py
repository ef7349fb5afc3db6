"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingles(text, k=5):
    words = re.findall("[^\x20\x09-\x0d]+", lower(text))
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def components(nodes, links):
    of = {n: n for n in nodes}

    def root(n):
        while of[n] != n:
            n = of[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        of[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def jaccard_groups(docs, percent=75):
    """docs: {doc_id: text} -> {doc_id: (n_shingles, component_id)}."""
    sets = {d: shingles(t) for d, t in docs.items()}
    names = sorted(sets)
    links = []
    for i, a in enumerate(names):
        for b in names[i + 1 :]:
            if sets[a] and sets[b] and 100 * min(len(sets[a]), len(sets[b])) >= percent * max(len(sets[a]), len(sets[b])):
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    links.append((a, b))
    of = components(names, links)
    return {d: (len(sets[d]), of[d]) for d in names}


def bench_words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower(text))


def contamination(docs, items, n=13, share=20):
    windows = defaultdict(set)
    for item, text in items:
        words = bench_words(text)
        for i in range(max(1, len(words) - n + 1) if words else 0):
            windows[tuple(words[i : i + n])].update(() if item is None else (str(item),))
    lengths = {len(w) for w in windows}
    out = {}
    for doc, text in docs.items():
        words = bench_words(text)
        hit, found = set(), set()
        for length in lengths:
            for i in range(len(words) - length + 1):
                names = windows.get(tuple(words[i : i + length]))
                if names is not None:
                    hit.update(range(i, i + length))
                    found |= names
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out[doc] = (len(words), len(hit), len(found), digest, bool(hit) and share * len(hit) >= len(words))
    return out


def exact_groups(docs):
    body = {d: re.sub("[\x20\x09-\x0d]+", " ", t or "") for d, t in docs.items()}
    groups = defaultdict(list)
    for d, b in body.items():
        groups[b].append(d)
    return {d: (min(groups[b]), len(groups[b]), d == min(groups[b]), hashlib.sha256(b.encode()).hexdigest()) for d, b in body.items()}


def repeated_bytes(docs, length=400):
    """{doc_id: (n_bytes, n_removed, n_spans, kept_sha256)}."""
    data = {d: (t or "").encode() for d, t in docs.items()}
    seen = Counter(b[i : i + length] for b in data.values() for i in range(len(b) - length + 1))
    out = {}
    for d, b in data.items():
        removed = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                removed[i : i + length] = b"\x01" * length
        spans = len(re.findall(b"\x01+", bytes(removed)))
        out[d] = (len(b), sum(removed), spans, hashlib.sha256(bytes(c for c, r in zip(b, removed) if not r)).hexdigest())
    return out
