"""Brute-force versions of the operators' contracts, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

ALNUM = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def contamination(docs, benchmark, window=13):
    """{doc_id: (n_words, n_hit, n_items, items_sha256, contaminated)}"""
    places = defaultdict(set)
    for item, text in benchmark:
        words = ALNUM.findall(lower(text or "").encode())
        size = min(window, len(words))
        for p in range(len(words) - size + 1 if words else 0):
            places[tuple(words[p:p + size])].add(str(item))
    sizes = sorted({len(w) for w in places})
    out = {}
    for doc, text in docs:
        words, hit, items = ALNUM.findall(lower(text or "").encode()), set(), set()
        for size in sizes:
            for p in range(len(words) - size + 1):
                found = places.get(tuple(words[p:p + size]))
                if found:
                    items |= found
                    hit.update(range(p, p + size))
        sha = hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
        out[doc] = (len(words), len(hit), len(items), sha, bool(hit) and 20 * len(hit) >= len(words))
    return out


def shingles(text, k):
    words = WORD.findall(lower(text or ""))
    if len(words) < k:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i:i + k]) for i in range(len(words) - k + 1))


def components(docs, k, percent):
    """{doc_id: (set size, smallest doc_id reachable)}, comparing all pairs."""
    sets = {d: shingles(t, k) for d, t in docs}
    comp = {d: d for d in sets}

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                comp[max(x, y)] = min(x, y)
    return {d: (len(s), find(d)) for d, s in sets.items()}


def removed(docs, size=100):
    """{doc_id: (n_bytes, n_removed, n_spans, kept_sha256)}"""
    seen, out = set(), {}
    for doc, text in sorted(docs, key=lambda r: (r[0] is not None, r[0])):
        raw = (text or "").encode()
        mark = bytearray(len(raw))
        for i in range(len(raw) - size + 1):
            if raw[i:i + size] in seen:
                mark[i:i + size] = b"\1" * size
            seen.add(raw[i:i + size])
        kept = bytes(c for c, m in zip(raw, mark) if not m)
        runs = len(re.findall(rb"[\x01]+", bytes(mark)))
        out[doc] = (len(raw), sum(mark), runs, hashlib.sha256(kept).hexdigest())
    return out
