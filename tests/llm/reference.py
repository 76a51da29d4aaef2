"""Plain Python versions of the text operators, for small tables."""

from __future__ import annotations

import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def near_components(docs, pct, size=5):
    """{id: (number of shingles, component)} by comparing all pairs."""
    sets = {}
    for doc_id, text in docs:
        w = (text or "").encode().lower().split()
        sets[doc_id] = frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1)) or (frozenset([tuple(w)]) if w else frozenset())
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * min(len(x), len(y)) >= pct * max(len(x), len(y)):
                common = len(x & y)
                if 100 * common >= pct * (len(x) + len(y) - common):
                    p, q = sorted((root(a), root(b)))
                    parent[q] = p
    return {d: (len(sets[d]), root(d)) for d in ids}


def without_repeats(docs, window=20):
    """{id: (number of words, removed, kept words)}."""
    seen, out = set(), {}
    for doc_id, text in sorted(docs, key=lambda x: x[0]):
        w = words(text)
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            phrase = tuple(w[i : i + window])
            if phrase in seen:
                gone[i : i + window] = [True] * window
            seen.add(phrase)
        out[doc_id] = (len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g))
    return out


def base_rules(text):
    w = words(text)
    triples = Counter(zip(w, w[1:], w[2:]))
    repeated = [False] * len(w)
    for i in range(len(w) - 2):
        if triples[tuple(w[i : i + 3])] > 1:
            repeated[i : i + 3] = [True] * 3
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    counts = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), sum(repeated))
    return (*counts, counts[0] < 50 or 100 * counts[4] > 50 * counts[0])
