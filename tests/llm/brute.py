"""Plain Python versions of the operators' contracts, for small fixtures."""

from __future__ import annotations

import collections
import hashlib
import re

import numpy as np

LOWER = {i: i + 32 for i in range(65, 91)}
ITEM_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def decontamination(docs, items, window=10):
    by_window = {}
    for i, t in items:
        w = ITEM_WORDS.findall((t or "").translate(LOWER))
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            by_window.setdefault(tuple(w[k : k + n]), set()).add(i)
    sizes = {len(w) for w in by_window}
    out = []
    for d, t in docs:
        w = ITEM_WORDS.findall((t or "").translate(LOWER))
        hit, met = set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if found := by_window.get(tuple(w[k : k + n])):
                    hit |= set(range(k, k + n))
                    met |= found
        names = ",".join(sorted(str(m) for m in met))
        out.append((d, len(w), len(hit), len(met), hashlib.sha256(names.encode()).hexdigest(), bool(hit)))
    return out


def shingles(text, k):
    w = WORDS.findall((text or "").translate(LOWER))
    n = min(k, len(w))
    return {tuple(w[j : j + n]) for j in range(len(w) - n + 1)} if n else set()


def near_duplicates(docs, k=4, percent=80):
    """{doc_id: (set size, component, kept)}; ids are unique."""
    sets = {d: shingles(t, k) for d, t in docs}
    holders = collections.defaultdict(list)
    for d, s in sets.items():
        for g in s:
            holders[g].append(d)
    both = collections.Counter()
    for ds in holders.values():
        for i, a in enumerate(ds):
            for b in ds[:i]:
                both[b, a] += 1
    top = {}

    def find(x):
        while top.get(x, x) != x:
            x = top[x]
        return x

    for (a, b), c in both.items():
        if 100 * c >= percent * (len(sets[a]) + len(sets[b]) - c):
            x, y = find(a), find(b)
            if x != y:
                top[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d), find(d) == d) for d in sets}


def repeated_words(docs, window):
    words = [(d, (t or "").encode().split()) for d, t in docs]
    first = {}
    for d, w in words:
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            first[key] = min(first.get(key, d), d)
    out = []
    for d, w in words:
        gone = set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < d:
                gone |= set(range(k, k + window))
        kept = b" ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return out


def repeated_bytes(docs, length):
    raw = [(d, (t or "").encode()) for d, t in docs]
    count = collections.Counter(r[i : i + length] for _, r in raw for i in range(len(r) - length + 1))
    out = []
    for d, r in raw:
        gone = np.zeros(len(r), bool)
        for i in range(len(r) - length + 1):
            if count[r[i : i + length]] > 1:
                gone[i : i + length] = True
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = np.frombuffer(r, np.uint8)[~gone].tobytes()
        out.append((d, len(r), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out
