"""Plain versions of the operators, over lists in memory."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def groups(ids, links):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def shingles(text, size):
    words = WORDS.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    if not words:
        return frozenset()
    return frozenset([tuple(words)]) if len(words) < size else frozenset(zip(*(words[i:] for i in range(size))))


def near_duplicates(docs, size, percent):
    sets = {i: shingles(text, size) for i, text in docs}
    links = []
    for a, b in combinations(sets, 2):
        common = len(sets[a] & sets[b])
        if common and 100 * common >= percent * len(sets[a] | sets[b]):
            links.append((a, b))
    parts = groups(sets, links)
    return {i: (len(s), parts[i], parts[i] == i) for i, s in sets.items()}


def repeated_passages(docs, length):
    """(bytes, removed, spans, digest of what is kept) for each row."""
    texts = [(text or "").encode() for text in docs]
    seen = Counter(t[s : s + length] for t in texts for s in range(len(t) - length + 1))
    out = []
    for t in texts:
        inside = np.zeros(len(t) + 1, dtype=bool)
        for s in range(len(t) - length + 1):
            if seen[t[s : s + length]] > 1:
                inside[s : s + length] = True
        kept = bytes(b for b, gone in zip(t, inside) if not gone)
        spans = int((inside[:-1] & ~np.concatenate([[False], inside[:-2]])).sum()) if len(t) else 0
        out.append((len(t), int(inside.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def cosine_groups(vectors, least):
    ok = {i: np.array(v, float) for i, v in vectors if v and None not in v and np.isfinite(v).all() and np.any(v)}
    links = []
    for a, b in combinations(ok, 2):
        x, y = ok[a], ok[b]
        if len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= least:
            links.append((a, b))
    ids = [i for i, _ in vectors]
    parts, degree = groups(ids, links), Counter(x for link in links for x in link)
    return {i: (degree[i], parts[i], parts[i] == i) for i in ids}
