"""Plain single-process versions of the corpus operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

WORDS = re.compile(rb"[^\x20\x09-\x0d]+")
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def shingles(text: str | None, width: int = 5) -> frozenset:
    words = WORDS.findall((text or "").encode().translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1)))


def components(docs: dict, percent: int = 80) -> dict:
    """id -> (number of shingles, smallest reachable id)."""
    sets = {d: shingles(t) for d, t in docs.items()}
    holders = defaultdict(set)
    for d, s in sets.items():
        for shingle in s:
            holders[shingle].add(d)
    parent = {d: d for d in docs}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for d, s in sets.items():
        common = Counter(o for shingle in s for o in holders[shingle] if o < d)
        for o, n in common.items():
            if 100 * n >= percent * (len(s) + len(sets[o]) - n):
                a, b = root(d), root(o)
                parent[max(a, b)] = min(a, b)
    return {d: (len(sets[d]), root(d)) for d in docs}


def without_repeats(docs: list, length: int = 200) -> list:
    """(n_bytes, n_removed, n_spans, digest of the rest) of each text."""
    raws = [(t or "").encode() for t in docs]
    seen = Counter(r[i : i + length] for r in raws for i in range(len(r) - length + 1))
    found = []
    for r in raws:
        gone = [False] * len(r)
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(b for b, g in zip(r, gone, strict=True) if not g)
        found.append((len(r), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return found


def top_k(vectors: list, queries: list, k: int) -> set:
    """(query_id, rank, vec_id, score) over integer vectors."""
    out = set()
    for q, v in queries:
        scored = sorted(
            {(-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in vectors if i != q and len(w) == len(v)}
        )
        out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])}
    return out
