"""Sets of hashed word shingles, computed for many texts at once."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
PART = 1 << 18  # bytes hashed at a time
BASE = 0x9E3779B97F4A7C15 | 1
UNBASE = pow(BASE, -1, 1 << 64)
# A different odd factor for each place in a shingle.
PLACES = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x2545F4914F6CDD1D)
    return x ^ (x >> np.uint64(32))


@lru_cache(1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        up = np.cumprod(np.append(np.uint64(1), np.full(n, BASE, np.uint64)))
        down = np.cumprod(np.append(np.uint64(1), np.full(n, UNBASE, np.uint64)))
    return up, down


def _part_hashes(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    inside = np.concatenate(([False], ~WHITE[raw], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    # The kept tables have the size of a part; only a word longer than that needs its own.
    up, down = _powers(2 * PART) if len(raw) <= 2 * PART else _powers.__wrapped__(len(raw))
    sums = np.concatenate(([np.uint64(0)], np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[: len(raw)])))
    whole = (sums[ends] - sums[starts]) * down[starts]
    return starts, mixed(whole + (ends - starts).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))


def word_hashes(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and 64-bit hash of each word; read in parts that end at white space."""
    starts, hashes, at = [], [], 0
    while at < len(raw):
        end = at + PART
        while end < len(raw):
            white = np.flatnonzero(WHITE[raw[end : end + PART]])
            if len(white):
                end += int(white[0])
                break
            end += PART
        part = raw[at : min(end, len(raw))]
        own, hashed = _part_hashes(part)
        starts.append(own + at)
        hashes.append(hashed)
        at += len(part)
    return np.concatenate([np.zeros(0, np.int64), *starts]), np.concatenate([np.zeros(0, np.uint64), *hashes])


def shingle_sets(texts: list[bytes], width: int = 5) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text.

    A text of fewer words is one shingle; one without words has none.
    """
    joined = b" ".join(texts).translate(LOWER)
    raw = np.frombuffer(joined, np.uint8)
    starts, words = word_hashes(raw)
    ends_at = np.cumsum([len(t) + 1 for t in texts])
    # texts' words: first[i] to first[i + 1]
    first = np.concatenate(([0], np.searchsorted(starts, ends_at)))
    n = len(words)
    if width > len(PLACES):
        raise ValueError(f"at most {len(PLACES)} words a shingle")
    full = np.zeros(max(0, n - width + 1), np.uint64)
    for place in range(width):
        full += mixed(words[place : place + len(full)] + np.uint64(place)) * PLACES[place]
    full = mixed(full)
    counts = np.diff(first)
    whole = counts >= width
    # Shingles that stay inside their text.
    owner = np.repeat(np.arange(len(texts)), counts)
    last = np.repeat(first[1:], counts)
    fits = np.flatnonzero(np.arange(n) + width <= last)
    hashes, owners = full[fits], owner[fits]
    order = np.lexsort((hashes, owners))
    hashes, owners = hashes[order], owners[order]
    if len(hashes):
        new = np.concatenate(([True], (hashes[1:] != hashes[:-1]) | (owners[1:] != owners[:-1])))
        hashes, owners = hashes[new], owners[new]
    cut = np.searchsorted(owners, np.arange(len(texts) + 1))
    found = []
    for i in range(len(texts)):
        if whole[i]:
            found.append(hashes[cut[i] : cut[i + 1]])
        elif counts[i]:
            some = words[first[i] : first[i + 1]]
            k = len(some)
            total = (mixed(some + np.arange(k).astype(np.uint64)) * PLACES[:k]).sum(dtype=np.uint64)
            found.append(mixed(np.array([total + np.uint64(k)], np.uint64)))
        else:
            found.append(hashes[:0])
    return found
