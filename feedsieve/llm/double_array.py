"""Tries over byte strings as double arrays, built and walked many keys at a time.

The child of a state by a symbol is ``base[state] + symbol`` if ``check`` of that place
names the state. Where the children of a node go does not depend on where the node itself
lies, so all nodes of a size are placed side by side: each draws a base, those that
meet a taken place or each other draw again. Nodes of many children come first.
"""

from __future__ import annotations

import numpy as np

SYMBOLS = 256
# Nodes of more children get 256 places of their own, whose gaps smaller nodes fill.
LARGE = 16
SPARE = 3  # places per edge


class DoubleArray:
    """``base``, ``check`` and the ``value`` of each accepting state; 0 elsewhere."""

    def __init__(self, base: np.ndarray, check: np.ndarray, value: np.ndarray):
        self.base, self.check, self.value = base, check, value

    @property
    def nbytes(self) -> int:
        return self.base.nbytes + self.check.nbytes + self.value.nbytes

    def step(self, states: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Next states, and which of them exist."""
        found = self.base[states] + symbols
        return found, self.check[found] == states

    def state_of(self, key: bytes) -> int:
        """The state after a key, -1 if no key begins with it."""
        state = np.zeros(1, np.int32)
        for symbol in key:
            state, there = self.step(state, np.int32(symbol))
            if not there[0]:
                return -1
        return int(state[0])


def _edges(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Parent and symbol of every node but the root, in order of depth, and the node of each key."""
    raw = np.frombuffer(b"".join(keys), np.uint8)
    sizes = np.array([len(k) for k in keys], np.int64)
    first = np.cumsum(sizes) - sizes
    node = np.zeros(len(keys), np.int64)
    parents, symbols, made, depth = [], [], 1, 0
    alive = np.flatnonzero(sizes > 0)
    while len(alive):
        edge = node[alive] * SYMBOLS + raw[first[alive] + depth]
        new, which = np.unique(edge, return_inverse=True)
        parents.append(new // SYMBOLS)
        symbols.append(new % SYMBOLS)
        node[alive] = made + which
        made += len(new)
        depth += 1
        alive = alive[sizes[alive] > depth]
    none = [np.zeros(0, np.int64)]
    return np.concatenate(parents or none), np.concatenate(symbols or none), node


def double_array(keys: list[bytes]) -> DoubleArray:
    """A trie of distinct keys; the value of key i is i + 1."""
    parent, symbol, node = _edges(keys)
    n_nodes = len(parent) + 1
    # Nodes are made level by level in order of their parents: siblings lie together.
    counts = np.bincount(parent, minlength=n_nodes)
    first = np.cumsum(counts) - counts
    large = np.flatnonzero(counts > LARGE)
    places = SYMBOLS * (len(large) + 2) + SPARE * len(parent)
    used = np.zeros(places + SYMBOLS, bool)
    used[0] = True  # the root's own
    base = np.zeros(n_nodes, np.int64)
    base[large] = SYMBOLS * (np.arange(len(large)) + 1)
    own = np.isin(parent, large)
    used[base[parent[own]] + symbol[own]] = True
    rng = np.random.Generator(np.random.PCG64(len(parent)))
    for size in range(min(LARGE, int(counts.max(initial=0))), 0, -1):
        waiting = np.flatnonzero(counts == size)
        while len(waiting):
            drawn = rng.integers(1, places, len(waiting))
            wanted = drawn[:, None] + symbol[first[waiting][:, None] + np.arange(size)]
            free = ~used[wanted].any(1)
            rows = np.flatnonzero(free)
            if not len(rows):
                continue
            flat = wanted[rows].ravel()
            once = np.zeros(len(flat), bool)
            once[np.unique(flat, return_index=True)[1]] = True
            rows = rows[once.reshape(-1, size).all(1)]
            used[wanted[rows].ravel()] = True
            base[waiting[rows]] = drawn[rows]
            waiting = np.delete(waiting, rows)
    state = np.zeros(n_nodes, np.int64)
    state[1:] = base[parent] + symbol
    bases = np.zeros(len(used), np.int32)
    check = np.full(len(used), -1, np.int32)
    value = np.zeros(len(used), np.int32)
    bases[state] = base
    check[state[1:]] = state[parent]
    value[state[node]] = np.arange(1, len(keys) + 1)
    return DoubleArray(bases, check, value)
