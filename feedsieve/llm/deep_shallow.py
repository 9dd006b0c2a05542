"""Deep-shallow string sorting.

A multikey quicksort orders strings by a few bytes at a time down to a shallow depth. Groups
that still agree there have long common prefixes; each is ordered by a blind trie, which
looks only at branching places on the way down and compares a string once, with the
leaf it reaches.
"""

from __future__ import annotations

KEY = 8


def common_prefix(a: bytes, b: bytes) -> int:
    """How many leading bytes agree."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


class BlindTrie:
    """Order of strings by branching places.

    An inner node is [depth, {byte: child}]; a leaf is a list of equal strings' numbers. -1
    stands for the end of a string.
    """

    def __init__(self, strings: list[bytes]):
        self.strings = strings
        self.root: list | None = None

    def _byte(self, string: bytes, depth: int) -> int:
        return string[depth] if depth < len(string) else -1

    @staticmethod
    def _is_leaf(node: list) -> bool:
        return len(node) < 2 or not isinstance(node[1], dict)

    def insert(self, number: int) -> None:
        string = self.strings[number]
        if self.root is None:
            self.root = [number]
            return
        path, node = [], self.root
        while not self._is_leaf(node):
            children = node[1]
            byte = self._byte(string, node[0])
            if byte not in children:
                byte = next(iter(children))
            path.append((node, byte))
            node = children[byte]
        other = self.strings[node[0]]
        agreed = common_prefix(string, other)
        if agreed == len(string) == len(other):
            node.append(number)
            return
        at = next((i for i, (inner, _) in enumerate(path) if inner[0] >= agreed), len(path))
        below = path[at][0] if at < len(path) else node
        new = self._byte(string, agreed)
        if at < len(path) and below[0] == agreed:
            below[1][new] = [number]
            return
        fork = [agreed, {self._byte(other, agreed): below, new: [number]}]
        if at:
            above, byte = path[at - 1]
            above[1][byte] = fork
        else:
            self.root = fork

    def order(self) -> list[tuple[int, int]]:
        """(number, length of the prefix common with the one before) in order."""
        found: list[tuple[int, int]] = []
        waiting: list[tuple[list, int]] = [(self.root, 0)] if self.root is not None else []
        while waiting:
            node, agreed = waiting.pop()
            if self._is_leaf(node):
                size = len(self.strings[node[0]])
                found.extend((n, size if k else agreed) for k, n in enumerate(node))
                continue
            depth, children = node
            keys = sorted(children, reverse=True)
            waiting.extend((children[k], agreed if k == keys[-1] else depth) for k in keys)
        return found


def deep_shallow_order(strings: list[bytes], shallow: int) -> tuple[list[int], list[int]]:
    """Sorted order of strings, and of each the prefix common with the one before it."""
    order: list[int] = []
    common: list[int] = []

    def follow(group: list[tuple[int, int]]) -> None:
        for k, (number, shared) in enumerate(group):
            if not k:
                shared = common_prefix(strings[order[-1]], strings[number]) if order else 0
            order.append(number)
            common.append(shared)

    # Groups that agree on ``depth`` bytes, the first on top.
    waiting = [(list(range(len(strings))), 0)]
    while waiting:
        group, depth = waiting.pop()
        if len(group) < 2:
            follow([(n, 0) for n in group])
        elif depth >= shallow:
            trie = BlindTrie(strings)
            for number in group:
                trie.insert(number)
            follow(trie.order())
        else:
            pivot = strings[group[len(group) // 2]][depth : depth + KEY]
            less, equal, more = [], [], []
            for number in group:
                key = strings[number][depth : depth + KEY]
                (less if key < pivot else equal if key == pivot else more).append(number)
            waiting.append((more, depth))
            if len(pivot) < KEY:  # these end here and are equal
                waiting.extend(([n], depth) for n in reversed(equal))
            else:
                waiting.append((equal, depth + KEY))
            waiting.append((less, depth))
    return order, common
