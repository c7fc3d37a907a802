"""A trie of word ids over burstable hash containers, for counting n-grams.

A key is a sequence of ids packed into one positive integer, the first id highest. A node covers
one place of the sequence: its containers hold, for a range of ids each, whole keys and counts in
an open-addressed hash table of two arrays. A container that grows beyond ``burst`` keys is split
between two ids; one that is left with a single id becomes a node of the next place. Nodes
therefore exist only where many keys share a beginning.
"""

from __future__ import annotations

from bisect import bisect_right

import numpy as np

BITS = 21  # of an id: three ids fit in a signed long
BURST = 1 << 17
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


class Container:
    """Counts of keys; 0 marks a free place, and at most half of the places are taken."""

    def __init__(self, bits: int = 4):
        self.bits, self.size = bits, 0
        self.keys, self.n = np.zeros(1 << bits, np.int64), np.zeros(1 << bits, np.int64)

    def __len__(self) -> int:
        return self.size

    def add(self, keys: np.ndarray, n: np.ndarray) -> None:
        """Count different keys, all of them at once, place by place."""
        if 2 * (self.size + len(keys)) > len(self.keys):
            held = self.items()
            self.__init__((2 * (self.size + len(keys))).bit_length())
            self._place(*held)
        self._place(keys, n)

    def _place(self, keys: np.ndarray, n: np.ndarray) -> None:
        at = ((keys.view(np.uint64) * _SPREAD) >> np.uint64(64 - self.bits)).astype(np.int64)
        while len(keys):
            free = self.keys[at] == 0
            self.keys[at[free]] = keys[free]  # of several keys for one place the last gets it
            mine = self.keys[at] == keys
            self.size += int(np.count_nonzero(free & mine))
            self.n[at[mine]] += n[mine]
            keys, n, at = keys[~mine], n[~mine], (at[~mine] + 1) & (len(self.keys) - 1)

    def items(self) -> tuple[np.ndarray, np.ndarray]:
        taken = np.flatnonzero(self.keys)
        return self.keys[taken], self.n[taken]


def _container(keys: np.ndarray, n: np.ndarray) -> Container:
    out = Container()
    out.add(keys, n)
    return out


class Node:
    """Containers and nodes for ranges of the id at one place; ``shift`` is that place's bit."""

    def __init__(self, shift: int, burst: int = BURST):
        self.shift, self.burst = shift, burst
        self.lows = [0]
        self.children: list[Container | Node] = [Container()]

    def _ids(self, keys: np.ndarray) -> np.ndarray:
        return (keys >> self.shift) & ((1 << BITS) - 1)

    def add(self, keys: np.ndarray, n: np.ndarray) -> int:
        """Count different keys in order; returns how many were new."""
        # Sorted keys that agree up to this place are sorted by the id here.
        cuts = np.searchsorted(self._ids(keys), np.array([*self.lows[1:], 1 << BITS]))
        new, start, full = 0, 0, []
        for at, end in enumerate(cuts.tolist()):
            if start < end:
                held = self.children[at]
                if isinstance(held, Node):
                    new += held.add(keys[start:end], n[start:end])
                else:
                    before = len(held)
                    held.add(keys[start:end], n[start:end])
                    new += len(held) - before
                    if len(held) > self.burst:
                        full.append(self.lows[at])
            start = end
        for low in full:
            self._split(low)
        return new

    def _split(self, low: int) -> None:
        """Split the container that begins at ``low`` until none of its parts is too large."""
        at = bisect_right(self.lows, low) - 1
        held = self.children[at]
        if len(held) <= self.burst:
            return
        keys, n = held.items()
        ids = self._ids(keys)
        order = np.sort(ids)
        if order[0] == order[-1]:  # one id: cut the range down to it and go on at the next place
            if self.shift:
                node = Node(self.shift - BITS, self.burst)
                node.children = [held]
                only = int(order[0])
                ranges = [(low, Container()), (only, node), (only + 1, Container())][low == only :]
                if only + 1 in self.lows:
                    ranges.pop()
                self.lows[at : at + 1], self.children[at : at + 1] = map(list, zip(*ranges))
                node._split(0)
            return
        middle = int(order[len(order) // 2])
        if middle == order[0]:
            middle = int(order[np.searchsorted(order, middle, side="right")])
        right = ids >= middle
        self.lows.insert(at + 1, middle)
        self.children[at : at + 1] = [_container(keys[~right], n[~right]), _container(keys[right], n[right])]
        self._split(self.lows[at])
        self._split(middle)

    def items(self) -> tuple[np.ndarray, np.ndarray]:
        keys, n = zip(*[child.items() for child in self.children])
        return np.concatenate(keys), np.concatenate(n)

    def __len__(self) -> int:
        return sum(map(len, self.children))

    def pop_largest(self) -> Container | Node:
        """Take out the largest subtree; its range stays, empty."""
        at = max(range(len(self.children)), key=lambda i: len(self.children[i]))
        taken, self.children[at] = self.children[at], Container()
        return taken
