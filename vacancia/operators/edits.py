"""Edit distances of texts from many others at once.

The bit-parallel columns of Myers (1999), in numpy: a machine word holds the differences down one
column of the table of a text, and an array of words those of all texts, so a character of a query is
a few operations on arrays. Queries that come in order share the columns of their common beginnings.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Code points of a text that fit a machine word.
LONGEST = 64
#: A character in less than this share of the texts has no array of its own.
RARE = 1 / 64


class Texts:
    """Texts of at most ``LONGEST`` code points, as words of 16, 32 or 64 bits by the longest of them."""

    def __init__(self, texts: list[str]):
        size = np.array([len(t) for t in texts], np.int64)
        self.n, longest = len(texts), int(size.max(initial=0))
        if longest > LONGEST:
            raise ValueError(f"a text of {longest} code points does not fit {LONGEST} bits")
        self.word = next(w for w in (np.uint16, np.uint32, np.uint64) if longest <= w(0).nbytes * 8)
        ones = np.full(self.n, ~np.uint64(0))
        self.low = np.where(size > 0, ones >> (64 - np.maximum(size, 1)).astype(np.uint64), 0).astype(self.word)
        chars = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
        order = np.argsort(chars, kind="stable")
        place = np.arange(len(chars)) - np.repeat(np.cumsum(size) - size, size)
        self.of = np.repeat(np.arange(self.n), size)[order]
        self.bits = (np.uint64(1) << place[order].astype(np.uint64)).astype(self.word)
        found, first = np.unique(chars[order], return_index=True)
        self.spans = {chr(c): (a, b) for c, a, b in zip(found.tolist(), first.tolist(), [*first[1:].tolist(), len(chars)])}
        self.masks = {}

    def mask(self, char: str) -> np.ndarray:
        """Where each text has the character."""
        if char in self.masks:
            return self.masks[char]
        out = np.zeros(self.n, self.word)
        a, b = self.spans.get(char, (0, 0))
        np.bitwise_or.at(out, self.of[a:b], self.bits[a:b])
        if b - a >= RARE * self.n:
            self.masks[char] = out
        return out

    def distances(self, queries: list[str]) -> Iterator[np.ndarray]:
        """For each query its distances from all texts, less its own length; cheap where it begins as the one before."""
        one = self.word(1)
        x, y, z = (np.empty(self.n, self.word) for _ in range(3))
        columns = [(np.full(self.n, ~self.word(0)), np.zeros(self.n, self.word))]
        before = ""
        for query in queries:
            at, shared = 0, min(len(query), len(before))
            while at < shared and query[at] == before[at]:
                at += 1
            while len(columns) <= len(query):
                columns.append((np.empty(self.n, self.word), np.empty(self.n, self.word)))
            for i in range(at, len(query)):
                (up, down), (next_up, next_down), eq = columns[i], columns[i + 1], self.mask(query[i])
                np.bitwise_and(eq, up, out=x)
                np.add(x, up, out=x)
                np.bitwise_xor(x, up, out=x)
                np.bitwise_or(x, eq, out=x)  # no growth along the diagonal
                np.bitwise_or(eq, down, out=y)
                np.bitwise_or(x, up, out=z)
                np.invert(z, out=z)
                np.bitwise_or(z, down, out=z)  # grows to the right
                np.bitwise_and(x, up, out=x)  # shrinks to the right
                np.left_shift(z, one, out=z)
                np.bitwise_or(z, one, out=z)
                np.left_shift(x, one, out=x)
                np.bitwise_or(y, z, out=next_up)
                np.invert(next_up, out=next_up)
                np.bitwise_or(next_up, x, out=next_up)
                np.bitwise_and(z, y, out=next_down)
            before = query
            up, down = columns[len(query)]
            yield np.bitwise_count(up & self.low).view(np.int8) - np.bitwise_count(down & self.low).view(np.int8)
