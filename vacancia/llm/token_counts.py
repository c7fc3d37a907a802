"""Token counts by rank-synchronous merging of ragged arrays.

The pre-tokens of a batch are held as one flat array of symbols with the first index of each
pre-token. In every round each pre-token applies the lowest-ranked of its pairs, all of them
at once and from the left; pre-tokens without a mergeable pair are counted and leave. Only
pre-tokens that a worker has not yet met are merged; their counts are kept in a table of at
most ``CACHE`` entries, which costs time and never changes a count.

Counts equal those of the vocabulary file's own library: special strings of the vocabulary
found in a text are one token each and cut the text.

Defined results: a NULL or empty text has 0 bytes and 0 tokens; repeated rows are counted
alike; a very long text is read in blocks of pre-tokens; extra columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import batched

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import query, read

VOCABULARY = "byte_bpe_50k.json"
LIMIT = 1024
CACHE = 1 << 19
BLOCK = 1 << 16  # pre-tokens of one text held at a time
NONE = np.int32(2**31 - 1)


def byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in vocabulary files of this kind:
    visible Latin-1 bytes stand for themselves, the others follow from code point 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Merges:
    """Pair ranks of a vocabulary file, and the symbol counts of pre-tokens."""

    def __init__(self, name: str = VOCABULARY):
        with open(public_tokenizers.path(name), encoding="utf-8") as file:
            spec = json.load(file)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        key = (left << 16) | right  # ids of these vocabularies fit in 16 bits
        assert max(vocab.values()) < 0xFFFF
        order = np.argsort(key, kind="stable")
        self.keys, self.ranks, self.made = key[order].astype(np.uint32), order.astype(np.int32), made[order]
        letters = byte_letters()
        self.of_byte = np.array([vocab[letters[b]] for b in range(256)], np.int64)
        special = [t["content"] for t in spec["added_tokens"] if t["special"]]
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.known: dict[str, int] = {}

    def counts(self, words: list[bytes]) -> np.ndarray:
        """Symbols that survive in each word."""
        out = np.zeros(len(words), np.int64)
        size = np.array([len(w) for w in words], np.int64)
        symbols = self.of_byte[np.frombuffer(b"".join(words), np.uint8)]
        live = np.flatnonzero(size)
        size = size[live]
        while len(live):
            first = np.concatenate([[0], np.cumsum(size)[:-1]])
            key = np.full(len(symbols), 0xFFFFFFFF, np.uint32)  # no pair: none has this key
            key[:-1] = (symbols[:-1] << 16) | symbols[1:]
            key[first[1:] - 1] = key[-1]  # the last symbol of a word has no pair
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            rank = np.where(self.keys[at] == key, self.ranks[at], NONE)
            best = np.minimum.reduceat(rank, first)
            over = best == NONE
            out[live[over]] = size[over]
            pick = (rank == np.repeat(best, size)) & (rank != NONE)
            # Pairs of one kind overlap only in runs of one symbol: take every second from the left.
            where = np.flatnonzero(pick)
            opens = np.ones(len(where), bool)
            opens[1:] = where[1:] != where[:-1] + 1
            run = np.maximum.accumulate(np.where(opens, np.arange(len(where)), 0))
            where = where[(np.arange(len(where)) - run) % 2 == 0]
            symbols[where] = self.made[at[where]]
            stays = np.ones(len(symbols), bool)
            stays[where + 1] = False
            stays &= np.repeat(~over, size)
            symbols = symbols[stays]
            left = np.add.reduceat(stays, first, dtype=np.int64)
            live, size = live[~over], left[~over]
        return out

    def _learn(self, pieces: set[str]) -> None:
        """Make the counts of these pre-tokens known."""
        new = pieces.difference(self.known)
        if new:
            if len(self.known) + len(new) > CACHE:
                self.known.clear()
                new = pieces
            words = list(new)
            self.known.update(zip(words, self.counts([w.encode() for w in words]).tolist()))

    def count(self, texts: list[str]) -> list[int]:
        """Tokens of whole texts; their pre-tokens are merged together, ``BLOCK`` at a time."""
        total, held, size = [0] * len(texts), [], 0

        def settle() -> None:
            self._learn(set().union(*[pieces for _, pieces in held]))
            for i, pieces in held:
                total[i] += sum(map(self.known.__getitem__, pieces))
            held.clear()

        for i, text in enumerate(texts):
            parts = [text] if self.special is None else self.special.split(text)
            total[i] = len(parts) - 1
            for part in parts:
                if len(part) <= BLOCK:
                    blocks = (self.pattern.findall(part),)
                else:
                    blocks = batched((m.group() for m in self.pattern.finditer(part)), BLOCK)
                for pieces in blocks:
                    held.append((i, pieces))
                    size += len(pieces)
                    if size >= BLOCK:
                        settle()
                        size = 0
        settle()
        return total


@lru_cache(maxsize=2)
def merges(name: str) -> Merges:
    return Merges(name)


def token_counts(docs: DataFrame, vocabulary: str = VOCABULARY, limit: int = LIMIT) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = merges(vocabulary)
        for batch in batches:
            for part in (batch.slice(i, 1024) for i in range(0, batch.num_rows, 1024)):
                n = np.array(model.count([t or "" for t in part.column(2).to_pylist()]), np.int64)
                columns = [part.column(0), part.column(1), pa.array(n), pa.array(n > limit)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    rows = docs.select(F.col("doc_id").cast("long"), size.alias("n_bytes"), "text")
    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


@query("op5_token_counts")
def op5_token_counts(spark, sf_dir):
    return token_counts(read(spark, sf_dir, "documents"))
