"""Phrase collocations: word pairs and triples that occur together far more often than apart.

Counting. Each task turns its words into ids of its own and counts n-grams in a trie of these
ids with burstable hash containers (``hat_trie``), one trie per language. When a task holds
more than ``HELD`` n-grams, whole subtrees, the largest first, leave as runs of (phrase, count)
sorted by phrase. The runs of all tasks are written once, dealt out by ranges of phrases, so
that a partition holds whole prefixes and a frequent prefix spreads over several, and merged
there.

A phrase is frequent only if all its parts are. Words are counted first, then pairs of frequent
words, then triples of frequent pairs; which parts are frequent reaches the tasks as a table of
``SLOTS`` bits. A bit set by another phrase costs a count too many in the runs and never changes
a result: every count of a frequent phrase is complete, and rare ones are dropped by their exact
counts.

Scores are whole numbers: decimals of 38 digits hold 10^6 a^2 for any a below 10^16.

Defined results: a NULL text has no words; a NULL language is ``und``; a language without words
or without candidates has no rows; repeated rows count each time; words and texts may be of any
length; equal scores are ordered by count, then phrase; extra columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import count, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import query, read, stored
from .hat_trie import BITS, BURST, Node
from .ragged import chunks

LEAST = 10  # occurrences of a candidate
SHARE = 50  # percent of a candidate's occurrences inside a longer one that drop it
TOP = 2000
UNKNOWN = "und"

HELD = 1 << 21  # n-grams in a task's tries
WORDS = 1 << 20  # ids of a task, at most 1 << BITS
SLOTS = 1 << 24  # bits of a table of frequent phrases
ROWS = 1 << 15  # of a batch of a run
PARTS = 16  # of a language's candidates, cut before they are ranked

_PRIME, _STEP = (1 << 31) - 1, 1_000_003
BREAK = b"\xff"  # never part of UTF-8

#: A-Z lower-cased, ends of pieces as one byte.
_TABLE = bytearray(range(256))
_TABLE[65:91] = range(97, 123)
for _byte in b".,;:!?\n\x0b\x0c\r":
    _TABLE[_byte] = 0xFF
_TABLE = bytes(_TABLE)


def tokens(text: bytes) -> list[bytes]:
    """Words of a text in order, with ``BREAK`` between pieces."""
    return text.translate(_TABLE).replace(BREAK, b" \xff ").split()


def next_slot(h, crc):
    """Hash of a phrase from the hash of its beginning and the CRC of its last word."""
    return (h * _STEP + crc) % _PRIME


def slot_of(lang: Column, words: list[Column]) -> Column:
    h = F.crc32(lang) % _PRIME
    for word in words:
        h = next_slot(h, F.crc32(word))
    return h % SLOTS


def bits(slots: DataFrame) -> np.ndarray:
    """The table of set slots; the driver receives ``SLOTS / 64`` rows at most."""
    word = F.shiftright("slot", 6).alias("word")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("slot") % 64).cast("int"))
    rows = slots.groupBy(word).agg(F.bit_or(bit).alias("bits")).toArrow()
    table = np.zeros(SLOTS // 64, np.int64)
    table[rows["word"].to_numpy()] = rows["bits"].to_numpy()
    return table.view(np.uint64)


def is_set(table: np.ndarray, h: np.ndarray) -> np.ndarray:
    slot = h % (64 * len(table))
    return (table[slot >> 6] >> (slot & 63).astype(np.uint64)) & np.uint64(1) == 1


class Counts:
    """N-grams of one task."""

    def __init__(self, n: int, table: np.ndarray | None, held: int, words: int, burst: int):
        self.n, self.table = n, table
        self.held, self.words, self.burst = held, words, burst
        self._restart()

    def _restart(self) -> None:
        self.tries: dict[str, Node] = {}
        self.size = 0
        self.ids: dict[bytes, int] = defaultdict(count().__next__)  # in order of arrival
        self.names: list[bytes] = []
        self.crc = np.zeros(1 << 10, np.int64)
        self._ids([BREAK])

    def _ids(self, words: list[bytes]) -> np.ndarray:
        out = np.fromiter(map(self.ids.__getitem__, words), np.int64, len(words))
        start = len(self.names)
        self.names.extend(islice(self.ids, start, None))
        while len(self.crc) < len(self.names):
            self.crc = np.concatenate([self.crc, np.zeros_like(self.crc)])
        self.crc[start : len(self.names)] = np.fromiter(map(zlib.crc32, self.names[start:]), np.int64)
        return out

    def _keys(self, lang: str, ids: np.ndarray) -> np.ndarray:
        """Packed n-grams whose parts may all be frequent."""
        real = ids > 0
        if self.n == 1:
            return ids[real]
        h = next_slot(zlib.crc32(lang.encode()) % _PRIME, self.crc[ids])
        if self.n == 2:
            good = real & is_set(self.table, h)
            return ((ids[:-1] << BITS) | ids[1:])[good[:-1] & good[1:]]
        pair = real[:-1] & real[1:] & is_set(self.table, next_slot(h[:-1], self.crc[ids[1:]]))
        return ((ids[:-2] << 2 * BITS) | (ids[1:-1] << BITS) | ids[2:])[pair[:-1] & pair[1:]]

    def add(self, lang: str, words: list[bytes]) -> None:
        keys = self._keys(lang, self._ids(words))
        if len(keys):
            trie = self.tries.setdefault(lang, Node(BITS * (self.n - 1), self.burst))
            self.size += trie.add(*np.unique(keys, return_counts=True))

    def runs(self, everything: bool = False) -> Iterator[pa.RecordBatch]:
        """Sorted runs of subtrees that leave, if the tries or the ids have become too many."""
        everything = everything or len(self.names) > self.words
        while self.size > (0 if everything else self.held):
            lang = max(self.tries, key=lambda x: len(self.tries[x]))
            subtree = self.tries[lang].pop_largest()
            self.size -= len(subtree)
            yield from self._run(lang, subtree)
        if everything:
            self._restart()

    def _run(self, lang: str, subtree) -> Iterator[pa.RecordBatch]:
        keys, n = subtree.items()
        ids = [(keys >> BITS * i) & ((1 << BITS) - 1) for i in reversed(range(self.n))]
        # Words of the subtree in order; keys in the order of their words.
        used = np.unique(np.concatenate(ids))
        names = pa.array([self.names[i] for i in used.tolist()], pa.string())
        by_name = pc.sort_indices(names)
        names, rank = names.take(by_name), np.empty(len(used), np.int64)
        rank[by_name.to_numpy()] = np.arange(len(used))
        ranks = [rank[np.searchsorted(used, i)] for i in ids]
        order = np.lexsort(ranks[::-1])
        for i in range(0, len(order), ROWS):
            part = order[i : i + ROWS]
            phrase = pc.binary_join_element_wise(*[names.take(pa.array(r[part])) for r in ranks], " ")
            columns = [pa.array([lang] * len(part), pa.string()), phrase, pa.array(n[part])]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "phrase", "n"])


def count_runs(docs: DataFrame, n: int, table: np.ndarray | None = None) -> DataFrame:
    """``lang, phrase, n``: sorted runs of the tasks' counts of phrases of ``n`` words."""

    limits = (HELD, WORDS, BURST)  # of the driver's module: a task's own may differ

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counts(n, table, *limits)
        for batch in batches:
            langs = batch.column(0).to_pylist()
            for chunk in chunks(batch.column(1)):
                data, of_lang = chunk.data.tobytes(), {}
                for i, lang in enumerate(langs[chunk.first : chunk.first + chunk.n]):
                    of_lang.setdefault(lang, []).append(data[chunk.bounds[i] : chunk.bounds[i + 1]])
                for lang, texts in of_lang.items():
                    counts.add(lang, tokens(BREAK.join(texts)))
                    yield from counts.runs()
        yield from counts.runs(everything=True)

    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "lang string, phrase string, n long")


def merged(runs: DataFrame, least: int) -> DataFrame:
    """``lang, phrase, f``: the runs merged within ranges of phrases, rare phrases left out."""
    dealt = runs.repartitionByRange("lang", "phrase")
    return dealt.groupBy("lang", "phrase").agg(F.sum("n").alias("f")).where(F.col("f") >= least)


def collocations(docs: DataFrame, least: int = LEAST, share: int = SHARE, top: int | None = TOP) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of each language's best phrases."""
    word_runs = stored(count_runs(docs, 1))
    words = stored(merged(word_runs, least))
    sizes = word_runs.groupBy("lang").agg(F.sum("n").alias("n"))
    pair_runs = stored(count_runs(docs, 2, bits(words.select(slot_of(F.col("lang"), [F.col("phrase")]).alias("slot")))))
    pairs = stored(merged(pair_runs, least))
    first, last = F.substring_index("phrase", " ", 1), F.substring_index("phrase", " ", -1)
    pair_slots = pairs.select(slot_of(F.col("lang"), [first, last]).alias("slot"))
    triples = stored(merged(stored(count_runs(docs, 3, bits(pair_slots))), least))

    def part(df: DataFrame, counts: DataFrame, key: Column, name: str) -> DataFrame:
        found = counts.select("lang", F.col("phrase").alias("__part"), F.col("f").alias(name))
        return df.withColumn("__part", key).join(found, ["lang", "__part"]).drop("__part")

    def score(left: str, right: str) -> Column:
        a, l, r = (F.col(c).cast("decimal(19,0)") for c in ("f", left, right))
        return F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * (a * a), l * r)

    two = part(part(pairs, words, first, "l"), words, last, "r")
    two = two.select("lang", "phrase", "f", "l", "r", score("l", "r").alias("score"))
    head, tail = F.substring_index("phrase", " ", 2), F.substring_index("phrase", " ", -2)
    three = part(part(triples, words, first, "l1"), pairs, tail, "r1")
    three = part(part(three, pairs, head, "l2"), words, last, "r2")
    three = three.withColumn("s1", score("l1", "r1")).withColumn("s2", score("l2", "r2"))
    early = F.col("s1") <= F.col("s2")
    three = three.select(
        "lang", "phrase", "f", F.when(early, F.col("l1")).otherwise(F.col("l2")).alias("l"),
        F.when(early, F.col("r1")).otherwise(F.col("r2")).alias("r"), F.least("s1", "s2").alias("score"),
    )
    longer = triples.select("lang", F.explode(F.array(head, tail)).alias("phrase"), "f")
    longer = longer.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    two = two.join(longer, ["lang", "phrase"], "left")
    two = two.where(F.col("longer").isNull() | (100 * F.col("longer") < share * F.col("f"))).drop("longer")
    ranked = two.unionByName(three)
    order = [F.col("score").desc(), F.col("f").desc(), F.col("phrase").asc()]
    if top is not None:  # cut within parts first: the last cut sees PARTS times `top` rows of a language at most
        ranked = ranked.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS)))
        ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
        ranked = ranked.where(F.col("rank") <= top)
    ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.join(sizes, "lang").select("lang", "rank", "phrase", F.col("f").alias("a"), "l", "r", "n", F.col("score").cast("long").alias("score"))


SQL = f"""WITH docs AS (SELECT row_number() OVER () AS id, coalesce(lang, 'und') AS lang,
    string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]') AS pieces FROM documents),
  pieces AS (SELECT id, lang, unnest(pieces) AS piece, generate_subscripts(pieces, 1) AS p FROM docs),
  listed AS (SELECT id, lang, p, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
  words AS (SELECT id, lang, p, unnest(w) AS w1, generate_subscripts(w, 1) AS i FROM listed),
  runs AS (SELECT lang, w1, lead(w1) OVER piece AS w2, lead(w1, 2) OVER piece AS w3 FROM words WINDOW piece AS (PARTITION BY id, p ORDER BY i)),
  f AS (SELECT lang, 1 AS k, w1 AS phrase, CAST(count(*) AS HUGEINT) AS f FROM runs GROUP BY ALL
    UNION ALL SELECT lang, 2, w1 || ' ' || w2, CAST(count(*) AS HUGEINT) FROM runs WHERE w2 IS NOT NULL GROUP BY ALL
    UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3, CAST(count(*) AS HUGEINT) FROM runs WHERE w3 IS NOT NULL GROUP BY ALL),
  sizes AS (SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang),
  cand AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= {LEAST}),
  cuts AS (SELECT c.lang, c.k, c.phrase, c.a, cut, array_to_string(w[1:cut], ' ') AS x, array_to_string(w[cut + 1:], ' ') AS y
    FROM cand c, (VALUES (1), (2)) AS t(cut) WHERE cut < c.k),
  scored AS (SELECT cuts.lang, cuts.k, cuts.phrase, a, fl.f AS l, fr.f AS r, cut, 1000000 * a * a // (fl.f * fr.f) AS score FROM cuts
    JOIN f fl ON fl.lang = cuts.lang AND fl.phrase = x AND fl.k = cut JOIN f fr ON fr.lang = cuts.lang AND fr.phrase = y AND fr.k = cuts.k - cut),
  best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
  inner2 AS (SELECT lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase, a AS longer FROM cand WHERE k = 3),
  gone AS (SELECT DISTINCT b.lang, b.phrase FROM best b JOIN inner2 USING (lang, phrase) WHERE b.k = 2 AND 100 * longer >= {SHARE} * b.a),
  ranked AS (SELECT b.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best b ANTI JOIN gone USING (lang, phrase))
  SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
    CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM ranked JOIN sizes USING (lang) WHERE rank <= {TOP}"""


@query("op13_collocations", SQL)
def op13_collocations(spark, sf_dir):
    return collocations(read(spark, sf_dir, "documents"))
