"""Benchmark decontamination with an Aho-Corasick automaton.

Test items and texts are normalised alike: A-Z lower-cased, words of ASCII letters and digits
and non-ASCII characters, one space between words. Every run of ten consecutive item words (the
whole item when it is shorter) is a window. All windows go into one automaton, which reads each
normalised batch of texts once, from end to end; a match is mapped back through the word starts
to words and bytes of the original text. Items go to the tasks in blocks of at most
``BLOCK_CHARS`` characters, one automaton per block, so a benchmark of any size is searched.

Defined results: a NULL or empty text has no words, no hits and the digest of an empty list; an
item without words has no windows; items with the same id count once; an item with a NULL id
marks words and is left out of the digest; repeated documents are scanned alike; extra columns
are carried by ``scan`` and ignored by the query; empty tables give no rows or no hits.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import ragged
from .common import query, read, released

WINDOW = 10
BLOCK_CHARS = 1 << 25
NORMAL = np.where(ragged.SIGNS, 0x20, ragged.LOWER).astype(np.uint8)

SPANS = T.ArrayType(
    T.StructType(
        [
            T.StructField("item_id", T.StringType()),
            T.StructField("first_word", T.LongType()),
            T.StructField("n_words", T.LongType()),
            T.StructField("start_byte", T.LongType()),
            T.StructField("end_byte", T.LongType()),
        ]
    )
)
ARROW_SPAN = pa.struct(
    [("item_id", pa.string()), ("first_word", pa.int64()), ("n_words", pa.int64()), ("start_byte", pa.int64()), ("end_byte", pa.int64())]
)


def item_words(text: str | None) -> list[str]:
    """Normalised words, as Latin-1 readings of their UTF-8 bytes."""
    data = NORMAL[np.frombuffer((text or "").encode(), np.uint8)]
    return [w for w in data.tobytes().decode("latin-1").split(" ") if w]


@lru_cache(maxsize=2)
def automaton_of(items: tuple[tuple[str | None, str | None], ...]) -> ahocorasick.Automaton:
    """Windows of the items; each holds its number of words and the items it is from."""
    windows: dict[str, tuple[int, list]] = {}
    for item_id, text in items:
        words = item_words(text)
        n = min(len(words), WINDOW)
        for i in range(len(words) - n + 1 if n else 0):
            entry = windows.setdefault(f" {' '.join(words[i : i + n])} ", (n, []))
            if item_id not in entry[1]:
                entry[1].append(item_id)
    automaton = ahocorasick.Automaton()
    for window, entry in windows.items():
        automaton.add_word(window, entry)
    automaton.make_automaton()
    return automaton


def normal_text(chunk: ragged.Chunk, starts: np.ndarray, ends: np.ndarray, first: np.ndarray) -> tuple[str, np.ndarray]:
    """A chunk's texts as ``" w1 w2 ... wn \\n"``, and where each word begins in it."""
    sizes = ends - starts
    text = np.repeat(np.arange(chunk.n), np.diff(first))
    before = np.arange(len(starts)) + 1 + 2 * text  # separators ahead of each word
    upto = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(sizes, out=upto[1:])
    begins = upto[:-1] + before
    out = np.full(upto[-1] + len(starts) + 2 * chunk.n, 0x20, np.uint8)
    out[upto[first[1:]] + first[1:] + 2 * np.arange(1, chunk.n + 1) - 1] = 10
    inside = ~ragged.SIGNS[chunk.data]
    out[np.arange(upto[-1]) + np.repeat(before, sizes)] = NORMAL[chunk.data[inside]]
    return out.tobytes().decode("latin-1"), begins


def matches(chunk: ragged.Chunk, automaton: ahocorasick.Automaton) -> tuple[np.ndarray, list[list[tuple]]]:
    """Words per text, and per text its spans: overlapping windows of one item are joined."""
    starts, ends, first = chunk.spans(ragged.SIGNS)
    found: list[list[tuple]] = [[] for _ in range(chunk.n)]
    if len(automaton) and len(starts):
        normal, begins = normal_text(chunk, starts, ends, first)
        open_spans: dict = {}
        hits = [(end, entry) for end, entry in automaton.iter(normal)]
        last_words = np.searchsorted(begins, [end for end, _ in hits], side="right") - 1
        runs = []
        for last, (_, (n, items)) in zip(last_words.tolist(), hits):
            for item in items:
                run = open_spans.get(item)
                if run is not None and last - n + 1 <= run[2] and run[1] >= first[np.searchsorted(first, last, "right") - 1]:
                    run[1], run[2] = min(run[1], last - n + 1), last + 1
                else:
                    open_spans[item] = run = [item, last - n + 1, last + 1]
                    runs.append(run)
        for item, lo, hi in runs:
            text = int(np.searchsorted(first, lo, side="right")) - 1
            base = chunk.bounds[text]
            found[text].append((item, lo - first[text], hi - lo, starts[lo] - base, ends[hi - 1] - base))
    return np.diff(first), found


def scan(docs: DataFrame, items: DataFrame, carry: list[str], names: tuple[str, str] = ("n_words", "spans")) -> DataFrame:
    """``carry`` columns, ``n_words`` and ``spans`` (item, words and bytes of the original text)
    under the given names.

    Items are read to the driver in blocks, each block scanning the texts once more.
    """
    rows = items.select(F.col("item_id").cast("string").alias("item"), "text").distinct()
    blocks: list[list] = [[]]
    size = 0
    for row in rows.orderBy("item", "text").toLocalIterator():
        size += len(row.text or "")
        if size > BLOCK_CHARS and blocks[-1]:
            blocks.append([])
            size = len(row.text or "")
        blocks[-1].append((row.item, row.text))
    kept = list(dict.fromkeys([*carry, "text"]))
    out = docs.select(*kept, F.lit(0).cast("long").alias("__n"), F.array().cast(SPANS).alias("__spans"))
    for block in blocks:
        out = _scan_block(out, tuple(block))
    return out.select(*carry, F.col("__n").alias(names[0]), F.col("__spans").alias(names[1]))


def _scan_block(df: DataFrame, block: tuple) -> DataFrame:
    place = df.columns.index("text")
    names = df.columns
    columns = names[:-2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = automaton_of(block)
        for batch in batches:
            for chunk in ragged.chunks(batch.column(place)):
                part = batch.slice(chunk.first, chunk.n)
                n_words, found = matches(chunk, automaton)
                if any(found):
                    before = part.column(len(columns) + 1).to_pylist()
                    keys = [f.name for f in ARROW_SPAN]
                    found = [[*a, *(dict(zip(keys, span)) for span in b)] for a, b in zip(before, found)]
                    spans = pa.array(found, pa.list_(ARROW_SPAN))
                else:
                    spans = part.column(len(columns) + 1)
                yield pa.RecordBatch.from_arrays([*part.columns[: len(columns)], pa.array(n_words), spans.cast(pa.list_(ARROW_SPAN))], names)

    return df.mapInArrow(released(run), df.schema)


def hit_words(spans: Column) -> Column:
    """Words inside any span."""
    each = F.transform(spans, lambda s: F.sequence(s["first_word"], s["first_word"] + s["n_words"] - 1))
    return F.size(F.array_distinct(F.flatten(each))).cast("long")


def report(docs: DataFrame, items: DataFrame) -> DataFrame:
    found = scan(docs.select(F.col("doc_id").cast("long"), "text"), items, ["doc_id"])
    ids = F.array_sort(F.array_distinct(F.array_compact(F.transform("spans", lambda s: s["item_id"]))))
    return found.select(
        "doc_id",
        "n_words",
        hit_words(F.col("spans")).alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


NORMAL_SQL = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

SQL = f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, {NORMAL_SQL} AS w FROM documents),
  b AS (SELECT item_id, {NORMAL_SQL} AS w FROM benchmark),
  bw AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS win
    FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
      FROM (SELECT item_id, w, least(len(w), {WINDOW}) AS n FROM b WHERE len(w) > 0))),
  dw AS (SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS win
    FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i
      FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
  hits AS (SELECT r, i, n, item_id FROM dw JOIN bw USING (n, win)),
  words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r),
  found AS (SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
    FROM hits GROUP BY r)
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
  FROM d LEFT JOIN words USING (r) LEFT JOIN found USING (r)"""


@query("op4_decontamination", SQL)
def op4_decontamination(spark, sf_dir):
    return report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
