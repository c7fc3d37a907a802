"""Fill-in-middle: texts cut at two drawn places, their parts in another order.

A unit is a code point. The UTF-8 bytes of many texts are viewed as words of eight bytes; shifts
mark, in the lowest bit of its byte, every byte that ends a unit (the next byte begins one).
``bitwise_count`` gives the units of a word and their running sum the units before it, so the
place where unit k ends is a search in that sum and a select among the marks of one word. No
text is decoded, and nothing is kept per character.

Places, form and order follow from the id alone, so every run and every layout of the rows
gives the same result. ``restore`` rebuilds a text from output and form: the three parts hold
none of the markers, and no marker can arise where a part meets one.

Defined results: a NULL text is empty, an empty text has 0 units and stays plain; a NULL id is
hashed as no digits; repeated rows come out alike; a very long text is one chunk of bytes;
extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import query, read
from .ragged import chunks

MARKS = (b"<P>", b"<S>", b"<M>")
PLAIN_FROM = 90  # of 100
SPM_BELOW = 20  # of 100

_LANES = np.uint64(0x0101010101010101)
_ONE = np.uint64(1)


class Units:
    """Where the units of UTF-8 bytes end."""

    def __init__(self, data: np.ndarray):
        words = np.zeros(len(data) // 8 + 1, "<u8")  # at least one byte of padding
        words.view(np.uint8)[: len(data)] = data
        follows = (words >> np.uint64(7)) & ~(words >> np.uint64(6)) & _LANES  # bytes 10xxxxxx
        begins = follows ^ _LANES
        after = np.append(begins[1:], _LANES)
        ends = (begins >> np.uint64(8)) | (after << np.uint64(56))
        ends[-1] &= (_ONE << np.uint64(8 * (len(data) % 8))) - _ONE  # the padding ends nothing
        self.ends = ends
        self.before = np.zeros(len(ends) + 1, np.int64)
        np.cumsum(np.bitwise_count(ends), out=self.before[1:])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Units that end in the first ``at`` bytes."""
        word = at >> 3
        below = (_ONE << ((at & 7) * 8).astype(np.uint64)) - _ONE
        return self.before[word] + np.bitwise_count(self.ends[word] & below)

    def select(self, k: np.ndarray) -> np.ndarray:
        """Bytes up to the end of unit ``k``, counted from 1; 0 bytes for unit 0."""
        word = np.maximum(np.searchsorted(self.before, k, side="left") - 1, 0)
        marks, left = self.ends[word], k - self.before[word]
        for _ in range(7):  # drop the marks of earlier units of the word
            earlier = left > 1
            marks = np.where(earlier, marks & (marks - _ONE), marks)
            left = left - earlier
        lowest = marks & (~marks + _ONE)
        return np.where(k > 0, word * 8 + (np.bitwise_count(lowest - _ONE) >> 3) + 1, 0)


def draws(id: int | None, n: int) -> tuple[int, int, int, int]:
    """Two places among ``n`` units, and two draws below 100."""
    digest = hashlib.sha256(f"1:{'' if id is None else id}".encode()).digest()
    h = [int.from_bytes(digest[i : i + 4]) for i in (0, 4, 8, 12)]
    return h[0] % (n + 1), h[1] % (n + 1), h[2] % 100, h[3] % 100


def fill_in_middle(docs: DataFrame) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` of every document."""
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for chunk in chunks(batch.column(1)):
                own = ids[chunk.first : chunk.first + chunk.n]
                units = Units(chunk.data)
                upto = units.rank(chunk.bounds)
                n = np.diff(upto)
                drawn = [draws(i, size) for i, size in zip(own, n.tolist())]
                cuts = np.array([d[:2] for d in drawn], np.int64)
                low, high = cuts.min(axis=1), cuts.max(axis=1)
                first, second = units.select(upto[:-1] + low), units.select(upto[:-1] + high)
                data, rows = chunk.data.tobytes(), []
                for i, (_, _, plain, spm) in enumerate(drawn):
                    start, end = chunk.bounds[i], chunk.bounds[i + 1]
                    text = data[start:end]
                    if not text or plain >= PLAIN_FROM or any(mark in text for mark in MARKS):
                        rows.append((own[i], n[i], "plain", None, None, text))
                        continue
                    a, b = first[i] - start, second[i] - start
                    prefix, middle, suffix = text[:a], text[a:b], text[b:]
                    form = "spm" if spm < SPM_BELOW else "psm"
                    if form == "psm":
                        parts = (MARKS[0], prefix, MARKS[1], suffix, MARKS[2], middle)
                    else:
                        parts = (MARKS[1], suffix, MARKS[0], prefix, MARKS[2], middle)
                    rows.append((own[i], n[i], form, low[i], high[i] - low[i], b"".join(parts)))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restore(output: Column, form: Column) -> Column:
    """The text from an output and its form."""
    parts = F.split(output, "<[PSM]>")
    psm = F.concat(F.get(parts, 1), F.get(parts, 3), F.get(parts, 2))
    spm = F.concat(F.get(parts, 2), F.get(parts, 3), F.get(parts, 1))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


SQL = """WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || CAST(doc_id AS VARCHAR)) AS s FROM documents),
  h AS (SELECT doc_id, t, length(t) AS n, CAST('0x' || substr(s, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(s, 9, 8) AS BIGINT) AS h2,
    CAST('0x' || substr(s, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(s, 25, 8) AS BIGINT) AS h4 FROM d),
  c AS (SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
      WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
  p AS (SELECT *, left(t, a) AS prefix, substr(t, a + 1, b - a) AS middle, substr(t, b + 1) AS suffix FROM c)
  SELECT doc_id, CAST(n AS BIGINT) AS n, form, CAST(CASE WHEN form <> 'plain' THEN a END AS BIGINT) AS prefix_chars,
    CAST(CASE WHEN form <> 'plain' THEN b - a END AS BIGINT) AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
      ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
    sha256(t) AS restored_sha256 FROM p"""


@query("op12_fill_in_middle", SQL)
def op12_fill_in_middle(spark, sf_dir):
    made = fill_in_middle(read(spark, sf_dir, "documents"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )
