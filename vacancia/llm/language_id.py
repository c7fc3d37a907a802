"""Language ID by error-correcting output codes over byte trigrams.

Every learned language has a codeword of bits. For each bit one binary classifier tells the
languages with a 1 from those with a 0: a linear one over hashed byte trigrams of the
lower-cased text, whose weights are log-odds of trigram counts. The counts cover every training
text, are summed per language in one pass, and serve all bits. Decoding compares a text's bit
margins with each codeword: a wrong or weak bit costs a logistic loss, weighted by how reliable
that bit is for that language on a bounded sample of ``SAMPLE`` training texts; the language of
least loss wins. ``score`` is its share under the losses of all codewords, and ``ambiguous``
flags texts whose score is below ``AMBIGUOUS``.

Defined results: a text without a letter, empty or NULL is ``und`` with score 0 and ambiguous;
with no learned language every text is ``und``; NULL languages are never learned; NULL ids count
as training rows; repeated rows are judged alike; ties go to the language first in order; extra
columns are carried; an empty table gives an empty result. Languages are few by nature: their
list and the trigram counts per language are held by the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from . import ragged
from .common import fold, query, read

BITS = 14
BUCKETS = 1 << BITS
FOLDS, HELD = 4, 2
SAMPLE = 1 << 14
AMBIGUOUS = 0.5
UNKNOWN = "und"
STEP = 1 << 20  # bytes of text held as trigrams at a time

#: Lower-cased bytes of letters and digits stay, the rest of ASCII counts as a space.
LETTERS = np.where(ragged.SIGNS, 0x20, ragged.LOWER).astype(np.uint32)


def codewords(n: int) -> np.ndarray:
    """One row of signs per language.

    Up to six languages get the exhaustive code (every split into two groups once); more get,
    of 200 seeded random codes of ``10 log2 n`` bits, the one whose closest rows differ most.
    """
    if n <= 6:
        splits = np.arange(1, 1 << max(n - 1, 0))
        return np.where((splits[None, :] >> np.arange(n)[:, None]) & 1, 1, -1).astype(np.float64)
    width, draw, best, found = int(np.ceil(10 * np.log2(n))), np.random.default_rng(7), -1, None
    for _ in range(200):
        code = draw.choice([-1.0, 1.0], (n, width))
        code = code[:, np.abs(code.sum(axis=0)) < n]
        apart = (code.shape[1] - code @ code.T) / 2
        np.fill_diagonal(apart, width)
        if apart.min() > best:
            best, found = apart.min(), code
    return found


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray  # languages x bits
    weights: np.ndarray  # buckets x bits
    trust: np.ndarray  # languages x bits, rows sum to 1

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest codeword and its share, per row of margins."""
        loss = np.logaddexp(0, -margins[:, None, :] * self.code[None]) * self.trust[None]
        total = loss.sum(axis=2)
        best = total.argmin(axis=1)
        share = np.exp(total.min(axis=1, keepdims=True) - total)
        return best, 1 / share.sum(axis=1)


def trigrams(chunk: ragged.Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Hashed trigrams with at least two letters, and each text's first one (n + 1)."""
    data = LETTERS[chunk.data]
    if len(data) < 3:
        return np.zeros(0, np.int64), np.zeros(chunk.n + 1, np.int64)
    code = (data[:-2] << 16) | (data[1:-1] << 8) | data[2:]
    gap = data == 0x20
    use = (gap[:-2].astype(np.int8) + gap[1:-1] + gap[2:]) < 2
    for back in (1, 2):  # not across texts
        at = chunk.bounds[1:-1] - back
        use[at[(at >= 0) & (at < len(use))]] = False
    at = np.flatnonzero(use)
    bucket = ((code[at] * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)).astype(np.int64)
    return bucket, np.searchsorted(at, chunk.bounds)


def margins_of(chunk: ragged.Chunk, weights: np.ndarray) -> np.ndarray:
    """Summed log-odds per bit over the root of the number of trigrams."""
    bucket, first = trigrams(chunk)
    n = np.diff(first)
    out = np.zeros((chunk.n, weights.shape[1]))
    full = np.flatnonzero(n)
    if len(full):
        out[full] = np.add.reduceat(weights[bucket], first[full], axis=0) / np.sqrt(n[full])[:, None]
    return out


def lowered(batch: pa.RecordBatch, at: int) -> Iterator[ragged.Chunk]:
    return ragged.chunks(pc.utf8_lower(pc.fill_null(batch.column(at).cast(pa.large_string()), "")), STEP)


def trigram_counts(training: DataFrame, languages: list[str]) -> np.ndarray:
    """Counts (languages x buckets) over all training texts."""
    index = {name: i for i, name in enumerate(languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(languages) * BUCKETS, np.int64)
        for batch in batches:
            language = np.array([index[x] for x in batch.column(1).to_pylist()], np.int64)
            for chunk in lowered(batch, 0):
                bucket, first = trigrams(chunk)
                offset = np.repeat(language[chunk.first : chunk.first + chunk.n] * BUCKETS, np.diff(first))
                total += np.bincount(bucket + offset, minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["cell", "n"])

    cells = training.select("text", "lang").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    out = np.zeros(len(languages) * BUCKETS)
    rows = cells.toPandas()  # at most languages x BUCKETS rows
    out[rows["cell"].to_numpy(np.int64)] = rows["n"].to_numpy(float)
    return out.reshape(len(languages), BUCKETS)


def fit(docs: DataFrame) -> Model:
    """Learn from the text and language of the training rows."""
    training = docs.where((fold("doc_id", FOLDS) != HELD) & F.col("lang").isNotNull())
    languages = sorted(row.lang for row in training.select("lang").distinct().collect())
    code = codewords(len(languages))
    if code.shape[1] == 0:
        return Model(languages, code, np.zeros((BUCKETS, 0)), np.ones((len(languages), 0)))
    counts = trigram_counts(training, languages)
    weights = np.zeros((BUCKETS, code.shape[1]))
    for bit in range(code.shape[1]):
        sides = [counts[code[:, bit] == sign].sum(axis=0) + 0.5 for sign in (1, -1)]
        weights[:, bit] = np.log(sides[0] / sides[0].sum()) - np.log(sides[1] / sides[1].sum())
    index = {name: i for i, name in enumerate(languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        right, seen = np.zeros(code.shape), np.zeros(len(languages))
        for batch in batches:
            language = np.array([index[x] for x in batch.column(1).to_pylist()], np.int64)
            for chunk in lowered(batch, 0):
                mine = language[chunk.first : chunk.first + chunk.n]
                np.add.at(right, mine, margins_of(chunk, weights) * code[mine] > 0)
                np.add.at(seen, mine, 1)
        at = np.arange(right.size)
        columns = [pa.array(at), pa.array(right.ravel()), pa.array(np.repeat(seen, code.shape[1]))]
        yield pa.RecordBatch.from_arrays(columns, ["cell", "hit", "n"])

    # A bounded sample in hash order; its ids are at most SAMPLE numbers.
    ids = training.select("doc_id").where("doc_id is not null").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    sample = training.select("doc_id", "text", "lang").join(F.broadcast(ids), "doc_id", "left_semi").select("text", "lang")
    cells = sample.mapInArrow(run, "cell long, hit double, n double").groupBy("cell").agg(F.sum("hit"), F.sum("n"))
    trust = np.full(code.size, 0.5)
    for cell, hit, n in cells.collect():
        trust[cell] = (hit + 0.5) / (n + 1)
    trust = trust.reshape(code.shape)
    return Model(languages, code, weights.astype(np.float32), trust / trust.sum(axis=1, keepdims=True) * code.shape[1])


def predict(docs: DataFrame, model: Model, names: tuple[str, str, str] = ("lang_pred", "score", "ambiguous")) -> DataFrame:
    """All columns of the documents and the predicted language, its score and the flag, under
    the given names."""
    answers = np.array([*model.languages, UNKNOWN], object)
    docs = docs.drop(*names)
    columns = docs.columns
    place = columns.index("text")
    schema = StructType([*docs.schema.fields, *(StructField(n, t) for n, t in zip(names, (StringType(), DoubleType(), BooleanType())))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            has_letter = pc.fill_null(pc.match_substring_regex(batch.column(place), r"\pL"), False)
            has_letter = has_letter.to_numpy(zero_copy_only=False)
            for chunk in lowered(batch, place):
                part = slice(chunk.first, chunk.first + chunk.n)
                known = has_letter[part] & bool(model.languages)
                best, score = np.full(chunk.n, len(model.languages)), np.zeros(chunk.n)
                if model.languages:
                    best, score = model.decode(margins_of(chunk, model.weights))
                best, score = np.where(known, best, len(model.languages)), np.where(known, score, 0.0)
                added = [pa.array(answers[best], pa.string()), pa.array(score), pa.array(score < AMBIGUOUS)]
                yield pa.RecordBatch.from_arrays([*batch.slice(chunk.first, chunk.n).columns, *added], [*columns, *names])

    return docs.mapInArrow(run, schema)


@query("op10_language_id")
def op10_language_id(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    rows = docs.select(F.col("doc_id").cast("long"), (fold("doc_id", FOLDS) == HELD).alias("held_out"), "text")
    return predict(rows, fit(docs)).drop("text")
