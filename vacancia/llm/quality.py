"""Quality rules: base counts of a text, and a likelihood ratio of hashed word n-grams.

Two multinomials over ``BUCKETS`` hashed words and word pairs are counted: one over every
document (raw corpus), one over the documents labelled good (trusted target). A text's score
is the sum of ``log(target / raw)`` over its n-grams divided by their number; texts below a
threshold are rejected. The threshold is the score that separates the labelled good from the
labelled bad texts with the least balanced error (of equals the lowest), so the same tables
always give the same verdicts. For it, a labelled text is scored by a target without its own
fold: the texts are dealt into ``FOLDS`` by a hash of their text, so that copies share one. Without bad
or without good labels nothing is rejected by score.

The raw counts cover all texts. Labels are read from a bounded sample, ``labelled`` rows in
hash order of the id, whose ids go to every task; no text is shuffled.

Defined results: a NULL or empty text has no words and fails the base; a text without n-grams
has a NULL score; repeated rows are judged alike; ids with several labels count by the worst;
extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import ragged
from .common import query, read, stored

BITS = 16
BUCKETS = 1 << BITS
LABELLED = 1 << 15
FOLDS = 8
MIN_WORDS = 50
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True

BASE_SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, llr double"
)


def buckets_of(h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of a chunk's words and word pairs, each with the first index per text."""
    pairs, pair_first = ragged.grams(h, first, 2)
    shift = np.uint64(64 - BITS)
    return (h >> shift).astype(np.int64), first, (pairs >> shift).astype(np.int64), pair_first


def scores_of(h: np.ndarray, first: np.ndarray, weights: np.ndarray) -> np.ndarray:
    words, word_first, pairs, pair_first = buckets_of(h, first)
    total = ragged.sums_between(weights[words], word_first) + ragged.sums_between(weights[pairs], pair_first)
    n = np.diff(word_first) + np.diff(pair_first)
    return np.where(n > 0, total / np.maximum(n, 1), np.nan)


def labelled_sample(labels: DataFrame, column: str, size: int = LABELLED) -> DataFrame:
    """At most ``size`` ids with their smallest non-NULL label, in hash order of the id."""
    rows = labels.select("doc_id", F.col(column).alias("label")).where("doc_id is not null and label is not null")
    return rows.groupBy("doc_id").agg(F.min("label").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(size)


def gram_counts(docs: DataFrame, folds: int = 1) -> np.ndarray:
    """Counts of all hashed n-grams of all texts, per fold if ``docs`` has a column ``fold``.

    One row per task, fold and bucket is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(folds * BUCKETS, np.int64)
        for batch in batches:
            fold = batch.column(1).to_numpy(zero_copy_only=False)
            for chunk in ragged.chunks(batch.column(0)):
                starts, ends, first = chunk.spans(ragged.SPACES)
                words, word_first, pairs, pair_first = buckets_of(chunk.hashes(starts, ends), first)
                at = fold[chunk.first : chunk.first + chunk.n].astype(np.int64) * BUCKETS
                for grams, bounds in ((words, word_first), (pairs, pair_first)):
                    total += np.bincount(grams + np.repeat(at, np.diff(bounds)), minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["bucket", "n"])

    fold = F.col("fold") if folds > 1 else F.lit(0)
    texts = docs.select("text", fold.cast("int").alias("fold"))
    counted = texts.mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(folds * BUCKETS)
    for row in counted.collect():  # at most folds * BUCKETS rows
        out[row.bucket] = row.n
    return out.reshape(folds, BUCKETS)


def threshold_of(scores: np.ndarray, good: np.ndarray) -> float:
    """Lowest score from which on keeping makes the least balanced error."""
    if not good.any() or good.all():
        return -np.inf
    order = np.argsort(scores, kind="stable")
    scores, good = scores[order], good[order]
    lost = np.concatenate([[0], np.cumsum(good)]) / good.sum()
    passed = 1 - np.concatenate([[0], np.cumsum(~good)]) / (~good).sum()
    error = lost + passed
    error[1:-1][scores[1:] == scores[:-1]] = np.inf  # no cut between equal scores
    at = int(np.argmin(error))
    if at == 0:
        return -np.inf
    return float(scores[at - 1] + (scores[min(at, len(scores) - 1)] - scores[at - 1]) / 2)


def fit(docs: DataFrame, labels: DataFrame, size: int = LABELLED) -> tuple[np.ndarray, float]:
    """Weights per bucket and the threshold."""
    sample = labelled_sample(labels, "quality", size)
    # At most `size` rows of two numbers, so the hint is within a proven bound.
    fold = F.pmod(F.xxhash64("text"), F.lit(FOLDS)).cast("int").alias("fold")
    known = stored(docs.select("doc_id", "text", fold).join(F.broadcast(sample), "doc_id"))
    raw = gram_counts(docs)[0] + 1.0
    by_fold = gram_counts(known.where("label > 0"), FOLDS)
    base = np.log(raw / raw.sum())

    def weights_of(counts: np.ndarray) -> np.ndarray:
        target = counts + 1.0
        return np.log(target / target.sum()) - base

    weights = weights_of(by_fold.sum(0))
    unseen = [weights_of(by_fold.sum(0) - own) for own in by_fold]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels_ = batch.column(1).to_numpy(zero_copy_only=False)
            folds = batch.column(2).to_numpy(zero_copy_only=False)
            for chunk in ragged.chunks(batch.column(0)):
                starts, ends, first = chunk.spans(ragged.SPACES)
                h, part = chunk.hashes(starts, ends), folds[chunk.first : chunk.first + chunk.n]
                score = np.full(chunk.n, np.nan)
                for fold in np.unique(part):
                    mine = part == fold
                    score[mine] = scores_of(h, first, unseen[fold])[mine]
                label = labels_[chunk.first : chunk.first + chunk.n].astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(score), pa.array(label)], ["score", "label"])

    # At most `size` rows.
    rows = known.select("text", "label", "fold").mapInArrow(run, "score double, label int").toPandas()
    rows = rows[np.isfinite(rows["score"])]
    return weights, threshold_of(rows["score"].to_numpy(float), rows["label"].to_numpy() > 0)


def repeated_items(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Which items have an equal one in their text."""
    text = np.repeat(np.arange(len(first) - 1), np.diff(first)).astype(np.uint64)
    key = ragged.mix(h + text * np.uint64(0xC2B2AE3D27D4EB4F))
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    out = np.zeros(len(h), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def repeat_words(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Per text the words inside 3-word windows that the text holds at least twice."""
    windows, window_first = ragged.grams(h, first, 3)
    again = np.flatnonzero(repeated_items(windows, window_first))
    text = np.searchsorted(window_first, again, side="right") - 1
    at = again - window_first[text] + first[text]
    covered = np.zeros(len(h), bool)
    for k in range(3):
        covered[at + k] = True
    return ragged.sums_between(covered, first)


def duplicate_lines(chunk: ragged.Chunk, word_starts: np.ndarray) -> np.ndarray:
    """Per text the lines with a word that equal an earlier line."""
    starts, ends, _ = chunk.spans(ragged.NEWLINE)
    full = np.searchsorted(word_starts, ends) > np.searchsorted(word_starts, starts)
    starts, ends = starts[full], ends[full]
    first = np.searchsorted(starts, chunk.bounds)
    text = np.repeat(np.arange(chunk.n), np.diff(first))
    key = ragged.mix(chunk.hashes(starts, ends) + text.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    _, kept = np.unique(key, return_index=True)
    return np.diff(first) - np.bincount(text[kept], minlength=chunk.n)


def judge(docs: DataFrame, weights: np.ndarray, threshold: float) -> DataFrame:
    """One row per document with the base counts, the score and the verdict."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in ragged.chunks(batch.column(1)):
                starts, ends, first = chunk.spans(ragged.SPACES)
                h = chunk.hashes(starts, ends)
                leads = ragged.LEADS[chunk.data] & ~ragged.SPACES[chunk.data]
                n_words, repeats = np.diff(first), repeat_words(h, first)
                failed = (n_words < MIN_WORDS) | (100 * repeats > 50 * n_words)
                score = scores_of(h, first, weights)
                kept = ~failed & ~(score < threshold)
                columns = [
                    batch.column(0).slice(chunk.first, chunk.n),
                    pa.array(n_words),
                    pa.array(chunk.sums(leads)),
                    pa.array(chunk.sums(SYMBOLS[chunk.data])),
                    pa.array(duplicate_lines(chunk, starts)),
                    pa.array(repeats),
                    pa.array(failed),
                    pa.array(kept),
                    pa.array(score, mask=np.isnan(score)),
                ]
                names = [x.split()[0] for x in BASE_SCHEMA.split(", ")]
                yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, BASE_SCHEMA)


@query("op1_quality_rules")
def op1_quality_rules(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return judge(docs, *fit(docs, read(spark, sf_dir, "labels")))
