"""Toxicity by a factorization machine over hashed terms.

A text's terms are its lower-cased words and their beginnings of 4 to 7 bytes, hashed into
``TERMS`` buckets and taken as present or absent. The machine scores

    sigmoid(w0 + sum w_i + sum over pairs <v_i, v_j>)

so a pair of terms (an insult next to a group) can weigh more than its parts, which additive
weights cannot say. Terms are first chosen by a likelihood-ratio test of their document
frequencies in the labelled texts: those with more evidence than chance gives the best of as
many terms, ``FEWEST`` to ``CHOSEN`` of them. Learning reads a bounded
sample of ``LABELLED`` labelled training rows in hash order of the id; near copies in it (one
component of the exact word 5-gram join) share one row's weight, so a copied text cannot teach its
own words and no other text loses weight. Scoring covers whole texts.

Labels, language, source and id are no inputs of a score: the id only chooses training rows.

Defined results: a NULL or empty text, or one without chosen terms, scores the bias, which is
about the share of toxic rows; without both labels the score is 0; an id with several labels
counts as toxic if any label says so; NULL labels teach nothing; repeated rows score alike;
extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import ragged
from .common import fold, query, read, stored
from .ngram_join import near_duplicates

BITS = 20
TERMS = 1 << BITS
CHOSEN = 4096
FEWEST = 32
LABELLED = 1 << 15
LEAST = 2.5  # weighted documents that must hold a chosen term
FOLDS, HELD = 4, 2
CUT = 0.3
BEGINNINGS = (4, 5, 6, 7)
FACTORS = 8


@dataclass
class Machine:
    """``index`` maps a bucket to its chosen term or -1."""

    index: np.ndarray
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def margins(self, text: np.ndarray, term: np.ndarray, n: int) -> np.ndarray:
        """Margins of ``n`` texts that hold the given (text, chosen term) pairs."""
        out = self.bias + np.bincount(text, self.linear[term], n)
        v = self.factors[term]
        for k in range(v.shape[1]):
            out += 0.5 * (np.bincount(text, v[:, k], n) ** 2 - np.bincount(text, v[:, k] ** 2, n))
        return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def lowered(column: pa.Array) -> Iterator[ragged.Chunk]:
    return ragged.chunks(pc.utf8_lower(pc.fill_null(column.cast(pa.large_string()), "")), 1 << 20)


def terms_of(chunk: ragged.Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Text and bucket of every word and beginning, with repetitions."""
    starts, ends, first = chunk.spans(ragged.SIGNS)
    text = np.repeat(np.arange(chunk.n), np.diff(first))
    texts, hashes = [text], [chunk.hashes(starts, ends)]
    for k in BEGINNINGS:
        longer = ends - starts > k
        texts.append(text[longer])
        hashes.append(ragged.mix(chunk.hashes(starts[longer], starts[longer] + k) + np.uint64(k)))
    return np.concatenate(texts), (np.concatenate(hashes) >> np.uint64(64 - BITS)).astype(np.int64)


def held_terms(chunk: ragged.Chunk, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, chosen term) pairs of a chunk."""
    text, bucket = terms_of(chunk)
    term = index[bucket]
    hit = term >= 0
    pair = np.unique(text[hit] * np.int64(CHOSEN) + term[hit])
    return pair // CHOSEN, pair % CHOSEN


def choose(rows: DataFrame, share: dict[int, float]) -> np.ndarray:
    """Buckets of the chosen terms, most telling first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros((2, TERMS), np.float32)
        for batch in batches:
            ids, toxic = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for chunk in lowered(batch.column(1)):
                text, bucket = terms_of(chunk)
                pair = np.unique(text * np.int64(TERMS) + bucket)
                text, bucket = pair >> BITS, pair & (TERMS - 1)
                part = range(chunk.first, chunk.first + chunk.n)
                weight = np.array([share[ids[i]] for i in part])[text]
                side = np.array([int(toxic[i] > 0) for i in part])[text]
                found += np.bincount(side * TERMS + bucket, weight, 2 * TERMS).reshape(2, TERMS).astype(np.float32)
        at = np.flatnonzero(found.sum(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(at.astype(np.int32)), pa.array(found[0, at].astype(float)), pa.array(found[1, at].astype(float))],
            ["bucket", "clean", "toxic"],
        )

    counted = rows.select("doc_id", "text", "label").mapInArrow(run, "bucket int, clean double, toxic double")
    counted = stored(counted.groupBy("bucket").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")))
    n1 = sum(share[r.doc_id] for r in rows.where("label > 0").select("doc_id").collect())
    n0 = sum(share.values()) - n1
    n = F.col("clean") + F.col("toxic")
    # Evidence in nats that a term's texts are not a random share of all texts.
    rate = n1 / (n0 + n1)
    seen = [(F.col("toxic"), rate), (F.col("clean"), 1 - rate)]
    nats = sum(F.when(k > 0, k * F.log(k / (n * share_))).otherwise(0.0) for k, share_ in seen)
    tested = counted.where(n >= LEAST).select("bucket", nats.alias("nats"))
    best = tested.orderBy(F.desc("nats"), "bucket").limit(CHOSEN).collect()
    bar = np.log(max(tested.count(), 1))  # what the luckiest of as many random terms reaches
    return np.array([r.bucket for i, r in enumerate(best) if r.nats >= bar or i < FEWEST], np.int64)


def learn(text: np.ndarray, term: np.ndarray, label: np.ndarray, share: np.ndarray, n_terms: int) -> tuple:
    """Bias, linear weights and factors by Adam on the weighted logistic loss, in seeded order."""
    draw = np.random.default_rng(11)
    n = len(label)
    first = np.searchsorted(text, np.arange(n + 1))
    width = int(np.diff(first).max(initial=1)) or 1
    grid = np.full((n, width), n_terms)  # the last term is a pad of weight zero
    grid[text, np.arange(len(text)) - first[text]] = term
    rate = np.clip(np.average(label, weights=share), 1e-3, 1 - 1e-3)
    bias = np.array([np.log(rate / (1 - rate))])
    params = [bias, np.zeros(n_terms + 1), draw.normal(0, 0.05, (n_terms + 1, FACTORS))]
    params[2][-1] = 0
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in params]
    step = 0
    for epoch in range(40):
        for part in np.array_split(draw.permutation(n), max(1, n // 256)):
            held = grid[part]
            w, v = params[1][held], params[2][held]
            total = v.sum(axis=1)
            margin = params[0][0] + w.sum(axis=1) + 0.5 * ((total**2).sum(axis=1) - (v**2).sum(axis=(1, 2)))
            slope = (sigmoid(margin) - label[part]) * share[part] / share[part].sum()
            grads = [np.array([slope.sum()]), np.zeros(n_terms + 1), np.zeros((n_terms + 1, FACTORS))]
            np.add.at(grads[1], held, slope[:, None])
            np.add.at(grads[2], held, slope[:, None, None] * (total[:, None, :] - v))
            grads[1] += 2e-4 * params[1]
            grads[2] += 2e-3 * params[2]
            grads[1][-1] = grads[2][-1] = 0
            step += 1
            pace = 0.02 / (1 + epoch / 10)
            for p, g, (a, b) in zip(params, grads, moments):
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                p -= pace * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)
    return float(params[0][0]), params[1][:-1], params[2][:-1]


def fit(docs: DataFrame, labels: DataFrame, size: int = LABELLED) -> Machine:
    none = Machine(np.full(TERMS, -1, np.int32), -np.inf, np.zeros(1), np.zeros((1, FACTORS)))
    known = labels.select("doc_id", F.col("toxic").alias("label")).where("doc_id is not null and label is not null")
    known = known.where(fold("doc_id", FOLDS) != HELD).groupBy("doc_id").agg(F.max("label").alias("label"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(size)
    # At most `size` rows of two numbers, so the hint is within a proven bound.
    rows = stored(docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id"))

    copies = near_duplicates(rows).groupBy("doc_id").agg(F.min("component_id").alias("copy"))
    signed = copies.join(F.broadcast(sample), "doc_id").select("doc_id", "copy", "label").toPandas()
    if not 0 < (signed["label"] > 0).mean() < 1:
        return none
    # Near copies (compared exactly) with the same label share one row's weight. Repeated ids are one row.
    weight = 1 / signed.groupby(["copy", "label"])["doc_id"].transform("size")
    share = dict(zip(signed["doc_id"].tolist(), weight.tolist()))
    chosen = choose(rows, share)
    index = none.index
    index[chosen] = np.arange(len(chosen))

    def hold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in lowered(batch.column(1)):
                text, term = held_terms(chunk, index)
                ids = batch.column(0).slice(chunk.first, chunk.n).to_numpy(zero_copy_only=False)
                columns = [pa.array(ids[text]), pa.array(term.astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "term"])

    held = rows.select("doc_id", "text").mapInArrow(hold, "doc_id long, term int").distinct().toPandas()
    signed = signed.sort_values("doc_id", ignore_index=True)
    ids = signed["doc_id"].to_numpy()
    held = held.sort_values(["doc_id", "term"])
    text = np.searchsorted(ids, held["doc_id"].to_numpy())
    labelled = (signed["label"] > 0).to_numpy(float)
    shares = np.array([share[i] for i in ids.tolist()])
    return Machine(index, *learn(text, held["term"].to_numpy(np.int64), labelled, shares, max(len(chosen), 1)))


SCHEMA = "doc_id long, held_out boolean, score double, predicted int"


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in lowered(batch.column(2)):
                text, term = held_terms(chunk, machine.index)
                value = sigmoid(machine.margins(text, term, chunk.n)) if np.isfinite(machine.bias) else np.zeros(chunk.n)
                columns = [batch.column(i).slice(chunk.first, chunk.n) for i in (0, 1)]
                columns += [pa.array(value), pa.array((value >= CUT).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in SCHEMA.split(", ")])

    rows = docs.select(F.col("doc_id").cast("long"), (fold("doc_id", FOLDS) == HELD).alias("held_out"), "text")
    return rows.mapInArrow(run, SCHEMA)


@query("op7_toxicity")
def op7_toxicity(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    return score(docs, fit(docs, read(spark, sf_dir, "labels")))
