"""Personal data: fixed patterns as seeds, and identifiers that their contexts give away.

Base spans are what four fixed patterns find (mail addresses, network addresses, card and phone
numbers). They seed a bootstrap over all texts:

* A *slot* is a place for one identifier; its lexical patterns are the two words before it, the
  word on either side, and the two words after it (lower-cased; words with a digit or an ``@``
  count as one word). A *candidate* is a word with a digit, ``@`` or ``(at)``, or a run of such
  words made of digits and signs, that is no base span; its shape says which kinds it fits.
* Patterns and instances are the two sides of a graph whose links are counted over all
  documents. A pattern's confidence in a kind is the score of its slots' instances over *all*
  words that stand in such slots anywhere in the corpus, so "the _ of" is worth nothing however
  many numbers it holds. An instance's score is one minus the chance that all its confident
  patterns are wrong. Seeds score one; ``ROUNDS`` rounds spread scores back and forth as joins.
* An instance with a confident pattern is an identifier, and all its occurrences become spans.

Which patterns have instances enough reaches the counting tasks as a table of ``SLOTS`` bits; a
bit set by another pattern costs a count too many and changes no result. Instances are kept as
64-bit hashes, so no personal data is written to intermediate tables; patterns likewise, with
their words beside them for the report. Scores are whole millionths, so that sums do not depend
on the order of rows.

Defined results: a NULL text is empty and has no spans; repeated rows come out alike; a very long
text is scanned whole, in time linear in its length; an identifier of more than ``LONGEST``
characters fits no kind by shape (base spans have no limit); of two kinds with equal scores the
first listed is taken; an added span never overlaps a base span; NULL ids are kept; extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import query, read, stored
from .ragged import LEADS, SPACES, Chunk, chunks, mix

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 3
SUPPORT = 3  # different instances that a confident pattern has at least
CONFIDENT = 800_000  # millionths
SMOOTH = 1  # slots without an identifier that every pattern is charged with
LONGEST = 254
SLOTS = 1 << 24
SHOWN = 40  # characters of a word in a reported pattern

# -- fixed patterns ----------------------------------------------------------------------

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_NOT_LOCAL = re.compile(r"[^A-Za-z0-9._%+-]")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_ANY = re.compile(r"[0-9@]")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Each ``@`` with the longest run of local characters before it: a pattern that starts with
    such a run would try it again from every character."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done:  # back over blocks, so that a long run costs its length once
            block = max(done, start - 64)
            cut = max((m.end() for m in _NOT_LOCAL.finditer(text, block, start)), default=-1)
            if cut >= 0:
                start = cut
                break
            start = block
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            yield start, match.end()
            done = match.end()
        else:
            done = at + 1  # no later match can begin before this sign
        at = text.find("@", done)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(kind, start, end)`` by kind, then start; code points, end exclusive."""
    if not _ANY.search(text):
        return []
    out = [(0, *span) for span in _emails(text)]
    for match in _IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or "0") <= 255 for part in match.group().split(".")):
            out.append((1, *match.span()))
    for match in _CARD.finditer(text):
        if match.end() - match.start() >= 16:
            digits = _digits(match.group())
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append((2, *match.span()))
    for match in _PHONE.finditer(text):
        if 8 <= len(_digits(match.group())) <= 15:
            out.append((3, *match.span()))
    return out


# -- slots and their patterns ------------------------------------------------------------

_AT_SIGN = re.compile(rb"[(\[]at[)\]]", re.I)
_EMAIL_SHAPE = re.compile(r"[^@\s]+(?:@|[(\[]at[)\]])[^@\s]*[^@\s.]", re.I)
_IP_SHAPE = re.compile(r"[0-9A-Fa-f]{1,4}(?:(?:\.|::?|\[\.\])[0-9A-Fa-f]{1,4}){3,7}")
_CARD_SHAPE = re.compile(r"[0-9][0-9 ._/-]*[0-9]")
_PHONE_SHAPE = re.compile(r"[+(]?[0-9][0-9 ()./-]*[0-9]")
_OUTSIDE = ".,;:!?\"'<>[]{}"

_ID_BYTES = np.zeros(256, np.int64)
_ID_BYTES[0x30:0x3A] = _ID_BYTES[0x40] = 1
_SIGN_BYTES = np.zeros(256, np.int64)
_SIGN_BYTES[[*range(0x30, 0x3A), *b"+().-/"]] = 1

_IDENTIFIER, _EDGE = np.uint64(0x1D), np.uint64(0xED)
_FACTORS = [np.uint64(f) for f in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)]


def fits(shape: str) -> int:
    """Bits of the kinds that a candidate may be."""
    if len(shape) > LONGEST:
        return 0
    digits = len(_digits(shape))
    out = 1 if _EMAIL_SHAPE.fullmatch(shape) else 0
    out |= 2 if _IP_SHAPE.fullmatch(shape) else 0
    out |= 4 if 12 <= digits <= 19 and _CARD_SHAPE.fullmatch(shape) else 0
    return out | (8 if 7 <= digits <= 15 and _PHONE_SHAPE.fullmatch(shape) else 0)


def instance(text: str) -> int:
    """Hash of an identifier without case, spaces and signs that only group its digits."""
    plain = re.sub(r"[\s()+/-]", "", text.lower())
    if not re.search("[^0-9.]", plain) and plain.count(".") != 3:
        plain = plain.replace(".", "")
    return int(np.uint64(xxhash.xxh64_intdigest(plain)).astype(np.int64))


class Slots:
    """Words of a chunk and the patterns of the places between them."""

    def __init__(self, chunk: Chunk):
        data = chunk.data
        self.starts, self.ends, self.first = chunk.spans(SPACES)
        sums = np.zeros(len(data) + 1, np.int64)
        np.cumsum(_ID_BYTES[data], out=sums[1:])
        self.is_id = sums[self.ends] > sums[self.starts]
        signs = np.fromiter((m.start() for m in _AT_SIGN.finditer(data.tobytes())), np.int64)
        if len(signs):
            self.is_id[np.searchsorted(self.starts, signs, side="right") - 1] = True
        np.cumsum(_SIGN_BYTES[data], out=sums[1:])
        self.only_signs = self.is_id & (sums[self.ends] - sums[self.starts] == self.ends - self.starts)
        h = chunk.hashes(self.starts, self.ends, lower=True)
        h[self.is_id] = _IDENTIFIER
        # Two words before the first and after the last word of a text stand for its edges.
        text = np.repeat(np.arange(chunk.n), np.diff(self.first))
        self.low, self.high = self.first[:-1][text], self.first[1:][text]
        self.h = np.concatenate([h, np.full(2, _EDGE, np.uint64)])

    def _word(self, i: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return np.where((i >= low) & (i < high), self.h[np.clip(i, 0, len(self.h) - 1)], _EDGE)

    def patterns(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Hashes of the three patterns of slots that hold words ``i`` to ``j``."""
        low, high = self.low[i], self.high[i]
        b2, b1 = self._word(i - 2, low, high), self._word(i - 1, low, high)
        a1, a2 = self._word(j + 1, low, high), self._word(j + 2, low, high)
        f = _FACTORS
        out = [b2 * f[0] + b1 * f[1] + np.uint64(1), b1 * f[1] + a1 * f[2] + np.uint64(2), a1 * f[2] + a2 * f[3] + np.uint64(3)]
        return np.stack([mix(x) for x in out], axis=1).view(np.int64)


def _shown(words: list[str], i: int, j: int) -> list[str]:
    def word(k: int) -> str:
        if not 0 <= k < len(words):
            return "^" if k < 0 else "$"
        return "<id>" if re.search(r"[0-9@]|[(\[]at[)\]]", words[k], re.I) else words[k][:SHOWN].lower()

    return [f"{word(i - 2)} {word(i - 1)} _", f"{word(i - 1)} _ {word(j + 1)}", f"_ {word(j + 1)} {word(j + 2)}"]


_SLOT = pa.struct([
    ("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("fits", pa.int32()), ("instance", pa.int64()),
    ("wide", pa.bool_()), ("patterns", pa.list_(pa.int64())), ("shown", pa.list_(pa.string())),
])
_SPAN = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])
_SPANS = "array<struct<kind int, start int, end int>>"
_SCHEMA = f"doc_id long, base {_SPANS}, slots array<struct<kind int, start int, end int, fits int, instance long, wide boolean, patterns array<long>, shown array<string>>>"


def _scan_chunk(chunk: Chunk) -> tuple[list, list]:
    """Base spans and slots of every text of a chunk."""
    slots = Slots(chunk)
    all_base, all_slots = [], []
    busy = np.add.reduceat(np.append(slots.is_id, False), np.minimum(slots.first[:-1], len(slots.is_id))) if chunk.n else []
    for t in range(chunk.n):
        a, b = int(slots.first[t]), int(slots.first[t + 1])
        if a == b or not busy[t]:
            all_base.append([])
            all_slots.append([])
            continue
        raw = chunk.data[chunk.bounds[t] : chunk.bounds[t + 1]]
        text = raw.tobytes().decode()
        byte_of = np.append(np.flatnonzero(LEADS[raw]), len(raw))  # first byte of a code point
        starts, ends = slots.starts[a:b] - chunk.bounds[t], slots.ends[a:b] - chunk.bounds[t]
        word_from = np.searchsorted(byte_of, starts)
        word_to = np.searchsorted(byte_of, ends)
        base = base_spans(text)
        found = []  # kind, start, end, fits, first word, last word
        taken = np.zeros(len(starts), bool)
        for kind, start, end in base:
            i = int(np.searchsorted(word_from, start, side="right")) - 1
            j = int(np.searchsorted(word_from, end - 1, side="right")) - 1
            taken[i : j + 1] = True
            found.append((kind, start, end, 0, i, j))
        free = np.flatnonzero(slots.is_id[a:b] & ~taken)
        k = 0
        while k < len(free):
            i = j = int(free[k])
            k += 1
            while k < len(free) and free[k] == j + 1 and slots.only_signs[a + j] and slots.only_signs[a + j + 1] and text[word_to[j] : word_from[j + 1]] == " ":
                j += 1
                k += 1
            start, end = int(word_from[i]), int(word_to[j])
            whole = text[start:end]
            left = whole.lstrip(_OUTSIDE)
            start, whole = start + len(whole) - len(left), left.rstrip(_OUTSIDE)
            if whole.startswith("(") and whole.endswith(")"):
                start, whole = start + 1, whole[1:-1]
            bits = fits(whole)
            if bits:
                found.append((-1, start, start + len(whole), bits, i, j))
        rows = []
        if found:
            i, j = np.array([x[4] for x in found]), np.array([x[5] for x in found])
            hashes = slots.patterns(a + i, a + j).tolist()
            words = {x: text[word_from[x] : word_to[x]] for f in found for x in range(max(f[4] - 2, 0), min(f[5] + 3, b - a))}
            listed = _Listed(words, b - a)
            for (kind, start, end, bits, i, j), h in zip(found, hashes):
                rows.append({
                    "kind": kind, "start": start, "end": end, "fits": bits, "instance": instance(text[start:end]),
                    "wide": j > i, "patterns": h, "shown": _shown(listed, i, j),
                })
        all_base.append([{"kind": k, "start": s, "end": e} for k, s, e in base])
        all_slots.append(rows)
    return all_base, all_slots


class _Listed:
    """Some words of a text by their number."""

    def __init__(self, words: dict[int, str], n: int):
        self.words, self.n = words, n

    def __len__(self) -> int:
        return self.n

    def __getitem__(self, k: int) -> str:
        return self.words[k]


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id, base, slots`` of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                base, slots = _scan_chunk(chunk)
                columns = [batch.column(0).slice(chunk.first, chunk.n), pa.array(base, pa.list_(_SPAN)), pa.array(slots, pa.list_(_SLOT))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "base", "slots"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, _SCHEMA)


def pattern_totals(docs: DataFrame, table: np.ndarray) -> DataFrame:
    """``pattern, n``: how many words stand in the slots of patterns whose bit is set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(0)):
                slots = Slots(chunk)
                at = np.arange(len(slots.starts))
                found = slots.patterns(at, at).ravel()
                slot = found & (SLOTS - 1)
                set_ = (table[slot >> 6] >> (slot & 63).astype(np.uint64)) & np.uint64(1) == 1
                pattern, n = np.unique(found[set_], return_counts=True)
                if len(pattern):
                    yield pa.RecordBatch.from_arrays([pa.array(pattern), pa.array(n.astype(np.int64))], ["pattern", "n"])

    counted = docs.select(F.col("text").cast("string")).mapInArrow(run, "pattern long, n long")
    return counted.groupBy("pattern").agg(F.sum("n").alias("n"))


def _bits(patterns: DataFrame) -> np.ndarray:
    """Set bits of the patterns' slots; the driver receives ``SLOTS / 64`` rows at most."""
    slot = F.col("pattern").bitwiseAND(F.lit(SLOTS - 1))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (slot % 64).cast("int"))
    rows = patterns.groupBy(F.shiftright(slot, 6).alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
    table = np.zeros(SLOTS // 64, np.int64)
    table[rows["word"].to_numpy()] = rows["bits"].to_numpy()
    return table.view(np.uint64)


def _fitting(bits: Column) -> Column:
    """The kinds of a set of bits as rows."""
    kinds = F.array(*[F.when(bits.bitwiseAND(1 << k) > 0, F.lit(k)) for k in range(len(KINDS))])
    return F.explode(F.array_compact(kinds))


def bootstrap(docs: DataFrame, found: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame] | None:
    """``instance, kind, score`` of identifiers found by patterns, and the confident patterns
    (``pattern, kind, words, confidence, instances``); None where no pattern has enough of them."""
    slots = found.select(F.explode("slots").alias("s")).select("s.*")
    each = slots.select("kind", "fits", "instance", "wide", F.explode(F.arrays_zip("patterns", "shown")).alias("p"))
    links = each.groupBy(F.col("p.patterns").alias("pattern"), "instance").agg(
        F.count("*").alias("n"), F.count_if("wide").alias("n_wide"), F.min("p.shown").alias("words"),
    )
    links = stored(links)
    enough = links.groupBy("pattern").agg(
        F.count("*").alias("instances"), F.sum("n_wide").alias("n_wide"), F.min("words").alias("words"),
    )
    enough = stored(enough.where(F.col("instances") >= SUPPORT))
    if enough.isEmpty():
        return None
    two_sided = ~F.col("words").startswith("_") & ~F.col("words").endswith("_")
    totals = pattern_totals(docs, _bits(enough)).join(enough, "pattern").select(
        "pattern", "words",
        # A slot of several words has no single word in it: one between two words is counted here.
        (F.col("n") + F.when(two_sided, F.col("n_wide")).otherwise(0) + SMOOTH).alias("total"),
    )
    totals = stored(totals)
    links = stored(links.join(totals.select("pattern"), "pattern").select("pattern", "instance", "n"))
    seeds = slots.where("kind >= 0").select("instance", "kind").distinct()
    may_be = stored(slots.where("kind < 0").select("instance", _fitting(F.col("fits")).alias("kind")).distinct())
    scores = stored(seeds.select("instance", "kind", F.lit(1_000_000).cast("long").alias("score")))
    known = scores
    for _ in range(rounds):
        sums = links.join(scores, "instance").groupBy("pattern", "kind")
        sums = sums.agg(F.sum(F.col("n") * F.col("score")).alias("sum"), F.count("*").alias("instances"))
        confidence = F.least(F.call_function("div", F.col("sum"), F.col("total")), F.lit(999_999))
        patterns = sums.join(totals, "pattern").select("pattern", "kind", "words", confidence.alias("confidence"), "instances")
        patterns = stored(patterns.where((F.col("confidence") >= CONFIDENT) & (F.col("instances") >= SUPPORT)))
        wrong = F.round(-F.log(1 - F.col("confidence") / 1_000_000) * 1_000_000).cast("long")
        reached = links.join(patterns.select("pattern", "kind", wrong.alias("wrong")), "pattern").groupBy("instance", "kind")
        reached = reached.agg(F.sum("wrong").alias("wrong")).join(may_be, ["instance", "kind"])
        reached = reached.select("instance", "kind", F.floor(1_000_000 * (1 - F.exp(-F.col("wrong") / 1_000_000))).alias("score"))
        both = known.unionByName(reached.select("instance", "kind", F.col("score").cast("long")))
        scores = stored(both.groupBy("instance", "kind").agg(F.max("score").alias("score")))
    return scores.where(F.col("score") >= CONFIDENT), patterns


def personal_data(docs: DataFrame) -> DataFrame:
    """``doc_id, base, spans`` of every row: arrays of ``kind, start, end``, by kind and start."""
    # The row number is stored with the row, so a lost task cannot change it.
    found = stored(scan(docs).withColumn("row", F.monotonically_increasing_id()))
    learned = bootstrap(docs, found)
    if learned is None:
        return found.select("doc_id", "base", F.col("base").alias("spans"))
    scores = learned[0].select("instance", F.struct("score", (-F.col("kind")).alias("order"), "kind").alias("judged"))
    open_ = found.select("row", F.explode("slots").alias("s")).where("s.kind < 0").select("row", "s.start", "s.end", "s.fits", "s.instance")
    added = open_.join(scores, "instance").where(F.expr("shiftright(fits, judged.kind) & 1 = 1"))
    added = added.groupBy("row", "start", "end").agg(F.max("judged").alias("judged"))
    added = added.groupBy("row").agg(F.collect_list(F.struct(F.col("judged.kind").alias("kind"), "start", "end")).alias("added"))
    spans = F.when(F.col("added").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", "added")))
    return found.drop("slots").join(added, "row", "left").select("doc_id", "base", spans.alias("spans"))


def listed(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


@query("op11_personal_data")
def op11_personal_data(spark, sf_dir):
    found = personal_data(read(spark, sf_dir, "documents"))
    counts = [F.expr(f"cast(size(filter(base, s -> s.kind = {k})) as long) as n_{name}") for k, name in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(listed(F.col("base")), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))
