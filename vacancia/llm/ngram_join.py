"""Near duplicates by an exact Jaccard join of word 5-gram sets, at 0.75 or more.

Two linked sets of sizes x >= y differ in at most ``(x + y) / 7`` members. The join follows the
partition scheme of exact set joins: sets are sorted into size bands so that a set's partners
lie in its own band or the next; in each band the universe of 5-grams is cut by hash into more
segments than linked sets can have differences, so linked sets agree on whole segments. In
bands of small sets a segment also stands for its one-deletion neighbours (itself without one
member), which makes it count for two differences.

1. Every set is hashed once. Exact copies share a set id and are one vertex from then on.
2. Every task packs the segment fingerprints of its sets by fingerprint range; each range is
   sorted in one task. Fingerprints held by ``COMMON`` sets or fewer give all their pairs with
   the number of shared segments. More common ones give a star around one set, and their
   members are listed.
3. Allocation by cost: a set must be tried on as many segments as linked sets can differ in,
   plus one, and may leave out the rest. It leaves out its commonest. Pairs that share fewer
   segments than linked sets must are dropped before any set is looked at.
4. Parity vectors of the sets rule out most of the remaining pairs; the sets of the others are
   fetched (a Bloom filter of bounded size keeps other texts from being shingled) and compared
   exactly.
5. Sets that still need common segments are tried against the members that the links so far
   have not yet joined to them: first around the set with most common segments, then all, in
   blocks, again by sizes and parities first.
   Sets whose segments cannot cover the allowed differences (many empty ones) are tried on
   every single 5-gram instead, so no link is lost.

Defined results: a NULL or empty text, or one without words, has the empty set, links with
nothing and is its own component; fewer than five words are one shingle; repeated rows and equal
sets are one class; a NULL id never names a component that has another id; extra columns are
ignored; an empty table gives an empty result. Set ids are 64-bit fingerprints.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import ragged
from .common import query, read, stored
from .graph import components

WORDS = 5
SMALL = 64  # largest set of the bands with one-deletion neighbours
COMMON = 16
RANGE_ROWS = 1 << 21  # fingerprints sorted by one task
STEP = 1 << 22  # bytes of text shingled at a time
BLOOM_BITS = 1 << 27
PLACES = 512
PART = 4096


def band_limits(upto: int) -> np.ndarray:
    """Least size of each band: partners of a set lie in its band or the next one."""
    out = [1]
    while out[-1] <= upto:
        out.append(out[-1] * 4 // 3 + 1)
    return np.array(out)


def most_different(n: np.ndarray) -> np.ndarray:
    """Members in which a set of ``n`` and a linked one of at most ``n`` can differ."""
    return 2 * n // 7


def segments_of(band: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Segments of a band, and whether it has one-deletion neighbours."""
    largest = limits[band + 1] - 1
    differ = most_different(largest)
    small = largest <= SMALL
    many = np.ceil(1.1 * differ + 2 * np.sqrt(differ) + 3).astype(np.int64)
    return np.where(small, differ + 2, many), small


def shingle_sets(chunk: ragged.Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text, sorted, and each text's first one (n + 1)."""
    starts, ends, first = chunk.spans(ragged.SPACES)
    h = chunk.hashes(starts, ends, lower=True)
    grams, bounds = ragged.grams(h, first, WORDS)
    sets = [np.unique(grams[bounds[i] : bounds[i + 1]]) for i in range(chunk.n)]
    for n in range(1, WORDS):  # shorter texts are one shingle
        for i in np.flatnonzero(np.diff(first) == n):
            sets[i] = ragged.grams(h[first[i] : first[i + 1]], np.array([0, n]), n)[0]
    size = np.array([len(s) for s in sets], np.int64)
    out = np.zeros(len(sets) + 1, np.int64)
    np.cumsum(size, out=out[1:])
    return (np.concatenate(sets) if sets else np.zeros(0, np.uint64)), out


def set_ids(shingles: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Fingerprint of each set, as a signed integer."""
    spread = ragged.mix(shingles ^ np.uint64(0xA5A5A5A55A5A5A5A))
    total = np.zeros(len(spread) + 1, np.uint64)
    np.cumsum(spread, out=total[1:])
    size = np.diff(first).astype(np.uint64)
    return ragged.mix(total[first[1:]] - total[first[:-1]] + size * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)


def fingerprints(shingles: np.ndarray, first: np.ndarray, band: np.ndarray, limits: np.ndarray):
    """Segment fingerprints of the sets in the given bands.

    Returns fingerprints, the set each belongs to, and per set the differences its segments
    cover (a segment one, with its one-deletion neighbours two).
    """
    n_sets = len(first) - 1
    size = np.diff(first)
    owner = np.repeat(np.arange(n_sets), size)
    count, small = segments_of(band, limits)
    spread = ragged.mix(shingles + band[owner].astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
    segment = ((spread >> np.uint64(32)) * count[owner].astype(np.uint64)) >> np.uint64(32)
    place = (owner.astype(np.uint64) << np.uint64(32)) | segment
    order = np.argsort(place, kind="stable")
    place, spread = place[order], ragged.mix(spread[order])
    opens = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]])) if len(place) else np.zeros(0, np.int64)
    totals = np.add.reduceat(spread, opens) if len(opens) else np.zeros(0, np.uint64)
    held = np.diff(np.append(opens, len(place)))
    where = place[opens]
    of = (where >> np.uint64(32)).astype(np.int64)
    salt = ragged.mix((where & np.uint64(0xFFFFFFFF)) | (band[of].astype(np.uint64) << np.uint64(32)))
    found, owners = [ragged.mix(totals ^ salt)], [of]
    doubled = small[of] & (held > 1)
    if doubled.any():
        member = np.repeat(np.arange(len(opens)), held)
        use = doubled[member]
        member = member[use]
        found.append(ragged.mix((totals[member] - spread[use]) ^ salt[member]))
        owners.append(of[member])
    cover = np.bincount(of, 1 + doubled, n_sets).astype(np.int64)
    return np.concatenate(found), np.concatenate(owners), cover


def _bands(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    limits = band_limits(int(n.max(initial=1)) * 2)
    limits = np.append(limits, limits[-1] * 4 // 3 + 1)
    return np.searchsorted(limits, n, side="right") - 1, limits


def members(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, n, set_id, cover, uncovered`` of every document; the empty set has
    no id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in ragged.chunks(batch.column(2), STEP):
                shingles, first = shingle_sets(chunk)
                n = np.diff(first)
                full = n > 0
                cover, bare = np.zeros(chunk.n, np.int64), np.zeros(chunk.n, bool)
                if full.any():
                    band, limits = _bands(n[full])
                    cover[full] = fingerprints(shingles, first[np.append(np.flatnonzero(full), chunk.n)], band, limits)[2]
                    bare[full] = cover[full] <= most_different(n[full])
                columns = [*batch.slice(chunk.first, chunk.n).columns[:2], pa.array(n)]
                columns += [pa.array(set_ids(shingles, first), mask=~full), pa.array(cover), pa.array(bare)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "n", "set_id", "cover", "uncovered"])

    schema = "doc_id long, text_hash long, n long, set_id long, cover long, uncovered boolean"
    return docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), "text").mapInArrow(run, schema)


def planes(values: np.ndarray, width: int) -> bytes:
    """The low ``width`` bytes of 64-bit values, one plane per byte, highest first: the high
    bytes of sorted values compress to almost nothing."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8)[:, :width][:, ::-1].T).tobytes()


def unplaned(data: np.ndarray, width: int) -> np.ndarray:
    wide = np.zeros((len(data) // width, 8), np.uint8)
    wide[:, :width] = data.reshape(width, -1).T[:, ::-1]
    return wide.view(np.uint64).ravel()


def packed(docs: DataFrame, bits: int) -> DataFrame:
    """Segment fingerprints by range: ``range, prints, ids, marks``, ten or eleven bytes a row.

    A row is 40 bits of the fingerprint below the range bits, 40 bits of the set's id, and a
    byte with its role (odd: as smaller partner of the next band) and the logarithm of its size.
    Rows that agree by accident only make candidates, which are compared exactly.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edge = np.arange((1 << bits) + 1).astype(np.uint64)
        for batch in batches:
            for chunk in ragged.chunks(batch.column(0), STEP):
                shingles, first = shingle_sets(chunk)
                ids, n = set_ids(shingles, first), np.diff(first)
                _, one = np.unique(ids, return_index=True)
                one = np.sort(one[n[one] > 0])  # the distinct sets of the chunk
                if not len(one):
                    continue
                keep = np.zeros(chunk.n, bool)
                keep[one] = True
                shingles = shingles[np.repeat(keep, n)]
                ids, n = ids[one].view(np.uint64), n[one]
                first = np.concatenate([[0], np.cumsum(n)])
                band, limits = _bands(n)
                own, of, _ = fingerprints(shingles, first, band, limits)
                above, of_above, _ = fingerprints(shingles, first, band + 1, limits)
                prints, of = np.concatenate([own, above]), np.concatenate([of, of_above])
                role = np.concatenate([np.zeros(len(own), np.uint8), np.ones(len(above), np.uint8)])
                order = np.argsort(prints)
                prints, of, role = prints[order], of[order], role[order]
                edges = np.searchsorted(prints >> np.uint64(64 - bits) if bits else prints * np.uint64(0), edge)
                mark = (size_class(n)[of] << 1).astype(np.uint8) | role
                low = (prints << np.uint64(bits)) >> np.uint64(24)  # the 40 bits below the range
                spans = [(r, edges[r], edges[r + 1]) for r in range(1 << bits) if edges[r + 1] > edges[r]]
                columns = [
                    pa.array([r for r, _, _ in spans], pa.int32()),
                    pa.array([planes(low[a:b], 5) for _, a, b in spans], pa.binary()),
                    pa.array([planes(ids[of[a:b]], 5) for _, a, b in spans], pa.binary()),
                    pa.array([mark[a:b].tobytes() for _, a, b in spans], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["range", "prints", "ids", "marks"])

    return docs.select("text").mapInArrow(run, "range int, prints binary, ids binary, marks binary")


def size_class(n: np.ndarray) -> np.ndarray:
    """Logarithm of a size to the base 1.12, at most 127: sizes a factor 4/3 apart or closer
    differ by at most 4 classes."""
    return np.minimum(np.log(np.maximum(n, 1)) / np.log(1.12), 127).astype(np.int64)


PAIR, STAR, LISTED = 0, 1, 2
MEET_SCHEMA = "kind int, a long, b long, n int, own boolean"


def meet(table: pa.Table) -> pa.Table:
    """Pairs, stars and lists of the sets (40-bit ids) that share a fingerprint of one range.

    ``PAIR``: sets ``a`` and ``b`` share ``n`` segments. ``STAR``: ``b`` shares a common segment
    with ``a``. ``LISTED``: set ``a`` holds the common fingerprint ``b``, held by ``n`` sets;
    ``own`` if it does so in its own size band.
    """
    read_ = lambda name: [np.frombuffer(v.as_buffer(), np.uint8) for v in table.column(name)]
    prints = np.concatenate([unplaned(x, 5) for x in read_("prints")])
    ids = np.concatenate([unplaned(x, 5) for x in read_("ids")])
    marks = np.concatenate(read_("marks"))
    order = np.argsort(prints)
    prints = prints[order]
    same = prints[1:] == prints[:-1]
    shared = np.append(same, False) | np.append(False, same)
    order, prints = order[shared], prints[shared]
    ids, marks = ids[order].astype(np.int64), marks[order]
    # Copies of a set are one holder.
    order = np.lexsort((marks & 1, ids, prints))
    prints, ids, marks = prints[order], ids[order], marks[order]
    new = np.ones(len(prints), bool)
    new[1:] = (prints[1:] != prints[:-1]) | (ids[1:] != ids[:-1])
    prints, ids, own, size = prints[new], ids[new], marks[new] & 1 == 0, (marks[new] >> 1).astype(np.int64)
    opens = np.flatnonzero(np.concatenate([[True], prints[1:] != prints[:-1]])) if len(prints) else np.zeros(0, np.int64)
    held = np.diff(np.append(opens, len(prints)))

    def near(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return (own[x] | own[y]) & (np.abs(size[x] - size[y]) <= 4)

    pairs = []
    for k in range(2, COMMON + 1):
        base = opens[held == k]
        for i in range(k):
            for j in range(i + 1, k):
                left, right = base + i, base + j
                use = near(left, right)
                pairs.append(np.column_stack([ids[left[use]], ids[right[use]]]))
    pairs = np.concatenate(pairs)
    pairs, n = np.unique(pairs, axis=0, return_counts=True) if len(pairs) else (pairs, np.zeros(0, np.int64))

    common = np.flatnonzero(held > COMMON)
    rows = np.concatenate([np.arange(opens[g], opens[g] + held[g]) for g in common]) if len(common) else np.zeros(0, np.int64)
    centre, many = np.repeat(opens[common], held[common]), np.repeat(held[common], held[common])
    use = near(centre, rows) & (centre != rows)
    stars = np.unique(np.column_stack([ids[centre[use]], ids[rows[use]]]), axis=0) if use.any() else np.zeros((0, 2), np.int64)
    whole = prints[rows].astype(np.int64) | (int(table.column("range")[0].as_py()) << 40)

    def made(kind: int, a: np.ndarray, b: np.ndarray, n: np.ndarray, own: np.ndarray) -> pa.Table:
        columns = [np.full(len(a), kind, np.int32), a, b, n.astype(np.int32), own]
        return pa.Table.from_arrays([pa.array(c) for c in columns], ["kind", "a", "b", "n", "own"])

    return pa.concat_tables(
        [
            made(PAIR, pairs[:, 0], pairs[:, 1], n, np.ones(len(pairs), bool)),
            made(STAR, stars[:, 0], stars[:, 1], np.zeros(len(stars)), np.ones(len(stars), bool)),
            made(LISTED, ids[rows], whole, many, own[rows]),
        ]
    )


def bloom(ids: DataFrame) -> np.ndarray:
    """Bits of a column ``id``; at most ``BLOOM_BITS``, so its size is bounded. A full filter
    only lets more sets through."""
    n = ids.count()
    bits = min(max(1 << 16, 1 << (16 * n).bit_length()), BLOOM_BITS)
    spots = F.explode(F.array(F.col("id").bitwiseAND(bits - 1), F.shiftrightunsigned("id", 32).bitwiseAND(bits - 1)))
    words = ids.select(spots.alias("s")).groupBy(F.shiftright("s", 6).alias("w"))
    words = words.agg(F.bit_or(F.expr("shiftleft(1L, int(s & 63))")).alias("v")).toPandas()
    out = np.zeros(bits // 64, np.uint64)
    out[words["w"].to_numpy(np.int64)] = words["v"].to_numpy(np.int64).view(np.uint64)
    return out


def passes(filter_: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Which ids the filter may hold."""
    mask = np.uint64(len(filter_) * 64 - 1)
    ids = ids.view(np.uint64)
    out = np.ones(len(ids), bool)
    for spot in (ids & mask, (ids >> np.uint64(32)) & mask):
        out &= (filter_[spot >> np.uint64(6)] >> (spot & np.uint64(63))) & np.uint64(1) == 1
    return out


def texts_of(docs: DataFrame, rows: DataFrame, ids: DataFrame, schema: str, step: Callable[..., pa.RecordBatch]) -> DataFrame:
    """``step`` over the shingles of the sets ``id``, each once, as a stored table: its first
    column is the set's id. Of equal sets one text is taken; the others are not shingled."""
    ids = ids.select(F.col("id").alias("set_id"))
    chosen = stored(rows.join(ids, "set_id", "left_semi").groupBy("set_id").agg(F.min("text_hash").alias("id")))
    filter_ = bloom(chosen)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(passes(filter_, batch.column(1).to_numpy())))
            for chunk in ragged.chunks(batch.column(0), STEP):
                shingles, first = shingle_sets(chunk)
                ids, n = set_ids(shingles, first), np.diff(first)
                _, one = np.unique(ids, return_index=True)
                yield step(shingles, first, ids, n, one[n[one] > 0])

    found = docs.select("text", F.xxhash64("text").alias("text_hash")).mapInArrow(run, schema)
    return stored(found.dropDuplicates([schema.split()[0]]))


def fetched(docs: DataFrame, rows: DataFrame, ids: DataFrame) -> DataFrame:
    """``set_id, shingles`` of the given sets."""

    def step(shingles: np.ndarray, first: np.ndarray, ids: np.ndarray, n: np.ndarray, one: np.ndarray) -> pa.RecordBatch:
        data = [shingles[first[i] : first[i + 1]].tobytes() for i in one]
        return pa.RecordBatch.from_arrays([pa.array(ids[one]), pa.array(data, pa.binary())], ["set_id", "shingles"])

    return texts_of(docs, rows, ids, "set_id long, shingles binary", step)


def places_of(n: int) -> int:
    return PLACES if n < PLACES else 8 * PLACES if n < 8 * PLACES else 64 * PLACES


def folded(words: np.ndarray, n_words: int) -> np.ndarray:
    """Parities of fewer places: those that fall onto each other by exclusive or."""
    return words if len(words) == n_words else np.bitwise_xor.reduce(words.reshape(-1, n_words), axis=0)


def differing(x: np.ndarray, y: np.ndarray) -> int:
    """Members in which two sets differ at least, by their parities."""
    n_words = min(len(x), len(y))
    return int(np.bitwise_count(folded(x, n_words) ^ folded(y, n_words)).sum(dtype=np.int64))


def parities(docs: DataFrame, rows: DataFrame, ids: DataFrame) -> DataFrame:
    """``a, n, bits`` of the given sets: the parity of their shingles in each of 512 places (more
    for large sets). Two sets differ in at least as many members as their parities in places."""

    def step(shingles: np.ndarray, first: np.ndarray, ids: np.ndarray, n: np.ndarray, one: np.ndarray) -> pa.RecordBatch:
        bits = []
        for i in one:
            places = places_of(n[i])
            at = (shingles[first[i] : first[i + 1]] & np.uint64(places - 1)).astype(np.int64)
            bits.append(np.packbits(np.bincount(at, minlength=places) & 1, bitorder="little").tobytes())
        return pa.RecordBatch.from_arrays([pa.array(ids[one]), pa.array(n[one]), pa.array(bits, pa.binary())], ["a", "n", "bits"])

    return texts_of(docs, rows, ids, "a long, n long, bits binary", step)


def linked(docs: DataFrame, rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs ``a, b`` whose sets have 100 * intersection >= 75 * union.

    Parities, an eighth of a byte to a byte per member, rule out most other pairs first, so
    that few sets are shuffled.
    """

    def may(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column(2).to_numpy() + batch.column(3).to_numpy()
            words = [[np.frombuffer(v.as_buffer(), np.uint64) for v in batch.column(c)] for c in (4, 5)]
            kept = [differing(x, y) <= most // 7 for x, y, most in zip(*words, n.tolist())]
            yield batch.select([0, 1]).filter(pa.array(kept, pa.bool_()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for i in range(batch.num_rows):
                x, y = (np.frombuffer(batch.column(c)[i].as_buffer(), np.uint64) for c in (2, 3))
                both = len(np.intersect1d(x, y, assume_unique=True))
                kept.append(100 * both >= 75 * (len(x) + len(y) - both))
            yield batch.select([0, 1]).filter(pa.array(kept, pa.bool_()))

    def beside(frame: DataFrame, of: DataFrame, id_: str, *columns: str) -> DataFrame:
        """The frame with the columns of its set ``a`` (suffix _a) and of its set ``b``."""
        for side in ("a", "b"):
            frame = frame.join(of.select(F.col(id_).alias(side), *[F.col(c).alias(f"{c}_{side}") for c in columns]), side)
        return frame

    def ids(frame: DataFrame) -> DataFrame:
        return frame.select(F.explode(F.array("a", "b")).alias("id")).distinct()

    pairs = stored(pairs)
    sized = beside(pairs, parities(docs, rows, ids(pairs)), "a", "n", "bits")
    near = stored(sized.select("a", "b", "n_a", "n_b", "bits_a", "bits_b").mapInArrow(may, "a long, b long"))
    both = beside(near, fetched(docs, rows, ids(near)), "set_id", "shingles")
    return stored(both.select("a", "b", "shingles_a", "shingles_b").mapInArrow(run, "a long, b long"))


def ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()


def single_shingle_pairs(docs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs of the uncovered sets with every set that shares a shingle and may be linked."""
    spare = stored(sets.where("uncovered").select("set_id").distinct())

    def shingles_of(filter_: np.ndarray, by_set: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for chunk in ragged.chunks(batch.column(0), STEP):
                    shingles, first = shingle_sets(chunk)
                    n = np.diff(first)
                    ids = np.repeat(set_ids(shingles, first), n)
                    use = passes(filter_, ids if by_set else shingles.view(np.int64))
                    columns = [shingles.view(np.int64)[use], ids[use], np.repeat(n, n)[use]]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["id", "set_id", "n"])

        return docs.select("text").mapInArrow(run, "id long, set_id long, n long").distinct()

    mine = shingles_of(bloom(spare.select(F.col("set_id").alias("id"))), True).join(spare, "set_id", "left_semi")
    mine = stored(mine)
    others = shingles_of(bloom(mine.select("id").distinct()), False)
    others = others.select("id", F.col("set_id").alias("b"), F.col("n").alias("n_b"))
    near = (100 * F.least("n", "n_b") >= 75 * F.greatest("n", "n_b")) & (F.col("set_id") != F.col("b"))
    return ordered(mine.join(others, "id").where(near).select(F.col("set_id").alias("a"), "b"))


def links(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """Links ``a, b`` between set ids: all of them up to ones inside a joined component."""
    sets = rows.where("set_id is not null").groupBy("set_id")
    sets = stored(sets.agg(*[F.min(c).alias(c) for c in ("n", "cover")], F.max("uncovered").alias("uncovered")))
    short_id = F.col("set_id").bitwiseAND((1 << 40) - 1)
    # Units a set's segments cover beyond the differences linked sets can have.
    spare = F.col("cover") - F.floor(2 * F.col("n") / 7)
    sets = sets.select("set_id", "n", "uncovered", spare.alias("spare"), short_id.alias("short"))
    total = rows.agg(F.sum("n")).first()[0] or 0
    bits = max(0, int(np.ceil(np.log2(max(total, 1) / RANGE_ROWS))))
    met = stored(packed(docs, bits).groupBy("range").applyInArrow(meet, MEET_SCHEMA))

    def full(frame: DataFrame, column: str, of: DataFrame = sets) -> DataFrame:
        """40-bit ids to set ids, with the set's other columns."""
        named = of.select(F.col("short").alias(column), *[F.col(c).alias(f"{c}_{column}") for c in of.columns if c not in ("short", "uncovered")])
        return frame.join(named, column).drop(column).withColumnRenamed(f"set_id_{column}", column)

    listed = full(met.where(F.col("kind") == LISTED).withColumnRenamed("b", "print"), "a")
    # In the bands with one-deletion neighbours a fingerprint may stand for two units.
    listed = listed.withColumn("units", F.when(F.col("n_a") <= SMALL + SMALL // 3, 2).otherwise(1))
    listed = stored(listed.select("a", "print", F.col("n").alias("held"), "own", "units", "spare_a"))
    load = listed.where("own").groupBy(F.col("a").alias("set_id")).agg(F.sum("units").alias("load"))
    # Once per set, not once per pair.
    loaded = stored(sets.join(load, "set_id", "left").withColumn("load", F.coalesce("load", F.lit(0))))

    pairs = met.where(F.col("kind") == PAIR).groupBy("a", "b").agg(F.sum("n").alias("shared"))
    pairs = full(full(pairs, "a", loaded), "b", loaded).where("100 * least(n_a, n_b) >= 75 * greatest(n_a, n_b)")
    # Linked sets share all but the differing segments, fewer by those left out as common.
    spare = F.when(F.col("n_a") >= F.col("n_b"), F.col("spare_a")).otherwise(F.col("spare_b"))
    spare = F.when(F.col("n_a") == F.col("n_b"), F.least("spare_a", "spare_b")).otherwise(spare)
    left_out = F.greatest("load_a", "load_b")
    large = F.least("n_a", "n_b") > SMALL
    pairs = pairs.where(~large | (F.col("shared") >= spare - left_out)).select("a", "b")
    stars = full(full(met.where(F.col("kind") == STAR).select("a", "b").distinct(), "a"), "b").select("a", "b")
    pairs = pairs.unionByName(stars)
    if not sets.where("uncovered").isEmpty():
        pairs = pairs.unionByName(single_shingle_pairs(docs, sets))
    found = linked(docs, rows, ordered(pairs))

    if listed.isEmpty():
        return found
    listed = stored(asking(listed))
    for around_heaviest in (True, False):
        labels = components(found)
        rest = stars_between(listed, labels) if around_heaviest else cross_pairs(docs, rows, listed, labels)
        rest = stored(rest.join(found, ["a", "b"], "left_anti"))
        if not rest.isEmpty():
            found = stored(found.unionByName(linked(docs, rows, rest)))
    return found


def asking(listed: DataFrame) -> DataFrame:
    """``a, print, held, asks``: members of common fingerprints, ``asks`` where a set must be
    tried: its other segments are too few, and this is one of its less common ones. Fingerprints
    on which no set must be tried are left out."""
    whole = Window.partitionBy("a")
    upto = whole.orderBy("held", "print").rowsBetween(Window.unboundedPreceding, -1)
    own = listed.where("own")
    # Each set left out costs its units; `missing` of them must be tried after all.
    missing = F.sum("units").over(whole) + 1 - F.col("spare_a")
    asks = F.coalesce(F.sum("units").over(upto), F.lit(0)) < missing
    own = own.select("a", "print", "held", asks.alias("asks"))
    others = listed.where("not own").select("a", "print", "held", F.lit(False).alias("asks"))
    rows = stored(own.unionByName(others))
    return rows.join(rows.where("asks").select("print").distinct(), "print", "left_semi")


def placed(listed: DataFrame, labels: DataFrame) -> DataFrame:
    """Members, with their component, of the fingerprints on which some set must be tried and that
    span several components: a group of near copies that is joined already is left alone."""
    rows = listed.join(labels.select(F.col("id").alias("a"), "label"), "a", "left")
    rows = rows.withColumn("label", F.coalesce("label", "a"))
    spans = rows.groupBy("print").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.max("asks").alias("any"))
    return rows.join(spans.where("any and lo <> hi").select("print"), "print", "left_semi")


def stars_between(listed: DataFrame, labels: DataFrame) -> DataFrame:
    """In each common fingerprint, its set with most common segments and the sets of other
    components."""
    rows = stored(placed(listed, labels))
    rows = rows.join(rows.groupBy("a").agg(F.sum("held").alias("load")), "a")
    head = rows.groupBy("print").agg(F.max(F.struct("load", "a", "label")).alias("head"))
    pairs = rows.join(head, "print").where(F.col("head.label") != F.col("label"))
    return ordered(pairs.select("a", F.col("head.a").alias("b")))


def apart(table: pa.Table) -> pa.Table:
    """Pairs of several blocks (left sets against right sets of one fingerprint) that sizes and
    parities do not rule out."""
    order = table.sort_by([("print", "ascending"), ("i", "ascending"), ("j", "ascending")])
    key = [order.column(c).to_numpy() for c in ("print", "i", "j")]
    new = np.ones(order.num_rows, bool)
    new[1:] = np.any([k[1:] != k[:-1] for k in key], axis=0)
    edges = np.append(np.flatnonzero(new), order.num_rows)
    left, ids, label, n = (order.column(c).to_numpy() for c in ("left", "a", "label", "n"))
    words = [np.frombuffer(x.as_buffer(), np.uint64) for x in order.column("bits")]
    wide = np.array([len(w) > PLACES // 64 for w in words])
    narrow = np.array([folded(w, PLACES // 64) for w in words])
    found = []
    for start, end in zip(edges[:-1], edges[1:]):
        rows = np.arange(start, end)
        mine, theirs = rows[left[rows]], rows[~left[rows]]
        for at in range(0, len(mine), 64):
            x, y = mine[at : at + 64, None], theirs[None, :]
            may = (label[x] != label[y]) & (100 * np.minimum(n[x], n[y]) >= 75 * np.maximum(n[x], n[y]))
            i, j = np.nonzero(may)
            x, y = mine[at + i], theirs[j]
            most = (n[x] + n[y]) // 7
            use = np.bitwise_count(narrow[x] ^ narrow[y]).sum(axis=1, dtype=np.int64) <= most
            x, y, most = x[use], y[use], most[use]
            both = np.flatnonzero(wide[x] & wide[y])
            use = np.ones(len(x), bool)
            for k in both:
                use[k] = differing(words[x[k]], words[y[k]]) <= most[k]
            found.append(np.column_stack([ids[x[use]], ids[y[use]]]))
    pairs = np.concatenate(found) if found else np.zeros((0, 2), np.int64)
    pairs = np.unique(np.sort(pairs, axis=1), axis=0)
    return pa.Table.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])


def cross_pairs(docs: DataFrame, sets: DataFrame, listed: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs of a set that must be tried on a common fingerprint with its members elsewhere.

    The members of a fingerprint are cut into parts of about ``PART`` sets, and each part meets
    each other part in a block of its own.
    """
    rows = stored(placed(listed, labels).select("a", "print", "label", "asks"))
    bits = parities(docs, sets, rows.select(F.col("a").alias("id")).distinct())
    parts = rows.groupBy("print").agg(F.ceil(F.count("*") / PART).cast("int").alias("parts"))
    rows = rows.join(parts, "print").join(bits, "a").withColumn("part", F.pmod(F.xxhash64("a"), "parts").cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    kept = ["print", "a", "label", "n", "bits"]
    left = rows.where("asks").select(*kept, F.col("part").alias("i"), other.alias("j"), F.lit(True).alias("left"))
    right = rows.select(*kept, other.alias("i"), F.col("part").alias("j"), F.lit(False).alias("left"))
    # Many blocks are small: a task takes those of one hash range.
    tasks = 8 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    both = left.unionByName(right).withColumn("range", F.pmod(F.xxhash64("print", "i", "j"), F.lit(tasks)))
    return both.groupBy("range").applyInArrow(apart, "a long, b long").distinct()


def classes(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, n, set_id, label`` of every document: equal labels are one component;
    a document without words has none."""
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    rows = stored(members(docs))
    labels = components(links(docs, rows)).select(F.col("id").alias("set_id"), "label")
    out = rows.join(labels, "set_id", "left").withColumn("label", F.coalesce("label", "set_id"))
    return out.select("doc_id", "text_hash", "n", "set_id", "label")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, set_id, component_id`` of every document."""
    rows = stored(classes(docs))
    least = rows.where("label is not null").groupBy("label").agg(F.min("doc_id").alias("component_id"))
    out = rows.join(least, "label", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), "set_id", F.coalesce("component_id", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """All columns of one document per component: the one of least id (NULL last). Documents
    without words all stay; rows that repeat an id and a text are one document."""
    rows = stored(classes(docs))
    place = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")
    kept = rows.where("label is not null").groupBy("label").agg(F.min(place).alias("p")).select("p.doc_id", "p.text_hash")
    kept = kept.unionByName(rows.where("label is null").select("doc_id", "text_hash")).distinct()
    kept = kept.select(F.col("doc_id").alias("__doc"), F.col("text_hash").alias("__hash"))
    keyed = docs.withColumn("__id", F.col("doc_id").cast("long")).withColumn("__text", F.xxhash64("text"))
    same = F.col("__id").eqNullSafe(F.col("__doc")) & (F.col("__text") == F.col("__hash"))
    return keyed.join(kept, same, "left_semi").dropDuplicates(["__id", "__text"]).drop("__id", "__text")


@query("op8_ngram_join")
def op8_ngram_join(spark, sf_dir):
    return near_duplicates(read(spark, sf_dir, "documents")).drop("set_id")
