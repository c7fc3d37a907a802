"""Byte-level BPE with Spark's higher-order functions: encoding to ids and back.

A text is cut into pre-tokens by the vocabulary's pattern, and a fold merges the bytes of each.
The state of the fold is an array with a long per symbol: the rank of the pair that it makes
with the next one, its place and its id. The least long is the leftmost pair of the lowest rank;
a round merges it and ranks its two neighbours again, until no pair has a rank. A pre-token of
more than ``SHORT`` bytes is a string of symbols instead, one character each (the id above a
fixed code point), and a round replaces all occurrences of its lowest pair from the left, so
that long runs take few rounds.

Pair ranks are a constant of the plan, as are the symbols: a table of longs in which the pairs
of a left id stand at its own offset plus their right id, since Spark's own map type searches
its keys one by one. The constants are scalar subqueries, which the optimizer folds into the one
expression that reads them: they travel with the tasks and never with the rows.

The corpus' distinct pre-tokens are counted, and those frequent enough to be among about
``FREQUENT`` are folded once and looked up; the others are folded where they stand. The limit
bounds the table sent to the tasks and never changes an id. Texts are not shuffled.

Ids stay arrays of ints from the fold on: a text's words are flattened once. Decoding maps ids to
byte pieces and concatenates them; a piece is a Latin-1 string, one character a byte.

Defined results: a NULL or empty text has no ids and decodes to nothing; repeated rows are
encoded alike; a very long text or pre-token is folded like any other; extra columns are carried
by ``encode``; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import query, read, stored

RANKS = "byte_bpe_50k.tiktoken"
SLOTS = 1 << 19
FREQUENT = 1 << 19
WORD_SLOTS = 1 << 20
BASE = 0x10000  # code point of id 0: beyond it no code point is reserved

SHORT = 64  # bytes
RANK = 46  # a rank stands from this bit on, a place from bit 16 on, an id below
NO_RANK = 1 << 62
PLACE = 0x3FFFFFFF << 16

#: Characters of the Unicode property White_Space, which ``\s`` of the pattern stands for.
WHITE = "\\t-\\r \\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}"


def java_pattern() -> str:
    """The vocabulary's pattern with ``\\s`` and ``\\S`` spelled out for Java's regex."""
    pattern = public_tokenizers.PATTERN.replace("[^\\s", f"[^{WHITE}")
    return pattern.replace("\\S", f"[^{WHITE}]").replace("\\s", f"[{WHITE}]")


@lru_cache(maxsize=2)
def constants(name: str) -> tuple[list[int], list[int], list[int], list[str], list[str]]:
    """Pair table, each left id's offset in it, ids of the 256 bytes, symbols of all ids, and
    their bytes as Latin-1. An entry of the table is a left id and, in its low 16 bits, the rank."""
    with open(public_tokenizers.path(name), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    size = max(ranks.values()) + 1
    assert size <= 1 << 16
    pairs: dict[int, list[tuple[int, int]]] = {}
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
            if left is not None and right is not None:
                pairs.setdefault(left, []).append((right, rank))
    table, offsets, draw = np.full(SLOTS + size, -1, np.int64), np.zeros(size, np.int64), np.random.default_rng(1)
    for left, found in sorted(pairs.items(), key=lambda x: -len(x[1])):  # long rows first, each at a free offset
        right, rank = np.array(found).T
        for _ in range(1_000_000):
            at = int(draw.integers(SLOTS))
            if (table[at + right] < 0).all():
                break
        else:
            raise ValueError("pair table too small")
        table[at + right] = (left << 16) | rank
        offsets[left] = at
    pieces = [""] * size
    for token, rank in ranks.items():
        pieces[rank] = token.decode("latin-1")
    symbols = [chr(BASE + i) for i in range(size)]
    return table.tolist(), offsets.tolist(), [ranks[bytes([b])] for b in range(256)], symbols, pieces


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` evaluated once: a fold over no rows whose last step is ``body``."""
    return F.aggregate(F.expr("cast(array() as array<int>)"), value, lambda v, _: v, body)


def constant(spark: SparkSession, values: list, kind: str) -> Column:
    """A list as a constant of the plan."""
    return spark.createDataFrame(pd.DataFrame({"v": [values]}), f"v array<{kind}>").scalar()


def tables(spark: SparkSession, name: str) -> Column:
    pairs, offsets, of_byte, symbols, _ = constants(name)
    kinds = {"pairs": (pairs, "bigint"), "offsets": (offsets, "int"), "of_byte": (of_byte, "bigint"), "symbols": (symbols, "string")}
    return F.struct(*[constant(spark, values, kind).alias(k) for k, (values, kind) in kinds.items()])


def rank_of(t: Column, left: Column, right: Column) -> Column:
    """Rank of two neighbouring ids from bit ``RANK`` on, ``NO_RANK`` without one."""
    entry = F.get(t["pairs"], F.get(t["offsets"], left.cast("int")) + right.cast("int"))
    found = lambda e: F.when(F.shiftright(e, 16) == left, F.shiftleft(e.bitwiseAND(0xFFFF), RANK))
    return let(entry, lambda e: found(e).otherwise(F.lit(NO_RANK)))


def id_of(entry: Column) -> Column:
    return entry.bitwiseAND(0xFFFF)


def bytes_of(t: Column, word: Column) -> Column:
    """Ids of the bytes of a pre-token."""
    letters = F.split(F.decode(F.encode(word, "UTF-8"), "ISO-8859-1"), "")
    return F.transform(letters, lambda c: F.get(t["of_byte"], F.ascii(c)))


def written(t: Column, codes: Column) -> Column:
    """Ids as a string of symbols."""
    return F.array_join(F.transform(codes, lambda c: F.get(t["symbols"], c.cast("int"))), "")


def rounds(word: Column) -> Column:
    return F.sequence(F.lit(1), F.greatest(F.octet_length(word) - 1, F.lit(1)))


def ranked(t: Column, codes: Column) -> Column:
    """A long per symbol: rank of its pair with the next one, place, id."""

    def beside(c: Column) -> Column:
        placed = F.transform(c, lambda x, i: F.shiftleft(i.cast("bigint"), 16) + x)
        last = F.lit(NO_RANK)
        return F.zip_with(placed, F.slice(c, 2, F.size(c)), lambda x, b: x + F.when(b.isNull(), last).otherwise(rank_of(t, id_of(x), b)))

    return let(codes, beside)


def merge_first(t: Column, entries: Column) -> Column:
    """One round: the leftmost pair of the lowest rank becomes a symbol."""

    def with_best(best: Column) -> Column:
        def with_at(at: Column) -> Column:
            made, after, n = F.shiftright(best, RANK), F.get(entries, at + 1), F.size(entries)
            merged = best.bitwiseAND(PLACE) + made + F.when(after.isNull(), F.lit(NO_RANK)).otherwise(rank_of(t, made, id_of(after)))
            both = let(F.get(entries, at - 2).bitwiseAND(PLACE + 0xFFFF), lambda b: F.array(b + rank_of(t, id_of(b), made), merged))
            first = F.concat(F.array(merged), F.slice(entries, 3, n))
            return F.when(at == 1, first).otherwise(F.concat(F.slice(entries, 1, at - 2), both, F.slice(entries, at + 2, n)))

        # Counted by place: array_position leaves its loop by an exception, which costs more than a short array.
        place = best.bitwiseAND(PLACE)
        before = let(place, lambda p: F.size(F.filter(entries, lambda e: e.bitwiseAND(PLACE) < p)))
        return F.when(best >= NO_RANK, entries).otherwise(let(before + 1, with_at))

    return let(F.array_min(entries), with_best)


def merge_all(t: Column, word: Column) -> Column:
    """One round on a string of symbols, for all pairs of the lowest rank; NULL when nothing merges."""

    def with_symbols(s: Column) -> Column:
        codes = F.transform(s, lambda c: (F.ascii(c) - BASE).cast("bigint"))

        def with_entries(e: Column) -> Column:
            def with_best(best: Column) -> Column:
                at = F.array_position(e, best).cast("int")
                pair = F.concat(F.get(s, at - 1), F.get(s, at))
                return F.when(best < NO_RANK, F.replace(word, pair, F.get(t["symbols"], F.shiftright(best, RANK).cast("int"))))

            return let(F.array_min(e), with_best)

        return let(ranked(t, codes), with_entries)

    return let(F.split(word, ""), with_symbols)


def fold_long(t: Column, word: Column) -> Column:
    start = F.struct(written(t, bytes_of(t, word)).alias("word"), F.lit(False).alias("done"))

    def step(state: Column, _: Column) -> Column:
        def moved(next_: Column) -> Column:
            return F.struct(F.coalesce(next_, state["word"]).alias("word"), next_.isNull().alias("done"))

        return F.when(state["done"], state).otherwise(let(merge_all(t, state["word"]), moved))

    return F.aggregate(rounds(word), start, step, lambda s: F.transform(F.split(s["word"], ""), lambda c: F.ascii(c) - BASE))


def fold(t: Column, word: Column) -> Column:
    """A pre-token's ids: the merges folded over its bytes."""
    short = F.aggregate(rounds(word), ranked(t, bytes_of(t, word)), lambda e, _: merge_first(t, e), lambda e: F.transform(e, lambda x: id_of(x).cast("int")))
    return F.when(F.octet_length(word) <= SHORT, short).otherwise(fold_long(t, word))


def pre_tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(java_pattern()), F.lit(0))


def slot_of(word: Column) -> Column:
    return F.xxhash64(word).bitwiseAND(WORD_SLOTS - 1).cast("int")


def frequent_words(docs: DataFrame, t: Column) -> Column:
    """The frequent distinct pre-tokens with their ids, by slot: a constant of the plan."""
    spark = docs.sparkSession
    words = docs.select(F.explode(pre_tokens(F.col("text"))).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    words = stored(words.where("n > 1"))
    # The lowest class of counts (an eighth of a doubling each) that still fits.
    classes = words.groupBy(F.floor(F.log2("n") * 8).alias("class")).agg(F.count("*").alias("words"))
    total, least = 0, None
    for row in sorted(classes.collect(), reverse=True):
        total += row.words
        if total > FREQUENT and least is not None:
            break
        least = row["class"]
    kept = words.where(F.floor(F.log2("n") * 8) >= (least or 0)).select("word", "n", t.alias("__t"))
    # Folded before they are grouped: an aggregate would copy the constants into each of its rows.
    kept = kept.select("word", "n", let(F.col("__t"), lambda x: fold(x, F.col("word"))).alias("ids"))
    kept = stored(kept).groupBy(slot_of(F.col("word")).alias("slot"))
    kept = kept.agg(F.sort_array(F.collect_list(F.struct("n", "word", "ids")), asc=False).alias("all"))
    entry = lambda e: F.struct(e["word"].alias("word"), e["ids"].alias("ids"))
    more = F.when(F.size("all") > 1, F.transform(F.slice("all", 2, F.size("all")), entry))
    kept = kept.select("slot", F.col("all")[0]["word"].alias("word"), F.col("all")[0]["ids"].alias("ids"), more.alias("more"))
    found = stored(spark.range(WORD_SLOTS).select(F.col("id").cast("int").alias("slot")).join(kept, "slot", "left"))
    # Blocks of entries are put in order by many tasks; the last one only joins them end to end.
    entries = F.sort_array(F.collect_list(F.struct("slot", "word", "ids", "more")))
    full = F.transform(entries, lambda e: F.when(e["word"].isNotNull(), F.struct(*[e[k].alias(k) for k in ("word", "ids", "more")])))
    blocks = found.groupBy(F.shiftright("slot", 10).alias("block")).agg(full.alias("entries"))
    # WORD_SLOTS entries, of which the empty ones take eight bytes.
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("block", "entries"))), lambda b: b["entries"])
    return blocks.agg(F.flatten(ordered).alias("v")).scalar()


def encode(docs: DataFrame, vocabulary: str = RANKS) -> DataFrame:
    """All columns and ``symbols``: the ids of each of the text's pre-tokens."""
    t = tables(docs.sparkSession, vocabulary)
    kept = docs.columns
    docs = docs.select("*", t.alias("__t"), frequent_words(docs, t).alias("__frequent"))

    def of_word(x: Column, word: Column) -> Column:
        def looked_up(e: Column) -> Column:
            # The most frequent word of a slot stands first.
            later = F.when(e["more"].isNotNull(), F.get(F.filter(e["more"], lambda m: m["word"] == word), F.lit(0))["ids"])
            rest = let(later, lambda s: F.when(s.isNotNull(), s).otherwise(fold(x["t"], word)))
            return F.when(e["word"] == word, e["ids"]).otherwise(rest)

        return let(F.get(x["frequent"], slot_of(word)), looked_up)

    # Each constant is read in one place, so it is not copied into a row.
    bound = F.struct(F.col("__t").alias("t"), F.col("__frequent").alias("frequent"), pre_tokens(F.col("text")).alias("words"))
    symbols = let(bound, lambda x: F.transform(x["words"], lambda w: of_word(x, w)))
    return docs.select(*kept, symbols.alias("symbols"))


def ids(symbols: Column) -> Column:
    """Ids of the pre-tokens as one array of ids."""
    return F.flatten(symbols)


def decode(df: DataFrame, column: str, into: str, vocabulary: str = RANKS) -> DataFrame:
    """All columns and ``into``: the bytes of an array of ids."""
    kept = [c for c in df.columns if c not in (into, column)]
    df = df.select(*kept, column, constant(df.sparkSession, constants(vocabulary)[4], "string").alias("__pieces"))
    bound = F.struct(F.col("__pieces").alias("pieces"), F.col(column).alias("ids"))

    def both(x: Column) -> Column:
        pieces = F.array_join(F.transform(x["ids"], lambda i: F.get(x["pieces"], i)), "")
        return F.struct(x["ids"].alias("ids"), F.encode(pieces, "ISO-8859-1").alias("bytes"))

    # The ids are read once here: read twice, they would be made first, in rows that hold the pieces too.
    df = df.select(*kept, let(bound, both).alias("__both"))
    return df.select(*kept, F.col("__both")["ids"].alias(column), F.col("__both")["bytes"].alias(into))


def digests(docs: DataFrame, vocabulary: str = RANKS) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every document."""
    encoded = encode(docs.select(F.col("doc_id").cast("long"), "text"), vocabulary)
    decoded = decode(encoded.select("doc_id", ids(F.col("symbols")).alias("ids")), "ids", "bytes", vocabulary)
    spaced = F.replace(F.btrim(F.to_json("ids"), F.lit("[]")), F.lit(","), F.lit(" "))  # JSON of ints: [1,2,3]
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(spaced, 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )


@query("op6_byte_bpe")
def op6_byte_bpe(spark, sf_dir):
    return digests(read(spark, sf_dir, "documents"))
