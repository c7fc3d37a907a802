"""Near-duplicate pairs by edit distance, without comparing all rows.

The pair condition (similar title, similar company, near dates) is split into equi-joins:

1. ``similar_texts`` joins the *distinct* titles with each other on shared segments (the
   partition scheme of the Pass-Join paper, Li et al., VLDB 2011): a text cut into ``k + 1``
   segments keeps at least one of them under ``k`` edits, so any similar text holds that segment
   near its place. At a title's ratio segments are long, and few unlike texts share one.
2. Companies are compared only inside groups of one title and date block that have similar
   titles and neighbouring blocks. Where the smaller group has few companies, all of it is
   compared. Elsewhere a prefix filter over q-grams picks the candidates: ``k`` edits leave at
   least ``o`` grams of the longer name intact, each within ``k`` places, so in any order of all
   grams the first two of them stand early in both names. Rare grams come first in that order,
   names meet on pairs of them, and lengths and places must fit.

No similar pair is lost. A hot title spreads over the gram pairs of its companies, and a hot
company over its titles and dates.

Pairs grow with the square of a group of similar rows. ``fuzzy_links`` gives a row per id instead, with
its number of links and its class. Where most names are alike no filter helps: groups are then compared
in blocks, and links are counted where they are found, so that no pair is shuffled or written. Where an
order of the rows tells the loser, large groups are compared in numpy, a name with thousands at a time,
and their tasks give a row per id; this is quadratic in a group still, at some 10 ns a pair.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import as_column
from ..session import store
from .edits import LONGEST, Texts

#: Groups with this many companies or fewer are compared without a filter.
SMALL = 64
#: Buckets of hashed grams whose rarity orders them.
BUCKETS = 4096
#: Early grams of a name up to which pairs of them are made.
EARLY = 32
#: Rows of a group that are compared in one block with as many others.
BLOCK = 2048
#: Rows of a large group that are compared in one task with as many others, many at once.
PART = 16384


def similar_texts(df: DataFrame, column: str | Column, ratio: float) -> DataFrame:
    """All ordered pairs of distinct texts within the edit ratio, each text with itself.

    Distance is taken on lower-cased text and divided by the longer raw length. Columns:
    ``text_a, text_b`` (raw texts). Empty and NULL texts pair with nothing.
    """
    raw = as_column(column)
    # Each text grows into hundreds of segments, so the number of tasks must not shrink
    # with the small input, as adaptive coalescing would have it.
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = (
        df.select(raw.alias("text"))
        .where(F.length("text") > 0)
        .distinct()
        .repartition(tasks)
        .select("text", F.lower("text").alias("low"))
        .withColumn("len", F.length("low"))
    )
    # A lower-cased text is never shorter than the raw one, so this bound on the edits
    # is at least the true one.
    edits = f"cast(floor({ratio} * L + 1e-9) as int)"

    # Longer side: its own segments. base = len / (k + 1); the last `extra` are one longer.
    longer = (
        texts.withColumn("L", F.col("len"))
        .withColumn("k", F.expr(edits))
        .withColumn("base", F.expr("L div (k + 1)"))
        .withColumn("extra", F.expr("L - (L div (k + 1)) * (k + 1)"))
        .withColumn("i", F.explode(F.expr("sequence(0, k)")))
        .withColumn("at", F.expr("1 + i * base + greatest(0, i - (k + 1 - extra))"))
        .withColumn("size", F.expr("base + if(i >= k + 1 - extra, 1, 0)"))
        .select(
            F.col("text").alias("text_b"),
            F.col("L").cast("int").alias("L"),
            "i",
            F.expr("substring(low, int(at), int(size))").alias("segment"),
        )
    )

    # Shorter side: for every length the longer text may have, the substrings that could
    # be its segments. The window of start positions is the multi-match-aware one.
    # Only lengths that occur are tried; there are at most as many as the longest text.
    lengths = texts.agg(F.collect_set("len").alias("lengths")).scalar()
    reach = F.expr(f"sequence(len, int(floor(len / (1 - {ratio}) + 1e-9)))")
    shorter = (
        texts.withColumn("lengths", lengths)
        .withColumn("L", F.explode(F.filter(reach, lambda n: F.array_contains("lengths", n))))
        .withColumn("k", F.expr(edits))
        .where(F.expr("L - len <= k"))
        .withColumn("base", F.expr("L div (k + 1)"))
        .withColumn("extra", F.expr("L - (L div (k + 1)) * (k + 1)"))
        .withColumn("i", F.explode(F.expr("sequence(0, k)")))
        .withColumn("at", F.expr("int(1 + i * base + greatest(0, i - (k + 1 - extra)))"))
        .withColumn("size", F.expr("int(base + if(i >= k + 1 - extra, 1, 0))"))
        .withColumn("first", F.expr("greatest(1, at - i, at + (len - L) - (k - i))"))
        .withColumn("last", F.expr("least(len - size + 1, at + i, at + (len - L) + (k - i))"))
        .where("first <= last")
        .withColumn("p", F.explode(F.expr("sequence(first, last)")))
        .select(
            F.col("text").alias("text_a"),
            F.col("len").alias("len_a"),
            "L",
            "i",
            F.expr("substring(low, p, size)").alias("segment"),
        )
    )
    # A pair can share several segments: group it first, which also spreads the pairs of a
    # common segment over all tasks, and compute the distance once per pair.
    size = F.greatest(F.length("text_a"), F.length("text_b"))
    candidates = (
        shorter.join(longer, ["L", "i", "segment"])
        .where((F.col("len_a") < F.col("L")) | (F.col("text_a") < F.col("text_b")))
        .groupBy("text_a", "text_b")
        .agg(F.max(size).alias("size"))
    )
    bound = F.floor(F.lit(ratio) * F.col("size") + F.lit(1e-9)).cast("int")
    distance = F.call_function("levenshtein", F.lower("text_a"), F.lower("text_b"), bound)
    found = candidates.where((distance >= 0) & (distance / F.col("size") <= ratio))
    both_ways = F.array(
        F.struct(F.col("text_a"), F.col("text_b")),
        F.struct(F.col("text_b").alias("text_a"), F.col("text_a").alias("text_b")),
    )
    pairs = found.select(F.explode(both_ways).alias("p")).select("p.*")
    itself = texts.select(F.col("text").alias("text_a"), F.col("text").alias("text_b"))
    return pairs.unionByName(itself)


def rarity(texts: DataFrame) -> str:
    """Ranks of ``BUCKETS`` buckets of hashed 1- to 3-grams by how often they occur in the distinct
    texts (column ``low``), as a constant of SQL; the driver receives a row per bucket at most."""
    grams = " , ".join(f"transform(sequence(1, len - {q - 1}), i -> substring(low, i, {q}))" for q in (1, 2, 3))
    sized = texts.select("low", F.length("low").alias("len")).where("len >= 3")
    each = sized.select(F.explode(F.expr(f"concat({grams})")).alias("g"))
    counted = dict(each.groupBy(F.expr(f"pmod(hash(g), {BUCKETS})").alias("b")).agg(F.count("*").alias("n")).collect())
    order = sorted(range(BUCKETS), key=lambda b: (counted.get(b, 0), b))
    rank = {b: i for i, b in enumerate(order)}
    return "cast(split('" + ",".join(str(rank[b]) for b in range(BUCKETS)) + "', ',') as array<int>)"


def gram_pairs(names: DataFrame, ratio: float, ranks: str, lengths: Column | None) -> DataFrame:
    """Every column, and ``L, k, s``: the early gram pairs of ``low`` for partners of length ``L``.

    Without ``lengths`` the name is the longer one of a pair and ``L`` its own length; else it is
    the shorter one, or as long, and ``L`` each length that occurs. ``s`` has the fields
    ``g1, g2, p1, p2``: grams and their places. Where only one gram is sure to be left, or pairs
    would be too many, single grams stand for pairs (``g2`` empty).
    """
    rows = names.withColumn("__len", F.length("low"))
    if lengths is None:
        rows = rows.withColumn("L", F.col("__len"))
    else:
        reach = F.expr(f"sequence(__len, int(floor(__len / (1 - {ratio}) + 1e-9)))")
        rows = rows.withColumn("__all", lengths).withColumn("L", F.explode(F.filter(reach, lambda n: F.array_contains("__all", n)))).drop("__all")
    rows = rows.withColumn("k", F.expr(f"int(floor({ratio} * L + 1e-9))")).where("L - __len <= k")
    rows = rows.withColumn("__q", F.expr("case when L - 2 - 3 * k >= 2 then 3 when L - 1 - 2 * k >= 2 then 2 else 1 end"))
    rows = rows.withColumn("__o", F.expr("L - __q + 1 - k * __q")).where("__len - __q + 1 >= __o")
    rows = rows.withColumn("__two", F.expr(f"__o >= 2 and k * __q + 2 <= {EARLY}"))
    ranked = f"struct(get({ranks}, pmod(hash(substring(low, i, __q)), {BUCKETS})) as r, substring(low, i, __q) as g, i as p)"
    early = f"slice(array_sort(transform(sequence(1, __len - __q + 1), i -> {ranked})), 1, __len - __q + 1 - __o + if(__two, 2, 1))"
    rows = rows.withColumn("__early", F.expr(early))
    pairs = "flatten(transform(__early, (x, i) -> transform(slice(__early, i + 2, size(__early)), y -> struct(x.g as g1, y.g as g2, x.p as p1, y.p as p2))))"
    single = "transform(__early, x -> struct(x.g as g1, '' as g2, x.p as p1, x.p as p2))"
    rows = rows.withColumn("s", F.explode(F.expr(f"if(__two, {pairs}, {single})")))
    return rows.select(*names.columns, "L", "k", "s")


def company_candidates(posts: DataFrame, titles: DataFrame, ratio: float, small: int = SMALL) -> DataFrame:
    """Pairs of posts to compare: columns of ``posts`` (``title, company, block``) with ``_a`` and ``_b``.

    ``titles`` has similar titles both ways, each with itself. A pair comes in one of its two
    orders; a post comes with itself.
    """
    sizes = posts.groupBy("title", "block").agg(F.count("*").alias("m"))
    a = sizes.select(*[F.col(c).alias(f"{c}_a") for c in ("title", "block", "m")])
    b = sizes.select(*[F.col(c).alias(f"{c}_b") for c in ("title", "block", "m")])
    near = a.join(titles.select(F.col("text_a").alias("title_a"), F.col("text_b").alias("title_b")), "title_a")
    near = near.withColumn("block_b", F.explode(F.expr("array(block_a - 1, block_a, block_a + 1)"))).join(b, ["title_b", "block_b"])
    same = (F.col("title_a") == F.col("title_b")) & (F.col("block_a") == F.col("block_b"))
    links = near.where(same | (F.struct("title_a", "block_a") < F.struct("title_b", "block_b")))
    few = F.least("m_a", "m_b") <= small
    side_a = posts.select(*[F.col(c).alias(f"{c}_a") for c in ("title", "company", "block")])
    side_b = posts.select(*[F.col(c).alias(f"{c}_b") for c in ("title", "company", "block")])
    once = ~same | (F.col("company_a") <= F.col("company_b"))
    keys = ["title_a", "block_a", "title_b", "block_b"]
    out = [*keys[:2], "company_a", *keys[2:], "company_b"]
    direct = links.where(few).select(*keys).join(side_a, ["title_a", "block_a"]).join(side_b, ["title_b", "block_b"])
    direct = direct.where(once).select(*out)

    names = posts.select(F.lower("company").alias("low")).distinct()
    ranks = rarity(names)
    lengths = names.agg(F.collect_set(F.length("low")).alias("lengths")).scalar()
    many = links.where(~few).select(*keys)
    left = many.join(side_a, ["title_a", "block_a"]).withColumn("low", F.lower("company_a"))
    right = many.select("title_b", "block_b").distinct().join(side_b, ["title_b", "block_b"]).withColumn("low", F.lower("company_b"))
    found = []
    for a_longer in (True, False):
        x = gram_pairs(left, ratio, ranks, None if a_longer else lengths)
        y = gram_pairs(right, ratio, ranks, lengths if a_longer else None)
        x = x.select(*keys, "company_a", F.length("low").alias("n_a"), "L", "k", "s.g1", "s.g2", F.col("s.p1").alias("x1"), F.col("s.p2").alias("x2"))
        y = y.select("title_b", "block_b", "company_b", F.length("low").alias("n_b"), "L", "s.g1", "s.g2", F.col("s.p1").alias("y1"), F.col("s.p2").alias("y2"))
        met = x.join(y, ["title_b", "block_b", "L", "g1", "g2"]).where("abs(x1 - y1) <= k and abs(x2 - y2) <= k")
        if not a_longer:  # names of one length met in the first turn
            met = met.where("n_a < n_b")
        found.append(met.where(once).select(*out))
    return direct.unionByName(found[0].unionByName(found[1]).distinct())


def _rows(df: DataFrame, id: str, title: str, company: str, day: str, keep: tuple[str, ...], days: int) -> DataFrame:
    """The rows that can be in a pair: ``id, title, company, day, block`` and the columns to keep."""
    number = F.datediff(F.col(day), F.lit("1970-01-01").cast("date"))
    rows = df.select(
        F.col(id).alias("id"),
        F.col(title).alias("title"),
        F.col(company).alias("company"),
        F.col(day).alias("day"),
        *keep,
        F.floor(number / (days + 1)).cast("int").alias("block"),
    ).where("id is not null and title is not null and company is not null and day is not null")
    return rows.where((F.length("title") > 0) & (F.length("company") > 0))


def fuzzy_pairs(
    df: DataFrame,
    id: str,
    title: str,
    company: str,
    day: str,
    keep: tuple[str, ...] = (),
    title_ratio: float = 0.15,
    company_ratio: float = 0.35,
    days: int = 3,
    store_at: str | None = None,
) -> DataFrame:
    """Pairs ``a.id < b.id`` with similar title and company and dates at most ``days`` apart.

    Columns carry the suffixes ``_a`` and ``_b``; ``keep`` names further columns to carry. The
    text joins and both sides of the pair join read the rows: with ``store_at`` they are
    written there once and read back.
    """
    rows = _rows(df, id, title, company, day, keep, days)
    if store_at is not None:
        rows = store(rows, store_at)
    data = ["id", "title", "company", "day", *keep]
    posts = rows.select("title", "company", "block").distinct()

    candidates = company_candidates(posts, similar_texts(posts, "title", title_ratio), company_ratio)
    size = F.greatest(F.length("company_a"), F.length("company_b"))
    bound = F.floor(F.lit(company_ratio) * size + F.lit(1e-9)).cast("int")
    distance = F.call_function("levenshtein", F.lower("company_a"), F.lower("company_b"), bound)
    similar = candidates.where((distance >= 0) & (distance / size <= company_ratio))

    key = ["title", "company", "block"]
    sides = [rows.select(*[F.col(c).alias(f"{c}_{s}") for c in key], F.struct(*data).alias(s)) for s in ("a", "b")]
    pairs = similar.join(sides[0], [f"{c}_a" for c in key]).join(sides[1], [f"{c}_b" for c in key])
    itself = F.lit(True)
    for c in key:
        itself = itself & (F.col(f"{c}_a") == F.col(f"{c}_b"))
    forth = F.col("a.id") < F.col("b.id")
    wanted = (F.abs(F.datediff("a.day", "b.day")) <= days) & (forth | (~itself & (F.col("b.id") < F.col("a.id"))))
    pairs = pairs.where(wanted).select(
        F.when(forth, F.col("a")).otherwise(F.col("b")).alias("a"), F.when(forth, F.col("b")).otherwise(F.col("a")).alias("b")
    )
    return pairs.select(*[F.col(f"{s}.{c}").alias(f"{c}_{s}") for s in ("a", "b") for c in data])


def alike(names: DataFrame, ratio: float) -> bool:
    """Whether the gram filter would let an eighth of all pairs of the distinct names (column ``low``)
    meet or more: comparing all of them is then the smaller work."""
    ranks = rarity(names)
    lengths = names.agg(F.collect_set(F.length("low")).alias("lengths")).scalar()
    sides = [gram_pairs(names, ratio, ranks, of).groupBy("L", "s.g1", "s.g2").agg(F.count("*").cast("double").alias("n")) for of in (None, lengths)]
    met = sides[0].join(sides[1].withColumnRenamed("n", "m"), ["L", "g1", "g2"]).agg(F.sum(F.col("n") * F.col("m"))).first()[0]
    return (met or 0) >= names.count() ** 2 / 8


def _group_links(rows: DataFrame, titles: DataFrame) -> DataFrame:
    """Pairs of groups (one title and date block) with similar titles and near blocks, both ways and each
    with itself, with their sizes ``m_a, m_b``; not those whose rows have one label among them all."""
    sizes = rows.groupBy("title", "block").agg(F.count("*").alias("m"), F.min("label").alias("lo"), F.max("label").alias("hi"))
    a, b = (sizes.select(*[F.col(c).alias(f"{c}_{s}") for c in sizes.columns]) for s in "ab")
    near = a.join(titles.select(F.col("text_a").alias("title_a"), F.col("text_b").alias("title_b")), "title_a")
    near = near.withColumn("block_b", F.explode(F.expr("array(block_a - 1, block_a, block_a + 1)"))).join(b, ["title_b", "block_b"])
    near = near.where("lo_a <> hi_a or lo_b <> hi_b or lo_a <> lo_b")
    return near.select("title_a", "block_a", "m_a", "title_b", "block_b", "m_b")


def _blocks(rows: DataFrame, others: DataFrame, links: DataFrame, kept: list[str], ratio: float, days: int) -> DataFrame:
    """Links between labels of ``rows`` and ``others`` in linked groups, each compared once and given in
    both orders: the kept columns with ``_a`` and ``_b``.

    ``BLOCK`` rows of a group meet about as many at a time: a task holds a block, and a hot group is
    many of them.
    """
    sized = links.withColumn("parts", F.ceil(F.col("m_b") / BLOCK).cast("int"))
    part, each = F.pmod(F.xxhash64("id"), "parts").cast("int"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    a, b = (df.withColumn("low", F.lower("company")).withColumn("len", F.length("company")) for df in (rows, others))
    carried = a.columns
    a = a.join(sized.withColumnsRenamed({"title_a": "title", "block_a": "block"}), ["title", "block"])
    a = a.withColumn("i", part).withColumn("j", each)
    a = a.select("title_b", "block_b", "i", "j", *[F.col(c).alias(f"{c}_a") for c in carried])
    targets = sized.select(F.col("title_b").alias("title"), F.col("block_b").alias("block"), "parts").distinct()
    b = b.join(targets, ["title", "block"]).withColumn("j", part).withColumn("i", each)
    b = b.select("i", "j", *[F.col(c).alias(f"{c}_b") for c in carried])
    # Few bytes make many comparisons, so adaptive execution must not join tasks by size.
    tasks = 4 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = ["title_b", "block_b", "i", "j"]
    size = F.greatest("len_a", "len_b")
    most = F.floor(F.lit(ratio) * size + F.lit(1e-9)).cast("int")
    most = F.when(most / size <= ratio, most).otherwise(most - 1)
    met = a.repartition(tasks, *key).join(b.repartition(tasks, *key), key)
    met = met.where((F.col("id_a") < F.col("id_b")) & (F.col("label_a") != F.col("label_b")) & (F.abs(F.datediff("day_a", "day_b")) <= days))
    met = met.where(F.call_function("levenshtein", "low_a", "low_b", most) >= 0)
    orders = [F.struct(*[F.col(f"{c}_{s}").alias(f"{c}_{t}") for s, t in zip(order, "ab") for c in kept]) for order in ("ab", "ba")]
    return met.select(F.explode(F.array(*orders)).alias("p")).select("p.*")


def _parts(rows: DataFrame, links: DataFrame, order: tuple[str, ...], ratio: float, days: int) -> DataFrame:
    """``id, label, near, n_links, n_lost`` of rows by their links between labels in linked groups, which
    are numbered (``unit``): partial counts, a row per row and part of the other group.

    ``PART`` rows of a group meet as many of the other; both fit a task.
    """
    number = F.datediff("day", F.lit("1970-01-01").cast("date")).alias("day")
    sized = links.select("*", *[F.ceil(F.col(f"m_{s}") / PART).cast("int").alias(f"parts_{s}") for s in "ab"])
    slim = rows.select("title", "block", "id", "label", number, F.lower("company").alias("low"), F.length("company").alias("len"), *[F.col(c).cast("double") for c in order])
    tasks = 4 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sides = []
    for mine, other, i, j in (("a", "b", "i", "j"), ("b", "a", "j", "i")):
        groups = sized.select(F.col(f"title_{mine}").alias("title"), F.col(f"block_{mine}").alias("block"), "unit", "parts_a", "parts_b")
        side = slim.join(groups, ["title", "block"]).drop("title", "block")
        side = side.withColumn(i, F.pmod(F.xxhash64("id"), f"parts_{mine}").cast("int"))
        side = side.withColumn(j, F.explode(F.sequence(F.lit(0), F.col(f"parts_{other}") - 1))).drop("parts_a", "parts_b")
        side = side.select(*[F.col(c).alias(c) for c in side.columns])  # a group may meet itself
        # Few bytes make many comparisons, so adaptive execution must not join tasks by size.
        sides.append(side.repartition(tasks, "unit", "i", "j").groupBy("unit", "i", "j"))
    kind = {f.name: f.dataType.simpleString() for f in rows.schema.fields}

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        return _counts(left, right, order, ratio, days)

    return sides[0].cogroup(sides[1]).applyInArrow(run, f"id {kind['id']}, label {kind['label']}, near {kind['label']}, n_links long, n_lost long")


def _counts(left: pa.Table, right: pa.Table, order: tuple[str, ...], ratio: float, days: int) -> pa.Table:
    """The counts of each row of ``left`` over its links with rows of ``right``, and the least label it meets."""
    if not (len(left) and len(right)):
        types = [(left if len(left) else right).schema.field(c).type for c in ("id", "label", "label")] + [pa.int64()] * 2
        return pa.Table.from_arrays([pa.array([], t) for t in types], ["id", "label", "near", "n_links", "n_lost"])
    named = pa.concat_arrays([c for t in (left, right) for k in ("id", "label") for c in t.column(k).chunks])
    coded = named.dictionary_encode()
    by_name = coded.dictionary.take(sort := pa.compute.sort_indices(coded.dictionary))
    rank = np.empty(len(sort), np.int32)
    rank[sort.to_numpy()] = np.arange(len(sort), dtype=np.int32)
    codes = rank[coded.indices.to_numpy()]
    id_a, label_a, id_b, label_b = np.split(codes, np.cumsum([len(left), len(left), len(right)]))

    def side(t: pa.Table) -> tuple:
        numbers = (t.column(c).to_numpy().astype(np.int64) for c in ("day", "len"))
        standing = np.array([t.column(c).to_numpy() for c in order], float).reshape(len(order), len(t))
        return *numbers, t.column("low").to_pylist(), standing

    (day_a, len_a, low_a, standing_a), (day_b, len_b, low_b, standing_b) = side(left), side(right)
    standing_a = np.ascontiguousarray(standing_a.T)
    links, lost, near = np.zeros(len(left), np.int64), np.zeros(len(left), np.int64), np.full(len(left), len(rank), np.int32)

    def compare(queries: np.ndarray, lanes: np.ndarray) -> None:
        texts, lengths, days_b, ids, labels = Texts([low_b[i] for i in lanes]), len_b[lanes], day_b[lanes], id_b[lanes], label_b[lanes]
        allowed, judged = {}, {}
        for a, distance in zip(queries, texts.distances([low_a[a] for a in queries])):
            key = (len_a[a], len(low_a[a]), day_a[a])
            if key not in allowed:
                size = np.maximum(key[0], lengths)
                most = np.floor(ratio * size + 1e-9)
                most -= most / size > ratio
                allowed[key] = np.where(np.abs(days_b - key[2]) <= days, np.clip(most - key[1], -127, 127), -128).astype(np.int8)
            linked = distance <= allowed[key]
            linked &= labels != label_a[a]
            n = np.count_nonzero(linked)
            if not n:
                continue
            links[a] += n
            near[a] = min(near[a], labels[linked.argmax()])  # they are in order
            if (key := standing_a[a].tobytes()) not in judged:
                better, level = np.zeros(len(lanes), bool), np.ones(len(lanes), bool)
                for mine, others in zip(standing_a[a], standing_b[:, lanes]):
                    better |= level & (others < mine)
                    level &= ~((others < mine) | (others > mine))
                if len(judged) >= 64:
                    judged.clear()
                judged[key] = better, level
            better, level = judged[key]
            lost[a] += np.count_nonzero(linked & (better | (level & (ids < id_a[a]))))

    def compare_all(queries: np.ndarray, others: np.ndarray) -> None:
        # Short names need shorter words.
        queries = np.array(sorted(queries, key=low_a.__getitem__), np.int64)
        others = others[np.argsort(label_b[others], kind="stable")]
        sizes = np.array([len(low_b[i]) for i in others], np.int64)
        for least, most in ((0, 16), (17, 32), (33, LONGEST)):
            lanes = others[(sizes >= least) & (sizes <= most)]
            if len(lanes) and len(queries):
                compare(queries, lanes)

    found, n = np.unique(label_b, return_counts=True)
    common = found[n.argmax()]
    if 2 * n.max() > len(right):  # most are one class already, whose rows meet only the others
        compare_all(np.flatnonzero(label_a == common), np.flatnonzero(label_b != common))
        compare_all(np.flatnonzero(label_a != common), np.arange(len(right)))
    else:
        compare_all(np.arange(len(left)), np.arange(len(right)))
    rows = np.flatnonzero(links)
    columns = [left.column("id").take(rows), left.column("label").take(rows), by_name.take(pa.array(near[rows]))]
    return pa.Table.from_arrays([*columns, pa.array(links[rows]), pa.array(lost[rows])], ["id", "label", "near", "n_links", "n_lost"])


def fuzzy_links(
    df: DataFrame,
    id: str,
    title: str,
    company: str,
    day: str,
    loses: Column | tuple[str, ...],
    store_at: str,
    keep: tuple[str, ...] = (),
    title_ratio: float = 0.15,
    company_ratio: float = 0.35,
    days: int = 3,
) -> DataFrame:
    """``id, class_id, n_links, n_lost`` of every id with a link as in :func:`fuzzy_pairs`.

    ``class_id`` is the least id reachable by links, ``n_links`` counts the links, ``n_lost`` those in
    which ``loses`` holds, a condition on ``id`` and the kept columns with ``_a`` (this row) and ``_b``;
    or it names kept columns of numbers: the first of them that differs decides (a NULL differs from
    nothing), then the id, and the greater loses. Rows that share an id share its links. Each round every
    class joins the least class that it has a link to, so the number of classes with links between them
    is halved at least; links inside a class are compared in the first round only.
    """
    order = None if isinstance(loses, Column) else tuple(loses)
    if order is not None:
        loses = F.col("id_b") < F.col("id_a")
        for c in reversed(order):
            loses = F.when(F.col(f"{c}_a") != F.col(f"{c}_b"), F.col(f"{c}_b") < F.col(f"{c}_a")).otherwise(loses)
    rows = store(_rows(df, id, title, company, day, keep, days), f"{store_at}/rows")
    labels = rows.select("id", F.col("id").alias("label")).distinct()
    kept = ["id", "label", *keep]
    counts = [F.count("*").alias("n_links"), F.count_if(loses).alias("n_lost"), F.min("label_b").alias("near")]
    mine = [F.col(f"{c}_a").alias(c) for c in ("id", "label")]
    if alike(rows.select(F.lower("company").alias("low")).distinct(), company_ratio):
        titles = store(similar_texts(rows, "title", title_ratio), f"{store_at}/titles")
        too_long = F.length(F.lower("company")) > LONGEST
        any_too_long = not rows.where(too_long).isEmpty()

        def between(labels: DataFrame, turn: int) -> DataFrame:
            named = rows.join(labels, "id")
            links = _group_links(named, titles)
            if order is None:
                return _blocks(named, named, links, kept, company_ratio, days).groupBy(*mine).agg(*counts)
            links = store(links.withColumn("unit", F.monotonically_increasing_id()), f"{store_at}/groups-{turn}")
            large = F.least("m_a", "m_b") > SMALL
            found = _blocks(named, named, links.where(~large), kept, company_ratio, days).groupBy(*mine).agg(*counts)
            links = links.where(large)
            if links.isEmpty():
                return found
            short = named.where(~too_long)
            parts = [found, _parts(short, links, order, company_ratio, days)]
            if any_too_long:
                long = named.where(too_long)
                for some, others in ((long, named), (short, long)):
                    parts.append(_blocks(some, others, links, kept, company_ratio, days).groupBy(*mine).agg(*counts))
            for part in parts[1:]:
                found = found.unionByName(part)
            return found
    else:
        found = fuzzy_pairs(rows, "id", "title", "company", "day", keep, title_ratio, company_ratio, days)
        data = ["id", *keep]
        turned = [F.col(f"{c}_{s}").alias(f"{c}_{t}") for s, t in (("a", "b"), ("b", "a")) for c in data]
        forth = found.select(*[f"{c}_{s}" for s in ("a", "b") for c in data])
        pairs = store(forth.unionByName(forth.select(*turned)), f"{store_at}/pairs")

        def between(labels: DataFrame, turn: int) -> DataFrame:
            out = pairs
            for s in ("a", "b"):
                out = out.join(labels.select(F.col("id").alias(f"id_{s}"), F.col("label").alias(f"label_{s}")), f"id_{s}")
            return out.where("label_a <> label_b").groupBy(*mine).agg(*counts)

    sums = [F.sum(c).alias(c) for c in ("n_links", "n_lost")]
    counted = store(between(labels, 0).groupBy("id").agg(*sums, F.min("near").alias("near")), f"{store_at}/counted")
    nearest = counted.select(F.col("id").alias("label"), "near")
    labels = counted.select("id", F.col("id").alias("label"))
    turn = 0
    while not nearest.isEmpty():
        labels = _joined(labels, nearest, lambda name: f"{store_at}/{name}-{turn}")
        turn += 1
        nearest = store(between(labels, turn).groupBy("label").agg(F.min("near").alias("near")), f"{store_at}/nearest-{turn}")
    return counted.join(labels, "id").select("id", F.col("label").alias("class_id"), "n_links", "n_lost")


def _joined(labels: DataFrame, nearest: DataFrame, path: Callable[[str], str]) -> DataFrame:
    """Labels after every class took the lesser label of its own and ``near``, and that one's in turn."""
    up = nearest.select("label", F.least("label", "near").alias("up"))
    hops = 0
    while True:
        over = up.select(F.col("label").alias("up"), F.col("up").alias("over"))
        moved = up.join(over, "up", "left").select("label", F.coalesce("over", "up").alias("next"), "up")
        moved = store(moved, path(f"up-{hops}"))
        done = moved.where("next <> up").isEmpty()
        up, hops = moved.select("label", F.col("next").alias("up")), hops + 1
        if done:
            break
    out = labels.join(up, "label", "left").select("id", F.coalesce("up", "label").alias("label"))
    return store(out, path("labels"))


def pick_loser(pairs: DataFrame, value: str, rank: Column, rank_b: Column, id: str = "id") -> DataFrame:
    """Add ``loser``: the row without a value loses, then the worse-ranked one, then ``b``."""
    has_a, has_b = F.col(f"{value}_a").isNotNull(), F.col(f"{value}_b").isNotNull()
    a, b = F.col(f"{id}_a"), F.col(f"{id}_b")
    loser = (
        F.when(has_a & ~has_b, b)
        .when(has_b & ~has_a, a)
        .when(rank < rank_b, b)
        .when(rank_b < rank, a)
        .otherwise(b)
    )
    return pairs.withColumn("loser", loser)
