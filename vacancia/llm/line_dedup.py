"""Line dedup: later copies of repeated line runs are deleted, with DataFrame functions only.

A text is a sequence of line ids (fingerprints of its lines with a word). Prefix doubling names
every run of 2, 4, 8 ... lines: the name of 2k lines is made from the names of its two halves,
for all positions of all documents at once, so equal runs have equal names wherever they are.
Two suffixes that agree on their first e lines share the name of those lines; the suffixes with
one name are an interval of the suffix array whose longest common prefix is at least e.

For every position the shortest run from there on, and the shortest run up to there, with at
least ``MIN_WORDS`` words is taken. These runs' intervals are found by grouping names; in an
interval of several suffixes the first one (by document id, then line) stays and the others are
copies. A maximal repeated run of that many words is the union of such short runs, so all its
lines are deleted in all later places, and lines outside such runs stay. Lines are compared
whole; blank lines are skipped over and stay.

Only names, places and lengths of runs are shuffled to find copies; the texts move once, to meet
the list of their own deleted lines. A line that many documents share is counted on the map side
and joined with Spark's skew handling; no group is gathered in one task.

Defined results: a NULL text stays NULL with no lines; an empty text has one blank line; rows
that repeat an id and its text are one document and come out alike; NULL ids come first in
order; extra columns are carried by ``dedup_lines``; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import query, read

MIN_WORDS = 50
WORD = r"[^\\x20\\x09-\\x0D]+"


def _levels(min_words: int) -> list[int]:
    """Powers of two up to the longest run needed: every line has a word."""
    out = [1]
    while out[-1] * 2 <= min_words:
        out.append(out[-1] * 2)
    return out


def runs(docs: DataFrame, keys: list[str], min_words: int = MIN_WORDS) -> DataFrame:
    """``keys``, first line (counted among lines with a word), lines, words and name of each
    shortest run of ``min_words`` words that begins or ends at a line."""
    levels = _levels(min_words)
    lines = docs.where("text is not null").select(*keys, F.expr(r"split(text, '\n', -1)").alias("lines"))
    # One pass over the lines: fingerprint, words, and length as a further check.
    full = lines.select(
        *keys,
        F.expr(
            f"filter(transform(lines, l -> struct(xxhash64(l) as h, size(regexp_extract_all(l, '{WORD}', 0)) as w)), x -> x.w > 0)"
        ).alias("x"),
    ).where("size(x) > 0")
    rows = full.select(*keys, F.expr("x.h").alias("n1"), F.expr("x.w").alias("s1"))
    for k in levels[:-1]:
        rows = rows.select(
            "*",
            F.expr(f"transform(n{k}, (h, i) -> if(i + {k} < size(n{k}), xxhash64(h, get(n{k}, i + {k})), h))").alias(f"n{2 * k}"),
            F.expr(f"transform(s{k}, (s, i) -> if(i + {k} < size(s{k}), s + get(s{k}, i + {k}), s))").alias(f"s{2 * k}"),
        )
    # Descend the powers: the most lines that still hold fewer words than asked for.
    ahead, behind = "transform(s1, (s, i) -> struct(0 as n, 0 as w))", "transform(s1, (s, i) -> struct(0 as n, 0 as w))"
    rows = rows.select("*", F.expr(ahead).alias("ahead"), F.expr(behind).alias("behind"))
    for k in reversed(levels):
        # A block counts only when it lies inside the text; s{k} near the end holds fewer lines.
        step = "if({fits} and c.w + get(s{k}, {at}) < {m}, struct(c.n + {k} as n, c.w + get(s{k}, {at}) as w), c)"
        forth = step.format(fits=f"i + c.n + {k} <= size(s{k})", at="i + c.n", k=k, m=min_words)
        back = step.format(fits=f"i - c.n - {k} >= -1", at=f"i - c.n - {k} + 1", k=k, m=min_words)
        rows = rows.withColumn("ahead", F.expr(f"transform(ahead, (c, i) -> {forth})"))
        rows = rows.withColumn("behind", F.expr(f"transform(behind, (c, i) -> {back})"))
    spans = F.expr(
        """array_distinct(concat(
          filter(transform(ahead, (c, i) -> struct(i as at, c.n + 1 as n, c.w + get(s1, i + c.n) as words)), r -> r.words is not null),
          filter(transform(behind, (c, i) -> struct(i - c.n as at, c.n + 1 as n, c.w + get(s1, i - c.n) as words)), r -> r.words is not null)))"""
    )
    rows = rows.select(*keys, *[f"n{k}" for k in levels], F.explode(spans).alias("r"))
    # The name of n lines: their first and last 2^j, which overlap and cover them.
    first, last = F.lit(None).cast("long"), F.lit(None).cast("long")
    for k in levels:
        fits = F.col("r.n") >= k
        first = F.when(fits, F.get(f"n{k}", F.col("r.at"))).otherwise(first)
        last = F.when(fits, F.get(f"n{k}", F.col("r.at") + F.col("r.n") - k)).otherwise(last)
    return rows.select(*keys, "r.*", F.xxhash64("r.n", first, last).alias("name"))


def copies(found: DataFrame, keys: list[str]) -> DataFrame:
    """Runs that are not the first of their interval."""
    name = ["name", "n", "words"]
    place = F.struct(*keys, "at")
    intervals = found.groupBy(*name).agg(F.count("*").alias("suffixes"), F.min(place).alias("first"))
    intervals = intervals.where("suffixes > 1").drop("suffixes")
    return found.join(intervals, name).where(~place.eqNullSafe(F.col("first"))).select(*keys, "at", "n")


def _free(docs: DataFrame, *names: str) -> list[str]:
    """Column names like these that the frame does not use."""
    taken = {c.lower() for c in docs.columns}
    out = []
    for name in names:
        while name in taken:
            name = f"_{name}"
        out.append(name)
    return out


def _cleaned(text: str, runs: str) -> Column:
    """Struct of the cleaned text, its number of lines, the deleted ones, and whether that left no word.

    The lines are split once and bound to a name, ``transform(array(x), s -> ...)[0]``, and so is
    every array made of them. A caller's filter on these columns copies the whole expression, so
    nothing in a lambda may refer to a computed column.
    """
    empty = "cast(array() as array<int>)"
    numbers = r"filter(transform(s.lines, (l, i) -> if(l rlike '[^\\x20\\x09-\\x0D]', i, -1)), i -> i >= 0)"
    inside = "array_distinct(flatten(transform(s.runs, r -> sequence(r.at, r.at + r.n - 1))))"
    gone = f"transform(array(struct({numbers} as numbers)), n -> struct(n.numbers, array_sort(transform({inside}, i -> get(n.numbers, i))) as gone))[0]"
    kept = "array_except(sequence(0, size(s.lines) - 1), g.gone)"
    made = rf"""transform(array({gone}), g -> struct(
        array_join(transform({kept}, i -> get(s.lines, i)), '\n') as text, size(s.lines) as n_lines, g.gone as removed,
        size(array_except(g.numbers, g.gone)) = 0 as emptied))[0]"""
    left = f"struct(s.text, if(s.text is null, 0, size(s.lines)) as n_lines, {empty} as removed, false as emptied)"
    return F.expr(
        rf"transform(array(struct({text} as text, split({text}, '\n', -1) as lines, {runs} as runs)), s -> if(s.runs is null, {left}, {made}))[0]"
    )


def dedup_lines(
    docs: DataFrame, min_words: int = MIN_WORDS, report: tuple[str, str] = ("n_lines", "removed"), emptied: str | None = None
) -> DataFrame:
    """All columns with the cleaned ``text``, and under the names of ``report`` the number of
    lines and the deleted ones (numbers from 0), which replace columns of these names; under the
    name ``emptied``, if asked for, whether a text lost all its words."""
    asked = [*report, *([emptied] if emptied else [])]
    docs = docs.drop(*asked)
    id_, text_, id2, text2, runs_, made = _free(docs, "__id", "__text", "__id2", "__text2", "__runs", "__made")
    keys = [id_, text_]
    marked = docs.withColumn(id_, F.col("doc_id")).withColumn(text_, F.xxhash64("text"))
    # Repeated rows of one id and text share a place, so they count once.
    found = runs(marked.select(*keys, "text"), keys, min_words).distinct()
    gone = copies(found, keys).groupBy(*keys).agg(F.collect_list(F.struct("at", "n")).alias(runs_))
    gone = gone.select(F.col(id_).alias(id2), F.col(text_).alias(text2), runs_)
    match = F.col(id_).eqNullSafe(F.col(id2)) & (F.col(text_) == F.col(text2))
    both = marked.join(gone, match, "left").withColumn(made, _cleaned("text", runs_))
    fields = dict(zip(asked, ("n_lines", "removed", "emptied")))
    others = [F.col(f"{made}.text").alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns]
    return both.select(*others, *[F.col(f"{made}.{field}").alias(name) for name, field in fields.items()])


SQL = rf"""WITH raw AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS l, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS no FROM documents),
  nb AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY no) AS i, sum(w) OVER (PARTITION BY doc_id ORDER BY no) AS c
    FROM (SELECT *, len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) AS w FROM raw) WHERE w > 0),
  spans AS (
    SELECT a.doc_id, a.i, min(b.i) AS j FROM nb a JOIN nb b ON a.doc_id = b.doc_id AND b.i BETWEEN a.i AND a.i + {MIN_WORDS}
      AND b.c - a.c + a.w >= {MIN_WORDS} GROUP BY 1, 2
    UNION SELECT b.doc_id, max(a.i) AS i, b.i AS j FROM nb a JOIN nb b ON a.doc_id = b.doc_id AND a.i BETWEEN b.i - {MIN_WORDS} AND b.i
      AND b.c - a.c + a.w >= {MIN_WORDS} GROUP BY b.doc_id, b.i),
  named AS (SELECT s.doc_id, s.i, s.j, string_agg(nb.l, chr(10) ORDER BY nb.i) AS run
    FROM spans s JOIN nb ON nb.doc_id = s.doc_id AND nb.i BETWEEN s.i AND s.j GROUP BY ALL),
  later AS (SELECT * FROM named QUALIFY row_number() OVER (PARTITION BY run ORDER BY doc_id, i) > 1),
  gone AS (SELECT DISTINCT nb.doc_id, nb.no FROM nb JOIN later x ON nb.doc_id = x.doc_id AND nb.i BETWEEN x.i AND x.j),
  kept AS (SELECT doc_id, string_agg(l, chr(10) ORDER BY no) AS text FROM raw ANTI JOIN gone USING (doc_id, no) GROUP BY doc_id),
  cut AS (SELECT doc_id, count(*) AS n, string_agg(CAST(no AS VARCHAR), ',' ORDER BY no) AS removed FROM gone GROUP BY doc_id)
  SELECT d.doc_id, CAST(CASE WHEN d.text IS NULL THEN 0 ELSE len(string_split(d.text, chr(10))) END AS INTEGER) AS n_lines,
    CAST(coalesce(n, 0) AS INTEGER) AS n_removed, coalesce(removed, '') AS removed,
    CASE WHEN d.text IS NOT NULL THEN coalesce(kept.text, '') END AS text
  FROM documents d LEFT JOIN cut USING (doc_id) LEFT JOIN kept USING (doc_id)"""


@query("op9_line_dedup", SQL)
def op9_line_dedup(spark, sf_dir):
    cleaned = dedup_lines(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return cleaned.select(
        "doc_id",
        "n_lines",
        F.size("removed").alias("n_removed"),
        F.array_join(F.col("removed").cast("array<string>"), ",").alias("removed"),
        "text",
    )
