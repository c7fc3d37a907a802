"""Quality rules, line dedup, decontamination and the n-gram join against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from vacancia.llm import decontamination, line_dedup, ngram_join, quality

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(list(rows), schema)


# -- quality -------------------------------------------------------------------------------


def base_of(text):
    words = WORD.findall(text)
    at = {}
    for i in range(len(words) - 2):
        at.setdefault(tuple(words[i : i + 3]), []).append(i)
    repeated = {k for found in at.values() if len(found) > 1 for i in found for k in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated)


def random_texts(n, seed):
    rng = random.Random(seed)
    pieces = ["a", "b", "c", "\u00e9t\u00e9", "#x", "<b>", "\n", "\n", "  ", "\t", "a b c", "\x0b", "\U0001f600"]
    return ["".join(rng.choice(pieces) + rng.choice(["", " "]) for _ in range(rng.randint(0, 90))) for _ in range(n)]


def test_base_counts(spark):
    texts = dict(enumerate([*random_texts(400, 1), "", "x " * 60]))
    rows = quality.judge(frame(spark, texts.items()), np.zeros(quality.BUCKETS), -np.inf).collect()
    for row in rows:
        want = base_of(texts[row.doc_id])
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words) == want
        assert row.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert row.kept == (not row.base_failed)


def test_scores_equal_a_plain_likelihood_ratio(spark):
    rng = random.Random(5)
    good = [" ".join(rng.choice("one two three four five six seven".split()) for _ in range(80)) for _ in range(40)]
    bad = [" ".join(rng.choice("buy now $$$ free !!! click".split()) for _ in range(80)) for _ in range(40)]
    docs = frame(spark, enumerate(good + bad))
    labels = frame(spark, [(i, int(i < 40), 0) for i in range(0, 80, 2)], "doc_id long, quality int, toxic int")
    weights, threshold = quality.fit(docs, labels)
    rows = {r.doc_id: r for r in quality.judge(docs, weights, threshold).collect()}
    assert all(rows[i].llr > threshold for i in range(40)) and all(rows[i].llr < threshold for i in range(40, 80))
    h = {}
    for text in good + bad:
        (chunk,) = quality.ragged.chunks(quality.pa.array([text]))
        words = chunk.hashes(*chunk.spans(quality.ragged.SPACES)[:2])
        pairs = quality.ragged.grams(words, np.array([0, len(words)]), 2)[0]
        h[text] = np.concatenate([words, pairs]) >> np.uint64(48)
    raw = np.bincount(np.concatenate([h[t] for t in good + bad]).astype(int), minlength=quality.BUCKETS) + 1.0
    target = np.bincount(np.concatenate([h[good[i]] for i in range(0, 40, 2)]).astype(int), minlength=quality.BUCKETS) + 1.0
    ratio = np.log(target / target.sum()) - np.log(raw / raw.sum())
    assert rows[3].llr == pytest.approx(ratio[h[good[3]].astype(int)].mean())


def test_threshold_separates_with_least_error():
    assert quality.threshold_of(np.array([1.0, 2, 3, 4]), np.array([False, False, True, True])) == 2.5
    assert quality.threshold_of(np.array([1.0, 1, 2]), np.array([True, False, True])) == 1.5  # never between equal scores
    assert quality.threshold_of(np.array([1.0]), np.array([True])) == -np.inf


def test_quality_treats_unlabelled_texts_as_it_treats_labelled_ones(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    half = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(2)) == 0
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", "quality", half.alias("seen"))
    model = quality.fit(docs, labels.where("seen"))
    rows = quality.judge(docs, *model).join(labels, "doc_id").where("llr is not null").toPandas()
    rejected = (rows["llr"] < model[1]).groupby([rows["quality"], rows["seen"]]).mean()
    assert rejected[1, False] <= rejected[1, True] + 0.02
    assert rejected[0, False] >= 0.9


def test_quality_counts_per_fold_add_up(spark):
    texts = ["a b c", "a b", None, "", "c c c c", "a b c"]
    docs = frame(spark, [(t, i % 3) for i, t in enumerate(texts)], "text string, fold int")
    folds = quality.gram_counts(docs, 3)
    assert folds.shape == (3, quality.BUCKETS)
    assert (folds.sum(0) == quality.gram_counts(docs)[0]).all()
    assert folds.sum(1).tolist() == [5.0, 10.0, 5.0]  # words and word pairs


# -- lines ---------------------------------------------------------------------------------


def brute_lines(docs, least):
    """Deleted line numbers by comparing every run with every other."""
    places = []
    for doc, text in docs:
        lines = [(no, x, len(WORD.findall(x))) for no, x in enumerate((text or "").split("\n"))]
        places.append((doc, [x for x in lines if x[2]]))
    seen = {}
    for doc, lines in places:
        for i in range(len(lines)):
            for j in range(i + 1, len(lines) + 1):
                run = lines[i:j]
                if sum(w for _, _, w in run) >= least:
                    seen.setdefault(tuple(x for _, x, _ in run), []).append((doc, [no for no, _, _ in run]))
    gone = {doc: set() for doc, _ in docs}
    for found in seen.values():
        for doc, numbers in found[1:]:
            gone[doc].update(numbers)
    return gone


@pytest.mark.parametrize("least", [1, 4, 9])
def test_line_runs(spark, least):
    rng = random.Random(least)
    pool = ["a", "a b", "c d e", "f", "", "  ", "g h i j k", "l m"]
    docs = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(0, 9)))) for i in range(60)]
    docs += [(60, docs[3][1]), (61, "\n".join(["same line here"] * 12)), (62, None), (63, "")]
    rows = line_dedup.dedup_lines(frame(spark, docs), least).collect()
    gone = brute_lines(docs, least)
    for row in rows:
        text = dict(docs)[row.doc_id]
        assert set(row.removed) == gone[row.doc_id], (row, text)
        kept = None if text is None else "\n".join(x for no, x in enumerate(text.split("\n")) if no not in gone[row.doc_id])
        assert row.text == kept
        assert row.n_lines == (0 if text is None else len(text.split("\n")))


def test_line_dedup_has_no_python_and_keeps_columns(spark):
    docs = frame(spark, [(1, "x " * 60, 5), (2, "x " * 60, 6)], "doc_id long, text string, removed int")
    out = line_dedup.dedup_lines(docs)
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
    assert {r.doc_id: r.removed for r in out.collect()} == {1: [], 2: [0]}


# -- benchmark -----------------------------------------------------------------------------

SIGNS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def hits_of(text, items):
    words, hit, found = SIGNS.findall((text or "").translate(LOWER)), set(), set()
    for item_id, item in items:
        of = SIGNS.findall((item or "").translate(LOWER))
        n = min(10, len(of))
        for i in range(len(of) - n + 1 if n else 0):
            for at in range(len(words) - n + 1):
                if words[at : at + n] == of[i : i + n]:
                    hit.update(range(at, at + n))
                    found.add(item_id)
    return len(words), len(hit), sorted(map(str, found))


@pytest.mark.parametrize("block", [1, 1 << 25])
def test_decontamination(spark, monkeypatch, block):
    monkeypatch.setattr(decontamination, "BLOCK_CHARS", block)
    rng = random.Random(2)
    pool = ["the", "Cat", "sat", "\u00c9t\u00e9", "9", "on", "a"]
    items = [(i, " ".join(rng.choice(pool) for _ in range(rng.choice([0, 2, 5, 10, 14, 25])))) for i in range(12)]
    docs = []
    for i in range(150):
        item = rng.choice(items)[1].upper() if rng.random() < 0.5 else ""
        around = [" ".join(rng.choice(pool) for _ in range(rng.randint(0, 12))) for _ in range(2)]
        docs.append((i, rng.choice([", ", " ", "\n--"]).join([around[0], item, around[1]])))
    rows = decontamination.report(frame(spark, docs), frame(spark, items, "item_id long, text string")).collect()
    for row in rows:
        n, hit, found = hits_of(dict(docs)[row.doc_id], items)
        digest = hashlib.sha256(",".join(found).encode()).hexdigest()
        assert (row.n_words, row.n_hit, row.n_items, row.items_sha256) == (n, hit, len(found), digest)
        assert row.contaminated == (hit > 0)


def test_spans_map_to_the_original(spark):
    docs = frame(spark, [(1, "\u00c9!! So -- THE quick,brown \u00e9fox. End")])
    items = frame(spark, [(7, "the Quick brown")], "item_id long, text string")
    (row,) = decontamination.scan(docs, items, ["doc_id", "text"]).collect()
    (span,) = row.spans
    assert row.text.encode()[span.start_byte : span.end_byte].decode() == "THE quick,brown"
    assert (span.item_id, span.first_word, span.n_words) == ("7", 2, 3)


# -- near duplicates -----------------------------------------------------------------------


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) > 4 else {tuple(words)} - {()}


def brute_components(texts):
    sets = [shingles(t) for t in texts]
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, x in enumerate(sets):
        for j in range(i):
            y = sets[j]
            both = len(x & y)
            if both and 100 * both >= 75 * (len(x) + len(y) - both):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return sets, [root(i) for i in range(len(sets))]


def near_copies(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    texts = []
    for n, copies, most in ((150, 90, 0.09), (30, 60, 0.1), (500, 25, 0.06), (12, 60, 0.12), (7, 40, 0.2)):
        base = [rng.choice(vocabulary) for _ in range(n)]
        for _ in range(copies):
            rate = rng.random() * most
            texts.append(" ".join(rng.choice(vocabulary) if rng.random() < rate else w for w in base))
    passage = [rng.choice(vocabulary) for _ in range(40)]
    for _ in range(80):
        around = [[rng.choice(vocabulary) for _ in range(rng.randint(0, 50))] for _ in range(2)]
        texts.append(" ".join([*around[0], *passage, *around[1]]))
    texts += [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 25))) for _ in range(80)]
    texts += ["A b", "a  b", "c", "", "  ", None, None]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("seed, common, ranges", [(1, 16, 1 << 21), (2, 3, 3000)])
def test_join_finds_every_component(spark, monkeypatch, seed, common, ranges):
    monkeypatch.setattr(ngram_join, "COMMON", common)
    monkeypatch.setattr(ngram_join, "RANGE_ROWS", ranges)
    monkeypatch.setattr(ngram_join, "PART", 20 if common == 3 else 4096)
    texts = near_copies(seed)
    sets, want = brute_components(texts)
    rows = ngram_join.near_duplicates(frame(spark, enumerate(texts))).collect()
    assert len(rows) == len(texts)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == {i: (len(sets[i]), want[i]) for i in range(len(texts))}


def test_uncovered_sets_are_joined_by_single_shingles(spark, monkeypatch):
    texts = near_copies(3)
    # Too few segments to cover any difference: every set of several members takes the other way.
    monkeypatch.setattr(ngram_join, "segments_of", lambda band, limits: (np.ones_like(band), np.zeros(len(band), bool)))
    monkeypatch.setattr(ngram_join, "most_different", lambda n: 2 * n // 7 + (n > 3))
    _, want = brute_components(texts)
    rows = ngram_join.near_duplicates(frame(spark, enumerate(texts))).collect()
    assert {r.doc_id: r.component_id for r in rows} == dict(enumerate(want))


def test_one_document_of_each_group_stays(spark):
    docs = frame(spark, [(3, "a b c d e f", 1), (2, "A b c d e f", 2), (2, "A b c d e f", 2), (5, "", 3), (6, "", 4), (None, "a b c d e f", 5)], "doc_id long, text string, n int")
    kept = sorted((r.doc_id, r.n) for r in ngram_join.one_of_each(docs).collect())
    assert kept == [(2, 2), (5, 3), (6, 4)]


def test_a_filter_on_cleaned_texts_splits_them_once(spark):
    import corpus_pipeline

    df = spark.createDataFrame([(1, "a\nb", "en", "s", 3)], "doc_id long, text string, lang string, source string, n_chars long")
    plan = corpus_pipeline.dedup_lines(spark, df, "")._jdf.queryExecution().optimizedPlan().toString()
    above = plan[: plan.index("Join LeftOuter")]
    assert "Filter" in above and above.count("split(text") <= 2  # once in the filter, once in what it returns


def test_long_texts_of_many_deleted_lines_take_linear_time(spark):
    from vacancia.llm import line_dedup

    shared = "\n".join(f"line {i} of one passage" for i in range(4000))
    texts = [f"{shared}\nown {d}" for d in range(3)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = line_dedup.dedup_lines(df, emptied="gone").where("not gone").collect()
    assert sorted((r.doc_id, r.text, len(r.removed)) for r in rows) == [(0, texts[0], 0), (1, "own 1", 4000), (2, "own 2", 4000)]


def test_line_dedup_keeps_columns_with_names_like_its_own(spark):
    from vacancia.llm import line_dedup

    df = spark.createDataFrame([(1, "a", "x", "y", 3, 4)], "doc_id long, text string, __id string, __text string, __runs int, __lines int")
    row = line_dedup.dedup_lines(df).first()
    assert (row["__id"], row["__text"], row["__runs"], row["__lines"], row.n_lines) == ("x", "y", 3, 4, 1)


def test_joined_groups_of_near_copies_make_no_rows(spark):
    """Members of a common segment are tried only where it spans components and some set must be tried."""
    members = [(a, p, p <= 2) for p in (1, 2, 3) for a in range(20)]
    listed = spark.createDataFrame([(a, p, 20, asks) for a, p, asks in members], "a long, print long, held int, asks boolean")
    label = lambda *apart: spark.createDataFrame([(a, a if a in apart else 0) for a in range(20)], "id long, label long")
    assert ngram_join.placed(listed, label()).count() == 0
    assert {r.print for r in ngram_join.placed(listed, label(7)).collect()} == {1, 2}
    assert ngram_join.stars_between(listed, label()).count() == 0


def test_each_pass_shingles_the_wanted_texts_once(spark, monkeypatch):
    """A set's parities and members stand beside both sides of a pair, from one scan of the texts."""
    plans = []
    stored = ngram_join.stored
    monkeypatch.setattr(ngram_join, "stored", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or stored(df))
    monkeypatch.setattr(ngram_join, "COMMON", 3)
    docs = frame(spark, enumerate(near_copies(4)))
    ngram_join.near_duplicates(docs)
    assert any("bits_a" in plan for plan in plans)
    assert all(len(re.findall(r"MapInArrow run\(text", plan)) <= 1 for plan in plans)


def test_fingerprints_that_no_set_asks_for_are_left_out(spark):
    """Sets 0 to 19 hold three common segments and must be tried on two of them, not on the third."""
    rows = [(a, p, 20 + p, True, 1, 2) for p in (1, 2, 3) for a in range(20)]
    listed = spark.createDataFrame(rows, "a long, print long, held int, own boolean, units int, spare_a int")
    asked = ngram_join.asking(listed).collect()
    assert {r.print for r in asked if r.asks} == {r.print for r in asked} != {1, 2, 3}
    assert len(asked) == 20 * len({r.print for r in asked}) > 0
