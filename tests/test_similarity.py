"""Near-duplicate pairs: equal to brute force on both paths, and candidates that grow with the rows."""

import random

import pytest
from pyspark.sql import functions as F

from vacancia.operators import edits, similarity

LETTERS = "abcdefghijklmnopqrstuvwxyz"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def near(a, b, ratio):
    return distance(a.lower(), b.lower()) / max(len(a), len(b)) <= ratio


def changed(rng, text):
    out = list(text)
    for _ in range(rng.randint(0, 4)):
        at = rng.randrange(len(out) + 1)
        rng.choice([lambda: out.insert(at, rng.choice("ab")), lambda: out.pop(at) if at < len(out) and len(out) > 1 else None,
                    lambda: out.__setitem__(min(at, len(out) - 1), rng.choice("ab"))])()
    return "".join(out)


def names(rng, n):
    roots = ["a", "ab", "Acme", "aab aab", "Bob's Bakery", "International Trade Co", "x" * 60, "abcabcabc"]
    return sorted({changed(rng, rng.choice(roots)) for _ in range(n)})


@pytest.mark.parametrize("ratio", [0.15, 0.35, 0.6])
@pytest.mark.parametrize("small", [0, 64])
def test_candidates_lose_no_similar_name(spark, ratio, small):
    rng = random.Random(7)
    companies = names(rng, 140)
    posts = spark.createDataFrame([("t", c, rng.randint(0, 1)) for c in companies], "title string, company string, block int")
    titles = spark.createDataFrame([("t", "t")], "text_a string, text_b string")
    rows = posts.collect()
    got = {frozenset([(r.company_a, r.block_a), (r.company_b, r.block_b)]) for r in similarity.company_candidates(posts, titles, ratio, small).collect()}
    for i, x in enumerate(rows):
        for y in rows[i:]:
            if near(x.company, y.company, ratio):
                assert frozenset([(x.company, x.block), (y.company, y.block)]) in got, (x, y)


def test_pairs_equal_brute_force(spark, monkeypatch):
    rng = random.Random(3)
    companies, titles = names(rng, 12), ["Data Analyst", "Data Analyst!", "Data Engineer", "Chef"]
    rows = [(i, rng.choice(titles), rng.choice([*companies, None, ""]), rng.randint(1, 9), i % 2) for i in range(160)]
    df = spark.createDataFrame(rows, "id int, title string, company string, d int, extra int").withColumn("day", F.expr("date_add(date'2026-01-01', d)"))
    want = sorted(
        (a[0], b[0]) for a in rows for b in rows
        if a[0] < b[0] and a[2] and b[2] and abs(a[3] - b[3]) <= 3 and near(a[1], b[1], 0.15) and near(a[2], b[2], 0.35)
    )
    for small in (0, 64):
        monkeypatch.setattr(similarity.company_candidates, "__defaults__", (small,))
        got = similarity.fuzzy_pairs(df, "id", "title", "company", "day", keep=("extra",)).collect()
        assert sorted((r.id_a, r.id_b) for r in got) == want
        assert all(r.extra_a == r.id_a % 2 and r.extra_b == r.id_b % 2 for r in got)


def random_names(rng, n):
    return ["".join(rng.choice(LETTERS) for _ in range(rng.randint(9, 16))) for _ in range(n)]


def test_candidates_grow_with_the_names(spark):
    """Titles grow with the names: groups stay as large, so candidates must stay in proportion."""
    counts = []
    for times in (1, 2, 4):
        rng = random.Random(times)
        rows = [(f"title number {i % (20 * times)} of its kind", c, i % 7) for i, c in enumerate(random_names(rng, 2000 * times))]
        posts = spark.createDataFrame(rows, "title string, company string, block int")
        same = posts.select(F.col("title").alias("text_a"), F.col("title").alias("text_b")).distinct()
        counts.append(similarity.company_candidates(posts, same, 0.35).count())
    assert counts[2] < 4.8 * counts[0], counts


def test_one_hot_title_is_not_compared_in_pairs(spark):
    rng = random.Random(1)
    posts = spark.createDataFrame([("hot", c, 0) for c in random_names(rng, 3000)], "title string, company string, block int")
    same = spark.createDataFrame([("hot", "hot")], "text_a string, text_b string")
    n = similarity.company_candidates(posts, same, 0.35).count()
    assert n < 0.1 * 3000 * 3000 / 2, n


def brute_links(rows):
    links = [
        (a, b) for a in rows for b in rows
        if a[0] != b[0] and a[2] and b[2] and abs(a[3] - b[3]) <= 3 and near(a[1], b[1], 0.15) and near(a[2], b[2], 0.35)
    ]
    least = {a[0]: a[0] for a, _ in links}
    while True:
        moved = dict(least)
        for a, b in links:
            moved[a[0]] = min(moved[a[0]], moved[b[0]])
        if moved == least:
            break
        least = moved
    return sorted((i, least[i], sum(a[0] == i for a, _ in links), sum(a[0] == i and b[4] < a[4] for a, b in links)) for i in least)


@pytest.mark.parametrize("dense", [True, False])
def test_links_equal_brute_force(spark, tmp_path, monkeypatch, dense):
    """A row per id with its class and links, compared in blocks of a few rows or by gram pairs."""
    rng = random.Random(5)
    companies, titles = names(rng, 12), ["Data Analyst", "Data Analyst!", "Data Engineer", "Chef"]
    rows = [(i, rng.choice(titles), rng.choice([*companies, None, ""]), rng.randint(1, 30), i % 3) for i in rng.sample(range(900), 150)]
    df = spark.createDataFrame(rows, "id int, title string, company string, d int, extra int").withColumn("day", F.expr("date_add(date'2026-01-01', d)"))
    monkeypatch.setattr(similarity, "alike", lambda *_: dense)
    monkeypatch.setattr(similarity, "BLOCK", 3)
    got = similarity.fuzzy_links(df, "id", "title", "company", "day", F.col("extra_b") < F.col("extra_a"), str(tmp_path), ("extra",))
    assert sorted(map(tuple, got.collect())) == brute_links(rows)


def test_similar_names_are_counted_without_their_pairs(spark, tmp_path):
    """Nearly all names are alike: 1,200 rows have hundreds of thousands of links, and a row each."""
    names_ = spark.range(1200).selectExpr("id", "'Data Analyst' AS title", "concat('Company ', id % 37, '-', id) AS company", "date'2026-01-01' AS day")
    assert similarity.alike(names_.select(F.lower("company").alias("low")), 0.35)
    got = similarity.fuzzy_links(names_, "id", "title", "company", "day", F.lit(False), str(tmp_path)).collect()
    assert len(got) == 1200 and {r.class_id for r in got} == {0}
    assert sum(r.n_links for r in got) > 400_000


def test_unlike_names_keep_the_filter(spark):
    unlike = spark.createDataFrame([(c,) for c in random_names(random.Random(2), 2000)], "low string")
    assert not similarity.alike(unlike, 0.35)


def test_distances_of_many_at_once():
    """Bit-parallel distances equal the table's, at every word size and over shared beginnings."""
    rng = random.Random(4)
    texts = ["", "a", "ß東🙂b", "x" * 16, "x" * 17, "x" * 33, "y" * 64, *names(rng, 60)]
    queries = sorted([*texts, "z" * 70, "xx", "東京"])
    for most in (16, 32, 64):
        some = [t for t in texts if len(t) <= most]
        found = edits.Texts(some)
        assert found.word(0).nbytes * 8 == most
        for query, got in zip(queries, found.distances(queries)):
            assert (got + len(query)).tolist() == [distance(t, query) for t in some], query
    with pytest.raises(ValueError):
        edits.Texts(["y" * 65])


@pytest.mark.parametrize("part", [7, 16384])
def test_links_of_large_groups_equal_brute_force(spark, tmp_path, monkeypatch, part):
    """Groups over ``SMALL`` are counted in numpy, in parts: NULL standings, names over 64, shared ids."""
    rng = random.Random(8)
    companies, titles = [*names(rng, 12), "x" * 70, "x" * 66, "ß" * 3], ["Data Analyst", "Data Analyst!", "Data Engineer", "Chef"]
    ids = [f"p{i}" for i in rng.sample(range(900), 200)]
    rows = [(rng.choice(ids[:190]) if i % 20 == 0 else ids[i], rng.choice(titles), rng.choice(companies), rng.randint(1, 30), rng.choice([0, 1]), rng.choice([None, 1, 2])) for i in range(200)]
    schema = "id string, title string, company string, d int, unpaid int, rank int"
    df = spark.createDataFrame(rows, schema).withColumn("day", F.expr("date_add(date'2026-01-01', d)"))

    def lost(a, b):
        for x, y in zip(a[4:], b[4:]):
            if x is not None and y is not None and x != y:
                return y < x
        return b[0] < a[0]

    plain = brute_links([(*r[:4], 0) for r in rows])
    losses = {}
    for a in rows:
        for b in rows:
            if a[0] != b[0] and abs(a[3] - b[3]) <= 3 and near(a[1], b[1], 0.15) and near(a[2], b[2], 0.35):
                losses[a[0]] = losses.get(a[0], 0) + lost(a, b)
    monkeypatch.setattr(similarity, "alike", lambda *_: True)
    monkeypatch.setattr(similarity, "SMALL", 4)
    monkeypatch.setattr(similarity, "PART", part)
    counted = []
    monkeypatch.setattr(similarity, "_parts", lambda *a, f=similarity._parts: counted.append(1) or f(*a))
    got = similarity.fuzzy_links(df, "id", "title", "company", "day", ("unpaid", "rank"), str(tmp_path), ("unpaid", "rank"))
    assert sorted(map(tuple, got.collect())) == [(i, c, n, losses[i]) for i, c, n, _ in plain]
    assert counted


def test_a_hot_group_is_not_joined_row_by_row(spark, tmp_path, monkeypatch):
    """Groups of many rows go to numpy: the plan that joins rows sees small groups only."""
    rows = spark.range(400).selectExpr("id", "'Data Analyst' AS title", "concat('Company ', id % 37, '-', id) AS company", "date'2026-01-01' AS day", "0 AS rank")
    met = []
    monkeypatch.setattr(similarity, "_blocks", lambda a, b, links, *rest, f=similarity._blocks: met.append(links.count()) or f(a, b, links, *rest))
    got = similarity.fuzzy_links(rows, "id", "title", "company", "day", ("rank",), str(tmp_path), ("rank",)).collect()
    assert met and not any(met)
    assert len(got) == 400 and sum(r.n_lost for r in got) * 2 == sum(r.n_links for r in got) > 40_000
