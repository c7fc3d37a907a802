"""Personal data, fill-in-middle and collocations against plain versions."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from vacancia.llm import collocations, fill_in_middle, hat_trie, personal_data
from vacancia.llm.queries import QUERIES

# -- personal data -----------------------------------------------------------------------

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    out = []
    for k, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            if kind == "card":
                doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
                if not 16 <= len(digits) <= 19 or sum(d - 9 * (d > 9) for d in doubled) % 10:
                    continue
            out.append((k, *m.span()))
    return out


def test_base_spans_equal_the_plain_patterns():
    rng = random.Random(5)
    parts = ["a@b.c", "x.y@m-1.org", "@", ".", "1.2.3.4", "255.256.1.1", "000.0.0.255", "4111 1111 1111 1111", "+1 (22) 333-4444", "+", "-", " ", "12", "é", "a%b", "\n"]
    for _ in range(20_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 9)))
        assert personal_data.base_spans(text) == plain_spans(text), repr(text)


def test_long_runs_take_linear_time():
    for text in ("a" * 300_000, "1" * 300_000, "a" * 300_000 + "@", "1." * 150_000 + "x", "+1 " * 100_000, "@" * 300_000, "a@b" * 100_000):
        personal_data.base_spans(text)


def test_base_columns_of_the_query(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    rows = QUERIES["op11_personal_data"](spark, sf).collect()
    assert len(rows) == len(texts)
    for row in rows:
        spans = plain_spans(texts[row.doc_id] or "")
        said = ",".join(f"{personal_data.KINDS[k]}:{s}:{e}" for k, s, e in spans)
        assert row.base_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(k == x for k, *_ in spans) for x in range(4)]
        assert set(filter(None, said.split(","))) <= set(row.spans.split(","))


def contextual(unseen, noise=400):
    """Texts with phones after a phrase of their own, numbers in common contexts, and one unseen form."""
    rng = random.Random(3)
    words = "the of and to in that it was for on are with".split()
    fill = lambda n: " ".join(rng.choice(words) for _ in range(n))
    rows = [f"{fill(8)} call us at +1 (20{i}) 555-01{i}0 until noon {fill(6)}" for i in range(8)]
    rows += [f"{fill(9)} {rng.randint(10**8, 10**9)} {fill(9)}" for _ in range(noise)]
    rows += [f"{fill(4)} the +1 (30{i}) 555-01{i}0 of {fill(4)}" for i in range(4)]
    return [f"{fill(5)} call us at {unseen} until noon {fill(5)}", *rows]


def found(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = personal_data.personal_data(df).collect()
    return {r.doc_id: [(s.kind, texts[r.doc_id][s.start : s.end]) for s in r.spans if s not in r.base] for r in rows}


def test_contexts_discover_an_unseen_form_and_nothing_else(spark):
    got = found(spark, contextual("555.010.2233"))
    assert got.pop(0) == [(3, "555.010.2233")]
    assert not any(got.values())  # numbers in ordinary contexts stay


def test_an_identifier_is_found_again_elsewhere(spark):
    texts = contextual("(555)010-2233") + ["nothing around 5550102233 here", "nothing around 5550102299 here"]
    got = found(spark, texts)
    assert got[len(texts) - 2] == [(3, "5550102233")] and got[len(texts) - 1] == []


def test_confidence_spreads_in_rounds(spark):
    rng = random.Random(9)
    number = lambda: f"{rng.randint(200, 999)}.{rng.randint(100, 999)}.{rng.randint(1000, 9999)}"
    shared, far = [number() for _ in range(4)], number()
    texts = [f"call us at +1 (2{i:02}) 555-01{i}0 until noon" for i in range(30)]
    texts += [f"call us at {n} until noon" for n in shared]  # found in round 1
    texts += [f"my desk line {n} rings twice" for n in shared] * 4  # which makes this a pattern of round 2
    texts += [f"my desk line {far} rings twice"]
    got = found(spark, texts)
    assert got[len(texts) - 1] == [(3, far)]


def test_totals_count_every_word_in_a_slot(spark):
    texts = ["a b c a b 1234567 d", "a b x", "b", ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    full = np.full(personal_data.SLOTS // 64, 2**64 - 1, np.uint64)
    got = Counter({r.pattern: r.n for r in personal_data.pattern_totals(df, full).collect()})
    assert sum(got.values()) == 3 * sum(len(t.split()) for t in texts)
    slot = personal_data.scan(df).where("doc_id = 0").first().slots[0]
    assert [got[p] for p in slot.patterns] == [3, 1, 1] and list(slot.shown) == ["a b _", "b _ d", "_ d $"]


# -- fill-in-middle ----------------------------------------------------------------------


def test_select_and_rank_find_every_code_point():
    rng = random.Random(1)
    for _ in range(300):
        texts = ["".join(rng.choice("aé中\U0001f600") for _ in range(rng.randint(0, 30))) for _ in range(rng.randint(1, 5))]
        text = "".join(texts)
        data = np.frombuffer(text.encode(), np.uint8)
        units = fill_in_middle.Units(data)
        want = [len(text[:k].encode()) for k in range(len(text) + 1)]
        assert units.select(np.arange(len(text) + 1)).tolist() == want
        ranks = units.rank(np.arange(len(data) + 1))
        assert ranks[want].tolist() == list(range(len(text) + 1))


def test_every_form_is_restored(spark):
    texts = [None, "", "plain", "has <P> in it", "<", "<P", "S><M", "é中\U0001f600" * 40, "<<<>>>PSM" * 30, "x" * 100_000]
    rows = [(i * 100 + j, t) for i in range(30) for j, t in enumerate(texts)] + [(None, "no id"), (70007, "twice"), (70007, "twice")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    made = fill_in_middle.fill_in_middle(df)
    got = made.withColumn("back", fill_in_middle.restore(made.output, made.form)).collect()
    assert {r.form for r in got} == {"plain", "psm", "spm"} and len(got) == len(rows)
    by_id = dict(rows)
    for r in got:
        text = by_id[r.doc_id] or ""
        assert r.back == text and r.n == len(text)
        a, b, plain, spm = fill_in_middle.draws(r.doc_id, len(text))
        a, b = min(a, b), max(a, b)
        if not text or "<P>" in text or plain >= 90:
            assert (r.form, r.output, r.prefix_chars, r.middle_chars) == ("plain", text, None, None)
        else:
            want = f"<S>{text[b:]}<P>{text[:a]}<M>{text[a:b]}" if spm < 20 else f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}"
            assert (r.output, r.prefix_chars, r.middle_chars) == (want, a, b - a)


# -- collocations ------------------------------------------------------------------------


@pytest.mark.parametrize("burst", [1, 2, 7, 1 << 20])
def test_trie_counts_like_a_table(burst):
    rng = np.random.default_rng(burst)
    node, want = hat_trie.Node(2 * hat_trie.BITS, burst), Counter()
    for _ in range(20):
        ids = rng.zipf(1.5, (500, 3)) % 50 + 1
        keys = (ids[:, 0] << 2 * hat_trie.BITS) | (ids[:, 1] << hat_trie.BITS) | ids[:, 2]
        before = len(want)
        want.update(keys.tolist())
        assert node.add(*np.unique(keys, return_counts=True)) == len(want) - before
    table = lambda part: dict(zip(*[x.tolist() for x in part.items()]))
    assert table(node) == want and len(node) == len(want)
    taken = node.pop_largest()
    assert table(taken) | table(node) == want and len(taken) + len(node) == len(want)


def plain_collocations(rows, least, share, top):
    counts, sizes = Counter(), Counter()
    for lang, text in rows:
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", low):
            words = re.findall(r"[^ \t]+", piece)
            sizes[lang or "und"] += len(words)
            for k in (1, 2, 3):
                for i in range(len(words) - k + 1):
                    counts[lang or "und", tuple(words[i : i + k])] += 1
    chosen = {}
    for (lang, p), a in counts.items():
        if len(p) > 1 and a >= least:
            cuts = [(10**6 * a * a // (counts[lang, p[:k]] * counts[lang, p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            chosen[lang, p] = (score, a, counts[lang, p[:k]], counts[lang, p[k:]])
    out = []
    for lang in {lang for lang, _ in chosen}:
        inside = {q for (x, p) in chosen if x == lang and len(p) == 3 for q in (p[:2], p[1:]) if 100 * counts[lang, p] >= share * counts[lang, q]}
        kept = [(-s, -a, " ".join(p).encode(), a, l, r) for (x, p), (s, a, l, r) in chosen.items() if x == lang and p not in inside]
        for i, (s, _, p, a, l, r) in enumerate(sorted(kept)[:top]):
            out.append((lang, i + 1, p.decode(), a, l, r, sizes[lang], -s))
    return sorted(out)


def random_rows():
    rng = random.Random(2)
    words = ["New", "york", "CITY", "of", "the", "Été", "x\x00y", "\U0001f600", "a", " b"]
    ends = [" ", " ", " ", "\t", ". ", ",", "\n", "  "]
    rows = [(rng.choice(["en", None, "de"]), "".join(rng.choice(words) + rng.choice(ends) for _ in range(rng.randint(0, 60)))) for _ in range(120)]
    return rows + [("fr", None), ("fr", ""), ("es", "..."), ("en", "new york city " * 50)]


@pytest.mark.parametrize("small", [False, True])
def test_collocations_equal_the_plain_version(spark, monkeypatch, small):
    if small:  # spill, lose the ids and burst all the time; crowd the table of bits
        for name, value in (("HELD", 3), ("WORDS", 5), ("SLOTS", 64), ("BURST", 2), ("ROWS", 2), ("PARTS", 2)):
            monkeypatch.setattr(collocations, name, value)
    rows = random_rows()
    df = spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string")
    got = collocations.collocations(df.repartition(3), least=3, share=50, top=20).collect()
    assert sorted(map(tuple, got)) == plain_collocations(rows, 3, 50, 20)


def test_scores_beyond_64_bits_are_exact(spark):
    a = F_a = 3_000_000_000
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(a, 2 * a, 3 * a + 1)], "f long, l long, r long")
    x, l, r = (F.col(c).cast("decimal(19,0)") for c in "flr")
    got = df.select(F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * (x * x), l * r).alias("s")).first().s
    assert got == 10**6 * F_a * F_a // (2 * F_a * (3 * F_a + 1))


def test_awkward_tables_have_no_rows_or_their_own_language(spark):
    schema = "doc_id long, text string, lang string, phrase string, n int, f int, score int"
    empty = spark.createDataFrame([], schema)
    assert collocations.collocations(empty).collect() == []
    rows = spark.createDataFrame([(None, "a b " * 10, None, "p", 1, 2, 3), (None, None, "en", None, None, None, None)], schema)
    assert [(r.lang, r.phrase, r.a) for r in collocations.collocations(rows).collect()] == [("und", "a b", 10), ("und", "b a", 9)][:1]
