"""The learned operators: gradients, distributions, held-out accuracy, and the whole pipeline."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from test_corpus_text import SIGNS, brute_components, brute_lines, hits_of
from vacancia.llm import language_id, lm_score, toxicity, url_filter
from vacancia.llm.common import read

SF = "/root/testdata/sf0.01"
WORD = re.compile("[^\x20\x09-\x0d]+")


# -- url filter ----------------------------------------------------------------------------


def plain_judgement(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([i for i in map(rest.find, "/?#") if i >= 0], default=len(rest))
    host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
    path = re.split("[?#]", rest[cut:], maxsplit=1)[0]
    fits = [r for r in url_filter.RULES if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fits, key=lambda r: len(r[0] + r[1]), default=None)
    return host, path, best and best[0] + best[1], best and best[2]


def test_rules(spark):
    rng = random.Random(1)
    hosts = ["Example.COM", "www.example.com", "a.www.example.com", "net", "x.net", "notnet", "com", "example.com.evil.org", "\u00c4.com", ""]
    paths = ["", "/", "/en/", "/en/x", "/EN/", "/es/y?/fr/", "/fr/#a", "?q=/en/", "#/en/", "/en"]
    urls = [rng.choice(["http://", "https://", "://", ""]) + rng.choice(hosts) + rng.choice(paths) for _ in range(300)] + [None, "a\nb://net/es/"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    for row in url_filter.judge(pages, url_filter.RULES, url_filter.fit(url_filter.labelled_urls())).collect():
        host, path, rule, verdict = plain_judgement(urls[row.page_id])
        assert (row.host, row.path, row.rule) == (host, path, rule), urls[row.page_id]
        assert row.verdict == (verdict or ("block" if row.score >= 0.5 else "allow"))


def test_model_tells_unseen_hosts_apart():
    model = url_filter.fit(url_filter.labelled_urls())
    hosts = ["casino-royal.example.org", "free-bets.example.com", "adult-x.example.net", "xxx-cams.example.org", "citylibrary.example.org", "sciencenews.example.com", "thehistory.example.net", "gardenbooks.example.org"]
    margins = model.margins(url_filter.pa.array(hosts), url_filter.pa.array(["/en/1"] * 8))
    assert (margins[:4] > 0).all() and (margins[4:] < 0).all()


# -- toxicity ------------------------------------------------------------------------------


def test_machine_learns_a_pair_that_no_sum_can():
    """Toxic only when an insult meets a group: neither alone, and neither is rarer than the other."""
    rng = np.random.default_rng(0)
    x = rng.integers(0, 2, (1200, 2))
    label = (x[:, 0] & x[:, 1]).astype(float)
    noise = 2 + rng.integers(0, 20, 1200)
    held = np.concatenate([np.column_stack([np.nonzero(x)[0], np.nonzero(x)[1]]), np.column_stack([np.arange(1200), noise])])
    held = held[np.lexsort((held[:, 1], held[:, 0]))]
    bias, linear, factors = toxicity.learn(held[:, 0], held[:, 1], label, np.ones(1200), 22)
    machine = toxicity.Machine(np.zeros(1), bias, linear, factors)
    margins = machine.margins(np.array([1, 2, 3, 3]), np.array([0, 1, 0, 1]), 4)
    assert margins[0] < 0 and margins[1] < 0 and margins[2] < 0 < margins[3]
    assert factors[0] @ factors[1] > 0.5


def test_only_real_near_copies_share_a_weight(spark, monkeypatch):
    """Texts that hold one common word pair, and eleven copies of one text."""
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    copied = " ".join(word() for _ in range(60))
    texts = [f"{'once again ' * 3}{word()} {word()}" for _ in range(60)] + [copied] * 10 + [f"{copied} {word()}"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 2 == 0 and i < 60)) for i in range(71)], "doc_id long, toxic int")
    seen = {}
    monkeypatch.setattr(toxicity, "choose", lambda rows, share: seen.update(share) or np.zeros(0, np.int64))
    toxicity.fit(docs, labels)
    alike = [i for i in seen if i >= 60]
    assert {round(seen[i], 9) for i in seen if i < 60} == {1.0}
    assert len(alike) > 1 and sum(seen[i] for i in alike) == pytest.approx(1)


def test_toxicity_on_held_out_rows(spark):
    rows = toxicity.op7_toxicity(spark, "/root/testdata/sf0.1").join(read(spark, "/root/testdata/sf0.1", "labels"), "doc_id").where("held_out").collect()
    right = sum(r.predicted == r.toxic for r in rows) / len(rows)
    found = [r.predicted for r in rows if r.toxic == 1]
    assert right > 0.96 and sum(found) / len(found) > 0.75
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in rows)


# -- language ------------------------------------------------------------------------------


@pytest.mark.parametrize("n", [0, 1, 2, 4, 6, 9, 40])
def test_codewords_differ(n):
    code = language_id.codewords(n)
    assert len(code) == n
    if n > 1:
        assert min((code[i] != code[j]).sum() for i in range(n) for j in range(i)) >= max(1, code.shape[1] // 4)


def test_decoding_mends_a_wrong_bit():
    code = language_id.codewords(6)
    model = language_id.Model([str(i) for i in range(6)], code, None, np.ones_like(code))
    margins = 3 * code.copy()
    margins[:, 0] *= -1
    best, score = model.decode(margins)
    assert best.tolist() == list(range(6)) and (score > 0.5).all()
    _, unsure = model.decode(np.zeros((1, code.shape[1])))
    assert unsure[0] == pytest.approx(1 / 6)


def test_language_on_held_out_rows(spark):
    rows = language_id.op10_language_id(spark, SF).join(read(spark, SF, "documents"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.98


def test_texts_without_letters_are_undetermined(spark):
    docs = read(spark, SF, "documents").select("doc_id", "text", "lang")
    odd = spark.createDataFrame([(-1, "123 !!", "en"), (-2, None, "en"), (-3, "", None)], "doc_id long, text string, lang string")
    rows = language_id.predict(odd, language_id.fit(docs)).collect()
    assert {(r.lang_pred, r.score, r.ambiguous) for r in rows} == {("und", 0.0, True)}


# -- language model ------------------------------------------------------------------------


def test_gradient():
    draw = np.random.default_rng(0)
    p = lm_score.start(draw.integers(0, 100, lm_score.SUBWORDS + 1).astype(float))
    p = {k: v.astype(np.float64) + 0.05 * draw.normal(size=v.shape) for k, v in p.items()}
    batch = lm_score.windows(draw.integers(0, lm_score.SUBWORDS, 70), np.array([0, 20, 20, 70]))

    def loss():
        g, _ = lm_score.hidden(p, batch[0], batch[1])
        return -lm_score.log_probabilities(p, g[batch[3]], batch[2][batch[3]]).mean()

    grads = lm_score.gradient(p, *batch[:4])
    for k in lm_score.SHAPES:
        at = np.unravel_index(np.abs(grads[k]).argmax(), grads[k].shape)
        old, step = p[k][at], 1e-4
        p[k][at] = old + step
        up = loss()
        p[k][at] = old - step
        down = loss()
        p[k][at] = old
        assert grads[k][at] == pytest.approx((up - down) / (2 * step), rel=1e-3, abs=1e-7), k


def test_steps_in_one_array_equal_plain_adam():
    """Gradients go straight into the array that a step takes, over stale entries of the step before."""
    draw = np.random.default_rng(2)
    mine = lm_score.start(draw.integers(0, 100, lm_score.SUBWORDS + 1).astype(float))
    plain = {k: v.astype(np.float64) for k, v in mine.items()}
    moments = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in plain.items()}
    adam = lm_score.Adam(mine, 0.01)
    for t in range(1, 6):
        ids = draw.integers(0, lm_score.SUBWORDS if t % 2 else 100, 400)
        batch = lm_score.windows(ids, np.array([0, 0, 150, 400]))[:4]
        adam.step(lm_score.gradient(mine, *batch, adam.grads))
        for k, g in lm_score.gradient(plain, *batch).items():
            a, b = moments[k]
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            plain[k] -= 0.01 * (a / (1 - 0.9**t)) / (np.sqrt(b / (1 - 0.99**t)) + 1e-6)
            if k in ("Wc", "Wm"):
                np.clip(plain[k], -1, 1, out=plain[k])
    for k in lm_score.SHAPES:
        assert np.abs(mine[k] - plain[k]).mean() < 1e-5 and np.abs(mine[k] - plain[k]).max() < 5e-3, k
        assert np.shares_memory(mine[k], adam.all)


def test_next_subwords_are_a_distribution_and_windows_score_each_once():
    draw = np.random.default_rng(1)
    p = lm_score.start(draw.integers(0, 9, lm_score.SUBWORDS + 1).astype(float))
    g = draw.normal(size=(1, lm_score.WIDTH)).astype(np.float32)
    every = np.arange(lm_score.SUBWORDS + 1)
    assert np.exp(lm_score.log_probabilities(p, np.repeat(g, len(every), 0), every)).sum() == pytest.approx(1, abs=1e-4)
    ids, first = draw.integers(0, lm_score.SUBWORDS, 83), np.array([0, 0, 1, 50, 83])
    inputs, exists, target, real, text = lm_score.windows(ids, first)
    assert [target[text == i][real[text == i]].tolist() for i in range(4)] == [[*ids[a:b], lm_score.END] for a, b in zip(first, first[1:])]
    # Nothing after a place, nor in another text, moves its probability.
    alone = lm_score.score_steps(p, ids[50:], np.array([0, 33]))
    assert lm_score.score_steps(p, ids, first)[3] == pytest.approx(alone[0], rel=1e-5)


def test_a_place_sees_at_least_sixteen_inputs_before_it():
    p = lm_score.start(np.zeros(lm_score.SUBWORDS + 1))
    ids = np.arange(40)
    other = np.concatenate([[99], ids[1:]])
    one, two = (lm_score.hidden(p, *lm_score.windows(x, np.array([0, 40]))[:2])[0].reshape(-1, lm_score.WIDTH) for x in (ids, other))
    assert np.abs(one[16] - two[16]).max() > 0  # input 1 is the first subword
    assert (one[0] == two[0]).all()


def test_every_round_trains_on_every_training_text(spark, monkeypatch):
    """Two million characters, above the size from which a sample was once taken."""
    read_by_rounds = []
    monkeypatch.setattr(lm_score, "train_round", lambda texts, p, pace: read_by_rounds.append(texts.count()) or p)
    docs = read(spark, SF, "documents")
    lm_score.scores(docs)
    ids = [r.doc_id for r in docs.select("doc_id").collect()]
    assert read_by_rounds == [sum(zlib.crc32(str(i).encode()) % 7 != 2 for i in ids)] * 3


def test_base_and_held_out_scores(spark):
    texts = {r.doc_id: r.text for r in read(spark, SF, "documents").select("doc_id", "text").collect()}
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tokens = {i: [*WORD.findall((t or "").translate(lower)), None] for i, t in texts.items()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    counts = Counter(w for i, words in tokens.items() if not held[i] for w in words)
    total, distinct = sum(counts.values()), len(counts)
    rows = lm_score.op3_lm_score(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        words = tokens[r.doc_id]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held[r.doc_id], len(words), total)
        assert r.n_known == sum(counts[w] > 0 for w in words)
        assert r.base_score == pytest.approx(sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in words))
        assert math.isfinite(r.score) and r.score < 0
    # Far better than the subword frequencies the model starts from.
    out = [r for r in rows if r.held_out]
    assert sum(r.score for r in out) / sum(r.n_tokens for r in out) > -4.6


# -- pipeline ------------------------------------------------------------------------------


def test_pipeline_equals_a_plain_one(spark, tmp_path):
    """Stage by stage on a fixture whose languages are easy, with copies, passages and test items."""
    rng = random.Random(3)
    syllables = {"en": ["the", "ing", "tion", "er"], "de": ["sch", "ung", "keit", "ein"]}
    word = lambda lang: "".join(rng.choice(syllables[lang]) for _ in range(rng.randint(1, 4)))
    line = lambda lang, n: " ".join(word(lang) for _ in range(n))
    passage, item = line("en", 60), line("en", 14)
    docs = []
    for i in range(120):
        lang = "de" if i % 3 == 0 else "en"
        docs.append([i, "\n".join(line(lang, rng.randint(5, 30)) for _ in range(4)), lang])
    for i in (10, 20, 40):
        docs[i][1] += "\n" + passage
    for i in (31, 32):
        docs[i][1] = docs[i][1].replace("\n", f" {item.upper()}, ", 1)
    docs[50][1] = docs[49][1]
    docs[52][1] = docs[51][1].replace("\n", "\nextra ", 1)
    docs += [[120, "123 456 ***", "en"], [121, None, "en"], [122, "", None], [123, docs[5][1], "en"]]
    rows = [(*d, "src", len(d[1] or ""), "more") for d in docs]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, label string")
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    kept = [(i, t) for i, t, _ in docs if t and re.search(r"[a-z]", t)]
    gone = brute_lines(kept, 50)
    kept = [(i, "\n".join(x for no, x in enumerate(t.split("\n")) if no not in gone[i])) for i, t in kept]
    kept = [(i, t) for i, t in kept if not gone[i] or WORD.search(t)]
    _, roots = brute_components([t for _, t in kept])
    kept = [x for at, x in enumerate(kept) if roots[at] == at]
    kept = [(i, t) for i, t in kept if not hits_of(t, [(1, item)])[1]]
    assert {i for i in (31, 32, 120, 121, 122, 123)}.isdisjoint(i for i, _ in kept) and len(kept) < 118
    assert SIGNS.search(passage)

    stage_docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        stage(spark, stage_docs, str(tmp_path)).write.parquet(f"{tmp_path}/stage{n}")
        stage_docs = spark.read.parquet(f"{tmp_path}/stage{n}")
        assert stage_docs.columns == frame.columns
    assert sorted((r.doc_id, r.text) for r in stage_docs.collect()) == sorted(kept)
    assert all(r.n_chars == len(r.text) for r in stage_docs.collect())
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(r.doc_id for r in out) == sorted(i for i, _ in kept)


def test_pipeline_takes_an_empty_table(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
