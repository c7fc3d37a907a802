"""Token counts and byte-level BPE against the libraries of the vocabulary files."""

import base64
import hashlib
import random

import pytest
import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

from vacancia.llm import byte_bpe, token_counts

ALPHABET = " \t\n\r'stvemldrabcdeiou09\u0661a\u00e9\u0416\u4e2d\u6587\u00a0\u3000 \x1c\x85!#\U0001f600aaaa\x00"


def texts(n, seed):
    rng = random.Random(seed)
    out = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 40))) for _ in range(n)]
    return out + ["", "a" * 2000, "ab" * 1500, "\u4e2d\u6587" * 300, "<|endoftext|>", "x<|endoftext|><|endoftext|> y", "Hello world's end"]


def test_counts_equal_the_library():
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = texts(4000, 1) + [t + "<|endoftext|>" + t[:3] for t in texts(200, 2)]
    assert token_counts.merges("byte_bpe_50k.json").count(rows) == [len(library.encode(t, add_special_tokens=False).ids) for t in rows]


def test_counts_do_not_depend_on_block_or_cache(monkeypatch):
    rows = texts(300, 3)
    want = token_counts.Merges().count(rows)
    monkeypatch.setattr(token_counts, "BLOCK", 3)
    monkeypatch.setattr(token_counts, "CACHE", 5)
    assert token_counts.Merges().count(rows) == want


@pytest.fixture(scope="module")
def library():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_ids_and_round_trip_equal_the_library(spark, library):
    rows = dict(enumerate([None, *texts(1500, 4)]))
    got = byte_bpe.digests(spark.createDataFrame(list(rows.items()), "doc_id long, text string")).collect()
    assert len(got) == len(rows)
    for row in got:
        text = rows[row.doc_id] or ""
        ids = library.encode_ordinary(text)
        digest = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert (row.n_tokens, row.ids_sha256) == (len(ids), digest), repr(text)
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_table_of_frequent_words_changes_no_id(spark, monkeypatch):
    df = spark.createDataFrame(list(enumerate(["the cat the cat", "the dog", "a cat", " the zzz"])), "doc_id long, text string")
    want = sorted(byte_bpe.digests(df).collect())
    monkeypatch.setattr(byte_bpe, "WORD_SLOTS", 2)
    monkeypatch.setattr(byte_bpe, "FREQUENT", 1)
    assert sorted(byte_bpe.digests(df).collect()) == want


def test_encode_carries_columns_and_gives_ids(spark, library):
    df = spark.createDataFrame([(1, "Hello world", "kept")], "doc_id long, text string, other string")
    row = byte_bpe.encode(df).select("other", byte_bpe.ids(byte_bpe.F.col("symbols")).alias("ids")).first()
    assert (row.other, row.ids) == ("kept", library.encode_ordinary("Hello world"))


def test_words_of_one_slot_are_all_folded_once(spark, monkeypatch):
    """Every frequent word is in the table, and the constants stand in no row on the way."""
    frames = []
    stored = byte_bpe.stored
    monkeypatch.setattr(byte_bpe, "stored", lambda df: frames.append(df) or stored(df))
    monkeypatch.setattr(byte_bpe, "WORD_SLOTS", 2)
    words = [f"w{c}" for c in "abcdefgh"]
    docs = spark.createDataFrame([(i, " ".join(words)) for i in range(3)], "doc_id long, text string")
    t = byte_bpe.tables(spark, byte_bpe.RANKS)
    entries = spark.range(1).select(byte_bpe.frequent_words(docs, t).alias("v")).first().v
    found = [e.word for slot in entries if slot for e in (slot, *(slot.more or []))]
    assert sorted(found) == sorted([words[0], *(f" {w}" for w in words[1:])])
    for plan in (df._jdf.queryExecution().executedPlan().toString() for df in frames):
        assert "__t" not in "".join(line.rpartition("output=")[2] for line in plan.splitlines() if "output=" in line)


def test_short_and_long_words_fold_alike(spark, library):
    rng = random.Random(9)
    words = ["".join(rng.choice("aaabcdeiouéЖ") for _ in range(n)) for n in range(50, 80)]
    docs = spark.createDataFrame(list(enumerate(words)), "doc_id long, text string")
    rows = byte_bpe.encode(docs).select("text", byte_bpe.ids(byte_bpe.F.col("symbols")).alias("ids")).collect()
    assert all(r.ids == library.encode_ordinary(r.text) for r in rows) and len(rows) == 30


def test_constants_stand_in_no_row_of_the_digests(spark):
    """A projection below that makes the ids must not hold the pieces (a megabyte) for each row."""
    docs = spark.createDataFrame([(1, "the cat"), (2, None)], "doc_id long, text string")
    plan = byte_bpe.digests(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "ids" in plan and not any(f"AS {name}#" in plan for name in ("__pieces", "__t", "__frequent"))


def test_table_of_blocks_stands_in_the_order_of_slots(spark, monkeypatch):
    """The table is put together from blocks, so no task holds a row for each of its entries."""
    plans = []
    frame = type(spark.range(0))
    scalar = frame.scalar
    monkeypatch.setattr(byte_bpe, "WORD_SLOTS", 4096)
    words = [f"w{i}" for i in range(50)]
    docs = spark.createDataFrame([(i, " ".join(words)) for i in range(2)], "doc_id long, text string")
    t = byte_bpe.tables(spark, byte_bpe.RANKS)
    monkeypatch.setattr(frame, "scalar", lambda df: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or scalar(df))
    table = byte_bpe.frequent_words(docs, t)
    entries = spark.range(1).select(table.alias("v")).first().v
    slot = byte_bpe.slot_of(byte_bpe.F.col("w"))
    at = {r.w: r.s for r in spark.createDataFrame([(e.word,) for e in entries if e], "w string").select("w", slot.alias("s")).collect()}
    assert len(entries) == 4096 and len(at) > 40 and all(entries[s].word == w for w, s in at.items())
    assert all(p.count("Aggregate") == 2 for p in plans) and plans


def test_a_worker_gives_memory_back_after_its_last_batch(monkeypatch):
    from vacancia.llm import common

    said = []
    monkeypatch.setattr(common, "release", lambda: said.append("released"))
    step = common.released(lambda batches: (said.append(b) or b for b in batches))
    assert list(step(iter([1, 2]))) == [1, 2] and said == [1, 2, "released"]
    monkeypatch.undo()
    common.release()
