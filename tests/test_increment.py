"""The mart kept batch by batch equals the mart built at once."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from vacancia import schemas
from vacancia.plans import increment, mart
from vacancia.streaming import ingest

AT = dt.datetime(2026, 8, 1)


def posting(provider, id, title, company, minutes, query="q"):
    if provider == "jsearch":
        doc = {"job_id": id, "job_title": title, "employer_name": company, "job_description": "text"}
    elif provider == "theirstack":
        doc = {"id": id, "job_title": title, "company": company, "description": "text"}
    else:
        doc = {"identifier": {"value": id}, "title": title, "hiringOrganization": {"name": company}, "description": "text"}
    return (f"{provider}:{query}", json.dumps(doc), AT + dt.timedelta(minutes=minutes), minutes)


def label(id, archetype, minutes):
    row = dict.fromkeys(schemas.ENRICHMENT.fieldNames())
    return tuple({**row, "job_id": id, "role_archetype": archetype, "enriched_at": AT + dt.timedelta(minutes=minutes)}.values())


def batches(n=3, size=50):
    """Postings that come again with other titles and companies, and labels that change."""
    rng = random.Random(4)
    ids = [*map(str, range(40)), None]
    titles = ["Data Analyst", "data analyst ", "Data Engineer", "Senior Analyst", None]
    out, minute = [], 0
    for _ in range(n):
        rows, labels = [], []
        for _ in range(size):
            minute += 1
            provider = rng.choice(schemas.PROVIDERS)
            rows.append(posting(provider, rng.choice(ids), rng.choice(titles), rng.choice(["A", "B", "C", None]), minute))
            if rng.random() < 0.3:
                labels.append(label(rng.choice(ids[:-1]), rng.choice(["data_analyst", "software_engineer", None]), minute))
        out.append((rows, labels))
    return out


def frames(spark, rows, labels):
    return spark.createDataFrame(rows, schemas.LANDING), spark.createDataFrame(labels, schemas.ENRICHMENT)


def built(spark, parts):
    landing, labels = frames(spark, [r for rows, _ in parts for r in rows], [x for _, labels in parts for x in labels])
    return content(mart.build_mart(mart.split_landing(landing), labels))


def content(df):
    return sorted(map(str, df.select(*schemas.MART_COLUMNS).collect()))


@pytest.fixture(scope="module")
def parts():
    return batches()


def test_batches_equal_the_full_build_and_repeats_change_nothing(spark, tmp_path, parts):
    kept = increment.MartStore(spark, str(tmp_path), buckets=7)
    assert kept.mart().collect() == []
    for i, (rows, labels) in enumerate(parts):
        assert kept.apply(i, *frames(spark, rows, labels))
    assert not kept.apply(2, *frames(spark, *parts[0]))  # known by its number
    assert kept.apply(len(parts), *frames(spark, *parts[-1]))  # the same rows again under another one
    assert content(kept.mart()) == built(spark, parts)


def test_a_batch_that_dies_is_invisible_and_can_be_repeated(spark, tmp_path, parts, monkeypatch):
    kept = increment.MartStore(spark, str(tmp_path), buckets=3)
    kept.apply(0, *frames(spark, *parts[0]))
    with monkeypatch.context() as m:
        m.setattr(increment.MartStore, "_commit", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            kept.apply(1, *frames(spark, *parts[1]))
    assert content(kept.mart()) == built(spark, parts[:1])
    assert kept.apply(1, *frames(spark, *parts[1]))
    assert content(kept.mart()) == built(spark, parts[:2])


def test_the_runner_up_wins_when_the_winner_moves_away(spark, tmp_path):
    kept = increment.MartStore(spark, str(tmp_path), buckets=16)
    first = [posting("builtin", "1", "Data Analyst", "A", 1), posting("jsearch", "2", "Data Analyst", "A", 2)]
    moved = [posting("builtin", "1", "Data Engineer", "A", 3)]
    kept.apply(0, *frames(spark, first, []))
    assert [r.job_id for r in kept.mart().collect()] == ["1"]
    kept.apply(1, *frames(spark, moved, []))
    assert {(r.job_id, r.job_title) for r in kept.mart().collect()} == {("1", "Data Engineer"), ("2", "Data Analyst")}


def test_only_touched_buckets_are_written(spark, tmp_path):
    kept = increment.MartStore(spark, str(tmp_path), buckets=64)
    rows = [posting("jsearch", str(i), "Data Analyst", f"Company {i}", i) for i in range(200)]
    kept.apply(0, *frames(spark, rows, []))
    kept.apply(1, *frames(spark, [posting("jsearch", "7", "Data Analyst", "Company 7", 999)], []))
    written = {r["name"]: r["count"] for r in kept.ledger().where("batch = 1 and bucket >= 0").groupBy("name").count().collect()}
    assert written == {"newest": 1, "labels": 1, "staged": 1, "mart": 1}
    assert kept.mart().count() == 200


def test_stream_restarts_in_the_middle_with_the_same_mart(spark, tmp_path, parts, monkeypatch):
    inbox, root, state = (str(tmp_path / x) for x in ("inbox", "root", "state"))
    monkeypatch.setattr(ingest, "FILES_PER_BATCH", 1)
    parts = [(rows, []) for rows, _ in parts]

    def arrive(i):
        spark.createDataFrame(parts[i][0], schemas.LANDING).coalesce(1).write.mode("append").json(inbox)

    arrive(0)
    kept = ingest.stream_mart(spark, inbox, root, state, buckets=3)
    arrive(1)
    arrive(2)
    commit = increment.MartStore._commit

    def dies_after_commit(self, entries, batch):
        commit(self, entries, batch)
        raise RuntimeError("lost driver")

    with monkeypatch.context() as m:  # the batch is in the ledger, but the stream does not know
        m.setattr(increment.MartStore, "_commit", dies_after_commit)
        with pytest.raises(Exception, match="lost driver"):
            ingest.stream_mart(spark, inbox, root, state, buckets=3)
    ingest.stream_mart(spark, inbox, root, state, buckets=3)
    assert content(kept.mart()) == built(spark, parts[:3])
    ingest.stream_mart(spark, inbox, root, state, buckets=3)  # nothing new
    assert content(kept.mart()) == built(spark, parts[:3])
    assert kept.ledger().where(F.col("name") == "batch").count() == 3


def test_texts_move_once_a_batch_and_follow_their_postings(spark, tmp_path, parts):
    """Staged rows hold no texts; a posting that wins later brings its own from an untouched bucket."""
    texts = lambda df: sorted((r.job_id, r.company_name, r.description) for r in df.collect())

    def landed(id, provider, company, minutes):
        source, payload, at, n = posting(provider, id, "Data Analyst", company, minutes)
        return (source, payload.replace('"text"', f'"text of {provider} {id} at {minutes}"'), at, n)

    first = [landed(str(i), "jsearch", f"C{i}", i) for i in range(30)] + [landed("x", "builtin", "C3", 40)]
    second = [landed("x", "builtin", "Elsewhere", 50)]  # C3 goes back to posting 3
    kept = increment.MartStore(spark, str(tmp_path), buckets=11)
    for i, rows in enumerate((first, second)):
        kept.apply(i, *frames(spark, rows, []))
    landing, labels = frames(spark, first + second, [])
    assert texts(kept.mart()) == texts(mart.build_mart(mart.split_landing(landing), labels))
    assert "description" not in spark.read.parquet(f"{tmp_path}/staged/batch=0").columns
