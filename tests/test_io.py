"""Sources and sinks."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from vacancia import schemas
from vacancia.operators import usage
from vacancia.operators.overlay import set_by_ids
from vacancia.sources import landing, snapshots, tables, web_pages
from vacancia.streaming import ingest

AT = dt.datetime(2026, 8, 1)


def rows(spark, *sources):
    return spark.createDataFrame([(s, '{"job_id": "1"}', AT, i) for i, s in enumerate(sources)], schemas.LANDING)


def test_land_and_read_one_provider(spark, tmp_path):
    path = str(tmp_path / "landing")
    report = landing.land(rows(spark, "jsearch:a", "jsearch", "builtin:b"), path)
    assert {r.provider: r.n for r in report.collect()} == {"jsearch": 2, "builtin": 1}
    landing.land(rows(spark, "builtin:c"), path)
    assert landing.read_landing(spark, path, "builtin").count() == 2
    assert landing.read_landing(spark, path).count() == 4


def test_unknown_provider_fails(spark):
    with pytest.raises(Exception, match="no landing table for source other:x"):
        landing.route(rows(spark, "other:x")).collect()


def test_record_members_win_over_scraper_metadata(spark):
    df = spark.createDataFrame(
        [("u", "crawl", 0, ("real", "node-url"))],
        "source_url string, title string, pos int, job struct<title: string, source_url: string>",
    )
    row = landing.wrap_records(df, "builtin", "Data Analyst", F.lit(AT), "pos", node="job").first()
    assert row.source == "builtin:Data Analyst"
    assert json.loads(row.raw_payload) == {"title": "real", "source_url": "node-url"}
    flat = landing.wrap_records(df.select("title", "pos"), "jsearch", None, F.lit(AT), "pos").first()
    assert (flat.source, json.loads(flat.raw_payload)) == ("jsearch", {"title": "crawl"})


def test_high_water_mark_of_an_empty_table(spark):
    assert landing.high_water_mark(rows(spark).where("false")).first().high_water_mark is None


def test_cached_documents(spark, tmp_path):
    array, envelope = tmp_path / "a.json", tmp_path / "b.json"
    array.write_text(json.dumps([{"id": 1}, {"id": 2}], indent=1))
    envelope.write_text(json.dumps({"data": {"jobs": [{"id": 1}, {"id": 2}, {"id": 3}]}}, indent=1))
    assert landing.read_documents(spark, str(array)).count() == 2
    assert landing.read_documents(spark, str(envelope), ("data", "jobs")).columns == ["id"]
    assert landing.read_documents(spark, str(envelope), ("data", "jobs")).count() == 3


def test_logs_round_trip(spark, tmp_path):
    run = usage.run_row(
        landing.route(rows(spark, "jsearch:a", "builtin:b")), spark.createDataFrame([("theirstack",)], "p string"),
        "r1", F.lit(AT), 3, schemas.PROVIDERS,
    )
    tables.append_runs(run, str(tmp_path / "runs"))
    back = tables.read_runs(spark, str(tmp_path / "runs")).first()
    assert (back.status, back.total_rows, back.theirstack_rows) == ("partial", 2, 0)
    credit = spark.createDataFrame([("r1", AT, "jsearch", 1, 2, 1, 1, "2026-09-01T10:00:00"), ("r1", AT, "a", 1, 2, 1, 1, None)], schemas.USAGE)
    tables.append_usage(credit, str(tmp_path / "usage"))
    back = tables.read_usage(spark, str(tmp_path / "usage")).collect()
    assert [(r.source, r.reset_date) for r in back] == [("a", "—"), ("jsearch", "2026-09-01")]


def test_mart_coercion(spark):
    df = spark.createDataFrame(
        [("1", '["a", 2]', "2026-08-01", "x", "yes", None)],
        "JOB_ID string, TECH_STACK_REQUIRED string, DATE_POSTED string, FINAL_SALARY_MIN string, "
        "ACKNOWLEDGES_AI string, EXPLICITLY_ENCOURAGES_APPLICANTS boolean",
    )
    row = tables.coerce_mart(df).first()
    assert row.tech_stack_required == ["a"] and row.date_posted == dt.date(2026, 8, 1)
    assert row.final_salary_min is None and row.acknowledges_ai is True
    assert row.explicitly_encourages_applicants is False


def test_copy_reports_counts(spark, tmp_path):
    old, new = str(tmp_path / "old"), str(tmp_path / "new")
    spark.range(5).write.parquet(old)
    report = tables.copy_tables(spark, {"t": (old, new)}).collect()
    assert [(r["table"], r["old"], r["new"], r["status"]) for r in report] == [("t", 5, 5, "ok")]


def test_snapshot_store(spark, tmp_path):
    path = str(tmp_path / "snapshots")

    def doc(value):
        return spark.createDataFrame([("a", value), ("b", "1")], "path string, value string")

    snapshots.write_snapshot(doc("0"), "2026-08-01", path)
    snapshots.write_snapshot(doc("1"), "2026-08-08", path)
    snapshots.write_snapshot(doc("2"), "2026-08-08", path)
    store = snapshots.read_snapshots(spark, path)
    assert store.count() == 4
    changes = snapshots.changes_since_previous(store, "2026-08-08").collect()
    assert [(c.path, c.old_value, c.new_value) for c in changes] == [("a", "0", "2")]
    assert snapshots.previous_snapshot(store, "2026-08-01").first().value is not None


def test_checkpoint_csv(spark, tmp_path):
    path = str(tmp_path / "csv")
    tables.write_checkpoint_csv(spark.createDataFrame([("u", None), ("v", "x, y")], "url string, label string"), path)
    back = tables.read_checkpoint_csv(spark, path, "url string, label string").orderBy("url").collect()
    assert [(r.url, r.label) for r in back] == [("u", None), ("v", "x, y")]


def test_ad_hoc_sql_and_catalog(spark):
    assert tables.run_query(spark, "SELECT sum(id) AS s FROM {t}", t=spark.range(4)).first().s == 6
    assert tables.existing_tables(spark, ["surely_missing"]) == {"surely_missing": False}


def test_flag_correction(spark):
    df = spark.createDataFrame([("1", True), ("2", True)], "id string, f boolean")
    ids = spark.createDataFrame([("2",), ("2",)], "id string")
    fixed = set_by_ids(df, ids, "id", "f", F.lit(False)).orderBy("id").collect()
    assert [r.f for r in fixed] == [True, False]


def page(label, after="", extra=""):
    node = json.dumps({"@graph": [{"@type": "Organization"}, {"@type": "JobPosting", "title": "T", "seniority": "old"}]})
    box = '<div class="d-flex gap-sm align-items-start"><div><i class="fa-regular fa-trophy"></i></div><span> {} </span></div>'
    return (
        f'<html><body><div id="main"><div class="gap-sm align-items-start"><span>Pay</span></div>{extra}'
        f"{box.format(label) if label else ''}</div>{box.format(after) if after else ''}"
        f'<script TYPE="application/ld+json">{node}</script></body></html>'
    )


@pytest.mark.parametrize(
    "html, expected",
    [
        (page("Mid level"), "Mid level"),
        (page("Senior"), None),
        (page(None, after="Junior"), None),
        (page("Junior", extra="<img src=x><br><p>open paragraph"), "Junior"),
    ],
)
def test_posting_pages(spark, html, expected):
    df = spark.createDataFrame([(html, "u"), ("<html></html>", "v")], "html string, url string")
    found = web_pages.postings(df, "html", "url").collect()
    assert [(r.source_url, r.seniority) for r in found] == [("u", expected)]
    assert json.loads(found[0].payload) == {"@type": "JobPosting", "title": "T", "seniority": expected}


def test_streaming_lands_each_file_once(spark, tmp_path):
    inbox, path, state = (str(tmp_path / n) for n in ("inbox", "landing", "state"))
    rows(spark, "jsearch:a", "builtin:b").write.json(inbox)
    ingest.land_new_files(spark, inbox, path, state)
    ingest.land_new_files(spark, inbox, path, state)
    assert ingest.landed(spark, path).count() == 2
    rows(spark, "theirstack:c").write.mode("append").json(inbox)
    ingest.land_new_files(spark, inbox, path, state)
    counts = ingest.landed(spark, path).groupBy("provider").count().collect()
    assert {r.provider: r["count"] for r in counts} == {"jsearch": 1, "builtin": 1, "theirstack": 1}
