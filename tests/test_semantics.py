"""Edge cases that are easy to get wrong, one small fixture each."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from vacancia import schemas
from vacancia.functions import arrays, dates, rules, text
from vacancia.operators import aggregates as agg
from vacancia.operators import dedupe, filters, joins, metrics, profiling, quality, usage
from vacancia.plans import enrichment, mart, staging


def ts(day, hour=0):
    return dt.datetime(2026, 8, day, hour)


def landing_row(source, payload, at, ordinal=0):
    return (source, payload if isinstance(payload, str) else json.dumps(payload), at, ordinal)


def landing(spark, rows):
    return spark.createDataFrame(rows, schemas.LANDING)


def column(df, name="x"):
    return [r[name] for r in df.collect()]


def one(spark, expression):
    return spark.range(1).select(expression.alias("x")).first().x


def test_null_query_wins_at_equal_time(spark):
    rows = [("a", ts(1), "q"), ("a", ts(1), None)]
    df = spark.createDataFrame(rows, "job_id string, ingested_at timestamp, ingestion_query string")
    kept = dedupe.latest_per_key(df, ["job_id"], ["ingested_at", "ingestion_query"]).collect()
    assert [r.ingestion_query for r in kept] == [None]


@pytest.mark.parametrize("mode, left", [("collapse", 1), ("keep", 3), ("drop", 0)])
def test_null_company_rows(spark, mode, left):
    df = spark.createDataFrame([("A", None), ("B", None), ("C", None)], "t string, c string")
    kept = dedupe.best_per_expression(df, text.dedup_key("t", "c"), F.lit(1), ["t"], null_keys=mode)
    assert kept.count() == left


def test_best_provider_survives(spark):
    df = spark.createDataFrame(
        [(" Data Analyst", "Acme ", "jsearch"), ("data analyst", "ACME", "builtin"), ("Data Analyst", "acme", "theirstack")],
        "t string, c string, source string",
    )
    kept = dedupe.best_per_expression(df, text.dedup_key("t", "c"), rules.provider_rank("source"))
    assert column(kept, "source") == ["builtin"]


def test_senior_titles(spark):
    titles = ["Leadership Data Analyst", "Sr Data Engineer", "Israel Data Analyst", "Data Analyst"]
    df = spark.createDataFrame([(t,) for t in titles], "t string")
    assert column(filters.exclude_titles(df, "t"), "t") == ["Data Analyst"]
    kept = column(filters.exclude_titles(df, "t", word_boundary=True), "t")
    assert kept == ["Leadership Data Analyst", "Israel Data Analyst", "Data Analyst"]


def test_title_with_newline_is_kept(spark):
    df = spark.createDataFrame([("Data Analyst\nSenior team",), (None,)], "t string")
    assert filters.exclude_titles(df, "t").count() == 1


@pytest.mark.parametrize(
    "title, bucket",
    [
        ("Analytics Engineer, Data", "Analytics Engineer"),
        ("Data Science Platform Engineer", "Data Scientist"),
        ("Data Quality Analyst", "Data Analyst"),
        ("Senior data   ENGINEER", "Data Engineer"),
        ("Head Chef", "no_match"),
        (None, "no_match"),
    ],
)
def test_role_bucket(spark, title, bucket):
    assert one(spark, rules.title_role_bucket(F.lit(title).cast("string"))) == bucket


def test_html_decodes_before_it_strips(spark):
    html = "&lt;p&gt;A&amp;nbsp;B<br/>  C &amp;lt;"
    assert one(spark, text.html_to_text(F.lit(html))) == "A B C <"
    assert one(spark, text.html_to_text(F.lit("<p>1 &lt; 2</p>"), "tags_first")) == "1 < 2"


def stage_one(spark, provider, payload):
    rows = landing(spark, [landing_row(f"{provider}:Data Analyst", payload, ts(1))])
    return staging.stage(rows, staging.PROVIDERS[provider]).first()


def nested(**extra):
    base = {"identifier": {"value": "1"}, "title": "Data Analyst", "description": "<p>x</p>"}
    return {**base, **extra}


def test_nested_provider(spark):
    row = stage_one(spark, "builtin", nested(title="Hybrid Data Analyst", jobLocationType="TELECOMMUTE"))
    assert (row.work_model, row.description, row.ingestion_query) == ("remote", "x", "Data Analyst")
    assert stage_one(spark, "builtin", nested(title="Hybrid Data Analyst")).work_model == "hybrid"


@pytest.mark.parametrize("unit, low, expected", [("YEAR", 60, None), ("HOUR", 50, None), ("YEAR", 90000, 90000.0)])
def test_salary_gate(spark, unit, low, expected):
    payload = nested(baseSalary={"value": {"minValue": low, "maxValue": low, "unitText": unit}})
    row = stage_one(spark, "builtin", payload)
    assert (row.salary_min, row.salary_max) == (expected, expected)


@pytest.mark.parametrize(
    "listed, expected", [("not_found", None), ("unavailable", "unavailable"), ("Mid level", "mid_level")]
)
def test_listed_seniority(spark, listed, expected):
    assert stage_one(spark, "builtin", nested(seniority=listed)).listed_seniority == expected


def test_work_model_precedence_differs_by_provider(spark):
    one_ = stage_one(spark, "jsearch", {"job_id": "1", "job_title": "Hybrid Data Analyst", "job_description": "x", "job_is_remote": True})
    two = stage_one(spark, "theirstack", {"id": 1, "job_title": "Remote Data Analyst", "description": "x", "hybrid": True})
    assert (one_.work_model, two.work_model) == ("hybrid", "hybrid")
    assert (two.job_id, two.employment_type) == ("1", "other")


def test_malformed_payload_and_date(spark):
    row = stage_one(spark, "jsearch", {"job_id": "1", "job_title": "Data Analyst", "job_description": "x", "job_posted_at_datetime_utc": "soon"})
    assert row.date_posted is None
    assert staging.extract(landing(spark, [landing_row("jsearch:q", "{bad", ts(1))]), staging.PROVIDERS["jsearch"]).first().job_id is None


def test_tag_without_query(spark):
    rows = landing(spark, [landing_row("jsearch", {"job_id": "1"}, ts(1))])
    row = staging.extract(rows, staging.PROVIDERS["jsearch"]).first()
    assert (row.source, row.ingestion_query) == ("jsearch", None)


def test_null_flag_counts_as_false(spark):
    df = spark.createDataFrame([(True,), (False,), (None,), (True,)], "f boolean")
    row = agg.bool_rate(df, "f").first()
    assert (row.yes, row.total, row.rate) == (2, 4, 0.5)


def test_null_archetype_is_kept(spark):
    df = spark.createDataFrame([(None,), ("software_engineer",)], "a string")
    assert column(filters.drop_value_keep_null(df, "a", "software_engineer"), "a") == [None]


def test_not_in_with_null_label(spark):
    rows = spark.createDataFrame([("1",), ("2",), (None,)], "job_id string")
    labels = spark.createDataFrame([("1",), (None,)], "job_id string")
    empty = labels.where("false")
    assert joins.unlabelled(rows, labels, "job_id", null_aware=True).count() == 0
    assert sorted(map(str, column(joins.unlabelled(rows, labels), "job_id"))) == ["2", "None"]
    assert column(joins.unlabelled(rows, labels.where("job_id = '1'"), null_aware=True), "job_id") == ["2"]
    assert joins.unlabelled(rows, empty, null_aware=True).count() == 3


def test_last_non_null_per_column(spark):
    df = spark.createDataFrame([("s", ts(1), 5), ("s", ts(2), None)], "source string, run_at timestamp, v int")
    assert usage.latest_nonnull(df, ["source"], "run_at", ["v"]).first().v == 5


def test_rounding_is_half_even(spark):
    df = spark.createDataFrame([(0.125,)], "v double")
    assert agg.stats(df, [], "v", ("mean",), 2).first()["mean"] == 0.12


def burn(spark, rows):
    df = spark.createDataFrame(rows, "run_id string, run_at timestamp, source string, credits_remaining int, credits_used_cumulative int")
    return [r.credits_used_this_run for r in usage.credit_burn(df).orderBy("run_at").collect()]


def test_credit_burn_with_reset(spark):
    rows = [("1", ts(1), "s", 190, 10), ("2", ts(3), "s", 180, 20), ("3", ts(5), "s", 195, 5), ("4", ts(6), "s", None, None), ("5", ts(7), "s", 190, 10)]
    assert burn(spark, rows) == [10, 10, 5, 0, 10]


def test_forecast_needs_two_runs_in_the_window(spark):
    def row(run, day, source, left, spent, reset):
        return (run, ts(day), source, left, 200, 0, spent, reset)

    rows = [
        row("1", 1, "a", 100, 5, "2026-09-20"), row("2", 21, "a", 90, 10, "2026-09-20"),
        row("1", 1, "b", 100, 5, None), row("2", 21, "b", 90, 10, "someday"),
        row("1", 21, "c", 100, 0, "2026-09-20"), row("2", 22, "c", 90, 0, "2026-09-20"),
    ]
    table = {r.source: r for r in usage.credit_forecast(spark.createDataFrame(rows, schemas.USAGE)).collect()}
    assert sorted(table) == ["b", "c"]
    assert (table["b"].avg_burn, table["b"].runs_left) == (7.5, 12)
    assert table["c"].runs_left is None


def test_credit_bands(spark):
    rows = [(str(i), ts(1), f"s{i}", left, limit, 0, 0, None) for i, (left, limit) in enumerate([(150, 200), (60, None), (10, 0)])]
    table = usage.credit_status(spark.createDataFrame(rows, schemas.USAGE)).orderBy("source").collect()
    assert [r.band for r in table] == ["healthy", "monitor", "low"]
    assert [r.reset_date for r in table] == ["—"] * 3


def test_near_duplicate_dates_and_ratios(spark):
    day = dt.date(2026, 8, 1)
    rows = [
        ("1", "Data Analyst", "candidhealth", "jsearch", day, None),
        ("2", "Data Analyst", "Candid Health", "builtin", day + dt.timedelta(3), 5.0),
        ("3", "Data Analyst", "Candid Health", "builtin", day + dt.timedelta(7), None),
        ("4", "Chef", "Candid Health", "builtin", day, None),
        ("5", None, "Candid Health", "builtin", day, None),
    ]
    df = spark.createDataFrame(rows, "job_id string, job_title string, company_name string, source string, date_posted date, final_salary_min double")
    pairs = mart.fuzzy_duplicates(df).collect()
    assert [(p.job_id_a, p.job_id_b, p.loser_job_id) for p in pairs] == [("1", "2", "1")]


def answer(**extra):
    base = {
        "inferred_seniority": "entry", "role_archetype": "data_analyst", "work_focus": " Dashboards ",
        "degree_requirement": "none", "acknowledges_ai": True, "explicitly_encourages_applicants": False,
        "confidence_score": 0.9,
    }
    return json.dumps({**base, **extra})


def errors_of(spark, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, r string")
    return [(r.errors, r) for r in quality.validate(df, "r").orderBy("i").collect()]


def test_response_contract(spark):
    got = errors_of(
        spark,
        answer(),
        answer(work_focus="a b c d e f g h i j k"),
        answer(years_required_min=5, years_required_max=2),
        answer(confidence_score=1.2),
        answer(inferred_seniority="Entry"),
        answer(tech_stack_required=None),
        answer(tech_stack_required=["SQL ", 3]),
        answer(years_required_min="3", acknowledges_ai="yes", confidence_score="0.5", unknown=1),
        answer(domain="  "),
        answer(domain=""),
        "{oops",
        "[1]",
        answer(salary_min=1.5),
    )
    found = [e for e, _ in got]
    assert found[0] == [] and got[0][1].work_focus == "dashboards" and got[0][1].tech_stack_required == []
    assert found[1] == ["work_focus: too many words"]
    assert found[2] == ["years_required: min above max"]
    assert found[3] == ["confidence_score: outside 0.0-1.0"]
    assert found[4] == ["inferred_seniority: not an allowed value"]
    assert found[5] == found[6] == ["tech_stack_required: not a list of texts"]
    assert found[7] == [] and got[7][1].years_required_min == 3 and got[7][1].confidence_score == 0.5
    assert found[8] == [] and got[8][1].domain == ""
    assert found[9] == [] and got[9][1].domain is None
    assert found[10] == found[11] == ["response: not a JSON object"]
    assert found[12] == ["salary_min: not a whole number"]


def test_label_rows_take_the_first_valid_attempt(spark):
    jobs = spark.createDataFrame([("1", "jsearch:q", "t"), ("2", "jsearch:q", ""), ("3", "x", "t")], "job_id string, source string, description string")
    replies = spark.createDataFrame(
        [("1", 1, "{bad"), ("1", 2, answer()), ("1", 3, answer(domain="late")), ("2", 1, answer()), ("3", 4, answer())],
        "job_id string, attempt int, response string",
    )
    rows, quarantined = enrichment.label_rows(jobs, replies, "response", "v1", F.lit(ts(1)))
    got = rows.collect()
    assert [(r.job_id, r.source, r.domain, r.model_version) for r in got] == [("1", "jsearch:q", None, "v1")]
    assert rows.schema.names == schemas.ENRICHMENT.names
    assert quarantined.count() == 1


def test_batch_verdicts(spark):
    jobs = spark.createDataFrame([("1", "a"), ("2", "b"), ("3", None)], "job_id string, description string")
    some, none = jobs.where("job_id = '1'"), jobs.where("false")
    assert quality.batch_outcome(jobs, some).first().asDict() == {"succeeded": 1, "failed": 1, "skipped": 1, "total": 3, "verdict": "partial_failure"}
    assert quality.batch_outcome(jobs, none).first().verdict == "total_failure"
    assert quality.batch_outcome(jobs, jobs).first().verdict == "ok"


def test_week_labels(spark):
    sunday = F.lit("2026-08-02").cast("date")
    assert one(spark, dates.week_start(sunday)) == dt.date(2026, 7, 27)
    assert one(spark, dates.week_end(sunday)) == dt.date(2026, 8, 2)


def test_explorer_rules(spark):
    df = spark.createDataFrame(
        [("Data Analyst", None, 50.0, 90.0, None), ("Cook", "C++ Labs", None, None, dt.date(2026, 8, 1))],
        "t string, c string, lo double, hi double, d date",
    )

    def n(as_of=None, **spec):
        return df.where(filters.explorer_predicate(filters.ExplorerSpec(**spec), as_of)).count()

    assert n() == 2 and n(facets={"t": []}) == 2
    assert n(ranges=[("lo", "hi", 80, 100)]) == 1 and n(ranges=[("lo", "hi", 91, 100)]) == 0
    assert n(F.lit("2026-08-21").cast("date"), recent=("d", 3)) == 1
    assert n(search=(["t", "c"], "data|cook")) == 2
    assert n(search=(["t", "c"], "c++"), literal_search=True) == 1
    assert filters.active_range((10, 20), "lo", "hi", 10, 20) == []


def test_string_arrays_from_json(spark):
    def parse(value):
        return one(spark, arrays.parse_strings(F.lit(value).cast("string")))

    assert parse('["a", 1, "b"]') == ["a", "b"]
    assert parse("{}") == parse("bad") == parse(None) == []


@pytest.mark.parametrize(
    "low, high, expected",
    [(60000.0, 80000.0, "＄60,000 - ＄80,000"), (60000.0, None, "＄60,000+"), (None, 8.0, "up to ＄8"), (None, None, "Not disclosed")],
)
def test_salary_text(spark, low, high, expected):
    assert one(spark, text.format_salary(F.lit(low).cast("double"), F.lit(high).cast("double"))) == expected


def test_display_labels(spark):
    assert one(spark, text.format_label(F.lit("ci/cd mid_level"))) == "Ci/Cd Mid Level"
    assert one(spark, text.format_seniority(F.lit(None).cast("string"))) == "—"
    assert one(spark, text.format_years(F.lit(2.0), F.lit(None).cast("double"))) == "2+ yrs"
    assert one(spark, text.format_location(F.lit(None).cast("string"), F.lit(""), F.lit("remote"))) == "Remote"
    assert one(spark, text.format_source(F.lit("other"))) == "other"
    assert one(spark, rules.employment_type_loose(F.lit(" Full-time "))) == "full_time"
    assert one(spark, rules.employment_type_loose(F.lit(None).cast("string"))) is None


def test_key_profile_counts_malformed_rows_in_the_total_only(spark):
    df = spark.createDataFrame([('{"a": 1, "b": null}',), ('{"a": "", "c": []}',), ("bad",), ("[1]",)], "p string")
    plain = {r.key: (r.non_null, r.total, r.population_pct) for r in profiling.json_key_profile(df, "p").collect()}
    assert plain == {"a": (2, 4, 50.0), "b": (0, 4, 0.0), "c": (1, 4, 25.0)}
    strict = {r.key: r.non_null for r in profiling.json_key_profile(df, "p", empty_as_null=True).collect()}
    assert strict == {"a": 1, "b": 0, "c": 0}


def test_metric_documents(spark):
    old = metrics.from_mapping(spark, {"a": {"x": 1, "y": 2}, "b": None})
    new = metrics.from_mapping(spark, {"a": {"x": 1, "y": 3}, "c": 4})
    changes = [(r.path, r.old_value, r.new_value) for r in metrics.diff_metrics(old, new).collect()]
    assert changes == [("a.y", "2", "3"), ("c", None, "4")]
    assert metrics.diff_metrics(old, old).count() == 0
    row = spark.createDataFrame([(float("nan"), 0.123456)], "n double, v double")
    assert dict(metrics.scalar_metrics(row, "m").collect()) == {"m.n": None, "m.v": "0.1235"}


def test_run_status(spark):
    for failed, rows, expected in [(1, 0, "failure"), (1, 5, "partial"), (0, 0, "success")]:
        assert one(spark, usage.run_status(F.lit(failed), F.lit(rows))) == expected


def test_freshness(spark):
    df = spark.createDataFrame([(ts(1),)], "at timestamp")
    for hours, expected in [(72, "pass"), (73, "warn"), (145, "error")]:
        rule = quality.Freshness("at", as_of=F.lit(ts(1) + dt.timedelta(hours=hours)))
        assert quality.freshness(df, rule).first().status == expected
    assert quality.freshness(df.where("false"), quality.Freshness("at")).first().status == "error"


def test_deduplication_is_idempotent(spark):
    df = spark.range(100).selectExpr("id % 7 AS k", "id AS v")
    first = dedupe.latest_per_key(df, ["k"], ["v"])
    assert sorted(dedupe.latest_per_key(first, ["k"], ["v"]).collect()) == sorted(first.collect())


def test_default_search(spark):
    day = dt.date(2026, 8, 20)
    rows = [
        (1, "Data Analyst", "New York, NY", "junior", "US", day, ts(20)),
        (2, "Data Analyst II", "New York, NY", "junior", "US", day, ts(20)),
        (3, "Data Analyst", "Newark, NJ", "junior", "US", day, ts(20)),
        (4, "Data Analyst", "Brooklyn", "senior", "US", day, ts(20)),
        (5, "data analyst", "Brooklyn", "mid_level", "US", day - dt.timedelta(8), ts(20)),
        (6, "data analyst", "Brooklyn", "mid_level", "US", day, ts(18)),
        (7, "data analyst", "Brooklyn", "mid_level", "US", day, ts(21)),
    ]
    df = spark.createDataFrame(
        rows,
        "id int, job_title string, location string, seniority string, country_code string, "
        "date_posted date, discovered_at timestamp",
    )
    spec = filters.default_search(["(?i)data analyst"])
    found = filters.search(df, spec, F.lit(day), F.lit(ts(19)))
    assert column(found, "id") == [7, 1]


def test_publishers_and_relevant_titles(spark):
    df = spark.createDataFrame(
        [("Adzuna", "Data Analyst"), ("Acme", "DATA ENGINEER"), (None, "Cook"), ("Acme", None)], "p string, t string"
    )
    spec = filters.SearchSpec(deny={"p": filters.DENIED_PUBLISHERS})
    assert filters.search(df, spec, newest_first=False).count() == 3
    assert column(filters.keep_titles(df, "t", filters.RELEVANT_TITLES), "p") == ["Adzuna", "Acme"]


@pytest.mark.parametrize("name", ["duplicate_marks", "health_title_classes"])
def test_texts_stay_out_of_shuffles_that_need_none(spark, name):
    from __spark_entry__ import queries

    plan = queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "__described" in plan and "AS description#" not in plan


def test_a_posting_whose_newest_landing_lost_its_description_is_dropped(spark):
    rows = [("jsearch:q", f'{{"job_id": "1", "job_title": "Data Analyst"{text}}}', dt.datetime(2026, 1, day), day) for day, text in ((1, ', "job_description": "x"'), (2, ""))]
    landing = spark.createDataFrame(rows, schemas.LANDING)
    assert staging.stage(landing, staging.PROVIDERS["jsearch"]).collect() == []
    assert staging.stage(landing.where("ordinal = 1"), staging.PROVIDERS["jsearch"]).count() == 1


def test_posting_search_stages_payloads_of_45_days(spark):
    from __spark_entry__ import queries

    found = queries()["posting_search"](spark, "/root/testdata/sf0.1")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" in plan and "text#" in plan  # newest landings of whole payloads
    days = [r.date_posted for r in found.collect()]
    assert min(days) < dt.date(2026, 7, 23) and min(days) >= dt.date(2026, 6, 15)
