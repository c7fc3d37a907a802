"""Every text-corpus query on awkward tables: NULLs, empty and long texts, repeats, clashing columns, no rows."""

import pytest

from vacancia.llm.common import fold
from vacancia.llm.queries import ORACLES, QUERIES

BY_PAGE = {"op2_url_filter"}
BY_LANGUAGE = {"op13_collocations"}
BY_ROW = sorted(QUERIES.keys() - BY_LANGUAGE)
LONG = "lorem ipsum dolor " * 20_000


def save(spark, folder, documents, labels, pages, benchmark):
    extra = "label int, score double, n long, words array<string>, spans string, set_id long, block long, symbols string, removed int, at int"
    rows = [(*row, 1, 0.5, 7, ["x"], "s", 3, 4, "y", 5, 6) for row in documents]
    spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {extra}").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(*r, 1.0) for r in pages], "page_id long, url string, html string, score double").write.parquet(f"{folder}/pages.parquet")
    spark.createDataFrame([(*r, 1) for r in benchmark], "item_id long, text string, n_words int").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


@pytest.fixture(scope="module")
def awkward(spark, tmp_path_factory):
    documents = [
        (1, "The quick brown fox jumps over the lazy dog again and again", "en", "a", 5),
        (1, "The quick brown fox jumps over the lazy dog again and again", "en", "a", 5),
        (2, None, None, None, None),
        (None, "a text without an id", "en", "b", 3),
        (None, None, "en", None, None),
        (3, "", "de", "b", 0),
        (4, " \t\n\r\x0b\x0c ", "de", "b", 7),
        (5, LONG, "en", "c", len(LONG)),
        (6, LONG, "en", "c", len(LONG)),
        (7, "der die das \U0001f600 \x00\x1c \u00a0 \u3000 \u00c4\u00d6\u00dc", "de", "c", 9),
        (8, "<|endoftext|>12345 !!!", "de", "c", 9),
        (9, "\u4e2d\u6587" * 50, None, "c", 9),
    ]
    labels = [(1, 1, 0), (1, 0, 1), (5, 0, 1), (7, 1, 0), (None, 1, 1), (8, None, None), (99, 1, 1)]
    pages = [(1, "https://www.example.com/en/1", ""), (2, None, None), (None, "x", ""), (3, "", ""), (3, "", ""), (4, "a://b://c?d", "")]
    benchmark = [(1, "quick brown fox"), (1, "quick brown fox"), (2, None), (3, ""), (None, "a text without an id"), (4, "!!!")]
    return save(spark, tmp_path_factory.mktemp("awkward"), documents, labels, pages, benchmark)


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("empty")
    return save(spark, folder, [], [], [], [])


def test_each_operator_has_a_query():
    assert [sum(n.startswith(f"op{i}_") for n in QUERIES) for i in range(1, 14)] == [1] * 13


@pytest.mark.parametrize("name", BY_ROW)
def test_awkward_rows_all_come_back(spark, awkward, name):
    rows = QUERIES[name](spark, awkward).collect()
    assert len(rows) == (6 if name in BY_PAGE else 12)
    key = "page_id" if name in BY_PAGE else "doc_id"
    by_id = {}
    for row in rows:
        if row[key] is not None:
            by_id.setdefault(row[key], set()).add(str([float(f"{v:.5g}") if isinstance(v, float) else v for v in row]))
    assert all(len(found) == 1 for found in by_id.values())  # repeated rows are treated alike


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_rows_give_no_rows(spark, empty, name):
    assert QUERIES[name](spark, empty).collect() == []


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql_agrees_on_the_test_tables(spark, name):
    from check import compare, connect

    sf = "/root/testdata/sf0.001"
    assert compare(QUERIES[name](spark, sf), connect(sf), ORACLES[name]) == ""


def test_fold_counts_missing_ids_as_zero(spark):
    import zlib

    rows = spark.createDataFrame([(5,), (None,)], "doc_id long").select("doc_id", fold("doc_id", 7).alias("f")).collect()
    assert {r.doc_id: r.f for r in rows} == {5: zlib.crc32(b"5") % 7, None: 0}
