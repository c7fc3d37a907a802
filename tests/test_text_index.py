"""Text search over an index of the trigrams of each file."""

import re
from pathlib import Path

import pytest

from vacancia.operators.filters import ExplorerSpec, explorer_predicate
from vacancia.sources import text_index

WORDS = ["Data Analyst", "Lead Analyst", "Data Engineer", "ML Ops", "C++ Dev", "naïve Café 𝒳𝒴𝒵", "", "ab", None]
QUERIES = [
    "data", "data|lead an", "lead.*analyst", "data?engineer", "anal+yst", "(data|lead) a", "^data", "Data", "é 𝒳𝒴𝒵",
    "café", "ab", "ml ops|c", "eng.neer", "a.*?lyst", "[d]ata", "zzz", "data+? eng", r"\bops",
]
COLUMNS = ["title", "company"]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """One file for each word as title and one for each as company."""
    path = str(tmp_path_factory.mktemp("rows of a table"))
    for word in WORDS:
        for title, company in ((word, "Acme"), (None, word)):
            row = spark.createDataFrame([(title, company)], "title string, company string")
            row.coalesce(1).write.mode("append").parquet(path)
    return path


def names(df):
    return sorted(map(str, df.select(*COLUMNS).collect()))


def matching(df, query, literal):
    return df.where(explorer_predicate(ExplorerSpec(search=(COLUMNS, query), literal_search=literal)))


@pytest.mark.parametrize("query, expected", [
    ("data", [{"dat", "ata"}]),
    ("abc|bcd", [{"abc"}, {"bcd"}]),
    ("abc?d", None),
    ("abcd?efg", [{"abc", "efg"}]),
    ("abc+def", [{"abc", "def"}]),
    ("abc.def", [{"abc", "def"}]),
    ("abc|x", None),
    ("abc|", None),
    ("(?i)abc", None),
    (r"abc\d", None),
])
def test_grams_that_every_match_holds(query, expected):
    assert text_index.needed_grams(query) == expected


def test_a_literal_query_is_taken_as_it_stands():
    assert text_index.needed_grams("c++ d", literal=True) == [{"c++", "++ ", "+ d"}]


def test_pruned_search_returns_the_rows_of_the_whole_search(spark, stored, tmp_path):
    index = str(tmp_path / "index")
    df = spark.read.parquet(stored)
    assert text_index.unmatched_files(spark, index, COLUMNS, "data") == []
    text_index.index_files(df, COLUMNS, index)
    for query in QUERIES:
        for literal in (False, True):
            pruned = text_index.prune(df, index, COLUMNS, query, literal)
            assert names(matching(pruned, query, literal)) == names(matching(df, query, literal)), query


def test_files_without_a_match_are_not_opened(spark, stored, tmp_path):
    table, index = str(tmp_path / "table"), str(tmp_path / "index")
    spark.read.parquet(stored).repartitionByRange(6, "title").write.parquet(table)
    df = spark.read.parquet(table)
    text_index.index_files(df, COLUMNS, index)
    skipped = text_index.unmatched_files(spark, index, COLUMNS, "lead an")
    assert 0 < len(skipped) < df.select(text_index.FILE).distinct().count()
    expected = names(matching(df, "lead an", False))
    for file in skipped:
        Path(re.sub("^file:/*", "/", file)).write_bytes(b"not parquet")
    pruned = text_index.prune(spark.read.schema(df.schema).parquet(table), index, COLUMNS, "lead an")
    assert names(matching(pruned, "lead an", False)) == expected


def test_unknown_files_are_read_and_only_they_are_added(spark, tmp_path):
    table, index = str(tmp_path / "table"), str(tmp_path / "index")
    schema = "title string, company string"
    for title in ("data one", "other"):
        spark.createDataFrame([(title, None)], schema).coalesce(1).write.mode("append").parquet(table)
        df = spark.read.parquet(table)
        query = title[:5]
        assert matching(text_index.prune(df, index, COLUMNS, query), query, False).count() == 1
        text_index.index_files(df, COLUMNS, index)
    text_index.index_files(df, COLUMNS, index)
    grams = spark.read.parquet(f"{index}/grams")
    assert grams.count() == grams.distinct().count() == 9
    assert len(text_index.unmatched_files(spark, index, COLUMNS, "other")) == 1


def test_columns_that_are_not_indexed_prune_nothing(spark, stored, tmp_path):
    index = str(tmp_path / "index")
    df = spark.read.parquet(stored)
    text_index.index_files(df, ["title"], index)
    assert text_index.unmatched_files(spark, index, COLUMNS, "data") == []
    assert text_index.unmatched_files(spark, index, ["title"], "data") != []
    text_index.index_files(df, COLUMNS, index)
    assert text_index.unmatched_files(spark, index, COLUMNS, "data") != []


def test_an_empty_table(spark, tmp_path):
    table, index = str(tmp_path / "table"), str(tmp_path / "index")
    spark.createDataFrame([], "title string, company string").write.parquet(table)
    df = spark.read.schema("title string, company string").parquet(table)
    text_index.index_files(df, COLUMNS, index)
    assert text_index.prune(df, index, COLUMNS, "data").count() == 0
