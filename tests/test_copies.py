"""Contents of table copies, compared by digest."""

import pytest
from pyspark.sql import functions as F

from vacancia.operators.quality import content_check, content_digest
from vacancia.sources import tables

ROWS = """VALUES ('x', NULL, 0.5D, TIMESTAMP '2026-01-01 00:00:00.000001', array('p', NULL), map('k', 1)),
  (NULL, 'x', NULL, NULL, array(), NULL), (NULL, 'x', NULL, NULL, array(), NULL), ('', '', 1e300D, NULL, NULL, map())"""


@pytest.fixture
def rows(spark):
    return spark.sql(f"SELECT * FROM {ROWS} AS t(a, b, n, at, tags, odd)")


def digest(df):
    return content_digest(df).first().digest


def test_order_files_and_column_order_do_not_matter(rows):
    same = rows.repartition(3).select(*reversed(rows.columns))
    assert digest(same) == digest(rows)
    assert [r.status for r in content_check([("t", rows, same)]).collect()] == ["ok"]


@pytest.mark.parametrize(
    "change",
    [
        {"a": "b", "b": "a"},  # a NULL that moves to another column
        {"at": "at + interval 1 microsecond"},
        {"tags": "if(size(tags) = 2, array(NULL, 'p'), tags)"},
        {"n": "coalesce(n, 0)"},
        {"a": "nullif(a, '')"},
        {"odd": "if(odd['k'] = 1, map('k', 2), odd)"},
    ],
)
def test_a_changed_cell_is_reported(rows, change):
    other = rows.selectExpr(*[f"{change.get(c, c)} AS {c}" for c in rows.columns])
    assert [r.status for r in content_check([("t", rows, other)]).collect()] == ["changed"]


def test_missing_and_doubled_rows(spark, rows):
    report = content_check(
        [("fewer", rows, rows.dropDuplicates(["a"])), ("swapped", rows, rows.where("a = ''").union(rows.where("a = ''")).union(rows.where("a IS NULL")))]
    )
    assert {r.table: r.status for r in report.collect()} == {"fewer": "mismatch", "swapped": "changed"}
    empty = rows.limit(0)
    assert digest(empty) == "0-0"
    assert [r.status for r in content_check([("t", empty, empty)]).collect()] == ["ok"]


def test_a_copy_with_another_content_fails(spark, rows, tmp_path, monkeypatch):
    old, new = str(tmp_path / "old"), str(tmp_path / "new")
    rows.write.parquet(old)
    report = tables.copy_tables(spark, {"t": (old, new)}, content=True).collect()
    assert [(r.old, r.new, r.status) for r in report] == [(4, 4, "ok")]
    real = tables.content_check
    spoiled = lambda pairs: real([(n, o, c.withColumn("n", F.lit(1.0))) for n, o, c in pairs])
    monkeypatch.setattr(tables, "content_check", spoiled)
    with pytest.raises(RuntimeError, match="contents differ"):
        tables.copy_tables(spark, {"t": (old, new)}, content=True)
