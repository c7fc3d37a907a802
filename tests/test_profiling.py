"""Walk of nested JSON against a plain recursive one."""

import json
import re
from collections import defaultdict

from vacancia import testbed
from vacancia.operators import profiling

SF = "/root/testdata/sf0.001"
KINDS = {bool: "boolean", int: "number", float: "number", str: "string", dict: "object", list: "array"}


def walk(value, path="$"):
    if isinstance(value, dict):
        for key, inner in value.items():
            step = f".{key}" if re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", key) else f'["{key}"]'
            yield path + step, inner
            yield from walk(inner, path + step)
    elif isinstance(value, list):
        for inner in value:
            yield path + "[*]", inner
            yield from walk(inner, path + "[*]")


def brute(texts):
    docs, values, nulls, kinds = defaultdict(set), defaultdict(int), defaultdict(int), defaultdict(set)
    for i, text in enumerate(texts):
        try:
            doc = json.loads(text or "")
        except ValueError:
            continue
        for path, value in walk(doc):
            if value is None:
                nulls[path] += 1
            else:
                docs[path].add(i)
                values[path] += 1
                kinds[path].add(KINDS[type(value)])
    return {
        p: ("|".join(sorted(kinds[p])), len(docs[p]), values[p], nulls[p]) for p in values.keys() | nulls.keys()
    }


def found(df, **options):
    rows = profiling.json_paths(df, "p", **options).collect()
    assert len({r.path for r in rows}) == len(rows)
    return {r.path: (r.kinds, r.docs, r.n_values, r.n_nulls) for r in rows}


NESTED = [
    '{"a": [1, {"b": null, "c": [true, "x"]}, {"c": []}], "odd key": {"z.z": 1.5}, "e": {}}',
    '{"a": {"b": 2}, "odd key": null}',
    '{"a": "text", "deep": [[[[[[[[[[{"end": [0]}]]]]]]]]]]}',
    '[{"a": 1}, 2]',
    '"scalar"',
    "7",
    "{broken",
    "",
    None,
    "{}",
]


def test_every_path_at_any_depth(spark):
    df = spark.createDataFrame([(t,) for t in NESTED * 3], "p string").repartition(4)
    expected = brute(NESTED * 3)
    assert expected["$.a[*].c[*]"] == ("boolean|string", 3, 6, 0)
    assert found(df) == expected
    assert found(df, levels=1) == expected
    assert {r.total for r in profiling.json_paths(df, "p").collect()} == {30}


def test_samples_come_from_the_first_row(spark):
    texts = ['{"a": ["late"], "n": 5}', '{"a": [null, "first", "second"]}', '{"a": [], "n": null}']
    df = spark.createDataFrame([(t, i) for t, i in zip(texts, (3, 1, 2))], "p string, value int")
    rows = {r.path: r.sample for r in profiling.json_paths(df, "p", "value").collect()}
    assert rows == {"$.a": None, "$.a[*]": "first", "$.n": "5"}
    long = spark.createDataFrame([(json.dumps({"a": "x" * 500}),)], "p string")
    assert profiling.json_paths(long, "p").first().sample == "x" * 120


def test_no_rows(spark):
    assert found(spark.createDataFrame([], "p string")) == {}


def test_payloads_of_all_providers(spark):
    for name, rows in testbed.landing(spark, SF).items():
        texts = [r.raw_payload for r in rows.select("raw_payload").collect()]
        assert found(rows.withColumnRenamed("raw_payload", "p")) == brute(texts), name


def test_one_scan_where_the_levels_suffice(spark, monkeypatch):
    stored = []
    real = profiling.store
    monkeypatch.setattr(profiling, "store", lambda df, path: stored.append(path) or real(df, path))
    df = spark.createDataFrame([(t,) for t in NESTED[:2]], "p string")
    profiling.json_paths(df, "p")
    assert len(stored) == 1
    profiling.json_paths(df, "p", levels=1)
    assert len(stored) == 4  # 1, 2 and 4 levels
