"""URL filter: host and path rules first, then a logistic regression on hashed characters.

A rule is a host, a path beginning and a verdict. It fits its host and every subdomain when the
URL's path starts with the rule's; of the fitting rules the longest (host and path together)
decides, ties going to the block rule and then to the first in order. URLs without a fitting
rule get the verdict of a model: character n-grams of 3 to 5 bytes of host and path, hashed into
``BUCKETS`` each, weighted by a regression learned on the driver from a small labelled table of
URLs. The rules are a short list written by hand and become one expression.

Defined results: a NULL URL or one without ``://`` has an empty host and path, fits no rule and
is judged by the model on empty strings; repeated URLs are judged alike; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import ragged
from .common import query, read

BITS = 13
BUCKETS = 1 << BITS
SIZES = (3, 4, 5)

#: Rules as (host, path beginning, verdict).
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)

#: The labelled URL table: words whose hosts are unwanted or wanted, and the forms hosts take.
UNWANTED = "casino poker bets betting slots jackpot gamble lottery adult xxx porn sex escort cams spam pills viagra loans warez torrent".split()
WANTED = """news wiki school library museum science health garden weather history recipes travel music sports council
bank archive forum maps books nature theatre nation station kitchen painting reading other another mother weather
northern southern winter letter river thread thunder brother earth breath health teacher heating standing listen
intention attention tradition edition region senate planet internet cabinet market street ticket print point""".split()
FORMS = ("{}.example.org", "www.{}.example.com", "m.{}.example.net", "blog.{}.example.net", "{}s.example.net", "{}.example.com")
UNWANTED_FORMS = ("{}-win.example.org", "free-{}.example.com", "{}-farm.example.net", "{}-x.example.org")
PATHS = ("/en/12", "/de/840", "/es/77.html", "/fr/301/", "", "/")


def labelled_urls() -> list[tuple[str, int]]:
    """The default labelled table, spelled out from the word lists above."""
    out = []
    for label, words, forms in ((1, UNWANTED, FORMS + UNWANTED_FORMS), (0, WANTED, FORMS)):
        for i, word in enumerate(words):
            for k, form in enumerate(forms):
                out.append((f"https://{form.format(word)}{PATHS[(i + k) % len(PATHS)]}", label))
    return out


def host_and_path(url: str | Column) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path of a URL; empty without ``://``."""
    url = F.col(url) if isinstance(url, str) else url
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, upper, upper.lower()), path


@dataclass
class Model:
    bias: float
    host: np.ndarray
    path: np.ndarray

    def margins(self, hosts: pa.Array, paths: pa.Array) -> np.ndarray:
        out = np.full(len(hosts), self.bias)
        for column, weights in ((hosts, self.host), (paths, self.path)):
            for chunk in ragged.chunks(column):
                bucket, first = char_grams(chunk)
                total = ragged.sums_between(weights[bucket], first)
                out[chunk.first : chunk.first + chunk.n] += total / np.sqrt(np.maximum(np.diff(first), 1))
        return out


def char_grams(chunk: ragged.Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Hashed byte n-grams of each text, with its two ends marked, in the order of the texts."""
    # One mark in front of every text and one behind it.
    size = np.diff(chunk.bounds)
    bounds = chunk.bounds + 2 * np.arange(chunk.n + 1)
    data = np.full(bounds[-1], 1, np.uint64)
    text = np.repeat(np.arange(chunk.n), size)
    data[np.arange(len(chunk.data)) + 2 * text + 1] = ragged.LOWER[chunk.data].astype(np.uint64) + np.uint64(2)
    texts, buckets = [], []
    for n in SIZES:
        h, first = ragged.grams(data, bounds, n)
        texts.append(np.repeat(np.arange(chunk.n), np.diff(first)))
        buckets.append((h >> np.uint64(64 - BITS)).astype(np.int64))
    text, bucket = np.concatenate(texts), np.concatenate(buckets)
    order = np.argsort(text, kind="stable")
    return bucket[order], np.searchsorted(text[order], np.arange(chunk.n + 1))


def fit(table: Sequence[tuple[str, int]], rounds: int = 200) -> Model:
    """Logistic regression by full-batch gradient steps with a small ridge."""
    urls = [u for u, _ in table]
    label = np.array([y for _, y in table], float)
    parts = []
    for which in (0, 1):
        texts = []
        for url in urls:
            rest = url.split("://", 1)[1] if "://" in url else ""
            cut = min([i for i in (rest.find(c) for c in "/?#") if i >= 0], default=len(rest))
            path = rest[cut:].split("?")[0].split("#")[0]
            texts.append(rest[:cut].lower() if which == 0 else path)
        dense = np.zeros((len(urls), BUCKETS), np.float32)
        (chunk,) = ragged.chunks(pa.array(texts, pa.large_string()), 1 << 30)
        bucket, first = char_grams(chunk)
        n = np.diff(first)
        row = np.repeat(np.arange(len(urls)), n)
        np.add.at(dense, (row, bucket), (1 / np.sqrt(np.maximum(n, 1)))[row])
        parts.append(dense)
    x = np.concatenate(parts, axis=1)
    used = np.flatnonzero(x.any(axis=0))
    slim, weights, bias = x[:, used], np.zeros(len(used), np.float32), 0.0
    for _ in range(rounds):
        slope = 1 / (1 + np.exp(-(slim @ weights + bias))) - label
        weights -= 2.0 * (slim.T @ slope / len(label) + 1e-4 * weights)
        bias -= 0.5 * slope.mean()
    full = np.zeros(2 * BUCKETS)
    full[used] = weights
    return Model(bias, full[:BUCKETS], full[BUCKETS:])


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """Rule text and verdict of the longest fitting rule, NULL without one."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    # Built inside out: the rule that is asked first comes last.
    asked_last_first = sorted(rules, key=lambda r: (len(r[0]) + len(r[1]), r[2] == "block", [-ord(c) for c in r[0] + r[1]]))
    for rule_host, rule_path, rule_verdict in asked_last_first:
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        text = F.when(fits, rule_host + rule_path).otherwise(text)
        verdict = F.when(fits, rule_verdict).otherwise(verdict)
    return text, verdict


SCHEMA = "page_id long, host string, path string, rule string, rule_verdict string, score double"


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]], model: Model) -> DataFrame:
    """``page_id, host, path, rule, verdict, score`` of every page; score is the model's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        for batch in batches:
            margin = model.margins(batch.column(1), batch.column(2))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(1 / (1 + np.exp(-margin)))], names)

    host, path = host_and_path("url")
    split = pages.select(F.col("page_id").cast("long"), host.alias("host"), path.alias("path"))
    rule, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    ruled = split.select("*", rule.alias("rule"), verdict.alias("rule_verdict"))
    scored = ruled.mapInArrow(run, SCHEMA)
    judged = F.when(F.col("score") >= 0.5, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", "rule", F.coalesce("rule_verdict", judged).alias("verdict"), "score")


@query("op2_url_filter")
def op2_url_filter(spark, sf_dir):
    return judge(read(spark, sf_dir, "pages"), RULES, fit(labelled_urls()))
