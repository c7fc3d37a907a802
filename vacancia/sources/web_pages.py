"""Listings and postings out of stored HTML pages."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions.text import as_column
from ..operators.dedupe import first_per_key

JSON_LD = r"""(?is)<script\b[^>]*\btype\s*=\s*["']?application/ld\+json["']?[^>]*>(.*?)</script\s*>"""


def json_ld(html: Column | str) -> Column:
    """The first JSON-LD script of a page as a document, NULL when there is none."""
    return F.try_parse_json(F.regexp_extract(as_column(html), JSON_LD, 1))


def graph_node(html: Column | str, kind: str) -> Column:
    """First node of the given ``@type`` in the page's ``@graph``."""
    nodes = F.try_variant_get(json_ld(html), '$["@graph"]', "array<variant>")
    typed = F.filter(nodes, lambda n: F.try_variant_get(n, '$["@type"]', "string") == kind)
    return F.get(typed, F.lit(0))


def listings(pages: DataFrame, html: str, page_order: str) -> DataFrame:
    """(title, url) of every listing on index pages, first sighting per URL.

    ``page_order`` is the crawl order; listings without a URL are dropped.
    """
    node = graph_node(html, "ItemList")
    items = F.try_variant_get(node, "$.itemListElement", "array<variant>")
    rows = pages.select(F.col(page_order).alias("page"), F.posexplode(items).alias("pos", "item"))
    rows = rows.select(
        "page",
        "pos",
        F.try_variant_get("item", "$.name", "string").alias("title"),
        F.nullif(F.try_variant_get("item", "$.url", "string"), F.lit("")).alias("url"),
    )
    return first_per_key(rows, ["url"], ["page", "pos"], null_keys="drop")


class _LabelFinder(HTMLParser):
    """Text of the span next to the trophy icon inside the element with id ``main``."""

    VOID = {
        "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source",
        "track", "wbr",
    }

    def __init__(self) -> None:
        super().__init__()
        self.open: list[str] = []
        self.main = 0  # nesting depth at which the container opened
        self.boxes: list[dict] = []  # candidate divs that are open
        self.hits: list[tuple[int, str | None]] = []
        self.seen = 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        values = dict(attrs)
        classes = values.get("class") or ""
        if tag not in self.VOID:
            self.open.append(tag)
        if not self.main and values.get("id") == "main":
            self.main = len(self.open)
        elif self.main > 0:
            if tag == "div" and "align-items-start" in classes and "gap-sm" in classes:
                self.seen += 1
                self.boxes.append(
                    {"at": len(self.open), "order": self.seen, "icon": False, "span": 0, "text": None}
                )
            for box in self.boxes:
                if tag == "i" and "fa-trophy" in classes:
                    box["icon"] = True
                if tag == "span" and box["text"] is None:
                    box["span"], box["text"] = len(self.open), ""

    def handle_endtag(self, tag: str) -> None:
        if tag not in self.open:
            return
        while self.open:
            depth, last = len(self.open), self.open.pop()
            for box in [b for b in self.boxes if b["at"] == depth]:
                self.boxes.remove(box)
                if box["icon"]:
                    self.hits.append((box["order"], box["text"]))
            for box in self.boxes:
                if box["span"] == depth:
                    box["span"] = 0
            if self.main == depth:
                self.main = -1  # the container closed; nothing after it counts
            if last == tag:
                break

    def handle_data(self, data: str) -> None:
        for box in self.boxes:
            if box["span"]:
                box["text"] += data.strip()

    def label(self) -> str | None:
        hits = self.hits + [(b["order"], b["text"]) for b in self.boxes if b["icon"]]
        return min(hits)[1] if hits else None


@F.pandas_udf(T.StringType())
def _main_label(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    def one(html: str | None) -> str | None:
        finder = _LabelFinder()
        finder.feed(html or "")
        return finder.label()

    for batch in batches:
        yield batch.map(one)


def seniority_label(html: Column | str) -> Column:
    """Allow-listed seniority label of a posting page.

    The label sits in nested markup, which needs a parser; pages without the icon never
    reach it.
    """
    page = as_column(html)
    label = _main_label(F.when(page.contains("fa-trophy"), page))
    return F.when(label.isin(schemas.LISTED_SENIORITY_LABELS), label)


def postings(pages: DataFrame, html: str, url: str) -> DataFrame:
    """Posting pages as (url, payload): the first JobPosting node with its seniority.

    Pages without such a node are dropped.
    """
    found = pages.select(
        F.col(url).alias("source_url"),
        graph_node(html, "JobPosting").alias("node"),
        F.col(html).alias("__html"),
    ).where(F.col("node").isNotNull())
    members = F.from_json(F.to_json("node"), "map<string,variant>")
    label = seniority_label("__html")
    with_label = found.select("source_url", members.alias("members"), label.alias("seniority"))
    added = F.create_map(
        F.lit("seniority"),
        F.coalesce(F.try_parse_json(F.to_json(F.col("seniority").cast("variant"))), F.parse_json(F.lit("null"))),
    )
    kept = F.map_filter("members", lambda k, _: k != "seniority")
    return with_label.select("source_url", F.to_json(F.map_concat(kept, added)).alias("payload"), "seniority")
