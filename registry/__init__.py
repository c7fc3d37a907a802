"""Named queries over the test tables and, where SQL can say it, their SQL twins."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function: Callable) -> Callable:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


for _module in ("posting_queries", "table_queries", "log_queries", "store_queries", "page_queries"):
    import_module(f"registry.{_module}")
