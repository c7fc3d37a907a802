"""All named queries of this package, with SQL where SQL can say them."""

from __future__ import annotations

from importlib import import_module

from .common import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

for _module in (
    "quality", "url_filter", "lm_score", "decontamination", "token_counts", "byte_bpe", "toxicity", "ngram_join",
    "line_dedup", "language_id", "personal_data", "fill_in_middle", "collocations",
):
    import_module(f"{__package__}.{_module}")
