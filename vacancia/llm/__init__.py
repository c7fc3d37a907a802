"""Operators for large text corpora: filters, scores, tokenizers and deduplication."""
