"""Incremental variants of the batch pipeline."""
