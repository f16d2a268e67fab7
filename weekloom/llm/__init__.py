"""Operators of a training-data pipeline: deduplication, filters, scoring, tokens, search."""
