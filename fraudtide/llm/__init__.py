"""Operators of a training-data pipeline: deduplication, mixing, tokens, languages, private data."""
