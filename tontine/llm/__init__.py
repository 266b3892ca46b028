"""Operators of a training-data pipeline: text scans, scoring, tokens, search and deduplication."""
