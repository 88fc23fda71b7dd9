"""Operators of a training-data pipeline: deduplication, search, scoring, mixing, packing."""
