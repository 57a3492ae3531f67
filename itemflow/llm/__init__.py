"""Operators of a training-data pipeline: cleaning, deduplication, mixing, formatting, encoding."""
