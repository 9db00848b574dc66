"""Operators of a training-data pipeline: deduplication, scoring, filtering, extraction, mixing."""
