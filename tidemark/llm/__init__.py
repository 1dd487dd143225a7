"""Operators for preparing training data: search, filtering, scoring, deduplication and mixing."""
