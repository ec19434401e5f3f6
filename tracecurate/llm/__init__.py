"""Corpus operators for training data: deduplication, encoding, scoring, search, sharding."""
