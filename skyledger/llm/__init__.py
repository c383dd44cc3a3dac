"""Corpus operators for training data: scoring, tokens, shards, duplicates, filters, personal data."""
