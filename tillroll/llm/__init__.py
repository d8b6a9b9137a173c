"""Operators for training data: cleaning, deduplication, tokens, private data, sharding."""
