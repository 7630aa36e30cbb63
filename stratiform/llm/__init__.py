"""Corpus operators for training data: filtering, deduplication, sharding, mixing, archives and tokens."""
