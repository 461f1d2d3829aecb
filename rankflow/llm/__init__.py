"""Operators for training-data pipelines: search, deduplication, classifiers, secrets, tokens, packing."""
