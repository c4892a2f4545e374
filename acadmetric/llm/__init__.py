"""Operators for training-data pipelines: deduplication, extraction, filtering, encoding and sharding of documents."""
