"""Operators for training-data pipelines: tokens, deduplication, filters, packing."""
