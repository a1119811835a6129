"""Structured Streaming flows around the batch operators."""
