"""Readers, writers, stores and configuration tables."""
