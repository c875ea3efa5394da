"""Readers, writers, generators, ingest checks, feature store and run log."""
