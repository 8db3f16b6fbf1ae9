"""Incremental ingest of newly arrived drop files."""
