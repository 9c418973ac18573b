"""Incremental ingest of landing files."""
