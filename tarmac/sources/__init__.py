"""Readers and writers: raw files, partitioned tables, catalog tables."""
