"""Incremental (streaming) import of record files."""
