"""Micro-batch ingest and stream monitoring."""
