"""Structured Streaming forms of ingest, totals, deduplication and counts."""
