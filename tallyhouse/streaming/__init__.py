"""Structured Streaming ingest and incremental gold tables."""
