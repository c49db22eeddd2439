"""Structured Streaming: ingest, deduplication, live traffic."""
