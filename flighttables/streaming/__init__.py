"""Structured Streaming adapters (incremental ingest)."""
