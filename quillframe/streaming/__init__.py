"""Structured Streaming forms of incremental ingest and triggers."""
