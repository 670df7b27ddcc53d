"""Incremental ingest of the landing zone with Structured Streaming."""
