"""Incremental ingest of newly landed trip files with Structured Streaming."""
