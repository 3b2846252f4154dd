"""Incremental ingest of landed batch files with Structured Streaming."""
