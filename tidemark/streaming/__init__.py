"""Ingest driven by Structured Streaming."""
