"""Whole-table operations: ingest a snapshot, publish, consolidate, read, repair."""
