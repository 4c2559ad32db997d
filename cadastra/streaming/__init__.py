"""Incremental ingest on Structured Streaming's file source."""
