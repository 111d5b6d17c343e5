"""Incremental file ingest with Structured Streaming and the run history."""
