"""Incremental ingest with Structured Streaming (the daily batch jobs run as
an available-now stream over a landing folder)."""
