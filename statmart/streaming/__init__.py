"""Structured Streaming form of the daily ingest."""
