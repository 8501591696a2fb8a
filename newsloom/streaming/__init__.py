"""Structured Streaming ingest of the article log."""
