"""Streaming ingest."""
