"""Structured Streaming ingest of broker records into the Bronze table."""
