"""Structured Streaming ingest of price payloads (the reference's fetch loop, as a stream)."""
