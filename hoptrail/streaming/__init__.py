"""Streaming ingest, the recent-window table and streaming statistics."""
