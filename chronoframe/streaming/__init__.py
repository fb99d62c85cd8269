"""Incremental point-in-time features on Structured Streaming."""
