"""Structured Streaming trigger for incremental loads."""
