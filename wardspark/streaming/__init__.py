"""Structured Streaming queries and incremental jobs."""
