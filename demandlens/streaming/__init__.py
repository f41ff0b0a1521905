"""Structured Streaming variants of batch operators (the reference has no streams)."""
