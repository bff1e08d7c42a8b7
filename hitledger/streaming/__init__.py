"""Structured Streaming forms of landing and of the daily counts."""
