"""Structured Streaming forms of the landing and merge steps."""
