"""Structured Streaming forms of the incremental steps."""
