"""Incremental batch and Structured Streaming forms of the log operators."""
