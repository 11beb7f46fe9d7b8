"""Structured Streaming forms of the row builders and run-log summaries."""
