"""Incremental batches as a Structured Streaming source."""
