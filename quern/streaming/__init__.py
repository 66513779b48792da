"""Bounded and continuous ingestion with Structured Streaming."""
