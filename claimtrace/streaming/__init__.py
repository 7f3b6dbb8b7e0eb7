"""Micro-batch ingestion with Structured Streaming."""
