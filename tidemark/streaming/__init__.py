"""Structured Streaming: incremental scans, delivery of sealed pages, deduplication."""
