"""Incremental, lossless and replay-safe extraction of tables into deterministic event pages, on Spark."""
