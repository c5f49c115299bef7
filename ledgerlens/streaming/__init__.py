"""Structured Streaming versions of ingestion and per-wallet state."""
