"""Incremental processing of arriving snapshots (Structured Streaming)."""
