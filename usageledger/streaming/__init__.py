"""Structured Streaming versions of incremental loading."""
