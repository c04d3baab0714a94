"""Structured Streaming: incremental keyed loads."""
