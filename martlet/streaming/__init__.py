"""Incremental landing with Structured Streaming."""

from martlet.streaming.incremental import start_incremental  # noqa: F401
