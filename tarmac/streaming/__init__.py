"""Structured Streaming: incremental maintenance of the flight summary."""
