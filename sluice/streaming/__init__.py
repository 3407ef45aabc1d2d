"""Structured Streaming: stateful processors and continuous jobs."""
