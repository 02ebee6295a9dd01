"""Structured Streaming feeds."""
