"""Structured Streaming queries over arriving checkpoint files."""
