"""Structured Streaming: change feeds applied as they arrive."""
