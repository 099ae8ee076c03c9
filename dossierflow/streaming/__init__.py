"""Structured Streaming versions of the page and store plans."""
