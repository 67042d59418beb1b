"""Structured Streaming over landed payload files."""
