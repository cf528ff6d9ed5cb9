"""Structured Streaming jobs over listing messages."""
