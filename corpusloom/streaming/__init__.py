"""Keyed conversation state over Structured Streaming."""
