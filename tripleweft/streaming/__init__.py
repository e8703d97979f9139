"""Structured Streaming jobs around the mapping."""
