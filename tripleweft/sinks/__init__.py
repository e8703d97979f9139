"""Serialisers and file sinks."""
