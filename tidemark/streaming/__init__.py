"""Structured Streaming counterparts of the batch counts."""
