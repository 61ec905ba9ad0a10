"""Streaming forms of the data products."""
