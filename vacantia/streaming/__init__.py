"""Streaming of the posting engine."""
