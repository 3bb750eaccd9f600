"""Structured Streaming form of the page intake."""
