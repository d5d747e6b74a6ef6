"""Structured Streaming jobs over the event bus."""
