"""Structured Streaming: texts arriving over time are coded incrementally into the response store."""
