"""Structured Streaming form of the strength refresh (incremental A3/A4 state)."""
