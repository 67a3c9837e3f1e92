"""Structured Streaming jobs (SRC8, ST1-ST5)."""
