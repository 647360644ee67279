"""Structured Streaming jobs; with ``availableNow`` each also serves as an incremental batch job."""
