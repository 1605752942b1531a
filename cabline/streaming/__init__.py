"""Structured Streaming versions of the jobs (append mode, event time, watermarks)."""
