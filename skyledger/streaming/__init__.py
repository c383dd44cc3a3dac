"""Structured Streaming jobs: the same operators behind a watermark."""
