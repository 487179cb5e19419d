"""Structured Streaming jobs: landing, change capture per micro-batch, dedupe, windowed counts."""
