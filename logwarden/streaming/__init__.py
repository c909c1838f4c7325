"""Structured Streaming jobs that share the batch column logic."""
