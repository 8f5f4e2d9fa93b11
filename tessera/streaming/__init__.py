"""Structured Streaming forms of the batch aggregates."""
