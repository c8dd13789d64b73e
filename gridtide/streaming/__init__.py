"""Structured Streaming forms of the rules and of the daily mart."""
