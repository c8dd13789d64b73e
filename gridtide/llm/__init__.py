"""Operators for preparing text corpora: cleaning, deduplication, scoring, encoding and packing."""
