"""Operators that prepare training data: cleaning, deduplication, scans and packing."""
