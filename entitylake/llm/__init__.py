"""Operators that prepare training data: extraction, filtering, deduplication, mixing, encoding."""
