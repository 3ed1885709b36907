"""Operators that prepare training data: deduplication, filters, tokens, packing, models and search."""
