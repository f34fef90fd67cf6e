"""Operators for preparing training data: dedup, filters, mixing, packing."""
