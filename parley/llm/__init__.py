"""Operators for large training corpora: dedup, filters, mixing, search and archives."""
