"""Operators for preparing language-model training data: filters, deduplication, encoding,
scoring and packing. Nothing else in the library imports this package."""
